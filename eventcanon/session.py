"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE splits a hot join key over several tasks. Every left join of the views keeps the
    # event side on the left, which is the side AQE may split.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE prefer a hash join when every shuffled partition is small, saving the sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# Spark's own size of a shuffled partition, and ours: a task that sorts or hashes a few of them at once holds many times their packed
# size, so that a task's memory grew with the input until partitions had 64 MB. A session that says otherwise keeps its size.
ADVISED, SPARKS_OWN, PARTITION = "spark.sql.adaptive.advisoryPartitionSizeInBytes", ("64MB", "67108864b"), "16MB"
# The same for what a task reads of a file: newest rows and folds sort their rows before the shuffle too, and 128 MB of Parquet are
# gigabytes of parsed payloads, which spilled. Files are cut between row groups only.
SPLIT, SPARKS_SPLIT = "spark.sql.files.maxPartitionBytes", ("128MB", "134217728b", "134217728")
PLANNED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings to a session and return it.

    The session's broadcast threshold is kept, but holds for measured sizes only. Sizes guessed from Parquet files are far too small for
    rows that come out of JSON payloads: millions of them passed for less than 10 MB and went through the driver.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(ADVISED) in SPARKS_OWN:
        spark.conf.set(ADVISED, PARTITION)
    if spark.conf.get(SPLIT) in SPARKS_SPLIT:
        spark.conf.set(SPLIT, PARTITION)
    planned = spark.conf.get(PLANNED)
    if not planned.startswith("-"):
        if spark.conf.get(MEASURED, None) is None:
            spark.conf.set(MEASURED, planned)
        spark.conf.set(PLANNED, "-1")
    return spark


def checkpoint_root(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; `default` only where it is unset.

    A machine-local folder would be lost with its executor, so none is made up here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or default
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root
