"""Exact deduplication as a stream with keyed state on disk.

A stream reads the table's files and keeps, for each digest of a text, the stable identifier (the largest doc_id), a
locator of its content (file and row) and the number of rows: a streaming aggregate in the RocksDB state store, which
lives on the executors' disks, is saved to the shared folder with each batch, and never expires (there is no watermark).
Each batch writes the changed states. Rows whose digest is held by more than one row are then checked byte for byte
against the content their state points to; rows that differ (a digest met twice) form groups by their whole text.

NULL counts as the empty text, texts are not changed before comparison, NULL ids come before all others.
Columns beside the id and the text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcanon.llm.common import cut, shared_folder, text_of

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "160",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # no space is set aside for each of the stores
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

STATES = "digest string, content struct<doc_id: bigint, file: string, row: bigint>, group_size bigint"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def digests(df: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Id, digest and locator of each row; the text as the last column."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), digest(text_of()).alias("digest"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"), text_of().alias("text"),
    )


def run_stream(spark: SparkSession, path: str, folder: str, digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """Feed the files at `path` through the state in `folder`; returns its states, one row per digest.

    A later call with the same folder goes on where the last one ended: only new files are read.
    """
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        # As a pattern, a path may name a single file or a folder of files.
        rows = digests(reader.parquet(f"{path[:-1]}[{path[-1]}]"), digest)
        state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("content"), F.count(F.lit(1)).alias("group_size"))

        def changed(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/states/batch={number}")

        spark.createDataFrame([], STATES).write.mode("overwrite").parquet(f"{folder}/states/batch=-1")
        running = state.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(changed).trigger(availableNow=True).start()
        running.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    states = spark.read.schema(STATES).parquet(f"{folder}/states")
    # A state only grows, so the largest of each digest is the newest.
    return states.groupBy("digest").agg(F.max("content").alias("content"), F.max("group_size").alias("group_size"))


def resolve(docs: DataFrame, states: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. `docs` is read from files."""
    rows = digests(docs, digest).withColumn("text_sha256", sha256(F.col("text")))
    held = states.select(F.col("digest").alias("digest"), "content", "group_size")
    here = (F.col("file") == F.col("content.file")) & (F.col("row") == F.col("content.row"))
    # Texts are dealt once; from then on only those of hits are carried.
    known = cut(rows.join(held, "digest", "left").select(
        "doc_id", "digest", "file", "row", "text_sha256", "group_size", F.col("content.doc_id").alias("keep_id"), here.alias("here"),
        F.when(F.col("group_size") > 1, F.col("text")).alias("text")))
    hits = known.where("group_size > 1")
    content = hits.where("here").select("digest", F.col("text").alias("content_text"))
    same = F.col("here") | F.col("text").eqNullSafe(F.col("content_text"))
    checked = cut(hits.join(content, "digest").withColumn("same", same).drop("text", "content_text"))
    alone = known.where("group_size = 1").drop("text")
    good = checked.where("same").drop("same")
    other = checked.where("not same").drop("same")
    if other.isEmpty():
        return _result(alone).union(_result(good))
    strays = other.groupBy("digest").agg(F.count(F.lit(1)).alias("strays"))
    good = good.join(strays, "digest", "left").withColumn("group_size", F.col("group_size") - F.coalesce("strays", F.lit(0)))
    texts = other.join(rows.select("digest", "file", "row", "text"), ["digest", "file", "row"])
    groups = texts.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("content"), F.count(F.lit(1)).alias("group_size"))
    apart = texts.drop("keep_id", "group_size", "here").join(groups, ["digest", "text"])
    apart = apart.withColumn("keep_id", F.col("content.doc_id")).withColumn("here", here)
    return _result(alone).union(_result(good)).union(_result(apart))


def _result(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "keep_id", "group_size", F.col("here").alias("kept"), "text_sha256")


def dedup(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Stream the table at `path` through a new state and resolve each of its rows."""
    folder = f"{shared_folder(spark)}/stream_dedup/{uuid.uuid4().hex}"
    return resolve(spark.read.parquet(path), run_stream(spark, path, folder, digest), digest)
