"""Continuous landing: new files of JSON lines are shaped and merged, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventcanon.functions.json import with_json
from eventcanon.functions.time import Instant
from eventcanon.operators.latest import latest_per_key
from eventcanon.operators.merge import merge_into
from eventcanon.operators.shape import bad_rows, good_rows, raw_rows
from eventcanon.session import checkpoint_root
from eventcanon.sources.catalog import SnapshotTable


def merge_batch(table: SnapshotTable, batch: DataFrame, keys: list[str], order: list[str], order_path: str | None = None) -> int:
    """Merge one batch into a table. The same batch twice gives the same rows; keys may move to other partitions."""
    if not table.exists():
        return table.replace(merge_into(batch.limit(0), batch, keys, order=order))
    return table.replace_touched(lambda rows: merge_into(rows, newer(rows, batch, keys, order_path), keys, order=order), batch, keys)


def newer(rows: DataFrame, batch: DataFrame, keys: list[str], order_path: str | None) -> DataFrame:
    """Rows of `batch` but those whose key has a later state in `rows` already, by the text at `order_path` of the payload."""
    if not order_path:
        return batch
    held = with_json(rows.select(*keys, "payload"), values={"__held": order_path}).select(*keys, "__held")
    given = with_json(batch, values={"__given": order_path}).join(held, keys, "left")
    return given.where(F.col("__held").isNull() | (F.coalesce("__given", F.lit("")) >= F.col("__held"))).drop("__given", "__held")


def start_ingest(
    spark: SparkSession,
    path: str,
    table: SnapshotTable,
    source_system: str,
    connection_name: str,
    object_type: str,
    id_path: str | None = None,
    rejects: str | None = None,
    checkpoint: str | None = None,
    max_files: int | None = None,
    as_of: Instant | None = None,
    order_path: str | None = None,
) -> StreamingQuery:
    """Land every file below `path` that has not been landed, then stop.

    Among several states of one object in a batch the one with the largest text at `order_path`
    wins (say, its time of change), then the line from the newest file, then the larger text; a state older than the
    table's is left out, so that the result does not depend on how files fall into batches. Rows without an id go to `rejects` if given. A batch that is run again after a
    failure is harmless: the merge is idempotent.
    """
    name = f"ingest/{source_system}/{connection_name}/{object_type}"
    where = (checkpoint or f"{checkpoint_root(spark).rstrip('/')}/{name}").rstrip("/")
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(path).select(
        F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("__file_time")
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        run = f"{name}#{batch_id}"
        rows = raw_rows(
            batch.where(F.trim("payload") != ""), source_system, connection_name, object_type, id_path,
            correlation_id=run, as_of=as_of, keep=["__file_time"],
        )
        if order_path:
            rows = with_json(rows, values={"__order": order_path})
        order = [*(["__order"] if order_path else []), "__file_time", "payload"]
        if rejects:
            bad = bad_rows(rows).drop("__order", "__file_time")
            # Named by batch, so a repeated batch replaces its own rejects.
            bad.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/batch={batch_id}")
        newest = latest_per_key(good_rows(rows), ["idem_key"], order).drop("__order", "__file_time")
        # Shaped once: the merge reads the batch several times. Named by batch, so a repeated batch replaces its own rows.
        staged = f"{where}-staged/batch={batch_id}"
        newest.write.mode("overwrite").parquet(staged)
        newest = batch.sparkSession.read.parquet(staged)
        merge_batch(table, newest, ["idem_key"], ["last_seen"], order_path)

    return (
        lines.writeStream.foreachBatch(each).option("checkpointLocation", where).trigger(availableNow=True).start()
    )
