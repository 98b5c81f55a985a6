"""Continuous fold of a domain event log into current state.

The state table keeps, per field, the newest non-NULL value together with its place in the log
order. Combining two states takes the later of each field, so late, repeated and reordered events
give the same state as one fold over the whole log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventcanon.operators.latest import combine_folds, fold_with_order
from eventcanon.session import checkpoint_root
from eventcanon.sources.catalog import SnapshotTable

BUCKET = "key_bucket"


def fold_batch(
    state: SnapshotTable,
    events: DataFrame,
    key: str,
    fields: Sequence[str],
    order: Sequence[str] = ("occurred_at", "event_id"),
    version: str = "event_id",
    buckets: int = 256,
) -> int:
    """Fold `events` into the state table; only the key buckets that occur in them are rewritten.

    The number of buckets is the table's: `buckets` counts when the table is made, and is read from it afterwards.
    """
    buckets = state.properties().get("buckets", buckets)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    fresh = fold_with_order(events, key, fields, order, version).withColumn(BUCKET, bucket)
    if not state.exists():
        return state.replace(fresh, properties={"buckets": buckets})

    def combine(current: DataFrame) -> DataFrame:
        both = current.drop(BUCKET).unionByName(fresh.drop(BUCKET))
        return combine_folds(both, key, fields).withColumn(BUCKET, bucket)

    return state.replace_touched(combine, events.select(bucket.alias(BUCKET)))


def start_fold(
    events: DataFrame,
    state: SnapshotTable,
    key: str,
    fields: Sequence[str],
    order: Sequence[str] = ("occurred_at", "event_id"),
    version: str = "event_id",
    buckets: int = 256,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Run `fold_batch` for every micro-batch of a streaming DataFrame, until the input is used up."""

    def each(batch: DataFrame, batch_id: int) -> None:
        fold_batch(state, batch, key, fields, order, version, buckets)

    spark = events.sparkSession
    where = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/fold{state.path.replace(':', '')}"
    return events.writeStream.foreachBatch(each).option("checkpointLocation", where).trigger(availableNow=True).start()
