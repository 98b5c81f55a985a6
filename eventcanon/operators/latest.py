"""Newest row per key, and newest known value per field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _desc(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def latest_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], rows: int = 1
) -> DataFrame:
    """The newest row (or `rows` newest) of every key; names in `order` sort newest first.

    Rows with a NULL key form a group of their own. Give enough columns to decide ties. Spark keeps
    only the best rows of each key on the map side before the shuffle (a window group limit), so a
    key that holds a third of all rows ships one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= rows).drop("__rn")


def fold_latest(
    df: DataFrame,
    key: str,
    fields: Sequence[str],
    order: Sequence[str] = ("occurred_at", "event_id"),
    version: str | None = "event_id",
    key_name: str | None = None,
) -> DataFrame:
    """Current state of every key of an append-only log.

    Each field holds its newest non-NULL value by `order`; arrival order does not matter. Adds
    ``row_id`` (the key), ``row_version`` (`version` of the newest event) and ``row_state``.
    One shuffle, whatever the number of fields, with partial aggregation before it: a hot key ships one row per task.
    Text fields make Spark aggregate over sorted rows, before and after the shuffle.
    """
    at = F.struct(*[F.col(c) for c in order])
    aggs = [F.max_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields]
    if version:
        aggs.append(F.max_by(F.col(version), at).alias("row_version"))
    out = df.groupBy(F.col(key).alias(key_name or key)).agg(*aggs)
    out = out.withColumn("row_id", F.col(key_name or key)).withColumn("row_state", F.lit("synced"))
    tail = ["row_id", *(["row_version"] if version else []), "row_state"]
    return out.select(key_name or key, *fields, *tail)


def fold_with_order(df: DataFrame, key: str, fields: Sequence[str], order: Sequence[str], version: str) -> DataFrame:
    """Like `fold_latest`, but keeps each field as ``struct(at, value)`` so folds can be combined.

    The result is a fold state: folding the union of two states gives the state of all events.
    """
    at = F.struct(*[F.col(c) for c in order])
    aggs = [
        F.max(F.when(F.col(f).isNotNull(), F.struct(at.alias("at"), F.col(f).alias("value")))).alias(f)
        for f in fields
    ]
    aggs.append(F.max(F.struct(at.alias("at"), F.col(version).alias("value"))).alias("row_version"))
    return df.groupBy(key).agg(*aggs)


def combine_folds(states: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Combine fold states of the same keys. Associative, commutative and idempotent."""
    return states.groupBy(key).agg(*[F.max(f).alias(f) for f in [*fields, "row_version"]])


def fold_values(state: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """A fold state as the plain rows `fold_latest` gives."""
    return state.select(
        key,
        *[F.col(f"{f}.value").alias(f) for f in fields],
        F.col(key).alias("row_id"),
        F.col("row_version.value").alias("row_version"),
        F.lit("synced").alias("row_state"),
    )
