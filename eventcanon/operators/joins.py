"""Left joins that keep working when one key, or NULL, holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys holding more than `share` of the rows: at most ``1 / share`` of them by arithmetic."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*").alias("__total"))
    return counts.where(F.col("__n") > total.scalar() * F.lit(share)).select(F.col(key).alias("__hot"))


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: int = 64,
    hot_share: float | None = None,
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``; both key columns stay.

    Rows whose key is NULL match nothing, yet a plain join sends them all to one task. They get a
    second join key that spreads them over `spread` groups. Whether `right` is broadcast stays
    Spark's choice, by its size.

    A hot key on the left is split by AQE at run time. With `hot_share` it is also split in the
    plan itself: keys above that share are found first (at most ``1 / hot_share`` of them, which
    bounds the broadcast), their left rows are spread over `spread` groups, and only *their* right
    rows are repeated. Worth it when the join feeds an operator that needs its partitioning, where
    AQE leaves skew alone.
    """
    salt = F.pmod(F.xxhash64(*[c for c in left.columns if _hashable(left, c)]), F.lit(spread)).cast("int")
    if hot_share is None:
        salted = left.withColumn("__salt", F.when(F.col(left_key).isNull(), salt).otherwise(0))
        other = right.where(F.col(right_key).isNotNull()).withColumn("__rsalt", F.lit(0))
        return _salted_join(salted, other, left_key, right_key)
    hot = F.broadcast(hot_keys(left, left_key, hot_share))
    marked = left.join(hot, F.col(left_key) == F.col("__hot"), "left")
    spreads = F.col(left_key).isNull() | F.col("__hot").isNotNull()
    salted = marked.withColumn("__salt", F.when(spreads, salt).otherwise(0)).drop("__hot")
    other = right.where(F.col(right_key).isNotNull()).join(hot, F.col(right_key) == F.col("__hot"), "left")
    groups = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    other = other.withColumn("__rsalt", F.explode(groups)).drop("__hot")
    return _salted_join(salted, other, left_key, right_key)


def _salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    on: Column = (F.col(left_key) == F.col(right_key)) & (F.col("__salt") == F.col("__rsalt"))
    return left.join(right, on, "left").drop("__salt", "__rsalt")


def _hashable(df: DataFrame, name: str) -> bool:
    text = df.schema[name].dataType.simpleString()
    return "map<" not in text and "variant" not in text
