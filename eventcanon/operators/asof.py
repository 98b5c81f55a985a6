"""As-of join: each row with what was valid at its time."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = 86_400


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _known(columns: Sequence[str]) -> Column:
    return reduce(operator.and_, [F.col(c).isNotNull() for c in columns])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    order: Sequence[str] = (),
    prefix: str = "",
    bucket_seconds: int = DAY,
    tolerance_seconds: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Every row of `left`, with the columns of the newest `right` row of the same keys whose time is not after its own.

    `strict` takes only rows from before. Right rows of one time are decided by `order`, the largest last. A match older than
    `tolerance_seconds` is none. A left row without keys or time matches nothing, a right row without them is never matched. Columns
    of `right` other than the keys are named with `prefix`; a name that `left` has raises.

    Both sides are united by key and time bucket and read in order of time, so a key with very many rows is spread over its buckets. What
    was valid at the start of a bucket is carried into it from the last earlier one: that takes one row per key and bucket,
    summed before it is dealt. Choose `bucket_seconds` so that a key's rows of one bucket fit a task.
    """
    values = [c for c in right.columns if c not in keys]
    names = [prefix + c for c in values]
    clash = {n.lower() for n in names} & {c.lower() for c in left.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are on both sides; give a prefix")
    ks = [f"__k{i}" for i in range(len(keys))]
    width = bucket_seconds * 1_000_000
    at = {"__at": F.col("__at"), "__bucket": F.floor(F.col("__at") / F.lit(width)).cast("long")}

    every = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__row"), *[F.col(k).alias(n) for k, n in zip(keys, ks)], _micros(left_time).alias("__at"))
    usable = _known([*ks, "__at"])
    said = F.struct(_micros(right_time).alias("at"), F.struct(*[F.col(o) for o in order], F.lit(0).alias("__o")).alias("o"), F.struct(*[F.col(f"`{c}`") for c in values]).alias("v"))
    held = right.select(*[F.col(k).alias(n) for k, n in zip(keys, ks)], _micros(right_time).alias("__at"), said.alias("__said")).where(usable).withColumns(at)
    asked = every.where(usable).withColumns(at)
    # At one time, what is asked comes after what is said, or before it if only earlier rows count.
    side = {"asked": 0 if strict else 1, "said": 1 if strict else 0}
    both = asked.withColumn("__side", F.lit(side["asked"])).unionByName(held.withColumn("__side", F.lit(side["said"])), allowMissingColumns=True)
    so_far = W.partitionBy(*ks, "__bucket").orderBy("__at", "__side", F.col("__said.o").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = both.withColumn("__in", F.last("__said", ignorenulls=True).over(so_far)).where(F.col("__row").isNotNull())

    spots = asked.select(*ks, "__bucket").distinct().withColumn("__last", F.lit(None).cast(held.schema["__said"].dataType))
    lasts = held.groupBy(*ks, "__bucket").agg(F.max_by("__said", F.struct("__at", "__said.o")).alias("__last"))
    by_bucket = spots.unionByName(lasts).groupBy(*ks, "__bucket").agg(F.first("__last", ignorenulls=True).alias("__last"))
    before = W.partitionBy(*ks).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = by_bucket.select(*[F.col(k).alias(f"{k}c") for k in ks], F.col("__bucket").alias("__c"), F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    same = reduce(operator.and_, [F.col(k) == F.col(f"{k}c") for k in ks] + [F.col("__bucket") == F.col("__c")])
    matched = inside.join(carried, same, "left").select("__row", "__at", F.coalesce("__in", "__carried").alias("__m"))
    matched = matched.unionByName(every.where(~usable).select("__row", "__at"), allowMissingColumns=True)
    if tolerance_seconds is not None:
        near = F.col("__at") - F.col("__m.at") <= F.lit(tolerance_seconds * 1_000_000)
        matched = matched.withColumn("__m", F.when(near, F.col("__m")))
    return matched.select("__row.*", *[F.col("__m.v").getField(c).alias(n) for c, n in zip(values, names)])
