"""Upsert, delete and stamp, as functions from the current snapshot to the next one."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventcanon.operators.latest import latest_per_key
from eventcanon.sources.reads import Filters, predicate

ACTION = "_merge_action"


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, whose keys are not NULL: a row without a key could never be found again, so it fails the job."""
    missing = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    failed = F.raise_error(F.lit(f"a row has no {', '.join(keys)}")).cast("boolean")
    return df.where(F.when(missing, failed).otherwise(True))


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None) -> DataFrame:
    """At most one source row per key: the newest by `order`, or a failure without an order. NULL keys fail."""
    source = with_keys(source, keys)
    if order:
        return latest_per_key(source, keys, order)
    # Two rows of a key are enough to know; the limit runs before the shuffle.
    w = W.partitionBy(*keys).orderBy(*keys)
    ranked = source.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= 2)
    twice = F.raise_error(F.lit(f"several source rows with the same {', '.join(keys)}"))
    return ranked.where(F.when(F.col("__rn") > 1, twice.cast("boolean")).otherwise(True)).drop("__rn")


def _same(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(operator.and_, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    skip_update: Sequence[str] = ("first_seen", "created_at"),
    order: Sequence[str | Column] | None = None,
    with_action: bool = False,
) -> DataFrame:
    """The snapshot after an upsert of `source` into `target`.

    Matched rows take `update_columns` (default: all source columns but keys and `skip_update`) from
    the source, unmatched source rows are added, other target rows stay. Source rows are reduced to
    one per key by `order`. `with_action` adds ``_merge_action``: insert, update or keep.

    One plan whatever the sizes: the target takes its updates by a left join, and the batch loses the keys that the target holds by
    an anti join with those. Spark broadcasts the batch by its own threshold, and then the target is not shuffled at all.
    Target keys are unique, source keys are made unique, so no task sees more than two rows per key.
    """
    source = one_per_key(source, keys, order)
    columns = target.columns
    if update_columns is None:
        update_columns = [c for c in source.columns if c not in keys and c not in skip_update]
    update = set(update_columns) & set(source.columns)
    unknown = set(source.columns) - set(columns)
    if unknown:
        raise ValueError(f"source columns {sorted(unknown)} are not in the target")
    types = {f.name: f.dataType for f in target.schema.fields}
    source = source.select(*[F.col(c).cast(types[c]).alias(c) for c in source.columns])

    out = _merge(target, source, keys, columns, update, types)
    return out if with_action else out.drop(ACTION)


def _sided(df: DataFrame, flag: str) -> DataFrame:
    return df.withColumn(flag, F.lit(True))


def _merge(target, source, keys, columns, update, types) -> DataFrame:
    s = _sided(source, "__s").alias("s")
    hit = F.col("s.__s").isNotNull()
    kept = target.alias("t").join(s, _same("t", "s", keys), "left").select(
        *[
            (F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in update else F.col(f"t.{c}")).alias(c)
            for c in columns
        ],
        F.when(hit, F.lit("update")).otherwise(F.lit("keep")).alias(ACTION),
    )
    # The target's keys that the batch holds: never more rows than the batch has.
    held = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    new = source.join(held, list(keys), "left_anti").select(
        *[(F.col(c) if c in source.columns else F.lit(None).cast(types[c])).alias(c) for c in columns],
        F.lit("insert").alias(ACTION),
    )
    return kept.unionByName(new)


def merge_counts(merged: DataFrame) -> DataFrame:
    """True counts of a merge made ``with_action``: inserted, updated, deleted, unchanged."""
    a = F.col(ACTION)
    return merged.agg(
        F.count_if(a == "insert").alias("rows_inserted"),
        F.count_if(a == "update").alias("rows_updated"),
        F.count_if(a == "delete").alias("rows_deleted"),
        F.count_if(a == "keep").alias("rows_kept"),
    )


def delete_where(target: DataFrame, filters: Filters) -> DataFrame:
    """The snapshot without the rows the filters hold for. A row they are NULL for stays."""
    return target.where(~F.coalesce(predicate(target, filters), F.lit(False)))


def stamp(
    target: DataFrame, stamps: DataFrame, keys: Sequence[str], columns: Sequence[str], constants: dict | None = None
) -> DataFrame:
    """Set `columns` (and `constants`) on target rows that have a stamp row; insert nothing.

    Two stamps for one key fail the job: which one should win is not for this operator to guess.
    """
    stamps = _sided(one_per_key(stamps.select(*keys, *columns), keys, None), "__s").alias("s")
    hit = F.col("s.__s").isNotNull()
    constants = constants or {}
    types = {f.name: f.dataType for f in target.schema.fields}

    def pick(c: str) -> Column:
        mine = F.col(f"t.{c}")
        if c in columns:
            return F.when(hit, F.col(f"s.{c}").cast(types[c])).otherwise(mine)
        if c in constants:
            return F.when(hit, F.lit(constants[c]).cast(types[c])).otherwise(mine)
        return mine

    joined = target.alias("t").join(stamps, _same("t", "s", keys), "left")
    return joined.select(*[pick(c).alias(c) for c in target.columns])


def new_rows_only(existing: DataFrame, batch: DataFrame, key: str, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Rows of `batch` to append so that no `key` is appended twice, now or on a repeat.

    Of several rows with one key the newest by `order` is taken; without an order, the one with the largest columns, in their
    order. A NULL key fails the job.
    """
    fresh = with_keys(batch, [key]).join(existing.select(key).distinct(), [key], "left_anti")
    if order is None:
        order = [F.col(f.name) if f.dataType.simpleString().split("<")[0] not in ("map", "variant") else F.col(f.name).cast("string") for f in batch.schema.fields if f.name != key]
    return latest_per_key(fresh, [key], order) if order else fresh.dropDuplicates([key])
