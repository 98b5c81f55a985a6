"""Incremental reads: source rows that a target has not seen, or has seen in an older state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.keys import suffixed
from eventcanon.sources.reads import Filters, predicate


def _wanted_key(source_key: str, suffix: str | None) -> Column:
    # The suffix is added on the source side, so the join stays an equality join.
    return suffixed(source_key, suffix) if suffix else F.col(source_key)


def changed_rows(
    source: DataFrame,
    target: DataFrame,
    source_key: str,
    target_key: str,
    source_ts: str = "last_seen",
    target_ts: str = "canonicalized_at",
    suffix: str | None = None,
    filters: Filters | None = None,
    newer_than: str = "any",
    columns: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Source rows without a target row, or newer than the target row they have.

    The target is reduced to one time per key first, so a target with many rows per key neither
    repeats source rows nor sends a hot key's rows through the join. ``newer_than="any"`` keeps a
    row newer than at least one of its target rows, ``"all"`` one newer than every one of them.
    A row whose own time is NULL is not read again once it has a target row.

    Rows come unordered unless a `limit` asks for the first rows by key: what follows is a merge,
    which would throw a global sort away.
    """
    if newer_than not in ("any", "all"):
        raise ValueError("newer_than is 'any' or 'all'")
    pick = F.min if newer_than == "any" else F.max
    seen = (
        target.where(F.col(target_key).isNotNull())
        .groupBy(F.col(target_key).alias("__key"))
        .agg(pick(target_ts).alias("__seen_at"))
        .withColumn("__seen", F.lit(True))
    )
    rows = source.where(predicate(source, filters)).withColumn("__want", _wanted_key(source_key, suffix))
    out = rows.join(seen, F.col("__want") == F.col("__key"), "left").where(
        F.col("__seen").isNull() | (F.col(source_ts) > F.col("__seen_at"))
    )
    out = out.drop("__want", "__key", "__seen", "__seen_at")
    if limit:
        # Every column breaks ties, so a page is repeatable and a hot key can be split.
        ties = [F.col(c) for c in source.columns if c not in (source_key, source_ts)]
        ties = [c for c in ties if _orderable(source, c)]
        out = out.orderBy(F.col(source_key).asc_nulls_first(), F.col(source_ts), *ties).limit(limit)
    return out.select(*columns) if columns else out


def _orderable(df: DataFrame, col: Column) -> bool:
    return not df.select(col).schema[0].dataType.simpleString().startswith(("map", "variant"))


def missing_rows(
    source: DataFrame,
    target: DataFrame,
    source_key: str,
    target_key: str,
    suffix: str | None = None,
    filters: Filters | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Source rows whose key the target does not hold. A NULL key counts as not held."""
    # Distinct before the join: a key with many target rows leaves each map task once, and the
    # join uses the partitioning that the distinct has made.
    held = target.select(F.col(target_key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    rows = source.where(predicate(source, filters)).withColumn("__want", _wanted_key(source_key, suffix))
    out = rows.join(held, F.col("__want") == F.col("__key"), "left_anti").drop("__want")
    return out.select(*columns) if columns else out


def validated_not_canonized(
    raw: DataFrame, canonical: DataFrame, suffix: str | None = None, filters: Filters | None = None
) -> DataFrame:
    """Raw rows that passed validation and have no canonical row yet."""
    passed = raw.where(F.col("validation_status") == "pass")
    return missing_rows(passed, canonical, "idem_key", "idem_key", suffix, filters)
