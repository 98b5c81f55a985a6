"""Reads over key-columned tables: filters, pages, cursors and windows."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcanon.functions.json import parse_json_columns
from eventcanon.functions.time import iso_text

_OPS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    ">": operator.gt,
    "<=": operator.le,
    ">=": operator.ge,
}
_ORDER = re.compile(r"^(.*?)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?$", re.I | re.S)

Filters = Mapping[str, object] | Sequence[Mapping[str, object]]


def predicate(df: DataFrame, filters: Filters | None) -> Column:
    """All filters ANDed. ``{col: value}`` tests equality; ``[{column, op, value}]`` compares.

    Values may come as text; they are cast to the type of the column they are compared with.
    """
    if not filters:
        return F.lit(True)
    if isinstance(filters, Mapping):
        filters = [{"column": c, "value": v} for c, v in filters.items()]
    tests = []
    for f in filters:
        op = f.get("op", "=")
        if op not in _OPS:
            raise ValueError(f"unknown comparison {op!r}; use one of {' '.join(_OPS)}")
        name = f["column"]
        value = F.lit(str(f["value"]) if not isinstance(f["value"], str) else f["value"])
        tests.append(_OPS[op](F.col(name), value.cast(df.schema[name].dataType)))
    return reduce(operator.and_, tests)


def sort_columns(order_by: str | Sequence[str | Column]) -> list[Column]:
    """``"last_seen DESC, idem_key"`` or a list. NULLs come first ascending, last descending."""
    items = re.split(r",(?![^(]*\))", order_by) if isinstance(order_by, str) else order_by
    out = []
    for item in items:
        if isinstance(item, Column):
            out.append(item)
            continue
        name, direction, nulls = _ORDER.match(item.strip()).groups()
        down = (direction or "").upper() == "DESC"
        suffix = f"_nulls_{nulls.lower()}" if nulls else ("_nulls_last" if down else "_nulls_first")
        out.append(getattr(F.expr(name), ("desc" if down else "asc") + suffix)())
    return out


def read_table(
    df: DataFrame,
    columns: Sequence[str] = ("*",),
    filters: Filters | None = None,
    order_by: str | Sequence[str | Column] | None = None,
    limit: int | None = None,
    key: str = "idem_key",
) -> DataFrame:
    """Filter, project, order and page a table.

    `columns` takes SQL expressions, aggregates included. A limit without an order pages by `key`,
    so the page is the same on every run.
    """
    out = df.where(predicate(df, filters))
    if order_by is None and limit:
        order_by = [F.col(key).asc_nulls_first()]
    plain = all(c == "*" or c in df.columns for c in columns)
    if order_by is not None and plain:
        out = out.orderBy(*sort_columns(order_by))  # before the projection: the key may be dropped
    out = out.selectExpr(*columns)
    if order_by is not None and not plain:
        out = out.orderBy(*sort_columns(order_by))
    return out.limit(int(limit)) if limit else out


def query_raw_objects(
    raw: DataFrame, source_system: str, object_type: str, filters: Filters | None = None, limit: int | None = None
) -> DataFrame:
    base = raw.where((F.col("source_system") == source_system) & (F.col("object_type") == object_type))
    return read_table(base, filters=filters, limit=limit)


def query_canonical_objects(
    canonical: DataFrame, canonical_schema: str, filters: Filters | None = None, limit: int | None = None
) -> DataFrame:
    return read_table(canonical.where(F.col("canonical_schema") == canonical_schema), filters=filters, limit=limit)


def with_parsed_json(df: DataFrame, columns: list[str]) -> DataFrame:
    """JSON text columns as VARIANT; unreadable text is kept in ``<name>_raw``."""
    return parse_json_columns(df, columns)


def with_iso_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp column as ISO text."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({n: iso_text(n) for n in names})


def cursor(
    df: DataFrame, source_system: str, connection_name: str, object_type: str, ts: str = "last_seen"
) -> DataFrame:
    """One row: the newest `ts` of one stream; NULL when it was never synced."""
    mine = (
        (F.col("source_system") == source_system)
        & (F.col("connection_name") == connection_name)
        & (F.col("object_type") == object_type)
    )
    return df.where(mine).agg(F.max(ts).alias("since"))


def cursors(
    df: DataFrame,
    stream: Sequence[str] = ("source_system", "connection_name", "object_type"),
    ts: str = "last_seen",
) -> DataFrame:
    """The newest `ts` of every stream at once."""
    return df.groupBy(*stream).agg(F.max(ts).alias("since"))


def backfill_window(
    df: DataFrame, stream: Sequence[str] = (), ts: str = "last_seen", days: int = 30
) -> DataFrame:
    """The `days` before the oldest row: ``until`` is that row's time, ``since`` lies before it."""
    return (
        df.groupBy(*stream)
        .agg(F.min(ts).alias("until"))
        .withColumn("since", F.col("until") - F.make_dt_interval(F.lit(days)))
    )


def unvalidated(raw: DataFrame, source_system: str, object_type: str) -> DataFrame:
    mine = (F.col("source_system") == source_system) & (F.col("object_type") == object_type)
    return raw.where(mine & F.col("validation_status").isNull())


def landed_objects(spark: SparkSession, path: str, text: str = "payload") -> DataFrame:
    """Landed files with one JSON object per line. Lines stay text, so no schema is inferred."""
    rows = spark.read.text(path)
    return rows.where(F.trim("value") != "").select(F.col("value").alias(text))


def landed_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same files read with a known schema; unreadable lines go to ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").json(path, columnNameOfCorruptRecord="_corrupt")


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a registered view, for export."""
    return spark.table(name)
