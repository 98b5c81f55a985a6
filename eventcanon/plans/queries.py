"""The registered queries: every operator on the given tables, each with SQL for the same result.

The Spark side goes through the library's own base tables (JSON payloads and all); the SQL works on
the plain columns. The SQL is written for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcanon.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return plain(fn(tune(spark), sf))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every client reads alike: wall-clock times, arrays as text."""
    out = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "timestamp":
            out[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif kind == "array<string>":
            out[f.name] = F.array_join(f.name, ",")
    return df.withColumns(out) if out else df


def load_all() -> None:
    """Import the modules that register queries."""
    from eventcanon.plans import queries_changes, queries_core, queries_reports, queries_tables, queries_views, queries_writes  # noqa: F401
