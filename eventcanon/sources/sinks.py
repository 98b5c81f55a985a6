"""Writers and the row forms they write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.text import stringify
from eventcanon.functions.time import Instant, as_of_lit, as_of_text
from eventcanon.operators.merge import new_rows_only

EVENT_REQUIRED = ("event_type", "source_system", "correlation_id")
EVENT_OPTIONAL = (
    "connection_name", "target_object_type", "event_schema_ref", "trace_id", "error_message", "payload",
)


def event_rows(df: DataFrame, as_of: Instant | None = None, status: str = "ok") -> DataFrame:
    """Rows for the event log: new id, time, status; empty optional text becomes NULL.

    A row without one of the required fields fails the job.
    """
    missing = [c for c in EVENT_REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"event rows need {missing}")

    def required(c: str) -> Column:
        bad = F.col(c).isNull() | (F.col(c) == "")
        return F.when(bad, F.raise_error(F.lit(f"{c} must be a non-empty string"))).otherwise(F.col(c)).alias(c)

    def optional(c: str) -> Column:
        if c not in df.columns:
            return F.lit(None).cast("string").alias(c)
        return F.when(F.col(c) != "", F.col(c)).alias(c)

    state = F.coalesce("status", F.lit(status)) if "status" in df.columns else F.lit(status)
    return df.select(
        F.expr("uuid()").alias("event_id"),
        *[required(c) for c in EVENT_REQUIRED],
        as_of_lit(as_of).alias("created_at"),
        state.alias("status"),
        *[optional(c) for c in EVENT_OPTIONAL],
    )


def append_log(
    df: DataFrame,
    path: str,
    time_column: str = "created_at",
    cluster_by: Sequence[str] = ("source_system", "event_type"),
    date_column: str = "created_date",
) -> None:
    """Append to a log laid out by day, sorted inside files by the cluster columns.

    The range exchange covers day, cluster columns and time, so one busy day or one busy stream is
    cut into many files; row-group statistics on the cluster columns then skip most of a day.
    """
    keys = [date_column, *cluster_by, time_column]
    out = df.withColumn(date_column, F.to_date(time_column))
    out.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("append").partitionBy(date_column).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_once(existing: DataFrame, batch: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key is not there yet; repeating a batch appends nothing."""
    new_rows_only(existing, batch, key).write.mode("append").parquet(path)


def sync_rows(df: DataFrame, as_of: Instant | None = None) -> DataFrame:
    """Every column as text and a ``projected_at`` column, the form of a full-replace export."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(
        *[stringify(c, types[c]).alias(c) for c in df.columns], F.lit(as_of_text(as_of)).alias("projected_at")
    )


def replace_table(df: DataFrame, path: str, as_of: Instant | None = None) -> None:
    sync_rows(df, as_of).write.mode("overwrite").parquet(path)


def sheet_rows(df: DataFrame, column_order: Sequence[str] | None = None) -> DataFrame:
    """Columns in sheet order, as text; NULL is an empty cell."""
    columns = list(column_order or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*[F.coalesce(stringify(c, types[c]), F.lit("")).alias(c) for c in columns])


def write_sheet(df: DataFrame, path: str, column_order: Sequence[str] | None = None) -> bool:
    """Replace a sheet (CSV with header). An empty input writes nothing and returns False."""
    rows = sheet_rows(df, column_order)
    if rows.isEmpty():
        return False
    rows.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return True


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_files(files: DataFrame, root: str) -> None:
    """Write each (path, content) row as a file below `root`, which every executor can reach.

    Tasks write their own rows; a repeated task writes the same bytes again. For millions of rows
    keep the (path, content) table instead: small files are slow to list and to read.
    """

    def save(rows) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for row in rows:
            target = f"{base.rstrip('/')}/{row.path.lstrip('/')}"
            store.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(target) as out:
                out.write(row.content.encode())

    files.select("path", "content").foreachPartition(save)


def dry_run(df: DataFrame, key: str = "idem_key") -> tuple[int, list[str]]:
    """How many rows a write would touch, and three of their keys; nothing is written."""
    return df.count(), [r[0] for r in df.select(key).limit(3).collect()]
