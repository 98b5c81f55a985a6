"""Time helpers. Every time-relative operator takes `as_of`, so a run can be repeated."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Instant = datetime | str


def as_of_text(as_of: Instant | None) -> str:
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    if isinstance(as_of, datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat(sep=" ")
    return as_of


def as_of_lit(as_of: Instant | None, dtype: str = "timestamp") -> Column:
    """A literal instant of the compared column's own type.

    With equal types Spark keeps the comparison free of casts and pushes it to the scan.
    """
    return F.lit(as_of_text(as_of)).cast(dtype)


def dtype_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def ago(as_of: Instant | None, df: DataFrame, column: str, **interval: int) -> Column:
    """``as_of`` minus an interval, typed like ``df[column]``; negative values look ahead."""
    return as_of_lit(as_of, dtype_of(df, column)) - F.make_dt_interval(
        F.lit(interval.get("days", 0)), F.lit(interval.get("hours", 0))
    )


def text_to_timestamp(col: str | Column, strict: bool = False) -> Column:
    """ISO text to timestamp. Bad text gives NULL, or fails the query when `strict`."""
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("timestamp") if strict else col.try_cast("timestamp")


def text_to_long(col: str | Column, strict: bool = False) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("long") if strict else col.try_cast("long")


def parse_rfc2822(col: str | Column) -> Column:
    """``Tue, 02 Jan 2024 03:04:05 +0100`` to timestamp; the day name may be missing."""
    col = F.col(col) if isinstance(col, str) else col
    plain = F.regexp_replace(col, r"^\s*[A-Za-z]{3},\s*", "")
    return F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z"))


def iso_text(col: str | Column) -> Column:
    """Timestamp to ISO text in UTC; the fraction is left out when it is zero."""
    col = F.col(col) if isinstance(col, str) else col
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    parts = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.when(parts.endswith(".000000"), whole).otherwise(parts), F.lit("+00:00"))
