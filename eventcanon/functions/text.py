"""Text helpers: NULL-safe regular expressions, token search, and templates as Columns."""

from __future__ import annotations

import re
import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def regex_group(col: str | Column, pattern: str, group: int = 1) -> Column:
    """`group` of the first match, NULL (not '') when nothing matches."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def sender_domain(email: str | Column) -> Column:
    return regex_group(email, r"@(.+)$")


def search_terms(query: str) -> list[str]:
    """The words of a search text, lower-cased."""
    terms = [t for t in re.split(r"[^\w]+", query.lower()) if t]
    if not terms:
        raise ValueError("empty search text")
    return terms


def text_words(text: str | Column) -> Column:
    """The lower-cased words of a text, and an empty one where it begins or ends with something else."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(text), r"[^\p{L}\p{N}_]+")


def contains_terms(text: str | Column, query: str) -> Column:
    """True where every whole word of `query` occurs as a word of `text`, ignoring case."""
    text = F.col(text) if isinstance(text, str) else text
    low = F.lower(text)
    terms = search_terms(query)
    # Most rows fail the plain substring test and are never split into words.
    found = F.lit(True)
    for t in terms:
        found = found & low.contains(t)
    words = text_words(text)
    whole = F.forall(F.array(*[F.lit(t) for t in terms]), lambda t: F.array_contains(words, t))
    return F.when(found, whole).otherwise(found)


def stringify(col: str | Column, dtype: str) -> Column:
    """Text form used by the exports: booleans are True/False, timestamps ISO, NULL stays NULL."""
    col = F.col(col) if isinstance(col, str) else col
    if dtype == "boolean":
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if dtype in ("timestamp", "timestamp_ntz"):
        whole = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        parts = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        text = F.when(parts.endswith(".000000"), whole).otherwise(parts)
        return F.concat(text, F.lit("+00:00")) if dtype == "timestamp" else text
    if dtype.startswith(("struct", "array", "map", "variant")):
        return F.to_json(col)
    return col.cast("string")


def template(text: str, null_text: str = "None", columns: Mapping[str, Column] | None = None) -> Column:
    """Compile ``"# {title}"`` into a Column; ``{{`` and ``}}`` are literal braces.

    `columns` overrides what a placeholder stands for. NULL prints as `null_text`.
    """
    parts: list[Column] = []
    for literal, field, spec, conversion in string.Formatter().parse(text):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if spec or conversion or not field:
                raise ValueError(f"only plain {{name}} placeholders are supported: {text!r}")
            value = (columns or {}).get(field)
            value = F.col(field) if value is None else value
            parts.append(F.coalesce(value.cast("string"), F.lit(null_text)))
    return F.concat(*parts) if parts else F.lit("")
