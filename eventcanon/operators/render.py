"""Rows to text: files with front matter, and messages. Templates become Column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.keys import send_key
from eventcanon.functions.text import template
from eventcanon.functions.time import Instant, as_of_text

# Plain YAML scalars that would be read back as something other than text.
_NOT_TEXT = r"(?i)^(~|null|true|false|yes|no|on|off|[-+]?(\d[\d_]*)?\.?\d+([eE][-+]?\d+)?|\d{4}-\d\d?-\d\d?([Tt ].*)?|[-+]?(\d+:)+\d+(\.\d*)?|0[xob][\da-f]+|\.inf|\.nan|=|<<)$"
_UNSAFE = r"^$|^[\s\-?:,\[\]{}#&*!|>'\"%@`]|: |:$| #|\s$|[\x00-\x1f\x7f]"


def yaml_scalar(text: Column) -> Column:
    """A string as a YAML scalar: plain where that is safe, else quoted."""
    single = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    quoted = F.to_json(F.array(text))
    double = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    plain = ~text.rlike(_NOT_TEXT) & ~text.rlike(_UNSAFE)
    return F.when(text.rlike(r"[\x00-\x1f\x7f]"), double).when(plain, text).otherwise(single)


def _literal_yaml(value: object, indent: int = 0) -> list[str]:
    pad = "  " * indent
    if isinstance(value, Mapping):
        lines = []
        for k, v in value.items():
            nested = isinstance(v, (Mapping, list)) and v
            lines += [f"{pad}{k}:"] + _literal_yaml(v, indent + 1 if isinstance(v, Mapping) else indent) if nested else [f"{pad}{k}: {_literal_scalar(v)}"]
        return lines
    if isinstance(value, list):
        return [f"{pad}- {_literal_scalar(v)}" for v in value]
    return [f"{pad}{_literal_scalar(value)}"]


def _literal_scalar(value: object) -> str:
    if value is None or isinstance(value, (bool, int, float, Mapping, list)):
        return json.dumps(value)
    text = str(value)
    if re.search(_UNSAFE, text) or re.match(_NOT_TEXT, text):
        return "'" + text.replace("'", "''") + "'"
    return text


def front_matter(spec: Mapping[str, object], null_text: str, extra: Mapping[str, Column]) -> Column:
    """A ``---`` block; text values are templates, everything else is written as it is."""
    parts: list[Column] = [F.lit("---\n")]
    for name, value in spec.items():
        if isinstance(value, str):
            parts += [F.lit(f"{name}: "), yaml_scalar(template(value, null_text, extra)), F.lit("\n")]
        else:
            parts.append(F.lit("\n".join(_literal_yaml({name: value})) + "\n"))
    return F.concat(*parts, F.lit("---\n\n"))


def render_files(
    df: DataFrame,
    path_template: str,
    content_template: str,
    base_path: str = "",
    front_matter_spec: Mapping[str, object] | None = None,
    null_text: str = "None",
    as_of: Instant | None = None,
) -> DataFrame:
    """One (path, content) row per input row. Templates may use ``{_projected_at}``."""
    extra = {"_projected_at": F.lit(as_of_text(as_of))}
    path = template(path_template, null_text, extra)
    if base_path:
        path = F.concat(F.lit(base_path.rstrip("/") + "/"), path)
    content = template(content_template, null_text, extra)
    if front_matter_spec:
        content = F.concat(front_matter(front_matter_spec, null_text, extra), content)
    return df.select(path.alias("path"), content.alias("content"))


def render_messages(
    df: DataFrame,
    text: str,
    to: str,
    provider: str | None = None,
    account: str | None = None,
    null_text: str = "",
    key: str | None = None,
) -> DataFrame:
    """One template over a table of recipients: to, subject, body, is_html, idempotency_key.

    ``{{ name }}`` placeholders. A first line ``Subject: ...`` becomes the subject. The key is the
    given column, or derived from what would be sent. Nothing is sent.
    """
    compiled = re.sub(r"\{\{\s*(\w+)\s*\}\}", "\x00\\1\x01", text)
    compiled = compiled.replace("{", "{{").replace("}", "}}").replace("\x00", "{").replace("\x01", "}")
    content = F.regexp_replace(template(compiled, null_text), r"^\s+|\s+$", "")
    has_subject = F.col("__content").startswith("Subject:")
    first = F.substring_index("__content", "\n", 1)
    rest = F.when(F.locate("\n", F.col("__content")) > 0, F.substring(F.col("__content"), F.length(first) + 2, F.length("__content"))).otherwise(F.lit(""))
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    out = df.withColumn("__content", content).select(
        F.col(to).alias("to"),
        F.when(has_subject, trim(F.substring(first, F.lit(9), F.length(first)))).otherwise(F.lit("")).alias("subject"),
        F.when(has_subject, trim(rest)).otherwise(F.col("__content")).alias("body"),
        *([F.col(key).alias("idempotency_key")] if key else []),
    )
    low = F.lower("body")
    out = out.withColumn("is_html", low.contains("<html") | low.contains("<body"))
    if not key:
        made = send_key("to", "subject", "body", "is_html", provider or "", account or "")
        out = out.withColumn("idempotency_key", made)
    return out.select("to", "subject", "body", "is_html", "idempotency_key")
