"""Identity keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import to_json_full

# Field names probed for an object's own id, in order of preference.
EXTERNAL_ID_FIELDS = (
    "id",
    "message_id",
    "external_id",
    "uuid",
    "responseId",
    "contactid",
    "cre92_clientsessionid",
    "cre92_clientreportid",
)

# Fields that identify an item when a content key is made.
IDENTITY_FIELDS = (
    "idem_key",
    "idempotency_key",
    "stream_id",
    "event_id",
    "entity_id",
    "version",
    "id",
)

# Fixed values: (source system, object type) -> payload field that holds the id.
ID_FIELD_BY_SOURCE = {
    ("gmail", "email"): "id",
    ("exchange", "email"): "id",
    ("dataverse", "contact"): "contactid",
    ("dataverse", "session"): "cre92_clientsessionid",
    ("dataverse", "report"): "cre92_clientreportid",
    ("google_forms", "form_response"): "responseId",
    ("stripe", "customer"): "id",
    ("stripe", "invoice"): "id",
    ("stripe", "payment_intent"): "id",
    ("stripe", "refund"): "id",
    ("stripe", "charge"): "id",
}


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def idem_key(
    source_system: str | Column,
    connection_name: str | Column,
    object_type: str | Column,
    external_id: Column,
) -> Column:
    """``source:connection:type:id``. Plain strings are literals, Columns are taken as they are.

    The key is opaque: filter on the separate columns, never on parts of the key.
    """
    parts = [F.lit(p) if isinstance(p, str) else p for p in (source_system, connection_name, object_type)]
    prefix = [x for p in parts for x in (F.coalesce(p, F.lit("")), F.lit(":"))]
    return F.concat(*prefix, external_id.cast("string"))


def suffixed(key: str | Column, suffix: str) -> Column:
    return F.concat(_c(key), F.lit(f"#{suffix}"))


def sha256_prefixed(text: str | Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(_c(text), 256))


def canonical_object(columns: dict[str, Column]) -> Column:
    """Compact JSON object with keys in sorted order (fixed when the plan is built)."""
    return to_json_full(*[columns[k].alias(k) for k in sorted(columns)])


def ascii_json(text: Column) -> Column:
    """JSON text with every non-ASCII character written as ``\\uXXXX``."""
    utf16 = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    escaped = F.array_join(
        F.transform(F.split(text, ""), lambda c: F.when(c.rlike(r"[^\x00-\x7F]"), utf16(c)).otherwise(c)), ""
    )
    return F.when(text.rlike(r"[^\x00-\x7F]"), escaped).otherwise(text)


def spaced_object(columns: dict[str, Column]) -> Column:
    """JSON object with sorted keys and a blank after each colon and comma."""
    parts: list[Column] = []
    for i, name in enumerate(sorted(columns)):
        parts.append(F.lit(("{" if i == 0 else ", ") + f'"{name}": '))
        one = F.to_json(F.array(columns[name]), {"ignoreNullFields": "false"})
        parts.append(F.substring(one, F.lit(2), F.length(one) - 2))
    return F.concat(*parts, F.lit("}"))


def content_key(df: DataFrame, method: str = "wal.append") -> Column:
    """Hash of the identity fields present in `df` (of all columns when there are none) + method."""
    fields = [f for f in IDENTITY_FIELDS if f in df.columns] or list(df.columns)
    cols = {f: F.col(f) for f in fields}
    cols.setdefault("method", F.lit(method))
    return sha256_prefixed(ascii_json(canonical_object(cols)))


def send_key(
    to: str | Column,
    subject: str | Column,
    body: str | Column,
    is_html: str | Column,
    provider: str,
    account: str,
    channel: str = "email",
) -> Column:
    """``email.send:`` and the first 16 hex digits of the hash of what would be sent."""
    text = spaced_object(
        {
            "to": _c(to),
            "subject": _c(subject),
            "body": _c(body),
            "is_html": _c(is_html),
            "channel": F.lit(channel),
            "provider": F.lit(provider),
            "account": F.lit(account),
        }
    )
    return F.concat(F.lit("email.send:"), F.substring(F.sha2(ascii_json(text), 256), 1, 16))


def with_audit_hashes(df: DataFrame, prompt: str, output: str, config: list[str]) -> DataFrame:
    """Hashes of prompt, settings and output of recorded model calls, for later comparison."""
    settings = canonical_object({c: F.col(c) for c in config})
    is_text = F.col(output).isNotNull()
    out_hash = sha256_prefixed(output)
    return df.withColumns(
        {
            "prompt_hash": sha256_prefixed(prompt),
            "config_hash": sha256_prefixed(settings),
            "output_hash": F.when(is_text, out_hash),
            "output_ref": F.when(is_text, F.concat(F.lit("artifact://inline/"), out_hash)),
        }
    )
