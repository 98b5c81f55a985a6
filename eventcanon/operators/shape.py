"""From raw items to keyed rows.

`shape_rows` applies its steps in one fixed order: wrap, external id, defaults, timestamps,
correlation id, key, key suffix, rename, allowlist. Later steps see what earlier ones made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventcanon.functions.json import _quoted, _variant_path, parse_path, to_json_full, with_json
from eventcanon.functions.keys import EXTERNAL_ID_FIELDS, ID_FIELD_BY_SOURCE, idem_key, suffixed
from eventcanon.functions.time import Instant, as_of_lit


def _usable(column: Column, kind: T.DataType) -> Column:
    """A column as the text of an id; NULL for empty text, the number zero and false. Texts like "0" and "false" are ids."""
    if isinstance(kind, T.BooleanType):
        column = F.when(column, column)
    elif isinstance(kind, T.NumericType):
        column = F.when(column != 0, column)
    text = column.cast("string")
    return F.when(text != "", text)


def _usable_json(name: str, payload: str, path: str) -> Column:
    """Like `_usable` for the text `name` of the value at a path of JSON text.

    Only a text that looks like zero or false needs the second look at the value's type.
    """
    value = f"try_variant_get(try_parse_json({_quoted(payload)}), '{_variant_path(parse_path(path))}', 'variant')"
    text = _quoted(name)
    looks = f"{text} RLIKE '^(-?0*[.]?0*([eE][+-]?[0-9]+)?|false)$'"
    return F.expr(f"CASE WHEN {text} = '' THEN NULL WHEN {looks} THEN CASE WHEN schema_of_variant({value}) = 'STRING' THEN {text} END ELSE {text} END")


def with_external_id(
    df: DataFrame, payload: str | None = None, fields: Sequence[str] = EXTERNAL_ID_FIELDS, name: str = "external_id"
) -> DataFrame:
    """Add the first usable id, as text: from columns, or from the JSON text in `payload` (parsed once)."""
    if payload:
        probe = {f"__id{i}": f"$.{f}" for i, f in enumerate(fields)}
        found = with_json(df, payload, values=probe)
        return found.withColumn(name, F.coalesce(*[_usable_json(c, payload, p) for c, p in probe.items()])).drop(*probe)
    return df.withColumn(name, _first_id(df, {f: F.col(f) for f in fields if f in df.columns}))


def _first_id(df: DataFrame, columns: Mapping[str, Column]) -> Column:
    found = [_usable(c, df.schema[f].dataType) for f, c in columns.items()]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def with_defaults(df: DataFrame, defaults: Mapping[str, object] | None) -> DataFrame:
    """Constant columns for names the rows do not have; present columns keep their values."""
    return df.withColumns({n: F.lit(v) for n, v in (defaults or {}).items() if n not in df.columns})


def renamed(df: DataFrame, field_map: Mapping[str, str] | None) -> DataFrame:
    """Rename by ``{new: old}``; an old name that is absent is skipped."""
    for new, old in (field_map or {}).items():
        if old in df.columns:
            df = df.drop(new).withColumnRenamed(old, new) if new != old else df
    return df


def allowlisted(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """Only `fields`, in the table's order. A field that is missing fails before any job runs."""
    if not fields:
        return df
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"missing required fields {missing}; available: {df.columns}")
    return df.select(*[c for c in df.columns if c in set(fields)])


def with_field_params(
    df: DataFrame,
    fields: Sequence[str] | None = None,
    field_map: Mapping[str, str] | None = None,
    field_defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Defaults, then rename, then allowlist."""
    return allowlisted(renamed(with_defaults(df, field_defaults), field_map), fields)


def shape_rows(
    df: DataFrame,
    *,
    correlation_id: str | None = None,
    payload_wrap: bool = False,
    auto_external_id: bool = False,
    field_defaults: Mapping[str, object] | None = None,
    timestamp_columns: Sequence[str] = (),
    as_of: Instant | None = None,
    id_field: str | None = None,
    suffix: str | None = None,
    field_map: Mapping[str, str] | None = None,
    fields: Sequence[str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Shape raw items into rows of a keyed table.

    An item without its id fails the job when `strict`; otherwise its key is NULL, see `bad_rows`.
    All rows of a run carry the same `as_of` in `timestamp_columns`.
    """
    item_columns = df.columns
    keep = F.struct(*item_columns)
    out = df.select(keep.alias("__item"))
    if payload_wrap:
        out = out.withColumn("payload", F.to_json("__item", {"ignoreNullFields": "false"}))
    else:
        out = out.select("__item", "__item.*")
    item = {c: F.col("__item").getField(c) for c in item_columns}
    if auto_external_id:
        out = out.withColumn("external_id", _first_id(df, {f: item[f] for f in EXTERNAL_ID_FIELDS if f in item}))
    out = with_defaults(out, field_defaults)
    if timestamp_columns:
        out = out.withColumns({c: as_of_lit(as_of) for c in timestamp_columns})
    if "correlation_id" not in out.columns:
        out = out.withColumn("correlation_id", F.lit(correlation_id))
    if id_field:
        if id_field not in item:
            raise ValueError(f"id field {id_field!r} not in {item_columns}")
        meta = field_defaults or {}
        key = idem_key(
            str(meta.get("source_system", "")),
            str(meta.get("connection_name", "")),
            str(meta.get("object_type", "")),
            item[id_field],
        )
        if strict:
            key = F.when(key.isNull(), F.raise_error(F.lit(f"item without {id_field}"))).otherwise(key)
        out = out.withColumn("idem_key", key)
    if suffix and "idem_key" in out.columns:
        out = out.withColumn("idem_key", suffixed("idem_key", suffix))
    return allowlisted(renamed(out.drop("__item"), field_map), fields)


def raw_rows(
    landed: DataFrame,
    source_system: str,
    connection_name: str,
    object_type: str,
    id_path: str | None = None,
    payload: str = "payload",
    schema_ref: str | None = None,
    correlation_id: str | None = None,
    as_of: Instant | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Landed JSON text to rows of the raw table.

    Without `id_path` the id is the field that `ID_FIELD_BY_SOURCE` names for the source and type; for others the usual id
    fields are probed.

    Columns of `landed` named in `keep` are carried along.

    Rows without an id get a NULL key; split them off with `bad_rows` before merging.
    """
    if id_path is None and (source_system, object_type) in ID_FIELD_BY_SOURCE:
        id_path = f"$.{ID_FIELD_BY_SOURCE[source_system, object_type]}"
    if id_path:
        rows = with_json(landed, payload, values={"__id": id_path}).withColumn("external_id", _usable_json("__id", payload, id_path))
    else:
        rows = with_external_id(landed, payload)
    now = as_of_lit(as_of)
    return rows.select(
        idem_key(source_system, connection_name, object_type, F.col("external_id")).alias("idem_key"),
        F.lit(source_system).alias("source_system"),
        F.lit(connection_name).alias("connection_name"),
        F.lit(object_type).alias("object_type"),
        F.lit(schema_ref).cast("string").alias("schema_ref"),
        F.col("external_id"),
        F.col(payload).alias("payload"),
        now.alias("first_seen"),
        now.alias("last_seen"),
        F.lit(correlation_id).cast("string").alias("correlation_id"),
        *keep,
    )


def good_rows(df: DataFrame, key: str = "idem_key") -> DataFrame:
    return df.where(F.col(key).isNotNull())


def bad_rows(df: DataFrame, key: str = "idem_key") -> DataFrame:
    return df.where(F.col(key).isNull())


def wrap_payload(df: DataFrame, name: str = "payload") -> DataFrame:
    """Every row as one JSON object in a single column."""
    return df.select(to_json_full(*df.columns).alias(name))
