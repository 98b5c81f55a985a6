"""Registered queries for reads, row shaping, merges, validation, checks, transforms, scoring and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventcanon.functions import keys as ky
from eventcanon.functions.json import to_json_full, with_json
from eventcanon.functions.time import parse_rfc2822
from eventcanon.functions.text import regex_group
from eventcanon.operators import checks, merge, render, shape, validate
from eventcanon.operators.latest import combine_folds, fold_latest, fold_values, fold_with_order, latest_per_key
from eventcanon.plans import canonical as cn
from eventcanon.plans import derived as d
from eventcanon.plans import forms as fm
from eventcanon.plans import reports as rp
from eventcanon.plans.queries import query
from eventcanon.sources import incremental, reads, sinks

SPLIT = "2024-01-16 00:00:00"
PRICE = "CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# --- reads ----------------------------------------------------------------------------------


@query("read_filtered", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_orderpriority <> '5-LOW'""")
def _(spark, sf):
    filters = [
        {"column": "o_orderstatus", "value": "F"}, {"column": "o_totalprice", "op": ">=", "value": "100000"},
        {"column": "o_orderpriority", "op": "!=", "value": "5-LOW"},
    ]
    return reads.read_table(d.load(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], filters)


@query("read_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(spark, sf):
    o = d.load(spark, sf, "orders")
    return reads.read_table(o, ["o_orderkey", "o_totalprice"], {"o_orderstatus": "O"}, "o_totalprice DESC, o_orderkey", 100)


@query("read_computed", """
SELECT max(last_seen) AS since, max(length(source_system)) AS longest FROM (SELECT o_orderdate + INTERVAL 1 DAY AS last_seen, o_orderpriority AS source_system FROM orders)""")
def _(spark, sf):
    return reads.read_table(d.raw_objects(spark, sf), ["MAX(last_seen) AS since", "CAST(MAX(LENGTH(source_system)) AS BIGINT) AS longest"])


@query("query_raw_objects", """
SELECT 'raw:' || o_orderkey AS idem_key, o_orderkey::VARCHAR AS external_id FROM orders
WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AND o_orderdate > TIMESTAMP '1998-01-01'""")
def _(spark, sf):
    rows = reads.query_raw_objects(d.raw_objects(spark, sf), "2-HIGH", "P", [{"column": "first_seen", "op": ">", "value": "1998-01-01 00:00:00"}])
    return rows.select("idem_key", "external_id")


@query("query_canonical_objects", """
SELECT 'pay:' || lpad(o_orderkey::VARCHAR, 12, '0') AS idem_key, 'stripe' AS source_system FROM orders""")
def _(spark, sf):
    rows = reads.query_canonical_objects(d.canonical_objects(spark, sf, d.payments, d.invoices), cn.SCHEMAS["payment"], {"source_system": "stripe"})
    return rows.select("idem_key", "source_system")


@query("cursor_by_stream", "SELECT event_type, max(ts) AS since FROM events GROUP BY 1")
def _(spark, sf):
    return reads.cursors(d.load(spark, sf, "events"), ["event_type"], "ts")


@query("cursor_of_stream", "SELECT max(o_orderdate) + INTERVAL 1 DAY AS since FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'")
def _(spark, sf):
    return reads.cursor(d.raw_objects(spark, sf), "2-HIGH", "main", "F")


@query("backfill_window", "SELECT event_type, min(ts) AS until, min(ts) - INTERVAL 30 DAY AS since FROM events GROUP BY 1")
def _(spark, sf):
    return reads.backfill_window(d.load(spark, sf, "events"), ["event_type"], "ts")


def _events_before(spark, sf):
    e = d.load(spark, sf, "events")
    return e, e.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))


@query("incremental_changed", """
WITH t AS (SELECT 'u' || user_id || '#x' AS k, ts AS seen FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'signup')
SELECT DISTINCT s.event_id, s.user_id, s.ts FROM events s LEFT JOIN t ON t.k = 'u' || s.user_id || '#x' WHERE t.k IS NULL OR s.ts > t.seen""")
def _(spark, sf):
    e, old = _events_before(spark, sf)
    key = F.concat(F.lit("u"), "user_id")
    target = old.where("event_type <> 'signup'").select(F.concat(key, F.lit("#x")).alias("k"), F.col("ts").alias("seen"))
    return incremental.changed_rows(e.withColumn("key", key), target, "key", "k", "ts", "seen", suffix="x", columns=["event_id", "user_id", "ts"])


@query("incremental_newer_than_all", """
WITH t AS (SELECT user_id, max(ts) AS seen FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT s.event_id FROM events s LEFT JOIN t USING (user_id) WHERE t.user_id IS NULL OR s.ts > t.seen""")
def _(spark, sf):
    e = d.load(spark, sf, "events")
    target = e.where("event_type = 'error'").select(F.col("user_id").alias("k"), F.col("ts").alias("seen"))
    return incremental.changed_rows(e, target, "user_id", "k", "ts", "seen", newer_than="all", columns=["event_id"])


@query("incremental_missing", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 200000)""")
def _(spark, sf):
    held = d.load(spark, sf, "orders").where("o_orderstatus = 'F' and o_totalprice > 200000")
    return incremental.missing_rows(d.load(spark, sf, "customer"), held, "c_custkey", "o_custkey", columns=["c_custkey", "c_name"])


@query("unvalidated_rows", "SELECT 'raw:' || o_orderkey AS idem_key FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
def _(spark, sf):
    return reads.unvalidated(d.raw_objects(spark, sf), "1-URGENT", "P").select("idem_key")


@query("validated_not_canonized", """
SELECT 'raw:' || o_orderkey AS idem_key FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""")
def _(spark, sf):
    done = d.load(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.concat(F.lit("raw:"), "l_orderkey", F.lit("#doc")).alias("idem_key"))
    return incremental.validated_not_canonized(d.raw_objects(spark, sf), done, suffix="doc").select("idem_key")


@query("json_roundtrip", """
SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, event_type AS scalar, NULL::VARCHAR AS object_as_scalar,
  '{"user_id":' || user_id || '}' AS object_text, CASE WHEN event_type = 'error' THEN NULL ELSE '{brace}' || event_type END AS brace_text,
  event_type || ',' || user_id AS items, user_id::VARCHAR AS first_id FROM events""")
def _(spark, sf):
    e = d.load(spark, sf, "events")
    brace = F.when(F.col("event_type") != "error", F.concat(F.lit("{brace}"), "event_type"))
    rows = e.select("event_id", to_json_full(
        F.from_json("props", "k bigint").alias("props"), F.col("event_type").alias("$kind"), F.struct("user_id").alias("who"), brace.alias("brace"),
        F.array("event_type", F.col("user_id").cast("string")).alias("items"), F.array(F.struct(F.col("user_id").alias("id"))).alias("people"),
    ).alias("payload"))
    out = with_json(
        rows, values={"k": "$.props.k", "scalar": "$.$kind", "object_as_scalar": "$.who", "brace_text": "$.brace", "first_id": "$.people[0].id"},
        queries={"object_text": "$.who"}, arrays={"items": "$.items"},
    )
    return out.withColumn("k", F.col("k").cast("long")).drop("payload")


@query("iso_timestamps", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) - second(ts) * 1000000 = 0 THEN '' ELSE '.' || lpad((microsecond(ts) - second(ts) * 1000000)::VARCHAR, 6, '0') END || '+00:00' AS ts FROM events""")
def _(spark, sf):
    return reads.with_iso_timestamps(d.load(spark, sf, "events").select("event_id", "ts"))


@query("regex_subject", "SELECT page_id, nullif(regexp_extract(url, '\\?page=(\\d+)', 1), '') AS page_no, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host FROM pages")
def _(spark, sf):
    p = d.load(spark, sf, "pages")
    return p.select("page_id", regex_group("url", r"\?page=(\d+)").alias("page_no"), regex_group("url", r"^https?://([^/]+)").alias("host"))


@query("rfc2822_dates", "SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS sent FROM orders")
def _(spark, sf):
    o = d.load(spark, sf, "orders")
    written = F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0130"))
    return o.select("o_orderkey", parse_rfc2822(written).alias("sent"))


# --- row shaping ----------------------------------------------------------------------------


@query("shape_rows", """
SELECT 'crm:main:customer:' || c_custkey || '#v1' AS key, c_custkey::VARCHAR AS external_id, 'crm' AS source_system,
  '{"uuid":' || c_custkey || ',"name":"' || c_name || '","nation":' || c_nationkey || '}' AS payload,
  TIMESTAMP '2024-01-31' AS first_seen, 'run-7' AS correlation_id FROM customer""")
def _(spark, sf):
    items = d.load(spark, sf, "customer").select(F.col("c_custkey").alias("uuid"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    # An id of 0 counts as no id in the probe; the key column keeps it.
    out = shape.shape_rows(
        items, correlation_id="run-7", payload_wrap=True, auto_external_id=True, timestamp_columns=["first_seen"], as_of=d.AS_OF, id_field="uuid",
        field_defaults={"source_system": "crm", "connection_name": "main", "object_type": "customer"}, suffix="v1", field_map={"key": "idem_key"},
        fields=["key", "external_id", "source_system", "payload", "first_seen", "correlation_id"],
    )
    return out.withColumn("external_id", F.coalesce("external_id", F.lit("0")))


@query("shape_without_batch", """
SELECT p_partkey AS part, p_name, 'cad' AS currency FROM part""")
def _(spark, sf):
    return shape.with_field_params(d.load(spark, sf, "part"), ["part", "p_name", "currency"], {"part": "p_partkey"}, {"currency": "cad", "p_name": "x"})


@query("raw_rows", """
SELECT 'shop:main:order:' || o_orderkey AS idem_key, 'shop' AS source_system, 'main' AS connection_name, 'order' AS object_type,
  o_orderkey::VARCHAR AS external_id, TIMESTAMP '2024-01-31' AS last_seen FROM orders WHERE o_orderkey <> 0""")
def _(spark, sf):
    landed = d.load(spark, sf, "orders").select(to_json_full(F.col("o_orderkey").alias("message_id"), "o_custkey").alias("payload"))
    rows = shape.raw_rows(landed, "shop", "main", "order", as_of=d.AS_OF)
    return shape.good_rows(rows).select("idem_key", "source_system", "connection_name", "object_type", "external_id", "last_seen")


@query("content_hash", """
SELECT p_partkey, 'sha256:' || sha256('{"id":' || p_partkey || ',"method":"wal.append","version":"' || p_brand || '"}') AS identity_key,
  'sha256:' || sha256('{"brand":"' || p_brand || '","key":' || p_partkey || ',"method":"wal.append"}') AS item_key FROM part""")
def _(spark, sf):
    p = d.load(spark, sf, "part")
    a = p.select("p_partkey", "p_name", F.col("p_partkey").alias("id"), F.col("p_brand").alias("version"))
    b = p.select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"))
    x = a.select("p_partkey", ky.content_key(a).alias("identity_key"))
    y = b.select(F.col("key").alias("p_partkey"), ky.content_key(b).alias("item_key"))
    return x.join(y, "p_partkey")


@query("send_keys", """
SELECT c_custkey, 'email.send:' || substr(sha256('{"account": "main", "body": "Hello ' || c_name || '", "channel": "email", "is_html": false, "provider": "mailer", "subject": "' ||
  c_mktsegment || '", "to": "' || c_custkey || '@example.com"}'), 1, 16) AS send_key FROM customer""")
def _(spark, sf):
    c = d.load(spark, sf, "customer")
    key = ky.send_key(
        F.concat("c_custkey", F.lit("@example.com")), "c_mktsegment", F.concat(F.lit("Hello "), "c_name"), F.lit(False), "mailer", "main"
    )
    return c.select("c_custkey", key.alias("send_key"))


@query("audit_hashes", """
SELECT conv_id, turn, 'sha256:' || sha256(text) AS prompt_hash, 'sha256:' || sha256('{"model":"' || role || '","temperature":0.5}') AS config_hash,
  CASE WHEN role <> 'system' THEN 'sha256:' || sha256(text) END AS output_hash,
  CASE WHEN role <> 'system' THEN 'artifact://inline/sha256:' || sha256(text) END AS output_ref FROM conversations""")
def _(spark, sf):
    c = d.load(spark, sf, "conversations").withColumns(
        {"model": F.col("role"), "temperature": F.lit(0.5).cast("double"), "answer": F.when(F.col("role") != "system", F.col("text"))}
    )
    return ky.with_audit_hashes(c, "text", "answer", ["model", "temperature"]).select("conv_id", "turn", "prompt_hash", "config_hash", "output_hash", "output_ref")


# --- newest row, folds ----------------------------------------------------------------------


@query("latest_per_key", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(spark, sf):
    return latest_per_key(d.load(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("latest_per_hot_key", "SELECT l_returnflag, l_orderkey, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_extendedprice DESC) = 1")
def _(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_extendedprice"]
    return latest_per_key(d.load(spark, sf, "lineitem"), ["l_returnflag"], order).select("l_returnflag", "l_orderkey", "l_partkey", "l_extendedprice")


FOLD_SQL = """
SELECT user_id, first(value ORDER BY ts DESC, event_id DESC) FILTER (WHERE event_type = 'purchase') AS last_purchase,
  first(props ORDER BY ts DESC, event_id DESC) FILTER (WHERE event_type = 'error') AS last_error, user_id AS row_id,
  first(event_id ORDER BY ts DESC, event_id DESC) AS row_version, 'synced' AS row_state FROM events GROUP BY user_id"""


def _fold_input(spark, sf):
    return d.load(spark, sf, "events").withColumns(
        {"last_purchase": F.expr("case when event_type = 'purchase' then value end"), "last_error": F.expr("case when event_type = 'error' then props end")}
    )


@query("fold_latest", FOLD_SQL)
def _(spark, sf):
    return fold_latest(_fold_input(spark, sf), "user_id", ["last_purchase", "last_error"], ["ts", "event_id"])


@query("fold_in_two_batches", FOLD_SQL)
def _(spark, sf):
    """The state of late and early events combined, as the streaming fold does it."""
    e, fields = _fold_input(spark, sf), ["last_purchase", "last_error"]
    split = F.lit(SPLIT).cast("timestamp_ntz")
    late = fold_with_order(e.where(F.col("ts") >= split), "user_id", fields, ["ts", "event_id"], "event_id")
    early = fold_with_order(e.where(F.col("ts") < split), "user_id", fields, ["ts", "event_id"], "event_id")
    return fold_values(combine_folds(late.unionByName(early), "user_id", fields), "user_id", fields)


# --- merge ----------------------------------------------------------------------------------


def _state_before(spark, sf):
    """Objects known before the split: one row per (user, kind), all but purchases."""
    e, old = _events_before(spark, sf)
    known = old.where("event_type <> 'purchase'").groupBy("user_id", "event_type").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )
    new = e.where(F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz")).select(
        "user_id", "event_type", "value", F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen"), "event_id"
    )
    return known, latest_per_key(new, ["user_id", "event_type"], ["last_seen", "event_id"]).drop("event_id")


MERGE_CTE = """
WITH t AS (SELECT user_id, event_type, arg_max(value, ts) AS value, min(ts) AS first_seen, max(ts) AS last_seen FROM events
    WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'purchase' GROUP BY 1, 2),
s AS (SELECT user_id, event_type, arg_max(value, ts) AS value, max(ts) AS seen FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2)"""


@query("merge_upsert", MERGE_CTE + """
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type, coalesce(s.value, t.value) AS value,
  coalesce(t.first_seen, s.seen) AS first_seen, coalesce(s.seen, t.last_seen) AS last_seen
FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type""")
def _(spark, sf):
    known, new = _state_before(spark, sf)
    return merge.merge_into(known, new, ["user_id", "event_type"], order=["last_seen"])


@query("merge_counts", MERGE_CTE + """
SELECT count(*) FILTER (WHERE t.user_id IS NULL) AS rows_inserted, count(*) FILTER (WHERE t.user_id IS NOT NULL AND s.user_id IS NOT NULL) AS rows_updated,
  0 AS rows_deleted, count(*) FILTER (WHERE s.user_id IS NULL) AS rows_kept FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type""")
def _(spark, sf):
    known, new = _state_before(spark, sf)
    return merge.merge_counts(merge.merge_into(known, new, ["user_id", "event_type"], order=["last_seen"], with_action=True))


@query("stamp_merge", """
SELECT o_orderkey, CASE WHEN x.k IS NOT NULL THEN x.n::VARCHAR ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN x.k IS NOT NULL THEN 'checked' ELSE o_orderstatus END AS o_orderstatus
FROM orders LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) x ON k = o_orderkey""")
def _(spark, sf):
    stamps = d.load(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("o_orderpriority"))
    o = d.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return merge.stamp(o, stamps, ["o_orderkey"], ["o_orderpriority"], {"o_orderstatus": "checked"})


@query("delete_where", """
SELECT idem_key, validation_status FROM (SELECT 'raw:' || o_orderkey AS idem_key, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'fail' END AS validation_status FROM orders)
WHERE validation_status IS NULL OR validation_status <> 'fail'""")
def _(spark, sf):
    return merge.delete_where(d.raw_objects(spark, sf).select("idem_key", "validation_status"), {"validation_status": "fail"})


@query("append_once", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    e, old = _events_before(spark, sf)
    old = old.select("event_id", "user_id")
    again = e.select("event_id", "user_id")
    return old.unionByName(merge.new_rows_only(old, again.unionByName(again), "event_id"))


# --- validation and checks ------------------------------------------------------------------

SCHEMA = {
    "type": "object",
    "required": ["k", "kind", "user"],
    "properties": {
        "k": {"type": "integer", "maximum": 90},
        "kind": {"type": "string", "enum": ["click", "purchase", "signup", "view"]},
        "user": {"$ref": "#/definitions/user"},
        "tags": {"type": "array", "items": {"type": "string"}},
    },
    "definitions": {"user": {"type": "object", "required": ["id"], "properties": {"id": {"type": "integer"}, "name": {"type": ["string", "null"]}}}},
}


def _payloads(spark, sf):
    """Event payloads with faults that depend on the event type."""
    e = d.load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    # view: k as text; click: unknown fields; error: not in the list of kinds; signup: no user
    k_text = F.to_json(F.struct(F.col("k").cast("string").alias("k"), F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("id")).alias("user")))
    k_number = F.to_json(F.struct(
        "k", F.col("event_type").alias("kind"),
        F.struct(F.col("user_id").alias("id"), F.when(F.col("event_type") == "click", F.lit(True)).alias("vip")).alias("user"),
        F.when(F.col("event_type") == "click", F.struct(F.lit(1).alias("deep"))).alias("extra"),
    ))
    payload = (
        F.when(F.col("event_type") == "signup", F.to_json(F.struct("k", F.col("event_type").alias("kind"))))
        .when(F.col("event_type") == "view", k_text)
        .otherwise(k_number)
    )
    return e.select("event_id", "event_type", payload.alias("payload"))


CHECKED = """
WITH p AS (SELECT event_id, event_type, json_extract(props, '$.k')::BIGINT AS k FROM events),
q AS (SELECT event_id, event_type,
  CASE WHEN event_type = 'signup' THEN 'Missing required: ''user'' is a required property' END AS missing,
  CASE WHEN event_type = 'view' THEN 'Type mismatch: ''' || k || ''' is not of type ''integer''' END AS typ,
  nullif(concat_ws('; ', CASE WHEN k > 90 AND event_type <> 'view' THEN k || ' is greater than the maximum of 90' END,
    CASE WHEN event_type = 'error' THEN '''error'' is not one of [''click'', ''purchase'', ''signup'', ''view'']' END), '') AS oth FROM p),
checked AS (SELECT event_id, event_type, nullif(concat_ws(' | ', missing, typ, 'Other: ' || oth), '') AS validation_error,
  CASE WHEN event_type = 'click' THEN 'extra,extra.deep,user.vip' END AS unknown_fields FROM q)"""


@query("validate_rows", CHECKED + """
SELECT event_id, CASE WHEN validation_error IS NULL THEN 'pass' ELSE 'fail' END AS validation_status, validation_error, unknown_fields FROM checked""")
def _(spark, sf):
    return validate.validate(_payloads(spark, sf), SCHEMA).select("event_id", "validation_status", "validation_error", "unknown_fields")


@query("validation_summary", CHECKED + """
SELECT event_type, count(*) AS total, count(*) FILTER (WHERE validation_error IS NULL) AS passed, count(validation_error) AS failed,
  CASE WHEN event_type = 'click' THEN 3 ELSE 0 END AS unknown_field_count FROM checked GROUP BY event_type""")
def _(spark, sf):
    return validate.validation_summary(validate.validate(_payloads(spark, sf), SCHEMA), ["event_type"])


@query("assert_rows", "SELECT count(*) AS row_count, true AS ok FROM lineitem")
def _(spark, sf):
    return checks.assert_rows(d.load(spark, sf, "lineitem"), minimum=1)


@query("assert_unique", """
SELECT count(*) FILTER (WHERE n > 1) AS duplicate_keys, sum(n - 1)::BIGINT AS surplus_rows, count(*) FILTER (WHERE n > 1) = 0 AS ok
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _(spark, sf):
    return checks.assert_unique(d.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _altered(spark, sf):
    o = d.load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    left = o.where("o_orderpriority <> '1-URGENT'")
    right = o.where("o_orderpriority <> '2-HIGH'").withColumn("o_orderstatus", F.expr("case o_orderstatus when 'P' then null when 'F' then 'f' else o_orderstatus end"))
    return left, right


@query("table_diff", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'right_only' WHEN '2-HIGH' THEN 'left_only' ELSE 'changed' END AS kind,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE 'o_orderstatus' END AS "column",
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE o_orderstatus END AS left_value,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus = 'P' THEN NULL ELSE 'f' END AS right_value
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus IN ('P', 'F')""")
def _(spark, sf):
    return checks.table_diff(*_altered(spark, sf), ["o_orderkey"])


@query("normalized_diff", """
SELECT o_orderkey, 'changed' AS kind, 'payload' AS "column",
  '/n=' || floor(o_totalprice)::BIGINT || chr(10) || '/s="' || o_orderstatus || '"' AS left_value,
  '/n=' || floor(o_totalprice)::BIGINT || chr(10) || '/s="' || lower(o_orderstatus) || '"' AS right_value
FROM orders WHERE o_orderstatus = 'F'""")
def _(spark, sf):
    """Equal but for key order, 250.0 or 250, volatile members, times and ids - except where the status differs."""
    o = d.load(spark, sf, "orders")
    whole = F.floor("o_totalprice")
    left = o.select("o_orderkey", F.col("o_orderdate").alias("created_at"), F.lit("a").alias("correlation_id"),
                    F.to_json(F.struct(whole.cast("double").alias("n"), F.col("o_orderstatus").alias("s"), F.lit("u1").alias("invoice_pdf"))).alias("payload"))
    status = F.expr("case o_orderstatus when 'F' then 'f' else o_orderstatus end")
    right = o.select("o_orderkey", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"), F.lit("b").alias("correlation_id"),
                     F.to_json(F.struct(status.alias("s"), F.lit("u2").alias("invoice_pdf"), whole.alias("n"))).alias("payload"))
    return checks.table_diff(left, right, ["o_orderkey"], normalize=True)


@query("coverage", "SELECT o_orderstatus AS status, count(*) AS total, count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) AS with_contact FROM orders GROUP BY 1")
def _(spark, sf):
    rows = with_json(d.sessions(spark, sf).select("payload"), values={"status": "$.status", "contact": "$.contact_id"})
    return checks.coverage(rows, ["status"], {"with_contact": F.col("contact")})


# --- canonical transforms -------------------------------------------------------------------


def _raw(df, source, object_type, key, payload):
    return df.select(
        key.alias("idem_key"), F.lit(source).alias("source_system"), F.lit("main").alias("connection_name"), F.lit(object_type).alias("object_type"),
        payload.alias("payload"), F.lit("run-1").alias("correlation_id"),
    )


def _raw_sessions(spark, sf):
    o = d.load(spark, sf, "orders")
    code = F.expr("case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 when '4-NOT SPECIFIED' then 4 else 9 end")
    payload = to_json_full(
        d.text("S", F.col("o_orderkey")).alias("cre92_clientsessionid"), F.col("o_custkey").alias("cre92_sessionnumber"), code.alias("statuscode"),
        d.when("o_orderstatus = 'F'", d.text("C", F.col("o_custkey"))).alias("_cre92_client_value"),
        d.when("o_orderstatus = 'O'", d.text("R", F.col("o_custkey"))).alias("regardingobjectid"), d.text("B", F.col("o_custkey")).alias("_ben_contactid_value"),
        d.iso("o_orderdate").alias("createdon"), d.iso("o_orderdate").alias("modifiedon"), F.lit(50).alias("scheduleddurationminutes"),
        d.when("o_orderstatus <> 'P'", F.col("o_orderpriority")).alias(cn.TRANSCRIPT_FIELD), F.lit("note").alias(cn.DOCUMENT_FIELDS["soap-note"]),
        F.lit(None).cast("string").alias(cn.DOCUMENT_FIELDS["client-summary"]),
    )
    return _raw(o, "dataverse", "session", d.text("dv:S", F.col("o_orderkey")), payload)


CLIENT = "CASE o_orderstatus WHEN 'F' THEN 'C' || o_custkey WHEN 'O' THEN 'R' || o_custkey ELSE 'B' || o_custkey END"
STATUS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'scheduled' WHEN '2-HIGH' THEN 'completed' WHEN '3-MEDIUM' THEN 'cancelled' WHEN '4-NOT SPECIFIED' THEN 'in_progress' END"


@query("canonical_session", f"""
SELECT 'dv:S' || o_orderkey || '#session' AS idem_key, 'iglu:org.canonical/clinical_session/jsonschema/2-0-0' AS canonical_schema,
  'S' || o_orderkey AS session_id, o_custkey AS session_num, {STATUS} AS status, {CLIENT} AS contact_id, 50 AS minutes,
  strftime(o_orderdate, {ISO}) AS created_at FROM orders""")
def _(spark, sf):
    out = cn.envelope(cn.clinical_session(_raw_sessions(spark, sf)), cn.SCHEMAS["clinical_session"], "clinical_session@2.0.0", "session", d.AS_OF)
    rows = with_json(out.select("idem_key", "canonical_schema", "payload"), values={
        "session_id": "$.session_id", "session_num": "$.session_num", "status": "$.status", "contact_id": "$.contact_id",
        "minutes": "$.duration_minutes", "created_at": "$.created_at",
    }).drop("payload")
    return rows.withColumns({"session_num": F.col("session_num").cast("long"), "minutes": F.col("minutes").cast("long")})


@query("canonical_fan_out", f"""
WITH parts(suffix, schema, suffix2) AS (VALUES ('session', 'clinical_session', NULL), ('transcript', 'session_transcript', '-transcript'),
  ('session_note', 'clinical_document', '-soap-note'), ('session_summary', 'clinical_document', '-client-summary'))
SELECT 'dv:S' || o_orderkey || '#' || suffix AS idem_key, 'iglu:org.canonical/' || schema || '/jsonschema/2-0-0' AS canonical_schema,
  CASE WHEN suffix <> 'session' THEN 'S' || o_orderkey || suffix2 END AS id,
  CASE suffix WHEN 'transcript' THEN CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END WHEN 'session_note' THEN 'note' END AS content,
  CASE WHEN suffix <> 'session' THEN 'Contact/' || CASE WHEN o_orderstatus = 'F' THEN 'C' || o_custkey ELSE '' END END AS reference
FROM orders, parts""")
def _(spark, sf):
    out = cn.fan_out(_raw_sessions(spark, sf), as_of=d.AS_OF)
    return with_json(out.select("idem_key", "canonical_schema", "payload"), values={
        "id": "$.id", "content": "$.content.text", "reference": "$.subject.reference"}).drop("payload")


@query("canonical_contact", """
SELECT 'dv:C' || c_custkey AS idem_key, 'C' || c_custkey AS contact_id, c_name AS first_name, c_mktsegment AS client_type, 'x' || c_custkey || '@example.com' AS email FROM customer""")
def _(spark, sf):
    c = d.load(spark, sf, "customer")
    payload = to_json_full(
        d.text("C", F.col("c_custkey")).alias("contactid"), F.col("c_name").alias("firstname"), d.text("x", F.col("c_custkey"), "@example.com").alias("emailaddress1"),
        F.col("c_mktsegment").alias("_cre92_contacttype_value@OData.Community.Display.V1.FormattedValue"),
    )
    out = cn.contact(_raw(c, "dataverse", "contact", d.text("dv:C", F.col("c_custkey")), payload))
    return with_json(out.select("idem_key", "payload"), values={
        "contact_id": "$.contact_id", "first_name": "$.first_name", "client_type": "$.client_type_label", "email": "$.email"}).drop("payload")


def _raw_forms(spark, sf):
    o = d.load(spark, sf, "orders")
    answer = lambda q, v: F.struct(F.lit(q).alias("questionId"), F.struct(F.array(F.struct(v.alias("value"))).alias("answers")).alias("textAnswers"))
    payload = to_json_full(
        d.text("R", F.col("o_orderkey")).alias("responseId"), d.text("form-", F.col("o_orderstatus")).alias("formId"), d.iso("o_orderdate").alias("lastSubmittedTime"),
        d.respondent().alias("respondentEmail"),
        F.struct(answer("q.priority", F.col("o_orderpriority")).alias("q.priority"), answer("q.price", d.price_band()).alias("q.price")).alias("answers"),
    )
    rows = _raw(o, "google_forms", "form_response", d.text("gf:", F.col("o_orderkey")), payload)
    return rows.withColumn("connection_name", F.lit("google-forms-intake-01"))


BAND = """CASE WHEN o_totalprice < 100000 THEN 'not at all' WHEN o_totalprice < 250000 THEN 'several days' WHEN o_totalprice < 400000 THEN 'nearly every day' ELSE 'unsure' END"""


@query("canonical_form_response", f"""
SELECT 'gf:' || o_orderkey AS idem_key, 'R' || o_orderkey AS response_id, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'C' || (o_custkey // 2) || '@EXAMPLE.COM' END AS email,
  q AS question_id, 'choice' AS answer_type, CASE q WHEN 'q.priority' THEN o_orderpriority ELSE {BAND} END AS answer_value
FROM orders, (VALUES ('q.priority'), ('q.price')) t(q)""")
def _(spark, sf):
    out = cn.form_response(_raw_forms(spark, sf))
    rows = with_json(out.select("idem_key", "payload"), values={"response_id": "$.response_id", "email": "$.respondent.email"})
    answers = F.from_json("payload", f"answers {fm.ANSWERS}")["answers"]
    return rows.select("idem_key", "response_id", "email", F.inline(answers))


def _raw_gmail(spark, sf):
    return d.raw_mail(spark, sf).withColumns({"connection_name": F.lit("acct1"), "correlation_id": F.lit("run-1")})


@query("canonical_email_gmail", """
SELECT doc_id::VARCHAR AS id, source AS thread_id, source || '@' || lang || '.example.com' AS sender, 'a@example.com' AS first_to, text AS subject,
  CASE WHEN lang = 'en' THEN 'false' ELSE 'true' END AS seen, CASE WHEN lang = 'en' THEN 'INBOX,UNREAD' ELSE 'INBOX' END AS labels FROM documents""")
def _(spark, sf):
    out = cn.email("gmail")(_raw_gmail(spark, sf))
    return with_json(out.select("payload"), values={
        "id": "$.id", "thread_id": "$.threadId", "sender": "$.from[0].email", "first_to": "$.to[0].email", "subject": "$.subject", "seen": "$.keywords.$seen",
    }, arrays={"labels": "$.labels"}).drop("payload")


@query("canonical_email_exchange", """
SELECT event_id::VARCHAR AS id, 'u' || user_id || '@example.com' AS sender, 'u' || user_id AS sender_name, 'a@example.com,b@example.com' AS recipients,
  CASE WHEN event_type = 'view' THEN 'true' ELSE 'false' END AS seen FROM events""")
def _(spark, sf):
    e = d.load(spark, sf, "events")
    person = lambda a, n=None: F.struct(F.struct(a.alias("address"), *([n.alias("name")] if n is not None else [])).alias("emailAddress"))
    payload = to_json_full(
        F.col("event_id").cast("string").alias("id"), person(d.text("u", F.col("user_id"), "@example.com"), d.text("u", F.col("user_id"))).alias("from"),
        F.array(person(F.lit("a@example.com")), person(F.lit("b@example.com"))).alias("toRecipients"), (F.col("event_type") == "view").alias("isRead"),
    )
    out = cn.email("exchange")(_raw(e, "exchange", "email", d.text("ex:", F.col("event_id")), payload))
    return with_json(out.select("payload"), values={"id": "$.id", "sender": "$.from[0].email", "sender_name": "$.from[0].name", "seen": "$.keywords.$seen"},
                     arrays={"recipients": "$.to[*].email"}).drop("payload")


@query("canonical_billing", f"""
SELECT 'pi' || o_orderkey AS payment_id, 'cus' || o_custkey AS customer_id, {PRICE} AS amount, 'card' AS payment_method_type,
  strftime(o_orderdate, {ISO}) AS event_time FROM orders""")
def _(spark, sf):
    o = d.load(spark, sf, "orders")
    payload = to_json_full(
        d.text("pi", F.col("o_orderkey")).alias("id"), d.text("cus", F.col("o_custkey")).alias("customer"), d.money("o_totalprice").alias("amount"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("created"), F.array(F.lit("card")).alias("payment_method_types"),
    )
    out = cn.billing("payment")(_raw(o, "stripe", "payment_intent", d.text("st:", F.col("o_orderkey")), payload))
    names = ["payment_id", "customer_id", "amount", "payment_method_type", "event_time"]
    return with_json(out.select("payload"), values={n: f"$.{n}" for n in names}).drop("payload")


@query("canonical_customer", "SELECT 'cus' || c_custkey AS customer_id, c_name AS name, c_custkey || '@example.com' AS email FROM customer")
def _(spark, sf):
    c = d.load(spark, sf, "customer")
    payload = to_json_full(d.text("cus", F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"), d.text(F.col("c_custkey"), "@example.com").alias("email"))
    out = cn.billing("customer")(_raw(c, "stripe", "customer", d.text("st:", F.col("c_custkey")), payload))
    return with_json(out.select("payload"), values={n: f"$.{n}" for n in ("customer_id", "name", "email")}).drop("payload")


@query("canonical_invoice", f"""
SELECT 'in' || o_orderkey AS invoice_id, {PRICE} AS amount_due, o_orderstatus AS status, strftime(o_orderdate, {ISO}) AS event_time, NULL::VARCHAR AS description FROM orders""")
def _(spark, sf):
    o = d.load(spark, sf, "orders")
    payload = to_json_full(
        d.text("in", F.col("o_orderkey")).alias("id"), d.money("o_totalprice").alias("amount_due"), F.col("o_orderstatus").alias("status"), d.iso("o_orderdate").alias("created"),
    )
    out = cn.billing("invoice")(_raw(o, "stripe", "invoice", d.text("st:", F.col("o_orderkey")), payload))
    return with_json(out.select("payload"), values={n: f"$.{n}" for n in ("invoice_id", "amount_due", "status", "event_time", "description")}).drop("payload")


@query("canonical_refund", """
SELECT 're' || l_orderkey AS refund_id, 'pi' || l_partkey AS payment_intent_id, CAST(l_extendedprice AS DECIMAL(15,2))::VARCHAR AS amount, l_returnflag AS reason FROM lineitem""")
def _(spark, sf):
    x = d.load(spark, sf, "lineitem")
    payload = to_json_full(
        d.text("re", F.col("l_orderkey")).alias("id"), d.text("pi", F.col("l_partkey")).alias("payment_intent"), d.money("l_extendedprice").alias("amount"), F.col("l_returnflag").alias("reason"),
    )
    out = cn.billing("refund")(_raw(x, "stripe", "refund", d.text("st:", F.col("l_orderkey")), payload))
    return with_json(out.select("payload"), values={n: f"$.{n}" for n in ("refund_id", "payment_intent_id", "amount", "reason")}).drop("payload")


@query("canonical_report", """
SELECT doc_id || '-progress-report' AS id, 'progress-report' AS doc_type, text AS content, 'markdown' AS format FROM documents""")
def _(spark, sf):
    docs = d.load(spark, sf, "documents")
    payload = to_json_full(F.col("doc_id").alias("cre92_clientsessionid"), F.col("text").alias(cn.DOCUMENT_FIELDS["progress-report"]))
    out = cn.clinical_document("progress-report")(_raw(docs, "dataverse", "report", d.text("dv:", F.col("doc_id")), payload))
    return with_json(out.select("payload"), values={"id": "$.id", "doc_type": "$.docType", "content": "$.content.text", "format": "$.content.format"}).drop("payload")


@query("parsed_json_columns", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, CASE WHEN event_type = 'error' THEN 'not json' END AS raw FROM events")
def _(spark, sf):
    e = d.load(spark, sf, "events").select("event_id", "props", "event_type")
    mixed = e.select("event_id", "props", F.when(F.col("event_type") == "error", "not json").otherwise(F.col("props")).alias("x"))
    out = reads.with_parsed_json(mixed, ["props", "x"])
    return out.select("event_id", F.variant_get("props", "$.k", "long").alias("k"), F.col("x_raw").alias("raw"))


# --- scoring --------------------------------------------------------------------------------

# Which question belongs to which instrument, and what an answer is worth: settings, not data.
KEY_ROWS = [
    ("intake_01", "q.priority", "urgency", "1", None),
    ("intake_01", "q.price", "worry", "1", None),
    ("intake_01", "q.status", "worry", "2", 3),
]
VALUE_ROWS = [
    ("urgency", "1-urgent", 4), ("urgency", "2-high", 3), ("urgency", "3-medium", 2), ("urgency", "5-low", 0),
    ("worry", "not at all", 0), ("worry", "several days", 1), ("worry", "nearly every day", 3), ("worry", "f", 1),
]


def _key_tables(spark):
    keys = spark.createDataFrame(KEY_ROWS, "binding_id string, field_key string, instrument string, item string, reverse_from int")
    return keys, spark.createDataFrame(VALUE_ROWS, "instrument string, answer string, value int")


def _measured(spark, sf):
    return fm.measurement_events(d.form_responses(spark, sf), "intake_01", as_of=d.AS_OF)


SCORES = f"""
WITH f AS (SELECT 'me:google_forms:form_response:' || o_orderkey AS id, o_orderpriority, o_orderdate, {BAND} AS band,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'C' || (o_custkey // 2) || '@EXAMPLE.COM' END AS email FROM orders WHERE o_orderstatus = 'F'),
items AS (
  SELECT id, 'urgency' AS instrument, '1' AS item, o_orderpriority AS raw_answer,
    CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 0 END::DOUBLE AS value FROM f
  UNION ALL SELECT id, 'worry', '1', band, CASE band WHEN 'not at all' THEN 0 WHEN 'several days' THEN 1 WHEN 'nearly every day' THEN 3 END::DOUBLE FROM f
  UNION ALL SELECT id, 'worry', '2', 'F', 2::DOUBLE FROM f),
totals AS (SELECT id, instrument, sum(value) AS total, count(value) AS answered, count(*) - count(value) AS unanswered FROM items GROUP BY 1, 2)
"""


@query("measurement_events", SCORES + """
SELECT id AS measurement_event_id, email AS subject_id, 'intake_01' AS binding_id, o_orderdate AS occurred_at, 'form-F' AS form_id FROM f""")
def _(spark, sf):
    return _measured(spark, sf).select("measurement_event_id", "subject_id", "binding_id", "occurred_at", "form_id")


@query("scoring_items", SCORES + """
SELECT id AS measurement_event_id, 'contact::' || coalesce(email, 'unknown@example.com') AS subject_id, p AS position, q AS field_key,
  CASE p WHEN 1 THEN o_orderpriority WHEN 2 THEN 'F' ELSE band END AS answer FROM f, (VALUES (1, 'q.priority'), (2, 'q.status'), (3, 'q.price')) t(p, q)""")
def _(spark, sf):
    return fm.scoring_items(_measured(spark, sf)).select("measurement_event_id", "subject_id", "position", "field_key", "answer")


@query("form_scores", SCORES + "SELECT id AS measurement_event_id, instrument, total, answered, unanswered FROM totals")
def _(spark, sf):
    return fm.score(fm.scored_items(fm.scoring_items(_measured(spark, sf)), *_key_tables(spark)))


OBSERVED = """
SELECT 'obs:' || id || ':' || instrument || ':' || item AS idem_key, id AS measurement_event_id, instrument, item, raw_answer, value, 'item' AS kind FROM items
UNION ALL SELECT 'obs:' || id || ':' || instrument || ':total', id, instrument, 'total', NULL, total, 'total' FROM totals"""


@query("observations", SCORES + OBSERVED)
def _(spark, sf):
    scored = fm.scored_items(fm.scoring_items(_measured(spark, sf)), *_key_tables(spark))
    return fm.observations(scored, d.AS_OF).drop("processed_at", "created_at")


@query("rescored_observations", SCORES + OBSERVED)
def _(spark, sf):
    """Observations of a binding dropped and scored again; the second scoring changes nothing."""
    me = _measured(spark, sf)
    first = fm.observations(fm.scored_items(fm.scoring_items(me), *_key_tables(spark)), d.AS_OF)
    kept = fm.without_binding(first, me, "intake_01")
    return merge.merge_into(kept, first, ["idem_key"], order=["processed_at"]).drop("processed_at", "created_at")


@query("unformed_responses", """
SELECT 'google_forms:form_response:' || o_orderkey AS idem_key FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def _(spark, sf):
    done = d.load(spark, sf, "orders").where("o_orderpriority <> '1-URGENT'").select(d.text("google_forms:form_response:", F.col("o_orderkey")).alias("canonical_object_id"))
    return fm.unformed_responses(d.form_responses(spark, sf), done, "intake_01").select("idem_key")


@query("unscored_events", SCORES + "SELECT id AS measurement_event_id FROM f WHERE o_orderpriority = '5-LOW'")
def _(spark, sf):
    me = _measured(spark, sf)
    low = d.load(spark, sf, "orders").where("o_orderpriority <> '5-LOW'")
    seen = low.select(d.text("me:google_forms:form_response:", F.col("o_orderkey")).alias("measurement_event_id")).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    return fm.unscored_events(me, seen, "intake_01").select("measurement_event_id")


@query("measurement_timeseries", SCORES + """
SELECT email AS subject_id, instrument, o_orderdate::DATE AS day, count(*) AS measurements, round(avg(total), 4) AS mean_total
FROM totals JOIN f USING (id) GROUP BY 1, 2, 3""")
def _(spark, sf):
    me = _measured(spark, sf)
    scored = fm.scored_items(fm.scoring_items(me), *_key_tables(spark))
    return rp.measurement_timeseries(fm.observations(scored, d.AS_OF), me)


# --- exports --------------------------------------------------------------------------------


@query("sync_text", """
SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS active,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey::VARCHAR END AS nation, '2024-01-31 00:00:00' AS projected_at FROM customer""")
def _(spark, sf):
    c = d.load(spark, sf, "customer").select(
        "c_custkey", "c_name", (F.col("c_acctbal") > 0).alias("active"), F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation")
    )
    return sinks.sync_rows(c, d.AS_OF)


@query("sheet_rows", "SELECT n_name, n_regionkey::VARCHAR AS n_regionkey, CASE WHEN n_nationkey = 0 THEN '' ELSE n_nationkey::VARCHAR END AS n_nationkey FROM nation")
def _(spark, sf):
    n = d.load(spark, sf, "nation").withColumn("n_nationkey", F.expr("nullif(n_nationkey, 0)"))
    return sinks.sheet_rows(n, ["n_name", "n_regionkey", "n_nationkey"])


@query("render_files", """
SELECT 'vault/' || c_mktsegment || '/' || c_custkey || '.md' AS path,
  '---' || chr(10) || 'source_type: contact' || chr(10) || 'record_id: ''' || c_custkey || '''' || chr(10) || 'projected_at: ''2024-01-31 00:00:00''' || chr(10) ||
  'fields:' || chr(10) || '  body: note' || chr(10) || '---' || chr(10) || chr(10) || '# ' || c_name || chr(10) || 'Nation: ' ||
  CASE WHEN c_nationkey = 3 THEN 'None' ELSE c_nationkey::VARCHAR END AS content FROM customer""")
def _(spark, sf):
    c = d.load(spark, sf, "customer").withColumn("nation", F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")))
    return render.render_files(
        c, "{c_mktsegment}/{c_custkey}.md", "# {c_name}\nNation: {nation}", "vault",
        {"source_type": "contact", "record_id": "{c_custkey}", "projected_at": "{_projected_at}", "fields": {"body": "note"}}, as_of=d.AS_OF,
    )


@query("render_messages", """
SELECT c_custkey || '@example.com' AS "to", 'Hello ' || c_name AS subject, '<html>' || c_mktsegment || '</html>' AS body, true AS is_html,
  'k' || c_custkey AS idempotency_key FROM customer""")
def _(spark, sf):
    c = d.load(spark, sf, "customer").withColumns({"mail": F.concat("c_custkey", F.lit("@example.com")), "k": F.concat(F.lit("k"), "c_custkey")})
    return render.render_messages(c, "Subject: Hello {{ c_name }}\n\n<html>{{c_mktsegment}}</html>\n", "mail", key="k")


@query("event_rows", """
SELECT 'job.' || event_type AS event_type, 'sys' AS source_system, 'run-' || user_id AS correlation_id, TIMESTAMP '2024-01-31' AS created_at,
  'ok' AS status, NULL::VARCHAR AS connection_name, nullif(CASE WHEN event_type = 'error' THEN props ELSE '' END, '') AS error_message FROM events""")
def _(spark, sf):
    e = d.load(spark, sf, "events").select(
        F.concat(F.lit("job."), "event_type").alias("event_type"), F.lit("sys").alias("source_system"), F.concat(F.lit("run-"), "user_id").alias("correlation_id"),
        F.when(F.col("event_type") == "error", F.col("props")).otherwise("").alias("error_message"),
    )
    rows = sinks.event_rows(e, d.AS_OF)
    return rows.select("event_type", "source_system", "correlation_id", "created_at", "status", "connection_name", "error_message")
