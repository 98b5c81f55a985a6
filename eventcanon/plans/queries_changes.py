"""Registered queries for change feeds, incremental runs by cursor, keyed streaming state, schemas that contain themselves, as-of joins and indexed search."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventcanon.operators import search_index, validate
from eventcanon.operators.asof import asof_join
from eventcanon.operators.merge import merge_into
from eventcanon.plans import derived as d
from eventcanon.plans import forms as fm
from eventcanon.plans import queries_core as core
from eventcanon.plans.queries import query
from eventcanon.plans.queries_tables import workspace
from eventcanon.sources.catalog import Catalog
from eventcanon.sources.changes import changes, new_rows
from eventcanon.streaming.keyed import current_rows, start_keyed_fold


@query("change_feed", f"""
WITH old AS (SELECT event_id, event_type, value FROM events WHERE ts < TIMESTAMP '{core.SPLIT}'),
new AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'moved' ELSE event_type END AS event_type, CASE WHEN event_id % 7 = 0 AND ts < TIMESTAMP '{core.SPLIT}' THEN -value ELSE value END AS value
  FROM events WHERE event_id % 13 <> 0)
SELECT coalesce(n.event_id, o.event_id) AS event_id, coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.value, o.value) AS value,
  CASE WHEN o.event_id IS NULL THEN 'insert' WHEN n.event_id IS NULL THEN 'delete' ELSE 'update' END AS "_change"
FROM new n FULL JOIN old o ON n.event_id = o.event_id
WHERE o.event_id IS NULL OR n.event_id IS NULL OR n.event_type <> o.event_type OR n.value IS DISTINCT FROM o.value""")
def _(spark, sf):
    """Net changes over an upsert, a compaction, keys that move to another partition and a deletion, read from touched directories only."""
    e = d.load(spark, sf, "events").select("event_id", "event_type", "value", "ts")
    old = F.col("ts") < F.lit(core.SPLIT).cast("timestamp_ntz")
    table = Catalog(spark, workspace(spark)).table("raw", "events", partition_by=["event_type"], sort_by=["event_id"])
    table.replace(e.where(old).drop("ts"))
    fresh = e.where(~old | (F.col("event_id") % 7 == 0)).withColumn("value", F.when(old, -F.col("value")).otherwise(F.col("value"))).drop("ts")
    table.replace_touched(lambda now: merge_into(now, fresh, ["event_id"], order=["value"]), fresh, keys=["event_id"])
    table.compact()
    moved = table.read().where("event_id % 11 = 0").withColumn("event_type", F.lit("moved"))
    table.replace_touched(lambda now: merge_into(now, moved, ["event_id"], order=["value"]), moved, keys=["event_id"])
    gone = table.read().where("event_id % 13 = 0")
    table.replace_touched(lambda now: now.where("event_id % 13 <> 0"), gone)
    return changes(table, 0, ["event_id"])


def _two_runs(spark, sf):
    """Responses landed in two parts, each followed by a run of one binding."""
    catalog = Catalog(spark, workspace(spark))
    responses, events = catalog.table("canonical", "canonical_objects", partition_by=["canonical_schema"]), catalog.table("derived", "measurement_events")
    forms = d.form_responses(spark, sf)
    first = F.crc32("idem_key") % 3 == 0
    for part in (first, ~first):
        responses.append(forms.where(part))
        fm.measure_new(responses, events, "intake_01", as_of=d.AS_OF)
    return responses, events


@query("gate_runs", core.SCORES + "SELECT id AS measurement_event_id, email AS subject_id, o_orderdate AS occurred_at, 4 AS versions FROM f")
def _(spark, sf):
    """Each run reads only what came since the run before; a compaction moves the cursor, and a run with nothing new publishes nothing."""
    responses, events = _two_runs(spark, sf)
    responses.compact()
    runs = [fm.measure_new(responses, events, "intake_01", as_of=d.AS_OF) for _ in range(2)]
    if runs != [2, None]:
        raise AssertionError(f"runs after a compaction published {runs}")
    fm.measure_new(responses, events, "intake_02", as_of=d.AS_OF)
    mine = events.read().where("binding_id = 'intake_01'")
    return mine.select("measurement_event_id", "subject_id", "occurred_at", F.lit(len(events.versions())).alias("versions"))


@query("gate_nothing_new", "SELECT o_orderkey::VARCHAR AS idem_key FROM orders WHERE false")
def _(spark, sf):
    """What a run after those would read: no row, from no file."""
    responses, events = _two_runs(spark, sf)
    responses.compact()
    return new_rows(responses, events, ["idem_key"], reader="intake_01", columns=["idem_key"])[0]


@query("keyed_stream_fold", core.FOLD_SQL)
def _(spark, sf):
    """The event table landed in shuffled parts, one of them twice, and folded by a stream that is started twice; states live in the state store."""
    root = workspace(spark)
    e = d.load(spark, sf, "events").withColumns(
        {"last_purchase": F.expr("case when event_type = 'purchase' then value end"), "last_error": F.expr("case when event_type = 'error' then props end")}
    ).select("user_id", "ts", "event_id", "last_purchase", "last_error")
    table = Catalog(spark, root).table("derived", "state")
    fields = ["last_purchase", "last_error"]
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for parts in ((2, 0), (1, 0)):
        for p in parts:
            e.where(part == p).coalesce(1).write.mode("append").parquet(f"{root}/landed")
        events = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
        start_keyed_fold(events, table, "user_id", fields, ["ts", "event_id"], checkpoint=f"{root}/checkpoint").awaitTermination()
    return current_rows(table, "user_id").select("user_id", *fields, "row_id", "row_version", "row_state")


NESTED = {
    "$ref": "#/definitions/node",
    "definitions": {
        "node": {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "next": {"$ref": "#/definitions/next"}}},
        "next": {"anyOf": [{"type": "null"}, {"$ref": "#/definitions/node"}]},
    },
}


@query("validate_nested", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 20 = 0 THEN event_id // 20 % 51 ELSE event_id % 4 END AS depth FROM events)
SELECT event_id, depth, CASE WHEN event_id % 3 = 0 THEN 'fail' ELSE 'pass' END AS validation_status,
  CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS errors,
  CASE WHEN event_id % 3 = 0 THEN CASE WHEN depth = 0 THEN 'type' ELSE 'alternatives' END END AS said FROM e""")
def _(spark, sf):
    """Payloads under a schema that contains itself, through alternatives, one of twenty up to fifty levels deep; all errors, uncut."""
    e = d.load(spark, sf, "events").selectExpr("event_id", "if(event_id % 20 = 0, event_id div 20 % 51, event_id % 4) AS depth")
    leaf = F.when(F.col("event_id") % 3 == 0, F.lit('{"v":"x","next":null}')).otherwise(F.lit('{"v":1}'))
    deep = F.col("depth").cast("int")
    rows = e.withColumn("payload", F.concat(F.repeat(F.lit('{"v":1,"next":'), deep), leaf, F.repeat(F.lit("}"), deep)))
    out = validate.validate(rows, NESTED, all_errors="all")
    text = F.get("all", F.lit(0))["text"]
    said = F.when(text.endswith("is not valid under any of the given schemas"), "alternatives").when(text.endswith("is not of type 'integer'"), "type").otherwise(text)
    return out.select("event_id", "depth", "validation_status", F.size("all").alias("errors"), said.alias("said"))


@query("asof_last_view", """
SELECT e.event_id, e.user_id, (SELECT max(v.event_id) FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id
  AND v.ts = (SELECT max(w.ts) FROM events w WHERE w.event_type = 'view' AND w.user_id = e.user_id AND w.ts <= e.ts)) AS view_id
FROM events e WHERE e.event_type IN ('error', 'purchase')""")
def _(spark, sf):
    """Each error and purchase with the view that its user had open then."""
    e = d.load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    views = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("view_id"))
    asked = e.where("event_type in ('error', 'purchase')").drop("event_type")
    return asof_join(asked, views, ["user_id"], "ts", "seen_at", order=["view_id"]).select("event_id", "user_id", "view_id")


@query("indexed_search", r"""
SELECT doc_id, lang FROM documents
WHERE list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), ['the', 'of', 'and'])""")
def _(spark, sf):
    """A search by a posting table that was made in two parts; only the postings of its words and the buckets with hits are read."""
    catalog = Catalog(spark, workspace(spark))
    texts = catalog.table("raw", "documents", partition_by=[search_index.ROW_BUCKET])
    index = catalog.table("derived", "postings", partition_by=[search_index.TOKEN_BUCKET], sort_by=["token", "key"])
    rows = d.load(spark, sf, "documents").select("doc_id", "lang", "text")
    for part in (F.col("doc_id") % 2 == 0, F.coalesce(F.col("doc_id") % 2 != 0, F.lit(True))):
        search_index.add_rows(texts, index, rows.where(part), "doc_id", "text", token_buckets=16, row_buckets=16)
    return search_index.search(texts, index, "of AND the", "doc_id", "text").select("doc_id", "lang")
