"""Registered queries for writers, isolated targets, checks of layouts and values, and runs that find nothing new."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import to_json_full
from eventcanon.operators import checks, merge, shape
from eventcanon.plans import context_views as xv
from eventcanon.plans import derived as d
from eventcanon.plans import forms as fm
from eventcanon.plans import registry
from eventcanon.plans import reports as rp
from eventcanon.plans.queries import query
from eventcanon.plans.queries_tables import workspace
from eventcanon.plans.queries_views import PROJECT_FOLD
from eventcanon.sources import reads, sinks
from eventcanon.sources.catalog import Catalog


@query("landed_objects", "SELECT event_id, value, event_type = 'error' AS unreadable FROM events")
def _(spark, sf):
    """Landed lines read with a known schema; lines that are no JSON are kept apart."""
    path = f"{workspace(spark)}/landed"
    line = F.when(F.col("event_type") != "error", to_json_full("event_id", "value"))
    e = d.load(spark, sf, "events")
    e.select(F.coalesce(line, F.concat_ws("|", F.lit("broken"), "event_id", "value")).alias("value")).write.text(path)
    rows = reads.landed_rows(spark, path, "event_id bigint, value double")
    bad = F.col("_corrupt").isNotNull()
    part = lambda i: F.split("_corrupt", r"\|")[i]
    return rows.select(
        F.when(bad, part(1).cast("long")).otherwise(F.col("event_id")).alias("event_id"),
        F.when(bad, part(2).cast("double")).otherwise(F.col("value")).alias("value"), bad.alias("unreadable"),
    )


@query("inserted_rows", "SELECT event_type, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def _(spark, sf):
    """Two inserts into one table."""
    path = f"{workspace(spark)}/events"
    e = d.load(spark, sf, "events").select("event_id", "event_type")
    for half in (0, 1):
        sinks.append_rows(e.where(F.col("event_id") % 2 == half), path)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"))


@query("json_dump", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type, 2 AS members FROM events""")
def _(spark, sf):
    """A dump as JSON lines keeps NULL members."""
    path = f"{workspace(spark)}/dump"
    sinks.write_json(d.load(spark, sf, "events").select("event_id", F.expr("nullif(event_type, 'error')").alias("event_type")), path)
    lines = reads.landed_objects(spark, path)
    return lines.select(
        F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"), F.get_json_object("payload", "$.event_type").alias("event_type"),
        F.size(F.json_object_keys("payload")).alias("members"),
    )


@query("isolated_target", """
SELECT 'live' AS target, c_custkey, c_name AS name FROM customer UNION ALL SELECT 'trial', c_custkey, upper(c_name) FROM customer""")
def _(spark, sf):
    """A trial run in a namespace of its own leaves the live table as it is."""
    live = Catalog(spark, workspace(spark))
    c = d.load(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"))
    tables = {"live": live.table("raw", "customers"), "trial": live.isolated("t1").table("raw", "customers")}
    tables["live"].replace(c)
    tables["trial"].replace(c.withColumn("name", F.upper("name")))
    return reduce(DataFrame.unionByName, [t.read().select(F.lit(n).alias("target"), "c_custkey", "name") for n, t in tables.items()])


@query("dry_run_rows", "SELECT count(*) AS rows, true AS keys_exist, false AS written FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    """What a write would touch; the target stays away."""
    todo = d.raw_objects(spark, sf).where("object_type = 'F'")
    target = Catalog(spark, workspace(spark)).table("raw", "objects")
    n, keys = sinks.dry_run(todo)
    found = todo.where(F.col("idem_key").isin(*keys)).agg((F.count("*") == len(keys)).alias("keys_exist"))
    return found.select(F.lit(n).cast("long").alias("rows"), "keys_exist", F.lit(target.exists()).alias("written"))


@query("schema_differences", """
SELECT 'event_id' AS column_name, 'mismatched' AS difference, count(*) AS rows FROM events
UNION ALL SELECT 'origin', 'missing', count(*) FROM events UNION ALL SELECT 'props', 'extra', count(*) FROM events""")
def _(spark, sf):
    """Each column in which a table differs from what is expected of it, with the number of rows concerned."""
    e = d.load(spark, sf, "events")
    expected = {f.name: f.dataType.simpleString() for f in e.schema.fields if f.name != "props"} | {"event_id": "string", "origin": "string"}
    found = checks.assert_schema(e, expected)
    differences = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("difference")) for kind in ("missing", "extra", "mismatched") for c in found[kind]])
    return e.agg(F.count("*").alias("rows")).select(F.inline(differences), "rows")


@query("bad_values", """
SELECT 'clerk' AS column_name, count(*) AS rows, 0 AS missing, count(*) AS bad FROM orders
UNION ALL SELECT 'day', count(*), 0, count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'num', count(*), count(*) FILTER (WHERE o_orderstatus = 'O'), count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders""")
def _(spark, sf):
    """Texts that are no number or no time, counted apart from missing ones."""
    o = d.load(spark, sf, "orders").select(
        F.expr("case o_orderstatus when 'F' then cast(o_custkey as string) when 'P' then 'no number' end").alias("num"),
        F.when(F.col("o_orderstatus") == "F", "soon").otherwise(d.iso("o_orderdate")).alias("day"), F.concat(F.lit("clerk "), "o_orderkey").alias("clerk"),
    )
    return checks.bad_values(o, {"num": "bigint", "day": "timestamp", "clerk": "bigint"})


@query("measurement_events_by_binding", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'intake_01' WHEN 'O' THEN 'intake_02' ELSE 'followup' END AS binding_id, 'form-' || o_orderstatus AS form_id,
  count(*) AS events, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    """Events of every binding."""
    forms = d.form_responses(spark, sf)
    events = reduce(DataFrame.unionByName, [fm.measurement_events(forms, b, as_of=d.AS_OF) for b in fm.BINDINGS])
    return events.groupBy("binding_id", "form_id").agg(F.count("*").alias("events"), F.min("occurred_at").alias("first_at"), F.max("occurred_at").alias("last_at"))


@query("nothing_new", "SELECT o_orderkey::VARCHAR AS idem_key FROM orders WHERE false")
def _(spark, sf):
    """A run over responses that all have their events already."""
    forms = d.form_responses(spark, sf)
    return fm.unformed_responses(forms, fm.measurement_events(forms, "intake_01", as_of=d.AS_OF), "intake_01").select("idem_key")


@query("canonical_summary_all", """
SELECT canonical_schema, source_system, count(*) AS count FROM (
  SELECT 'contact/jsonschema/2-0-0' AS canonical_schema, 'dataverse' AS source_system FROM customer
  UNION ALL SELECT 'customer/jsonschema/1-0-0', 'stripe' FROM customer, (VALUES (1), (2)) two(n)
  UNION ALL SELECT 'clinical_session/jsonschema/2-0-0', 'dataverse' FROM orders
  UNION ALL SELECT 'session_transcript/jsonschema/2-0-0', 'dataverse' FROM pages
  UNION ALL SELECT 'clinical_document/jsonschema/2-0-0', 'dataverse' FROM documents
  UNION ALL SELECT 'form_response/jsonschema/1-0-0', 'google_forms' FROM orders
  UNION ALL SELECT 'email_jmap_lite/jsonschema/1-0-0', CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'gmail' ELSE 'exchange' END FROM events
  UNION ALL SELECT 'invoice/jsonschema/1-0-0', 'stripe' FROM orders
  UNION ALL SELECT 'payment/jsonschema/1-0-0', 'stripe' FROM orders
  UNION ALL SELECT 'refund/jsonschema/1-0-0', 'stripe' FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1, 2""")
def _(spark, sf):
    """Counts of all ten kinds of objects."""
    kind = F.regexp_replace("canonical_schema", "^iglu:org.canonical/", "")
    return rp.canonical_summary(d.canonical_objects(spark, sf)).withColumn("canonical_schema", kind)


@query("snapshot_merge_moved", """
SELECT event_id, CASE WHEN value > 90 THEN 'moved' ELSE event_type END AS event_type, value FROM events""")
def _(spark, sf):
    """An upsert whose rows move to another partition leaves one row per key."""
    e = d.load(spark, sf, "events").select("event_id", "event_type", "value")
    table = Catalog(spark, workspace(spark)).table("raw", "events", partition_by=["event_type"], sort_by=["event_id"])
    table.replace(e)
    moved = e.where("value > 90").withColumn("event_type", F.lit("moved"))
    table.replace_touched(lambda now: merge.merge_into(now, moved, ["event_id"], order=["value"]), moved, keys=["event_id"])
    return table.read()


@query("compacted_table", "SELECT event_type, count(*) AS rows, 1 AS versions FROM events GROUP BY 1")
def _(spark, sf):
    """Appends, then compaction; versions before it are removed."""
    e = d.load(spark, sf, "events").select("event_id", "event_type")
    table = Catalog(spark, workspace(spark)).table("raw", "events", partition_by=["event_type"])
    for part in range(3):
        table.append(e.where(F.col("event_id") % 3 == part))
    table.compact()
    table.expire(keep=1)
    return table.read().groupBy("event_type").agg(F.count("*").alias("rows")).withColumn("versions", F.lit(len(table.versions())))


@query("context_emails_pruned", """
SELECT event_type, count(*) AS mails, min(received) AS first_at FROM (SELECT event_type, date_trunc('second', ts) AS received FROM events)
WHERE received > TIMESTAMP '2024-01-31' - INTERVAL 14 DAY GROUP BY 1""")
def _(spark, sf):
    """Recent mail of a table laid out by the day of receipt: older days are not read."""
    path = f"{workspace(spark)}/canonical"
    received = F.to_date(F.get_json_object("payload", "$.receivedAt").cast("timestamp"))
    d.emails(spark, sf).withColumn("received_date", received).repartition("received_date").write.partitionBy("received_date").parquet(path)
    rows = xv.context_emails(spark.read.parquet(path).unionByName(d.contacts(spark, sf), allowMissingColumns=True), [], [], d.AS_OF, date_column="received_date")
    label = F.get(F.filter("labels", lambda x: x != "INBOX"), 0)
    once = rows.dropDuplicates(["idem_key"])
    return once.groupBy(F.coalesce(label, F.lit("view")).alias("event_type")).agg(F.count("*").alias("mails"), F.min("received_at").alias("first_at"))


@query("keys_by_source", """
SELECT 'dataverse:main:session:' || o_orderkey AS idem_key, o_orderkey::VARCHAR AS external_id FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey <> 0
UNION ALL SELECT NULL, NULL FROM orders WHERE o_orderstatus = 'F' OR o_orderkey = 0
UNION ALL SELECT 'google_forms:main:form_response:r' || o_orderkey, 'r' || o_orderkey FROM orders
UNION ALL SELECT 'gmail:main:email:' || o_orderkey % 10, (o_orderkey % 10)::VARCHAR FROM orders
UNION ALL SELECT CASE WHEN o_orderstatus = 'F' THEN 'stripe:main:customer:true' END, CASE WHEN o_orderstatus = 'F' THEN 'true' END FROM orders
UNION ALL SELECT 'stripe:main:refund:' || (o_orderstatus = 'F'), (o_orderstatus = 'F')::VARCHAR FROM orders""")
def _(spark, sf):
    """The id field depends on source and type; another field named id is not taken for it, and rows without the field have no key.

    The number 0 and false are no ids; the texts "0" and "false" are.
    """
    o = d.load(spark, sf, "orders")
    is_f = F.col("o_orderstatus") == "F"
    payloads = {
        ("dataverse", "main", "session"): [F.when(~is_f, F.col("o_orderkey")).alias("cre92_clientsessionid"), F.col("o_custkey").alias("id")],
        ("google_forms", "main", "form_response"): [F.concat(F.lit("r"), "o_orderkey").alias("responseId"), F.col("o_custkey").alias("id")],
        ("gmail", "main", "email"): [(F.col("o_orderkey") % 10).cast("string").alias("id")],
        ("stripe", "main", "customer"): [is_f.alias("id")],
        ("stripe", "main", "refund"): [is_f.cast("string").alias("id")],
    }
    rows = [shape.raw_rows(o.select(to_json_full(*fields).alias("payload")), *source, as_of=d.AS_OF) for source, fields in payloads.items()]
    return reduce(lambda a, b: a.unionAll(b), rows).select("idem_key", "external_id")


@query("materialised_by_name", PROJECT_FOLD)
def _(spark, sf):
    """A view of the registry written as the next version of a table, twice, and read back."""
    table = Catalog(spark, workspace(spark)).table("views", "view_pm_projects")
    for _ in range(2):
        registry.materialise("view_pm_projects", {"domain_events": d.domain_events(spark, sf, d.project_log)}, table)
    return table.read()
