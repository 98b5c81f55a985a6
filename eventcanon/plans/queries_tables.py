"""Registered queries that write tables or run streams, and read the result back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventcanon.functions.json import to_json_full
from eventcanon.operators import merge, validate
from eventcanon.operators.latest import fold_values
from eventcanon.plans import derived as d
from eventcanon.plans import queries_core as core
from eventcanon.plans import registry
from eventcanon.plans.queries import query
from eventcanon.session import checkpoint_root
from eventcanon.sources import reads, sinks
from eventcanon.sources.catalog import Catalog
from eventcanon.streaming.fold import BUCKET, start_fold
from eventcanon.streaming.ingest import start_ingest


def workspace(spark: SparkSession) -> str:
    """A new folder on the cluster's shared storage. Where none is configured, a temporary one if all tasks run in this process; else it fails."""
    alone = re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", ""))
    root = checkpoint_root(spark, tempfile.gettempdir() if alone else None)
    return f"{root.rstrip('/')}/eventcanon-{uuid.uuid4().hex}"


INGESTED = """
WITH o AS (SELECT user_id || '-' || event_type AS id, ts, value, event_id FROM events)
SELECT 'app:main:event:' || id AS idem_key, id AS external_id, arg_max(event_id, ts) AS newest_event,
  CASE WHEN min(ts) < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS first_seen,
  CASE WHEN max(ts) >= TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS last_seen
FROM o GROUP BY id"""


@query("stream_ingest", INGESTED)
def _(spark, sf):
    """Two landings of JSON lines, streamed in and merged."""
    root = workspace(spark)
    e = d.load(spark, sf, "events")
    line = to_json_full(d.text(F.col("user_id"), "-", F.col("event_type")).alias("id"), "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))
    table = Catalog(spark, f"{root}/tables").table("raw", "objects", partition_by=["source_system", "object_type"])
    split = F.lit(core.SPLIT).cast("timestamp_ntz")
    for as_of, part in (("2024-02-01", F.col("ts") < split), ("2024-02-02", F.col("ts") >= split)):
        e.where(part).select(line.alias("value")).write.mode("append").text(f"{root}/landed")
        start_ingest(
            spark, f"{root}/landed", table, "app", "main", "event", "$.id", checkpoint=f"{root}/checkpoint", as_of=f"{as_of} 00:00:00", order_path="$.at"
        ).awaitTermination()
    event = F.get_json_object("payload", "$.event_id").cast("long").alias("newest_event")
    return table.read().select("idem_key", "external_id", event, "first_seen", "last_seen")


@query("stream_fold", core.FOLD_SQL)
def _(spark, sf):
    """The event table read as a stream and folded into a state table."""
    root = workspace(spark)
    schema = d.load(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    events = events.withColumns(
        {"last_purchase": F.expr("case when event_type = 'purchase' then value end"), "last_error": F.expr("case when event_type = 'error' then props end")}
    ).select("user_id", "ts", "event_id", "last_purchase", "last_error")
    state = Catalog(spark, root).table("derived", "state", partition_by=[BUCKET])
    fields = ["last_purchase", "last_error"]
    start_fold(events, state, "user_id", fields, ["ts", "event_id"], buckets=8, checkpoint=f"{root}/checkpoint").awaitTermination()
    return fold_values(state.read(), "user_id", fields)


@query("snapshot_merge", core.MERGE_CTE + """
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type, coalesce(s.value, t.value) AS value,
  coalesce(t.first_seen, s.seen) AS first_seen, coalesce(s.seen, t.last_seen) AS last_seen
FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type""")
def _(spark, sf):
    """An upsert that rewrites only the partitions its batch touches, twice over."""
    known, new = core._state_before(spark, sf)
    table = Catalog(spark, workspace(spark)).table("raw", "objects", partition_by=["event_type"], sort_by=["user_id"])
    table.replace(known)
    for _ in range(2):
        table.replace_touched(lambda now: merge.merge_into(now, new, ["user_id", "event_type"], order=["last_seen"]), new)
    return table.read()


@query("partitioned_log", """
SELECT event_type, ts::DATE AS created_date, count(*) AS events, sum(event_id)::BIGINT AS ids FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' GROUP BY 1, 2""")
def _(spark, sf):
    path = f"{workspace(spark)}/log"
    log = d.load(spark, sf, "events").select("event_id", "event_type", F.col("ts").alias("created_at"))
    sinks.append_log(log, path, cluster_by=["event_type"])
    days = spark.read.parquet(path).where(F.col("created_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-11").cast("date")))
    return days.groupBy("event_type", "created_date").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query("materialised_view", """
SELECT 'raw:' || o_orderkey AS idem_key, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'pass' END AS validation_status FROM orders""")
def _(spark, sf):
    """Validate what is not validated, stamp it, write the next version, read it back."""
    raw = d.raw_objects(spark, sf).withColumn("validation_status", F.expr("case object_type when 'F' then 'pass' end"))
    schema = {"type": "object", "required": ["o_orderkey"], "properties": {n: {} for n in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "total")}}
    todo = raw.where("validation_status is null and object_type = 'O'").select("idem_key", "payload")
    stamps = validate.validate(todo, schema).select("idem_key", "validation_status")
    stamped = merge.stamp(raw.select("idem_key", "validation_status", "object_type"), stamps, ["idem_key"], ["validation_status"])
    table = Catalog(spark, workspace(spark)).table("raw", "objects")
    table.replace(stamped)
    return reads.read_table(table.read(), ["idem_key", "validation_status"])


@query("registered_view", "SELECT count(*) AS rows, count(DISTINCT user_id) AS users FROM events")
def _(spark, sf):
    """A view made by name and read with SQL."""
    tables = {"domain_events": d.domain_events(spark, sf, d.project_log)}
    registry.create_views(tables, names=["view_pm_projects"])
    projects = reads.read_view(spark, "view_pm_projects")
    return tables["domain_events"].join(projects.select(F.col("project_id").alias("aggregate_id")), "aggregate_id").agg(
        F.count("*").alias("rows"), F.count_distinct("aggregate_id").alias("users")
    )
