"""Registered queries for the reports on logs, raw objects and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventcanon.plans import derived as d
from eventcanon.plans import reports as rp
from eventcanon.plans.queries import query

LOG = """
log AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN 'ingestion.completed' WHEN 'click' THEN 'validation.completed'
      WHEN 'purchase' THEN 'canonization.completed' WHEN 'signup' THEN 'job.started' ELSE 'job.failed' END AS event_type,
    'sys' || (user_id // 50) AS source_system, 'conn' || (user_id // 10) AS connection_name, event_type AS object_type,
    'k' || user_id AS idem_key, ts AS created_at,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN value >= 20 THEN 'success' ELSE 'ok' END AS status,
    CASE WHEN event_type = 'error' THEN props END AS error_message, 'obj' || (user_id // 25) AS obj,
    json_extract(props, '$.k')::BIGINT AS extracted, floor(value)::BIGINT AS inserted
  FROM events)"""

RAW = """
raw AS (
  SELECT 'raw:' || o_orderkey AS idem_key, o_orderpriority AS source_system, o_orderstatus AS object_type, o_orderdate AS first_seen,
    o_orderdate + INTERVAL 1 DAY AS last_seen, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'fail' END AS validation_status
  FROM orders)"""

PAYLOAD = """'{"object_type":"' || obj || '","records_extracted":' || extracted || ',"records_inserted":' || inserted || '}'"""


@query("canonical_summary", """
SELECT canonical_schema, source_system, count(*) AS count FROM (
  SELECT 'iglu:org.canonical/invoice/jsonschema/1-0-0' AS canonical_schema, 'stripe' AS source_system FROM orders
  UNION ALL SELECT 'iglu:org.canonical/email_jmap_lite/jsonschema/1-0-0',
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'gmail' ELSE 'exchange' END FROM events
  UNION ALL SELECT 'iglu:org.canonical/contact/jsonschema/2-0-0', 'dataverse' FROM customer) GROUP BY 1, 2""")
def _(spark, sf):
    return rp.canonical_summary(d.canonical_objects(spark, sf, d.contacts, d.emails, d.invoices))


@query("raw_validation", "WITH" + RAW + """
SELECT source_system, object_type, validation_status, count(*) AS count FROM raw GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rp.raw_validation(d.raw_objects(spark, sf))


@query("recent_jobs", "WITH" + LOG + """
SELECT event_type, source_system, status, count(*) AS count, min(created_at) AS first_seen, max(created_at) AS last_seen
FROM log WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rp.recent_jobs(d.event_log(spark, sf), d.AS_OF)


@query("stale_raw_objects", "WITH" + RAW + """
SELECT source_system, object_type, count(*) AS count, max(last_seen) AS most_recent FROM raw
WHERE last_seen < TIMESTAMP '1998-10-03' - INTERVAL 30 DAY GROUP BY 1, 2""")
def _(spark, sf):
    return rp.stale_raw_objects(d.raw_objects(spark, sf), "1998-10-03 00:00:00")


@query("stage_status", "WITH" + LOG + """
SELECT source_system, connection_name, obj AS object_type,
  max(CASE WHEN event_type = 'ingestion.completed' THEN created_at END) AS last_ingestion,
  max(CASE WHEN event_type = 'validation.completed' THEN created_at END) AS last_validation,
  max(CASE WHEN event_type = 'canonization.completed' THEN created_at END) AS last_canonization,
  max(CASE WHEN status = 'failed' THEN created_at END) AS last_failure,
  sum(CASE WHEN event_type = 'ingestion.completed' THEN extracted ELSE 0 END)::BIGINT AS total_extracted,
  sum(CASE WHEN event_type = 'ingestion.completed' THEN inserted ELSE 0 END)::BIGINT AS total_inserted
FROM log WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rp.pipeline_status(d.event_log(spark, sf), d.AS_OF)


@query("streams_health", "WITH" + LOG + """
SELECT source_system, connection_name, obj AS object_type, max(created_at) AS last_success_at,
  floor(date_diff('microsecond', max(created_at), TIMESTAMP '2024-01-31') / 3600000000)::BIGINT AS hours_since_last
FROM log WHERE event_type IN ('ingestion.completed', 'validation.completed', 'canonization.completed') AND status = 'success'
GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rp.streams_health(d.event_log(spark, sf), d.AS_OF)


@query("event_counts", "WITH" + LOG + """
SELECT event_type, source_system, object_type, count(*) AS event_count, min(created_at) AS first_event, max(created_at) AS last_event
FROM log GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rp.event_counts(d.event_log(spark, sf))


@query("event_counts_matching", "WITH" + LOG + """
SELECT event_type, source_system, object_type, count(*) AS event_count, min(created_at) AS first_event, max(created_at) AS last_event
FROM log WHERE event_type LIKE 'job.%' GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rp.event_counts(d.event_log(spark, sf), type_pattern=r"^job\.")


@query("object_counts", "WITH" + RAW + """
SELECT object_type, source_system, count(*) AS object_count, min(first_seen) AS oldest, max(last_seen) AS newest FROM raw GROUP BY 1, 2""")
def _(spark, sf):
    return rp.object_counts(d.raw_objects(spark, sf))


@query("recent_events", "WITH" + LOG + """
SELECT event_id, event_type, source_system, object_type, created_at, status FROM log ORDER BY created_at DESC, event_id DESC LIMIT 10""")
def _(spark, sf):
    return rp.recent_events(d.event_log(spark, sf))


@query("idempotency_ratio", "WITH" + LOG + """
SELECT count(DISTINCT event_id) AS total_events, count(DISTINCT idem_key) AS unique_objects,
  round(count(DISTINCT event_id) / count(DISTINCT idem_key), 2) AS duplication_ratio FROM log""")
def _(spark, sf):
    return rp.idempotency_ratio(d.event_log(spark, sf))


@query("failed_today", "WITH" + LOG + f"""
SELECT created_at, event_type, source_system, status, error_message, {PAYLOAD} AS payload FROM log
WHERE created_at::DATE = DATE '2024-01-20' AND status = 'failed'""")
def _(spark, sf):
    return rp.failed_today(d.event_log(spark, sf), "2024-01-20 12:00:00")


@query("completed_today", "WITH" + LOG + f"""
SELECT created_at, event_type, source_system, status, {PAYLOAD} AS payload FROM log
WHERE created_at::DATE = DATE '2024-01-20' AND status = 'ok' AND event_type = 'ingestion.completed'""")
def _(spark, sf):
    return rp.completed_today(d.event_log(spark, sf), "2024-01-20 12:00:00")


@query("form_validation_counts", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'google-forms-intake-01' WHEN 'O' THEN 'google-forms-intake-02' ELSE 'google-forms-followup' END
  AS connection_name, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'fail' END AS validation_status, count(*) AS count
FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    o = d.load(spark, sf, "orders")
    rows = o.select(
        d.binding_connection().alias("connection_name"),
        F.expr("case o_orderstatus when 'F' then 'pass' when 'O' then 'fail' end").alias("validation_status"),
    )
    return rp.validation_counts(rows)


@query("run_metrics", """
SELECT run_id, total_duration_ms, total_rows_read, total_rows_written, bottleneck_step,
  CASE WHEN total_duration_ms > 0 THEN round(total_rows_read / (total_duration_ms / 1000), 2) ELSE 0 END AS transform_throughput,
  CASE WHEN total_duration_ms > 0 THEN round(total_rows_written / (total_duration_ms / 1000), 2) ELSE 0 END AS write_throughput,
  CASE WHEN read_ms < 5000 THEN 'good' WHEN read_ms < 15000 THEN 'moderate' ELSE 'poor' END AS query_efficiency
FROM (
  SELECT user_id AS run_id, sum(floor(value))::BIGINT AS total_duration_ms, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS total_rows_read,
    coalesce(sum(CASE WHEN event_type = 'purchase' THEN event_id END), 0)::BIGINT AS total_rows_written,
    arg_max(step_id, (floor(value), step_id)) AS bottleneck_step,
    coalesce(sum(CASE WHEN event_type = 'view' THEN floor(value) END), 0)::BIGINT AS read_ms
  FROM (SELECT *, CASE WHEN event_type = 'view' THEN 'read.view.' || event_id ELSE event_type || '.' || event_id END AS step_id FROM events)
  GROUP BY user_id)""")
def _(spark, sf):
    e = d.load(spark, sf, "events")
    step = F.when(F.col("event_type") == "view", F.concat(F.lit("read.view."), "event_id")).otherwise(F.concat("event_type", F.lit("."), "event_id"))
    steps = e.select(
        F.col("user_id").alias("run_id"), step.alias("step_id"), F.floor("value").alias("duration_ms"),
        F.get_json_object("props", "$.k").cast("long").alias("rows_read"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("rows_written"),
    )
    return rp.run_metrics(steps)
