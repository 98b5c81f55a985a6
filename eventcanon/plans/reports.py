"""Reports on the state and health of the data flow.

Reports come unordered unless `ordered`: their results are small, but sorting is for the reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import with_json
from eventcanon.functions.time import Instant, ago, as_of_lit, as_of_text, dtype_of

# Event names of finished stages, and what counts as success.
STAGES = {
    "ingestion": "ingestion.completed",
    "validation": "validation.completed",
    "canonization": "canonization.completed",
}
SUCCESS = ("success",)

# Read time in milliseconds below which a run's reading counts as good or moderate.
READ_GOOD_MS = 5_000
READ_MODERATE_MS = 15_000


def _sorted(df: DataFrame, ordered: bool, *by: Column) -> DataFrame:
    return df.orderBy(*by) if ordered else df


def canonical_summary(canonical: DataFrame, ordered: bool = False) -> DataFrame:
    out = canonical.groupBy("canonical_schema", "source_system").agg(F.count("*").alias("count"))
    return _sorted(out, ordered, F.desc("count"), F.col("canonical_schema"), F.col("source_system"))


def raw_validation(raw: DataFrame, ordered: bool = False) -> DataFrame:
    by = ["source_system", "object_type", "validation_status"]
    return _sorted(raw.groupBy(*by).agg(F.count("*").alias("count")), ordered, *[F.asc_nulls_first(c) for c in by])


def recent_jobs(log: DataFrame, as_of: Instant | None = None, days: int = 7, ordered: bool = False) -> DataFrame:
    out = (
        log.where(F.col("created_at") >= ago(as_of, log, "created_at", days=days))
        .groupBy("event_type", "source_system", "status")
        .agg(F.count("*").alias("count"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"))
    )
    return _sorted(out, ordered, F.desc("last_seen"), F.col("event_type"), F.col("source_system"), F.col("status"))


def stale_raw_objects(raw: DataFrame, as_of: Instant | None = None, days: int = 30, ordered: bool = False) -> DataFrame:
    out = (
        raw.where(F.col("last_seen") < ago(as_of, raw, "last_seen", days=days))
        .groupBy("source_system", "object_type")
        .agg(F.count("*").alias("count"), F.max("last_seen").alias("most_recent"))
    )
    return _sorted(out, ordered, F.asc("most_recent"), F.col("source_system"), F.col("object_type"))


def pipeline_status(log: DataFrame, as_of: Instant | None = None, days: int = 30, strict: bool = False) -> DataFrame:
    """Last run of each stage, last failure and record totals per stream."""
    rows = log.where(F.col("created_at") >= ago(as_of, log, "created_at", days=days))
    rows = with_json(
        rows.select("source_system", "connection_name", "event_type", "status", "created_at", "payload"),
        values={"object_type": "$.object_type", "extracted": "$.records_extracted", "inserted": "$.records_inserted"},
    )
    kind, at = F.col("event_type"), F.col("created_at")

    def last(test: Column) -> Column:
        return F.max(F.when(test, at))

    def total(name: str) -> Column:
        n = F.col(name).cast("long") if strict else F.col(name).try_cast("long")
        return F.sum(F.when(kind == STAGES["ingestion"], n).otherwise(F.lit(0)))

    return rows.groupBy("source_system", "connection_name", "object_type").agg(
        last(kind == STAGES["ingestion"]).alias("last_ingestion"),
        last(kind == STAGES["validation"]).alias("last_validation"),
        last(kind == STAGES["canonization"]).alias("last_canonization"),
        last(F.col("status") == "failed").alias("last_failure"),
        total("extracted").alias("total_extracted"),
        total("inserted").alias("total_inserted"),
    )


def streams_health(log: DataFrame, as_of: Instant | None = None, success: Sequence[str] = SUCCESS) -> DataFrame:
    """Whole hours since the last successful stage of each stream."""
    rows = log.where(F.col("event_type").isin(*STAGES.values()) & F.col("status").isin(*success))
    rows = with_json(
        rows.select("source_system", "connection_name", "created_at", "payload"), values={"object_type": "$.object_type"}
    )
    now = as_of_lit(as_of, dtype_of(log, "created_at"))
    return (
        rows.groupBy("source_system", "connection_name", "object_type")
        .agg(F.max("created_at").alias("last_success_at"))
        .withColumn("hours_since_last", F.timestamp_diff("HOUR", F.col("last_success_at"), now))
    )


def event_counts(log: DataFrame, type_pattern: str | None = None, limit: int | None = None) -> DataFrame:
    rows = log.where(F.col("event_type").rlike(type_pattern)) if type_pattern else log
    out = rows.groupBy("event_type", "source_system", "object_type").agg(
        F.count("*").alias("event_count"), F.min("created_at").alias("first_event"), F.max("created_at").alias("last_event")
    )
    if limit:
        out = out.orderBy(F.desc("event_count"), "event_type", "source_system", "object_type").limit(limit)
    return out


def object_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("object_type", "source_system").agg(
        F.count("*").alias("object_count"), F.min("first_seen").alias("oldest"), F.max("last_seen").alias("newest")
    )


def recent_events(log: DataFrame, limit: int = 10) -> DataFrame:
    cols = ["event_id", "event_type", "source_system", "object_type", "created_at", "status"]
    return log.select(*cols).orderBy(F.desc("created_at"), F.desc("event_id")).limit(limit)


def idempotency_ratio(log: DataFrame, approximate: bool = False) -> DataFrame:
    """Different events per different object: how often the same object came again."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    out = log.agg(count("event_id").alias("total_events"), count("idem_key").alias("unique_objects"))
    ratio = F.col("total_events") / F.nullif(F.col("unique_objects"), F.lit(0))
    return out.withColumn("duplication_ratio", F.round(ratio, 2))


def _today(log: DataFrame, as_of: Instant | None) -> Column:
    day = F.lit(as_of_text(as_of)).cast("date")
    # A range on the time itself, so the scan can skip files; to_date() on the column could not.
    dtype = dtype_of(log, "created_at")
    return (F.col("created_at") >= day.cast(dtype)) & (F.col("created_at") < F.date_add(day, 1).cast(dtype))


def failed_today(log: DataFrame, as_of: Instant | None = None, limit: int | None = None) -> DataFrame:
    rows = log.where(_today(log, as_of) & (F.col("status") == "failed"))
    rows = rows.orderBy(F.desc("created_at"), F.desc("event_id")).limit(limit) if limit else rows
    return rows.select("created_at", "event_type", "source_system", "status", "error_message", "payload")


def completed_today(
    log: DataFrame, as_of: Instant | None = None, limit: int | None = None, status: str = "ok", event_type: str = STAGES["ingestion"]
) -> DataFrame:
    rows = log.where(_today(log, as_of) & (F.col("status") == status) & (F.col("event_type") == event_type))
    rows = rows.orderBy(F.desc("created_at"), F.desc("event_id")).limit(limit) if limit else rows
    return rows.select("created_at", "event_type", "source_system", "status", "payload")


def validation_counts(rows: DataFrame, by: Sequence[str] = ("connection_name", "validation_status")) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("count"))


# --- reports on the client views ------------------------------------------------------------

NOTE, SUMMARY, REPORT = "soap-note", "client-summary", "progress-report"


def content_counts(clients: DataFrame, sessions: DataFrame, transcripts: DataFrame, documents: DataFrame) -> DataFrame:
    """Sessions, transcripts, notes, summaries and reports per client, each counted once.

    Every table is reduced to counts per session or client before it is joined, so the product of a
    client's transcripts and documents is never formed. Ids are made distinct first: a document id
    listed under two of a client's sessions still counts once.
    """
    s = sessions.where(F.col("client_id").isNotNull()).select(F.col("client_id").alias("__c"), "session_id").distinct()

    def per_client(items: DataFrame, item: str, kind: Column | None) -> DataFrame:
        cols = [F.col("session_id"), F.col(item).alias("__i")] + ([kind.alias("__k")] if kind is not None else [])
        pairs = items.where(F.col("session_id").isNotNull() & F.col(item).isNotNull()).select(*cols).distinct()
        by = ["__c", "__i"] + (["__k"] if kind is not None else [])
        return s.join(pairs, "session_id").select(*by).distinct()

    t = per_client(transcripts, "transcript_id", None).groupBy("__c").agg(F.count("__i").alias("transcripts"))
    d = (
        per_client(documents, "document_id", F.col("doc_type"))
        .groupBy("__c")
        .agg(
            F.count_if(F.col("__k") == NOTE).alias("notes"),
            F.count_if(F.col("__k") == SUMMARY).alias("summaries"),
            F.count_if(F.col("__k") == REPORT).alias("reports"),
        )
    )
    n = s.groupBy("__c").agg(F.count("session_id").alias("sessions"))
    out = clients.select("client_id", "client_folder").distinct()
    for part in (n, t, d):
        out = out.join(part.withColumnRenamed("__c", "client_id"), "client_id", "left")
    names = ["sessions", "transcripts", "notes", "summaries", "reports"]
    return out.select("client_folder", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])


def wide_sessions(clients: DataFrame, sessions: DataFrame, transcripts: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per session with its transcript, note and summary."""

    def docs(kind: str, name: str) -> DataFrame:
        return documents.where(F.col("doc_type") == kind).select("session_id", F.col("content").alias(name))

    return (
        sessions.join(clients.select("client_id", "client_folder", "first_name", "last_name"), "client_id")
        .join(transcripts.select("session_id", F.col("content").alias("transcript")), "session_id", "left")
        .join(docs(NOTE, "session_note"), "session_id", "left")
        .join(docs(SUMMARY, "session_summary"), "session_id", "left")
        .select("client_folder", "first_name", "last_name", "session_num", "transcript", "session_note", "session_summary")
    )


def client_forms(clients: DataFrame, forms: DataFrame) -> DataFrame:
    c = clients.select("client_id", "client_folder", "first_name")
    return forms.join(c, "client_id").select("client_folder", "first_name", "submitted_at", "answers_json")


def file_contacts(clients: DataFrame) -> DataFrame:
    return clients.select(
        "client_folder", "first_name", "last_name", "email", "mobile", "phone", "client_type", "created_at", "idem_key", "client_id"
    )


def file_transcripts(clients: DataFrame, sessions: DataFrame, transcripts: DataFrame) -> DataFrame:
    c, s = clients.select("client_id", "client_folder"), sessions.select("session_id", "session_num")
    rows = transcripts.where(F.col("content").isNotNull()).join(s, "session_id").join(c, "client_id")
    return rows.select("client_folder", "session_num", "content", "idem_key", "transcript_id", "session_id", "client_id")


def file_session_documents(clients: DataFrame, sessions: DataFrame, documents: DataFrame, doc_type: str) -> DataFrame:
    """Notes or summaries that belong to a session of a known client."""
    c, s = clients.select("client_id", "client_folder"), sessions.select("session_id", "session_num")
    rows = documents.where(F.col("content").isNotNull() & (F.col("doc_type") == doc_type))
    return rows.join(s, "session_id").join(c, "client_id").select(
        "client_folder", "session_num", "content", "idem_key", "document_id", "session_id", "client_id", "doc_type"
    )


def file_reports(clients: DataFrame, documents: DataFrame) -> DataFrame:
    """Progress reports, which belong to a client but to no session."""
    rows = documents.where(F.col("content").isNotNull() & (F.col("doc_type") == REPORT))
    return rows.join(clients.select("client_id", "client_folder"), "client_id").select(
        "client_folder", "document_date", "title", "content", "idem_key", "document_id", "client_id", "doc_type"
    )


def file_session_files(sessions: DataFrame, transcripts: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per session for a file with its summary and transcript."""
    t = transcripts.select("session_id", F.col("content").alias("transcript_md"))
    d = documents.where(F.col("doc_type") == SUMMARY).select("session_id", F.col("content").alias("session_summary_md"))
    out = sessions.select("session_id", "client_id", "started_at").join(t, "session_id", "left").join(d, "session_id", "left")
    return out.select("client_id", "session_id", "started_at", "session_summary_md", "transcript_md")


# --- reports on runs and measurements -------------------------------------------------------


def run_metrics(steps: DataFrame, run: Sequence[str] = ("run_id",)) -> DataFrame:
    """Totals, slowest step, throughput and a verdict on reading, per run.

    `steps` has step_id, duration_ms, rows_read and rows_written. A tie for the slowest step goes to
    the step with the larger id.
    """
    ms = F.col("duration_ms")
    reading = F.lower("step_id").contains("read")
    out = steps.groupBy(*run).agg(
        F.sum(ms).alias("total_duration_ms"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).alias("total_rows_read"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("total_rows_written"),
        F.max_by("step_id", F.struct(ms, F.col("step_id"))).alias("bottleneck_step"),
        F.coalesce(F.sum(F.when(reading, ms)), F.lit(0)).alias("read_ms"),
    )
    seconds = F.col("total_duration_ms") / 1000

    def per_second(c: str) -> Column:
        return F.when(F.col("total_duration_ms") > 0, F.round(F.col(c) / seconds, 2)).otherwise(F.lit(0.0))

    return out.withColumns(
        {
            "transform_throughput": per_second("total_rows_read"),
            "write_throughput": per_second("total_rows_written"),
            "query_efficiency": F.when(F.col("read_ms") < READ_GOOD_MS, "good")
            .when(F.col("read_ms") < READ_MODERATE_MS, "moderate")
            .otherwise("poor"),
        }
    ).drop("read_ms")


def measurement_timeseries(observed: DataFrame, events: DataFrame) -> DataFrame:
    """Instrument totals per subject and day."""
    totals = observed.where(F.col("kind") == "total").select("measurement_event_id", "instrument", "value")
    e = events.select("measurement_event_id", "subject_id", "occurred_at")
    return (
        totals.join(e, "measurement_event_id")
        .groupBy("subject_id", "instrument", F.to_date("occurred_at").alias("day"))
        .agg(F.count("*").alias("measurements"), F.round(F.avg("value"), 4).alias("mean_total"))
    )


def weekly_snapshots(timeline: DataFrame) -> DataFrame:
    """Events and different contacts per week and kind, from the contact timeline."""
    return (
        timeline.where(F.col("event_timestamp").isNotNull())
        .groupBy(F.window("event_timestamp", "7 days").alias("w"), "event_type")
        .agg(F.count("*").alias("events"), F.count_distinct("contact_email").alias("contacts"))
        .select(F.col("w.start").alias("week_start"), "event_type", "events", "contacts")
    )
