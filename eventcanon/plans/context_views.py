"""Context tables for assistants: recent mail with personal data removed, calendar, open actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import with_json
from eventcanon.functions.text import regex_group, sender_domain
from eventcanon.functions.time import Instant, ago, as_of_lit, dtype_of, text_to_long, text_to_timestamp
from eventcanon.operators.joins import left_lookup
from eventcanon.plans.client_views import SUBJECT_ID, of_schema

# Window lengths.
MAIL_DAYS = 14
CALENDAR_DAYS = 14
ACTION_HOURS = 24


def contact_addresses(
    canonical: DataFrame, id_path: str = "$.id", primary: str = "$.telecom.email", secondary: str = "$.telecom.emailSecondary"
) -> DataFrame:
    """One row per contact row and different address of it, lower case.

    A join on this table finds what ``mail = primary OR mail = secondary`` finds, as an equality join.
    """
    rows = with_json(of_schema(canonical, "contact").select("payload"), values={"cid": id_path, "m1": primary, "m2": secondary})
    both = F.array_distinct(F.array_compact(F.array(F.lower("m1"), F.lower("m2"))))
    return rows.select(F.col("cid").alias("clinical_contact_id"), F.explode(both).alias("__address"))


def recent_dates(rows: DataFrame, date_column: str | None, first: Column, last: Column | None = None) -> DataFrame:
    """Rows whose `date_column` lies between the days of two times, or is NULL; all rows without such a column.

    Meant for a partition column that holds the day of a time inside the payload: older partitions are then never
    listed or read. It only prunes; the exact test on the time itself stays with the caller.
    """
    if date_column is None:
        return rows
    day = F.col(date_column)
    inside = day >= F.to_date(first)
    if last is not None:
        inside &= day <= F.to_date(last)
    return rows.where(day.isNull() | inside)


def redact_sender(email: Column) -> Column:
    """``a*****@domain``; NULL when the text has no domain."""
    return F.concat(F.lower(F.substring(email, 1, 1)), F.lit("*****@"), sender_domain(email))


def redact_name(name: Column) -> Column:
    return F.concat(F.lit("Client "), F.upper(F.substring(name, 1, 1)), F.lit("."))


def context_emails(
    canonical: DataFrame,
    clinical_sender_domains: Sequence[str],
    practice_recipient_emails: Sequence[str],
    as_of: Instant | None = None,
    days: int = MAIL_DAYS,
    hot_share: float | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Mail of the last `days`. Clinical mail loses the sender's identity and its snippet.

    Clinical is: from an address of a contact, from a listed domain, or to a listed mailbox. A
    sender whose address several contacts share gives one row per contact. For mail without a
    sender the test is NULL unless a listed mailbox decides it; such mail is shown as it is.
    `date_column` names a column with the UTC day of ``receivedAt``, by which older mail is left unread.
    """
    since = as_of_lit(as_of) - F.make_dt_interval(F.lit(days))
    rows = with_json(
        recent_dates(of_schema(canonical, "email"), date_column, since).select("idem_key", "source_system", "connection_name", "payload"),
        values={
            "email_id": "$.id", "thread_id": "$.threadId", "raw_sender": "$.from[0].email", "raw_name": "$.from[0].name",
            "subject": "$.subject", "raw_snippet": "$.preview", "received_text": "$.receivedAt",
            "flagged": "$.keywords.$flagged", "seen": "$.keywords.$seen",
        },
        arrays={"labels": "$.labels", "recipients": "$.to[*].email"},
    ).withColumn("received_at", text_to_timestamp("received_text"))
    rows = rows.where(F.col("received_at") > since)
    unread = F.coalesce("seen", F.lit("false")) != "true"
    sender = F.col("raw_sender")
    rows = rows.select(
        "email_id", "thread_id", "raw_sender", "raw_name", "subject", "raw_snippet", "received_at", "source_system",
        "connection_name", "idem_key", F.lower("raw_sender").alias("__sender"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
        (F.coalesce("flagged", F.lit("false")) == "true").alias("is_flagged"),
        unread.alias("is_unread"),
        (unread & ~sender.like("%noreply%") & ~sender.like("%no-reply%")).alias("needs_response"),
        F.coalesce(F.exists("recipients", lambda a: F.lower(a).isin(*practice_recipient_emails)), F.lit(False)).alias("__listed"),
    )
    found = left_lookup(rows, contact_addresses(canonical), "__sender", "__address", hot_share=hot_share)
    clinical = (
        F.col("clinical_contact_id").isNotNull()
        | sender_domain("__sender").isin(*clinical_sender_domains)
        | F.col("__listed")
    )
    return found.withColumn("is_clinical", clinical).select(
        "email_id", "thread_id",
        F.when(F.col("is_clinical"), redact_sender(sender)).otherwise(sender).alias("sender_email"),
        F.when(F.col("is_clinical"), redact_name(F.col("raw_name"))).otherwise(F.col("raw_name")).alias("sender_name"),
        "subject", F.when(F.col("is_clinical"), F.lit(None)).otherwise(F.col("raw_snippet")).alias("snippet"), "received_at", "labels",
        "is_flagged", "is_unread", "needs_response", "clinical_contact_id", "is_clinical", "source_system",
        "connection_name", "idem_key", as_of_lit(as_of).alias("projected_at"),
    )


def context_calendar(
    canonical: DataFrame, as_of: Instant | None = None, days: int = CALENDAR_DAYS, date_column: str | None = None
) -> DataFrame:
    """Sessions from `days` before to `days` after, with the client's given name and initial.

    `date_column` names a column with the UTC day of ``period.start``, by which other sessions are left unread.
    """
    now, span = as_of_lit(as_of), F.make_dt_interval(F.lit(days))
    rows = with_json(
        recent_dates(of_schema(canonical, "clinical_session"), date_column, now - span, now + span).select("idem_key", "payload"),
        values={
            "session_id": "$.id", "title": "$.title", "num": "$.sessionNumber", "start": "$.period.start", "end": "$.period.end",
            "changed": "$.meta.updatedAt", "minutes": "$.duration", "status": "$.status", "session_type": "$.type",
            "contact_id": "$.subject.reference",
        },
    ).withColumn("scheduled_start", text_to_timestamp("start"))
    rows = rows.where(F.col("scheduled_start").between(now - span, now + span))
    rows = rows.withColumn("__subject", regex_group("contact_id", SUBJECT_ID)).drop("payload")
    names = with_json(
        of_schema(canonical, "contact").select("payload"),
        values={"__cid": "$.id", "given": "$.name.given", "family": "$.name.family"},
    )
    empty = F.lit("")
    names = names.where(F.col("__cid") != "").select(
        "__cid",
        F.concat(F.coalesce("given", empty), F.lit(" "), F.coalesce(F.substring("family", 1, 1), empty)).alias("client_name"),
    )
    return left_lookup(rows, names, "__subject", "__cid").select(
        "session_id", "title", "client_name", text_to_long("num").alias("session_num"), "scheduled_start",
        text_to_timestamp("end").alias("scheduled_end"), text_to_timestamp("changed").alias("actual_start"),
        text_to_long("minutes").alias("duration_minutes"), "status", "session_type", "contact_id", "idem_key",
        as_of_lit(as_of).alias("projected_at"),
    )


def context_actions(actions: DataFrame, as_of: Instant | None = None, hours: int = ACTION_HOURS, ordered: bool = True) -> DataFrame:
    """Pending actions, and those completed in the last `hours`; pending first, newest first."""
    status, at = F.col("status"), F.col("created_at")
    recent = (status == "completed") & (at > ago(as_of, actions, "created_at", hours=hours))
    out = actions.where((status == "pending") | recent)
    if ordered:
        out = out.orderBy(F.when(status == "pending", 0).otherwise(1), at.desc_nulls_last(), "action_id")
    return out.select(
        "action_id", "user_id", "channel", "action_type", "context", "instruction", "created_at", "status",
        F.lit(None).cast("string").alias("idem_key"), as_of_lit(as_of, dtype_of(actions, "created_at")).alias("projected_at"),
    )
