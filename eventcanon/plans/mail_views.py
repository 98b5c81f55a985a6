"""A flat table of raw mail, and searches on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import with_json
from eventcanon.functions.text import contains_terms, sender_domain
from eventcanon.functions.time import parse_rfc2822


def emails_mv(raw: DataFrame, object_type: str = "email") -> DataFrame:
    """Raw mail with its often-read fields as columns; write it once, read it many times."""
    rows = with_json(
        raw.where(F.col("object_type") == object_type).select("idem_key", "source_system", "first_seen", "last_seen", "payload"),
        values={
            "message_id": "$.id", "thread_id": "$.threadId", "subject": "$.subject", "from_email": "$.from",
            "date": "$.date", "snippet": "$.snippet",
        },
        arrays={"to_emails": "$.to", "cc_emails": "$.cc", "labels": "$.labelIds"},
    )
    return rows.select(
        "idem_key", "source_system", "message_id", "thread_id", "subject", "from_email", "to_emails", "cc_emails",
        parse_rfc2822("date").alias("email_date"), "labels", "snippet", "first_seen", "last_seen", "payload",
    )


def subject_contains(mail: DataFrame, text: str) -> DataFrame:
    return mail.where(F.contains(F.col("subject"), F.lit(text))).select("message_id", "subject", "from_email", "email_date")


def count_by_sender(mail: DataFrame) -> DataFrame:
    return mail.groupBy("from_email").agg(F.count("*").alias("email_count"))


def with_label(mail: DataFrame, label: str) -> DataFrame:
    return mail.where(F.array_contains("labels", label)).select("message_id", "subject", "email_date")


def search_payload(df: DataFrame, text: str, column: str = "payload") -> DataFrame:
    """Rows whose text holds every word of `text`, in any order and case."""
    return df.where(contains_terms(column, text))


def with_extracted(df: DataFrame, paths: dict[str, str], payload: str = "payload") -> DataFrame:
    """Often-read payload paths as columns, to be written with the table."""
    return with_json(df, payload, values=paths)


def inbox_view(mail: DataFrame) -> DataFrame:
    """One row per thread: messages, senders' domains, first and last date, newest subject."""
    at = F.struct("email_date", "message_id")
    return (
        mail.withColumn("__domain", sender_domain(F.lower("from_email")))
        .groupBy("thread_id")
        .agg(
            F.count("*").alias("messages"),
            F.count_distinct("__domain").alias("sender_domains"),
            F.min("email_date").alias("first_at"),
            F.max("email_date").alias("last_at"),
            F.max_by("subject", at).alias("subject"),
        )
    )
