"""From form responses to scored observations.

Which question belongs to which instrument, and what an answer is worth, is data: a key table
(binding_id, field_key, instrument, item, reverse_from) and a value table (instrument, answer, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import with_json
from eventcanon.functions.time import Instant, as_of_lit, text_to_timestamp
from eventcanon.plans.canonical import SCHEMAS
from eventcanon.operators.merge import merge_into
from eventcanon.sources.catalog import SnapshotTable
from eventcanon.sources.changes import run_once
from eventcanon.sources.incremental import missing_rows

# Form bindings and the connection each one reads.
BINDINGS = {
    "intake_01": "google-forms-intake-01",
    "intake_02": "google-forms-intake-02",
    "followup": "google-forms-followup",
}

#: Stands for the subject of a form without an address.
UNKNOWN_SUBJECT = "unknown@example.com"

ANSWERS = "array<struct<question_id: string, answer_type: string, answer_value: string>>"


def measurement_events(
    canonical: DataFrame, binding_id: str, connection_name: str | None = None, binding_version: str = "1.0.0",
    as_of: Instant | None = None,
) -> DataFrame:
    """One measurement event per form response of a binding."""
    mine = (F.col("canonical_schema") == SCHEMAS["form_response"]) & (
        F.col("connection_name") == (connection_name or BINDINGS[binding_id])
    )
    rows = with_json(
        canonical.where(mine),
        values={
            "response_id": "$.response_id", "form_id": "$.form_id", "email": "$.respondent.email",
            "submitted_at": "$.submitted_at", "last_updated_at": "$.last_updated_at",
        },
        queries={"answers": "$.answers"},
    )
    now = as_of_lit(as_of)
    return rows.select(
        F.concat(F.lit("me:"), "idem_key").alias("measurement_event_id"),
        F.concat(F.lit("me:"), "idem_key").alias("idem_key"),
        F.col("email").alias("subject_id"),
        F.lit("form").alias("event_type"),
        F.lit(binding_id).alias("event_subtype"),
        text_to_timestamp(F.coalesce("submitted_at", "last_updated_at")).alias("occurred_at"),
        F.lit(binding_id).alias("binding_id"),
        F.lit(binding_version).alias("binding_version"),
        F.col("form_id"),
        F.col("response_id").alias("source_id"),
        F.col("idem_key").alias("canonical_object_id"),
        F.col("correlation_id"),
        now.alias("processed_at"),
        now.alias("created_at"),
        # The answers are JSON text already: placed as they are, not quoted again.
        F.concat(F.lit('{"answers":'), F.coalesce("answers", F.lit("[]")), F.lit("}")).alias("metadata"),
    )


def scoring_items(events: DataFrame, unknown: str = UNKNOWN_SUBJECT) -> DataFrame:
    """Answers of each event as rows: field_key, position from 1, answer; subject ``contact::email``, with `unknown` for none."""
    answers = F.from_json("metadata", f"answers {ANSWERS}")["answers"]
    subject = F.concat(F.lit("contact::"), F.coalesce("subject_id", F.lit(unknown)))
    return events.select(
        "measurement_event_id", "binding_id", "binding_version", "occurred_at", "correlation_id",
        subject.alias("subject_id"), F.posexplode(answers).alias("__pos", "__a"),
    ).select(
        "measurement_event_id", "binding_id", "binding_version", "occurred_at", "correlation_id", "subject_id",
        F.col("__a.question_id").alias("field_key"), (F.col("__pos") + 1).alias("position"),
        F.col("__a.answer_value").alias("answer"),
    )


def scored_items(items: DataFrame, keys: DataFrame, values: DataFrame) -> DataFrame:
    """Each mapped answer with its instrument, item and number; unknown answers give NULL.

    Key and value tables are settings (a row for each question and each answer) and are broadcast: items have few different
    questions and answers, so a shuffle by them would bring most items into a few tasks. A reversed item counts ``reverse_from - value``.
    """
    keyed = items.join(F.broadcast(keys), ["binding_id", "field_key"])
    lowered = values.select("instrument", F.lower(F.trim("answer")).alias("__answer"), F.col("value").alias("__value"))
    valued = keyed.withColumn("__answer", F.lower(F.trim("answer"))).join(F.broadcast(lowered), ["instrument", "__answer"], "left")
    reverse = F.col("reverse_from")
    value = F.when(reverse.isNotNull(), reverse - F.col("__value")).otherwise(F.col("__value"))
    return valued.withColumn("value", value.cast("double")).drop("__answer", "__value", "reverse_from")


def score(scored: DataFrame) -> DataFrame:
    """Sum, answered and unanswered items per event and instrument."""
    return scored.groupBy("measurement_event_id", "instrument").agg(
        F.sum("value").alias("total"),
        F.count("value").alias("answered"),
        F.count_if(F.col("value").isNull()).alias("unanswered"),
    )


def observations(scored: DataFrame, as_of: Instant | None = None) -> DataFrame:
    """Item rows and total rows, keyed so that a second run updates instead of adding."""
    now = as_of_lit(as_of)
    item_rows = scored.select(
        F.concat_ws(":", F.lit("obs"), "measurement_event_id", "instrument", "item").alias("idem_key"),
        "measurement_event_id", "instrument", "item", F.col("answer").alias("raw_answer"), "value",
        F.lit("item").alias("kind"),
    )
    total_rows = score(scored).select(
        F.concat_ws(":", F.lit("obs"), "measurement_event_id", "instrument", F.lit("total")).alias("idem_key"),
        "measurement_event_id", "instrument", F.lit("total").alias("item"), F.lit(None).cast("string").alias("raw_answer"),
        F.col("total").alias("value"), F.lit("total").alias("kind"),
    )
    both = item_rows.unionByName(total_rows)
    return both.withColumns({"processed_at": now, "created_at": now})


def unformed_responses(canonical: DataFrame, events: DataFrame, binding_id: str, connection_name: str | None = None) -> DataFrame:
    """Form responses of a binding that have no measurement event."""
    filters = {"canonical_schema": SCHEMAS["form_response"], "connection_name": connection_name or BINDINGS[binding_id]}
    return missing_rows(canonical, events, "idem_key", "canonical_object_id", filters=filters)


def measure_new(
    responses: SnapshotTable, events: SnapshotTable, binding_id: str, connection_name: str | None = None, as_of: Instant | None = None
) -> int | None:
    """One run of a binding over the responses that came or changed since its last run; the version of `events` that it published.

    With nothing new neither table is read and None is returned. A changed response replaces its event.
    """
    filters = {"canonical_schema": SCHEMAS["form_response"], "connection_name": connection_name or BINDINGS[binding_id]}

    def publish(made: DataFrame, properties: dict) -> int:
        if not events.exists():
            return events.replace(made, properties=properties)
        return events.replace_touched(lambda now: merge_into(now, made, ["idem_key"], order=["processed_at"]), made, properties=properties)

    return run_once(
        responses, events, lambda rows: measurement_events(rows, binding_id, connection_name, as_of=as_of), publish, ["idem_key"], filters, binding_id)


def unscored_events(events: DataFrame, observed: DataFrame, binding_id: str) -> DataFrame:
    """Measurement events of a binding that have no observation."""
    return missing_rows(events, observed, "measurement_event_id", "measurement_event_id", filters={"binding_id": binding_id})


def without_binding(observed: DataFrame, events: DataFrame, binding_id: str) -> DataFrame:
    """Observations to keep when a binding is scored again from the start."""
    mine = events.where(F.col("binding_id") == binding_id).select("measurement_event_id").distinct()
    return observed.join(mine, ["measurement_event_id"], "left_anti")


def scoring_input(events: DataFrame, unknown: str = UNKNOWN_SUBJECT) -> DataFrame:
    """Events as one scoring document each: form_id, submission id, subject (`unknown` for none), time and items."""
    answers = F.from_json("metadata", f"answers {ANSWERS}")["answers"]
    items = F.transform(
        answers,
        lambda a, i: F.struct(a["question_id"].alias("field_key"), (i + 1).alias("position"), a["answer_value"].alias("answer")),
    )
    subject = F.concat(F.lit("contact::"), F.coalesce("subject_id", F.lit(unknown)))
    return events.select(
        F.concat(F.lit("googleforms::"), "form_id").alias("form_id"), F.col("source_id").alias("form_submission_id"),
        subject.alias("subject_id"), F.col("occurred_at").alias("timestamp"), items.alias("items"),
    )
