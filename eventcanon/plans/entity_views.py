"""Current state of domain entities, folded from the domain event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import with_json
from eventcanon.operators.latest import fold_latest, latest_per_key

# Payload fields of each entity. Fields listed in JSON_FIELDS hold JSON arrays.
FIELDS = {
    "project": ("name", "description", "owner", "status", "target_end_date"),
    "deliverable": ("project_id", "name", "description", "status", "acceptance_criteria", "due_date"),
    "opsstream": ("name", "type", "owner", "status", "description"),
    "work_item": (
        "title", "kind", "state", "priority", "severity", "assignees", "labels", "due_at", "project_id",
        "deliverable_id", "opsstream_id", "parent_id",
    ),
    "artifact": (
        "title", "kind", "status", "content", "content_ref", "delivered_via", "tags", "work_item_id", "deliverable_id",
        "project_id", "opsstream_id", "contact_ref",
    ),
}
# What the hierarchy reads of a project, beside what its view shows.
PROJECT_STATE = (*FIELDS["project"], "opsstream_id")
JSON_FIELDS = {"assignees", "labels", "tags"}
ARTIFACT_CONTENT_LENGTH = 500


def entity_events(log: DataFrame, kind: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Events of one kind of entity with their payload fields as columns."""
    fields = fields or FIELDS[kind]
    rows = log.where(F.col("aggregate_type") == kind).select("aggregate_id", "event_id", "occurred_at", "payload")
    rows = with_json(
        rows,
        values={f: f"$.{f}" for f in fields if f not in JSON_FIELDS},
        queries={f: f"$.{f}" for f in fields if f in JSON_FIELDS},
    )
    return rows.drop("payload")


def fold_entity(log: DataFrame, kind: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    fields = fields or FIELDS[kind]
    return fold_latest(entity_events(log, kind, fields), "aggregate_id", fields, key_name=f"{kind}_id")


def project_states(log: DataFrame) -> DataFrame:
    """Projects with their stream, as `effective_opsstreams` needs them."""
    return fold_entity(log, "project", PROJECT_STATE)


def view_pm_projects(log: DataFrame) -> DataFrame:
    return fold_entity(log, "project")


def view_pm_deliverables(log: DataFrame) -> DataFrame:
    return fold_entity(log, "deliverable")


def view_pm_opsstreams(log: DataFrame) -> DataFrame:
    return fold_entity(log, "opsstream")


def view_pm_artifacts(log: DataFrame, content_length: int | None = ARTIFACT_CONTENT_LENGTH) -> DataFrame:
    """Artifacts; the content is shown up to `content_length` characters (None: whole)."""
    rows = fold_entity(log, "artifact")
    return rows if content_length is None else rows.withColumn("content", F.substring("content", 1, content_length))


def view_pm_work_items(log: DataFrame) -> DataFrame:
    """Work items with the project they belong to: their own, else that of their deliverable."""
    items = fold_entity(log, "work_item")
    parents = fold_entity(log, "deliverable").select(
        F.col("deliverable_id").alias("__d"), F.col("project_id").alias("__project")
    )
    out = items.join(parents, F.col("deliverable_id") == F.col("__d"), "left").withColumn(
        "effective_project_id", F.coalesce("project_id", "__project")
    )
    head = ["work_item_id", *FIELDS["work_item"], "effective_project_id", "row_id", "row_version", "row_state"]
    return out.select(*head)


def effective_opsstreams(
    work_items: DataFrame, deliverables: DataFrame, projects: DataFrame, project_stream: str = "opsstream_id"
) -> DataFrame:
    """Work items with the stream they belong to: their own, else that of their (deliverable's) project.

    Deliverables or projects without a stream column are taken as having none.
    """

    def stream(df: DataFrame, name: str):
        return (F.col(name) if name in df.columns else F.lit(None).cast("string")).alias("__s")

    d = deliverables.select(
        F.col("deliverable_id").alias("__d"), F.col("project_id").alias("__dp"), stream(deliverables, "opsstream_id").alias("__ds")
    )
    p = projects.select(F.col("project_id").alias("__p"), stream(projects, project_stream).alias("__ps"))
    out = work_items.join(d, F.col("deliverable_id") == F.col("__d"), "left")
    out = out.withColumn("effective_project_id", F.coalesce("project_id", "__dp"))
    out = out.join(p, F.col("effective_project_id") == F.col("__p"), "left")
    out = out.withColumn("effective_opsstream_id", F.coalesce("opsstream_id", "__ds", "__ps"))
    return out.drop("__d", "__dp", "__ds", "__p", "__ps")


def domain_objects(log: DataFrame, aggregate_type: str = "domain_object", drop_deleted: str = "before") -> DataFrame:
    """The newest event of every domain object.

    ``drop_deleted="before"`` removes deletion events first, so the last live state shows again
    after a deletion; ``"after"`` removes objects whose newest event is a deletion.
    """
    rows = log.where(F.col("aggregate_type") == aggregate_type)
    live = ~F.col("event_type").like("%.deleted")
    if drop_deleted == "before":
        rows = rows.where(live)
    newest = latest_per_key(rows, ["aggregate_id"], ["occurred_at", "event_id"])
    if drop_deleted == "after":
        newest = newest.where(live)
    out = with_json(
        newest,
        values={
            "idem_key": "$.idem_key", "entity_id": "$.entity_id", "object_type": "$.object_type",
            "object_variant": "$.object_variant", "content": "$.content", "model_used": "$.model_used",
        },
        queries={"inference_audit": "$.inference_audit"},
    )
    return out.select(
        "event_id", "aggregate_id", "aggregate_type", "event_type", "subject_id", F.col("occurred_at").alias("synthesized_at"),
        F.col("ingested_at").alias("created_at"), "idem_key", "entity_id", "object_type", "object_variant", "content",
        "model_used", "inference_audit", "payload", "producer_service", "producer_component", "correlation_id",
    )
