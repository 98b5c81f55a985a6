"""Raw payloads to canonical payloads, one plan per object kind.

Each transform takes rows of the raw table and returns them with a canonical JSON payload. Paths
and code lists are fixed values shared with the systems the data comes from.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import to_json_full, with_json
from eventcanon.functions.keys import suffixed
from eventcanon.functions.time import Instant, as_of_lit

# Canonical schema names.
SCHEMAS = {
    "clinical_session": "iglu:org.canonical/clinical_session/jsonschema/2-0-0",
    "session_transcript": "iglu:org.canonical/session_transcript/jsonschema/2-0-0",
    "clinical_document": "iglu:org.canonical/clinical_document/jsonschema/2-0-0",
    "contact": "iglu:org.canonical/contact/jsonschema/2-0-0",
    "form_response": "iglu:org.canonical/form_response/jsonschema/1-0-0",
    "email": "iglu:org.canonical/email_jmap_lite/jsonschema/1-0-0",
    "customer": "iglu:org.canonical/customer/jsonschema/1-0-0",
    "invoice": "iglu:org.canonical/invoice/jsonschema/1-0-0",
    "payment": "iglu:org.canonical/payment/jsonschema/1-0-0",
    "refund": "iglu:org.canonical/refund/jsonschema/1-0-0",
}

# Session status codes.
SESSION_STATUS = {
    "1": "scheduled",
    "2": "completed",
    "3": "cancelled",
    "4": "in_progress",
    "5": "no_show",
}

# Document kinds and the raw session field that holds their text.
DOCUMENT_FIELDS = {
    "soap-note": "cre92_clientsessionnote",
    "client-summary": "cre92_clientsessionsummary",
    "progress-report": "cre92_clientreport",
}
TRANSCRIPT_FIELD = "cre92_sessiontranscript"

# The columns of the canonical table.
CANONICAL_COLUMNS = (
    "idem_key", "source_system", "connection_name", "object_type", "canonical_schema",
    "canonical_format", "transform_ref", "payload", "correlation_id", "canonicalized_at", "created_at",
)


@dataclass(frozen=True)
class Transform:
    """Which raw paths a canonical payload needs, and the payload made of them (as ``r_`` columns)."""

    paths: Mapping[str, str]
    payload: Callable[[], list[Column]]
    lists: Mapping[str, str] = field(default_factory=dict)

    def __call__(self, df: DataFrame) -> DataFrame:
        """Raw rows with their payload replaced by the canonical one."""
        rows = _parsed(df, self.paths, self.lists).withColumn("payload", to_json_full(*self.payload()))
        return rows.drop(*[c for c in rows.columns if c.startswith("r_")])


def _parsed(df: DataFrame, paths: Mapping[str, str], lists: Mapping[str, str]) -> DataFrame:
    return with_json(
        df, values={f"r_{n}": p for n, p in paths.items()}, arrays={f"r_{n}": p for n, p in lists.items()}
    )


def lookup(codes: Mapping[str, str], code: Column) -> Column:
    """Text of a code; NULL for unknown codes."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), code)


def _source(platform: str, version: str) -> Column:
    return F.struct(F.lit(platform).alias("platform"), F.lit(version).alias("platform_version")).alias("source")


def _r(name: str, alias: str | None = None) -> Column:
    return F.col(f"r_{name}").alias(alias or name)


def _present(name: str) -> Column:
    return F.when(F.col(f"r_{name}") != "", F.col(f"r_{name}"))


clinical_session = Transform(
    {
        "id": "$.cre92_clientsessionid", "num": "$.cre92_sessionnumber", "s0": "$.scheduledstart", "s1": "$.scheduledend",
        "a0": "$.actualstart", "a1": "$.actualend", "subject": "$.subject", "description": "$.description", "code": "$.statuscode",
        "client": "$._cre92_client_value", "regarding": "$.regardingobjectid", "other": "$._ben_contactid_value",
        "kind": "$._ben_sessiontype_value", "minutes": "$.scheduleddurationminutes", "created": "$.createdon", "modified": "$.modifiedon",
    },
    lambda: [
        _r("id", "source_id"), F.lit("cre92_clientsession").alias("source_entity"), _r("id", "session_id"),
        F.col("r_num").try_cast("long").alias("session_num"), _r("s0", "scheduled_start"), _r("s1", "scheduled_end"),
        _r("a0", "actual_start"), _r("a1", "actual_end"), _r("subject"), _r("description"),
        lookup(SESSION_STATUS, F.col("r_code")).alias("status"),
        F.coalesce(_present("client"), _present("regarding"), F.col("r_other")).alias("contact_id"),
        _r("kind", "session_type"), F.col("r_minutes").try_cast("long").alias("duration_minutes"),
        _r("created", "created_at"), _r("modified", "updated_at"), _source("dataverse", "v2"),
    ],
)


def _session_paths(text_field: str) -> dict[str, str]:
    return {
        "id": "$.cre92_clientsessionid", "client": "$._cre92_client_value", "created": "$.createdon",
        "modified": "$.modifiedon", f"text_{text_field}": f"$.{text_field}",
    }


def _markdown(text_field: str) -> Column:
    body = F.col(f"r_text_{text_field}")
    return F.when(body.isNotNull(), F.struct(F.lit("markdown").alias("format"), body.alias("text"))).alias("content")


def _subject() -> Column:
    return F.struct(F.concat(F.lit("Contact/"), F.coalesce("r_client", F.lit(""))).alias("reference")).alias("subject")


def _meta() -> Column:
    return F.struct(_r("created", "createdAt"), _r("modified", "updatedAt")).alias("meta")


def session_transcript(text_field: str = TRANSCRIPT_FIELD) -> Transform:
    return Transform(
        _session_paths(text_field),
        lambda: [
            F.concat("r_id", F.lit("-transcript")).alias("id"), _r("id", "session_source_id"), _subject(), _r("created", "date"),
            _markdown(text_field), F.lit("en").alias("language"), F.struct(F.lit("completed").alias("status")).alias("processing"),
            _meta(), _source("dataverse", "v2"),
        ],
    )


def clinical_document(doc_type: str, text_field: str | None = None) -> Transform:
    """Transform for one kind of document: soap-note, client-summary or progress-report."""
    name = text_field or DOCUMENT_FIELDS[doc_type]
    return Transform(
        _session_paths(name),
        lambda: [
            F.concat("r_id", F.lit(f"-{doc_type}")).alias("id"), _r("id", "session_source_id"), F.lit(doc_type).alias("docType"),
            _subject(), _r("created", "date"), _markdown(name), _meta(), _source("dataverse", "v2"),
        ],
    )


contact = Transform(
    {
        "id": "$.contactid", "first": "$.firstname", "last": "$.lastname", "email": "$.emailaddress1", "mobile": "$.mobilephone",
        "phone": "$.telephone1", "birth": "$.birthdate", "created": "$.createdon", "modified": "$.modifiedon",
        "label": "$['_cre92_contacttype_value@OData.Community.Display.V1.FormattedValue']",
        "code": "$._cre92_contacttype_value", "stage": "$.lifecycleStage",
    },
    lambda: [
        _r("id", "contact_id"), _r("first", "first_name"), _r("last", "last_name"), _r("email"), _r("mobile"), _r("phone"),
        _r("label", "client_type_label"), _r("code", "client_type_code"), _r("stage", "lifecycleStage"), _r("birth", "birth_date"),
        _r("created", "created_at"), _r("modified", "updated_at"), _source("dataverse", "v2"),
    ],
)


_ANSWERS = (
    "answers map<string, struct<questionId: string, textAnswers: struct<answers: array<struct<value: string>>>>>"
)


def _answer_list() -> Column:
    """Answers keyed by question id as an array of {question_id, answer_type, answer_value}."""
    answers = F.transform(
        F.map_entries(F.from_json("payload", _ANSWERS)["answers"]),
        lambda e: F.struct(
            F.coalesce(e["value"]["questionId"], e["key"]).alias("question_id"),
            F.lit("choice").alias("answer_type"),
            F.get(e["value"]["textAnswers"]["answers"], 0)["value"].alias("answer_value"),
        ),
    )
    none = F.array().cast("array<struct<question_id:string,answer_type:string,answer_value:string>>")
    return F.coalesce(answers, none).alias("answers")


form_response = Transform(
    {"id": "$.responseId", "form": "$.formId", "email": "$.respondentEmail", "at": "$.lastSubmittedTime"},
    lambda: [
        _r("id", "response_id"), _r("form", "form_id"), F.struct(_r("email")).alias("respondent"),
        F.lit("submitted").alias("status"), _r("at", "submitted_at"), _r("at", "last_updated_at"), _answer_list(),
        _source("google_forms", "v1"),
    ],
)


# Our own mapping: canonical mail path -> path in the raw object, per mail system.
MAIL_PATHS = {
    "gmail": {
        "id": "$.id", "thread": "$.threadId", "subject": "$.subject", "preview": "$.snippet",
        "sent": "$.sentAt", "received": "$.receivedAt", "from_email": "$.from", "from_name": "$.fromName",
    },
    "exchange": {
        "id": "$.id", "thread": "$.conversationId", "subject": "$.subject", "preview": "$.bodyPreview",
        "sent": "$.sentDateTime", "received": "$.receivedDateTime",
        "from_email": "$.from.emailAddress.address", "from_name": "$.from.emailAddress.name",
    },
}
MAIL_LISTS = {
    "gmail": {"to": "$.to", "labels": "$.labelIds"},
    "exchange": {"to": "$.toRecipients[*].emailAddress.address", "labels": "$.categories"},
}


def _list(name: str) -> Column:
    return F.coalesce(f"r_{name}", F.array().cast("array<string>"))


def email(system: str) -> Transform:
    """Mail of one system to the common mail object: from[], to[], labels[], keywords."""

    def payload() -> list[Column]:
        if system == "gmail":
            seen, flagged = ~F.array_contains(_list("labels"), "UNREAD"), F.array_contains(_list("labels"), "STARRED")
        else:
            seen = F.coalesce(F.col("r_read") == "true", F.lit(False))
            flagged = F.coalesce(F.col("r_flag") == "flagged", F.lit(False))
        return [
            _r("id"), _r("thread", "threadId"), F.array(F.struct(_r("from_email", "email"), _r("from_name", "name"))).alias("from"),
            F.transform(_list("to"), lambda a: F.struct(a.alias("email"))).alias("to"), _r("subject"), _r("preview"),
            _r("sent", "sentAt"), _r("received", "receivedAt"), _list("labels").alias("labels"),
            F.struct(seen.alias("$seen"), flagged.alias("$flagged")).alias("keywords"), _source(system, "v1"),
        ]

    return Transform({**MAIL_PATHS[system], "read": "$.isRead", "flag": "$.flag.flagStatus"}, payload, MAIL_LISTS[system])


# Our own mapping: canonical payment-system paths -> paths in the raw object.
BILLING_PATHS = {
    "customer": {"customer_id": "$.id", "email": "$.email", "name": "$.name"},
    "invoice": {
        "invoice_id": "$.id", "customer_email": "$.customer_email", "status": "$.status", "event_time": "$.created",
        "invoice_number": "$.number", "amount_due": "$.amount_due", "currency": "$.currency", "description": "$.description",
    },
    "payment": {
        "payment_id": "$.id", "customer_id": "$.customer", "status": "$.status", "event_time": "$.created",
        "amount": "$.amount", "currency": "$.currency", "payment_method_type": "$.payment_method_types[0]",
    },
    "refund": {
        "refund_id": "$.id", "status": "$.status", "event_time": "$.created", "amount": "$.amount",
        "currency": "$.currency", "reason": "$.reason", "payment_intent_id": "$.payment_intent",
    },
}


def billing(kind: str) -> Transform:
    """customer, invoice, payment or refund. Epoch seconds in ``created`` become ISO text."""

    def one(name: str) -> Column:
        col = F.col(f"r_{name}")
        if name == "event_time":
            at = F.timestamp_seconds(col.try_cast("long"))
            col = F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), col)
        return col.alias(name)

    paths = BILLING_PATHS[kind]
    return Transform(paths, lambda: [*[one(n) for n in paths], _source("stripe", "v1")])


def envelope(
    df: DataFrame, schema: str, transform_ref: str, suffix: str | None = None,
    as_of: Instant | None = None, canonical_format: str = "iglu",
) -> DataFrame:
    """Transformed rows as rows of the canonical table."""
    now = as_of_lit(as_of)
    out = df.withColumns(
        {
            "canonical_schema": F.lit(schema), "canonical_format": F.lit(canonical_format),
            "transform_ref": F.lit(transform_ref), "canonicalized_at": now, "created_at": now,
        }
    )
    if suffix:
        out = out.withColumn("idem_key", suffixed("idem_key", suffix))
    return out.select(*CANONICAL_COLUMNS)


# One raw session gives these canonical objects: (key suffix, schema, transform reference, transform).
SESSION_PARTS = (
    ("session", "clinical_session", "clinical_session@2.0.0", clinical_session),
    ("transcript", "session_transcript", "session_transcript@2.0.0", session_transcript()),
    ("session_note", "clinical_document", "clinical_document@2.0.0", clinical_document("soap-note")),
    ("session_summary", "clinical_document", "clinical_document@2.0.0", clinical_document("client-summary")),
)


def fan_out(raw: DataFrame, parts=SESSION_PARTS, as_of: Instant | None = None) -> DataFrame:
    """All canonical objects of raw rows: the rows are read once and their JSON is parsed once.

    The payloads of all parts are made side by side and exploded; nothing is shuffled.
    """
    paths: dict[str, str] = {}
    for *_, transform in parts:
        for name, path in transform.paths.items():
            if paths.setdefault(name, path) != path:
                raise ValueError(f"two paths under one name: {name}")
    made = [
        F.struct(
            F.lit(suffix).alias("suffix"), F.lit(SCHEMAS[schema]).alias("schema"), F.lit(ref).alias("ref"),
            to_json_full(*transform.payload()).alias("payload"),
        )
        for suffix, schema, ref, transform in parts
    ]
    now = as_of_lit(as_of)
    return _parsed(raw, paths, {}).withColumn("o", F.explode(F.array(*made))).select(
        F.concat("idem_key", F.lit("#"), "o.suffix").alias("idem_key"), "source_system", "connection_name", "object_type",
        F.col("o.schema").alias("canonical_schema"), F.lit("iglu").alias("canonical_format"),
        F.col("o.ref").alias("transform_ref"), F.col("o.payload").alias("payload"), "correlation_id",
        now.alias("canonicalized_at"), now.alias("created_at"),
    )
