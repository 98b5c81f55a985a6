"""Flat views over canonical objects: clients, sessions, documents, forms, and the contact timeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.json import to_json_full, with_json
from eventcanon.functions.text import regex_group
from eventcanon.functions.time import text_to_long, text_to_timestamp
from eventcanon.operators.joins import left_lookup
from eventcanon.operators.latest import latest_per_key
from eventcanon.plans.canonical import SCHEMAS

# The client type code that stands for therapy, and the state of current clients.
THERAPY_CODE = "1"
ACTIVE_STAGE = "active"

# The mail systems of the timeline, and how much of a subject its event names show.
MAIL_SYSTEMS = ("gmail", "exchange")
SUBJECT_LENGTH = 50

SUBJECT_ID = r"/(.+)$"

TIMELINE_COLUMNS = (
    "contact_id", "contact_email", "event_type", "event_name", "event_source",
    "event_timestamp", "source_system", "source_record_id", "payload",
)


def of_schema(canonical: DataFrame, kind: str) -> DataFrame:
    return canonical.where(F.col("canonical_schema") == SCHEMAS[kind])


def in_code_list(codes: Column, code: str) -> Column:
    """True when `code` is an element of a comma list (not merely part of its text)."""
    return F.array_contains(F.split(codes, ","), code)


def folder_name(first: str, last: str, fallback: str) -> Column:
    """``First L``; the last name alone without a first name; `fallback` without a last name."""
    return (
        F.when(F.col(first).isNotNull() & F.col(last).isNotNull(), F.concat(first, F.lit(" "), F.substring(last, 1, 1)))
        .when(F.col(last).isNotNull(), F.col(last))
        .otherwise(F.col(fallback))
    )


def _active_therapy() -> Column:
    return in_code_list(F.col("client_type_code"), THERAPY_CODE) & (F.col("lifecycle_stage") == ACTIVE_STAGE)


def proj_clients(canonical: DataFrame) -> DataFrame:
    rows = with_json(
        of_schema(canonical, "contact").select("idem_key", "payload"),
        values={
            "client_id": "$.contact_id", "first_name": "$.first_name", "last_name": "$.last_name", "email": "$.email",
            "mobile": "$.mobile", "phone": "$.phone", "client_type": "$.client_type_label",
            "client_type_code": "$.client_type_code", "created_at": "$.created_at", "updated_at": "$.updated_at",
            "lifecycle_stage": "$.lifecycleStage",
        },
    )
    return rows.where(_active_therapy()).select(
        "client_id", "first_name", "last_name", "email", "mobile", "phone", "client_type", "client_type_code",
        folder_name("first_name", "last_name", "client_id").alias("client_folder"), "created_at", "updated_at", "idem_key",
    )


def proj_sessions(canonical: DataFrame, strict: bool = False) -> DataFrame:
    """Sessions that name a contact. A session number that is no number is NULL, or fails when `strict`."""
    rows = with_json(
        of_schema(canonical, "clinical_session").select("idem_key", "payload"),
        values={
            "session_id": "$.session_id", "client_id": "$.contact_id", "num": "$.session_num",
            "started_at": "$.created_at", "ended_at": "$.updated_at", "session_status": "$.status",
        },
    )
    return rows.where(F.col("client_id").isNotNull()).select(
        "session_id", "client_id", text_to_long("num", strict).alias("session_num"), "started_at", "ended_at",
        "session_status", "idem_key",
    )


def proj_transcripts(canonical: DataFrame) -> DataFrame:
    rows = with_json(
        of_schema(canonical, "session_transcript").select("idem_key", "payload"),
        values={
            "transcript_id": "$.id", "session_id": "$.session_source_id", "reference": "$.subject.reference",
            "content": "$.content.text", "language": "$.language", "transcript_date": "$.date",
            "processing_status": "$.processing.status", "created_at": "$.meta.createdAt", "updated_at": "$.meta.updatedAt",
        },
    )
    return rows.select(
        "transcript_id", "session_id", regex_group("reference", SUBJECT_ID).alias("client_id"), "content", "language",
        "transcript_date", "processing_status", "created_at", "updated_at", "idem_key",
    )


def proj_clinical_documents(canonical: DataFrame) -> DataFrame:
    rows = with_json(
        of_schema(canonical, "clinical_document").select("object_type", "idem_key", "payload"),
        values={
            "document_id": "$.id", "session_id": "$.session_source_id", "reference": "$.subject.reference",
            "doc_type": "$.docType", "title": "$.title", "content": "$.content.text", "status": "$.status",
            "audience": "$.audience", "document_date": "$.date", "created_at": "$.meta.createdAt", "updated_at": "$.meta.updatedAt",
        },
    )
    return rows.select(
        "document_id", "session_id", regex_group("reference", SUBJECT_ID).alias("client_id"), "doc_type", "title",
        "content", "status", "audience", "document_date", "created_at", "updated_at", "object_type", "idem_key",
    )


def proj_form_responses(canonical: DataFrame, hot_share: float | None = None) -> DataFrame:
    """Form responses with the client(s) of the respondent's address.

    Contacts are not reduced to one per address here: an address two contacts share gives two rows.
    """
    contacts = with_json(
        of_schema(canonical, "contact").select("payload"), values={"client_id": "$.contact_id", "email": "$.email"}
    ).select("client_id", F.lower("email").alias("__email"))
    rows = with_json(
        of_schema(canonical, "form_response").select("idem_key", "payload"),
        values={
            "response_id": "$.response_id", "respondent_email": "$.respondent.email", "status": "$.status",
            "submitted_at": "$.submitted_at", "last_updated_at": "$.last_updated_at", "source_platform": "$.source.platform",
        },
        queries={"answers_json": "$.answers"},
    ).drop("payload").withColumn("__respondent", F.lower("respondent_email"))
    joined = left_lookup(rows, contacts, "__respondent", "__email", hot_share=hot_share)
    return joined.select(
        "idem_key", "response_id", "respondent_email", "client_id", "status", "submitted_at", "last_updated_at",
        "source_platform", "answers_json",
    )


# --- the contact timeline -------------------------------------------------------------------


def therapy_clients(canonical: DataFrame) -> DataFrame:
    """One current therapy client per address: the one updated last."""
    rows = with_json(
        of_schema(canonical, "contact").select("idem_key", "payload"),
        values={
            "c_id": "$.contact_id", "mail": "$.email", "client_type_code": "$.client_type_code",
            "lifecycle_stage": "$.lifecycleStage", "updated_at": "$.updated_at",
        },
    ).where(_active_therapy() & F.col("mail").isNotNull())
    newest = latest_per_key(rows.withColumn("c_email", F.lower("mail")), ["c_email"], ["updated_at", "idem_key"])
    return newest.select("c_id", "c_email")


def billing_customers(canonical: DataFrame) -> DataFrame:
    """One address per customer: that of the newest canonical row."""
    rows = with_json(
        of_schema(canonical, "customer").select("idem_key", "created_at", "payload"),
        values={"cust_id": "$.customer_id", "mail": "$.email"},
    )
    newest = latest_per_key(rows, ["cust_id"], ["created_at", "idem_key"])
    return newest.select("cust_id", F.lower("mail").alias("cust_email"))


def _deduped(canonical: DataFrame, kind: str, key: str, values: dict[str, str]) -> DataFrame:
    rows = with_json(of_schema(canonical, kind).select("idem_key", "created_at", "payload"), values=values).drop("payload")
    return latest_per_key(rows, [key], ["created_at", "idem_key"])


def _by_address(df: DataFrame, address: Column, **cols: Column) -> DataFrame:
    """Timeline rows whose contact is still to be found by `address` (in ``__address``)."""
    cols |= {"contact_id": F.lit(None).cast("string")}
    return df.select(*[cols[c].alias(c) for c in TIMELINE_COLUMNS], address.alias("__address"))


def form_events(measurement_events: DataFrame) -> DataFrame:
    return _by_address(
        measurement_events, F.lower("subject_id"),
        contact_email=F.col("subject_id"), event_type=F.col("event_type"),
        event_name=F.col("event_subtype"), event_source=F.lit("google_forms"), event_timestamp=F.col("occurred_at").cast("timestamp"),
        source_system=F.lit("measurement_events"), source_record_id=F.col("measurement_event_id"),
        payload=to_json_full(
            "binding_id", "binding_version", "form_id", F.col("source_id").alias("form_submission_id"), "canonical_object_id"
        ),
    )


def session_events(canonical: DataFrame, clients: DataFrame, strict: bool = False) -> DataFrame:
    at = F.coalesce(text_to_timestamp("started_at", strict), text_to_timestamp("ended_at", strict))
    cols = dict(
        contact_id=F.col("client_id"), contact_email=F.col("c_email"), event_type=F.lit("session"),
        event_name=F.col("session_status"), event_source=F.lit("dataverse"), event_timestamp=at,
        source_system=F.lit("dataverse_sessions"), source_record_id=F.col("session_id"), payload=to_json_full("session_num"),
    )
    found = left_lookup(proj_sessions(canonical, strict), clients, "client_id", "c_id")
    return found.select(*[cols[c].alias(c) for c in TIMELINE_COLUMNS])


def email_events(
    canonical: DataFrame,
    own_addresses: Sequence[str] | Mapping[str, Sequence[str]],
    strict: bool = False,
    subject_length: int | None = SUBJECT_LENGTH,
) -> DataFrame:
    """Mail seen from the owner of `own_addresses`: who the other side is, and which way it went.

    All systems are read and parsed in one pass; `own_addresses` may differ by system. `subject_length` bounds
    the subject shown in the event's name (None: whole); the payload always has it whole.
    """
    if not isinstance(own_addresses, Mapping):
        own_addresses = dict.fromkeys(MAIL_SYSTEMS, own_addresses)
    rows = of_schema(canonical, "email").where(F.col("source_system").isin(*own_addresses))
    rows = with_json(
        rows.select("idem_key", "created_at", "source_system", "payload"),
        values={
            "email_id": "$.id", "subject": "$.subject", "sent_at": "$.sentAt", "thread_id": "$.threadId",
            "from_email": "$.from[0].email", "to_email": "$.to[0].email",
        },
    ).drop("payload")
    rows = latest_per_key(rows, ["source_system", "email_id"], ["created_at", "idem_key"])
    sender = F.lower("from_email")
    ours = [(F.col("source_system") == s) & sender.isin([a.lower() for a in own]) for s, own in own_addresses.items()]
    outbound = reduce(Column.__or__, ours)
    rows = rows.withColumns(
        {
            "direction": F.when(outbound, "outbound").otherwise("inbound"),
            "other": F.when(outbound, F.lower("to_email")).otherwise(sender),
        }
    )
    shown = F.coalesce("subject", F.lit("(no subject)"))
    shown = shown if subject_length is None else F.substring(shown, 1, subject_length)
    return _by_address(
        rows, F.col("other"),
        contact_email=F.col("other"), event_type=F.lit("email"), event_name=F.concat("direction", F.lit(": "), shown),
        event_source=F.col("source_system"), event_timestamp=text_to_timestamp("sent_at", strict),
        source_system=F.concat(F.lit("email_"), "source_system"), source_record_id=F.col("email_id"),
        payload=to_json_full("subject", "thread_id"),
    )


def invoice_events(canonical: DataFrame, strict: bool = False) -> DataFrame:
    rows = _deduped(
        canonical, "invoice", "invoice_id",
        {
            "invoice_id": "$.invoice_id", "mail": "$.customer_email", "status": "$.status", "event_time": "$.event_time",
            "invoice_number": "$.invoice_number", "amount_due": "$.amount_due", "currency": "$.currency", "description": "$.description",
        },
    ).withColumn("mail", F.lower("mail"))
    return _by_address(
        rows, F.col("mail"),
        contact_email=F.col("mail"), event_type=F.lit("invoice"), event_name=F.col("status"),
        event_source=F.lit("stripe"), event_timestamp=text_to_timestamp("event_time", strict),
        source_system=F.lit("stripe_invoice"), source_record_id=F.col("invoice_id"),
        payload=to_json_full("invoice_number", "amount_due", "currency", "description"),
    )


def money_events(canonical: DataFrame, strict: bool = False) -> DataFrame:
    """Payments and refunds. A refund belongs to the customer of its payment, in ``__customer``; address and contact are still to be found by it."""
    payments = _deduped(
        canonical, "payment", "payment_id",
        {
            "payment_id": "$.payment_id", "customer_id": "$.customer_id", "status": "$.status", "event_time": "$.event_time",
            "amount": "$.amount", "currency": "$.currency", "payment_method_type": "$.payment_method_type",
        },
    )
    refunds = _deduped(
        canonical, "refund", "refund_id",
        {
            "refund_id": "$.refund_id", "status": "$.status", "event_time": "$.event_time", "amount": "$.amount",
            "currency": "$.currency", "reason": "$.reason", "payment_intent_id": "$.payment_intent_id",
        },
    )
    payers = payments.select(F.col("payment_id").alias("p_id"), F.col("customer_id").alias("p_customer"))
    refunds = left_lookup(refunds, payers, "payment_intent_id", "p_id")
    both = _money(payments, "payment", "payment_id", "customer_id", "payment_method_type").unionByName(
        _money(refunds, "refund", "refund_id", "p_customer", "reason")
    )
    cols = dict(
        contact_id=F.lit(None).cast("string"), contact_email=F.lit(None).cast("string"), event_type=F.col("kind"),
        event_name=F.col("status"), event_source=F.lit("stripe"), event_timestamp=text_to_timestamp("event_time", strict),
        source_system=F.concat(F.lit("stripe_"), "kind"), source_record_id=F.col("record"), payload=F.col("details"),
    )
    return both.select(*[cols[c].alias(c) for c in TIMELINE_COLUMNS], F.col("customer").alias("__customer"))


def _who(clients: DataFrame, customers: DataFrame) -> DataFrame:
    """``__who`` (an address or a billing customer), contact and address: what events are looked up in. Every ``__who`` is there once."""
    billed = left_lookup(customers, clients, "cust_email", "c_email")
    return clients.select(_who_key("c_email", "address").alias("__who"), "c_id", F.lit(None).cast("string").alias("c_mail")).unionByName(
        billed.select(_who_key("cust_id", "customer").alias("__who"), "c_id", F.col("cust_email").alias("c_mail"))
    )


def _who_key(col: str, kind: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), col)


def _money(rows: DataFrame, kind: str, record: str, customer: str, detail: str) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("kind"), F.col(record).alias("record"), F.col(customer).alias("customer"), "status", "event_time",
        to_json_full("amount", "currency", detail).alias("details"),
    )


def proj_contact_events(
    canonical: DataFrame,
    measurement_events: DataFrame,
    own_addresses: Sequence[str] | Mapping[str, Sequence[str]],
    strict: bool = False,
    subject_length: int | None = SUBJECT_LENGTH,
) -> DataFrame:
    """Every touch of a contact in one ledger: forms, sessions, mail, invoices, payments, refunds.

    All branches that know a contact by address or by billing customer are united first and share one lookup, for which customers
    get their contacts beforehand, so that payments and refunds are dealt once for both; sessions have a lookup by id. Clients are
    dealt again for each lookup, so that AQE can split a contact or customer with very many events.
    """
    clients = therapy_clients(canonical)
    addressed = reduce(
        DataFrame.unionByName,
        [
            form_events(measurement_events),
            email_events(canonical, own_addresses, strict, subject_length),
            invoice_events(canonical, strict),
        ],
    )
    known = addressed.withColumn("__by", _who_key("__address", "address")).drop("__address").unionByName(
        money_events(canonical, strict).withColumn("__by", _who_key("__customer", "customer")).drop("__customer")
    )
    found = left_lookup(known, _who(clients, billing_customers(canonical)), "__by", "__who").withColumns(
        {"contact_id": F.col("c_id"), "contact_email": F.coalesce("contact_email", "c_mail")}
    )
    return found.select(*TIMELINE_COLUMNS).unionByName(session_events(canonical, clients, strict))
