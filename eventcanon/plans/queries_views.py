"""Registered queries for the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventcanon.plans import client_views as cv
from eventcanon.plans import context_views as xv
from eventcanon.plans import derived as d
from eventcanon.plans import entity_views as ev
from eventcanon.plans import mail_views as mv
from eventcanon.plans import reports as rp
from eventcanon.plans.queries import query

ISO = "'%Y-%m-%dT%H:%M:%SZ'"

CONTACTS = f"""
contacts AS (
  SELECT 'C' || c_custkey AS contact_id,
    CASE WHEN c_nationkey = 0 THEN NULL ELSE c_mktsegment END AS first_name,
    CASE WHEN c_nationkey <= 1 THEN NULL ELSE c_name END AS last_name,
    CASE WHEN c_nationkey = 3 THEN NULL ELSE 'c' || (c_custkey // 2) || '@Example.com' END AS email,
    's' || (c_custkey // 2) || '@example.org' AS email2,
    c_nationkey::VARCHAR AS mobile, c_name AS phone, c_mktsegment AS client_type,
    CASE c_mktsegment WHEN 'BUILDING' THEN '1' WHEN 'MACHINERY' THEN '1,3,6' WHEN 'HOUSEHOLD' THEN '2,1'
      WHEN 'AUTOMOBILE' THEN '11,3' END AS client_type_code,
    c_acctbal >= 0 AS active,
    '2024-01-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') || 'T00:00:00Z' AS updated_at,
    'dataverse:clinic:contact:C' || c_custkey AS idem_key
  FROM customer)"""

CLIENTS = CONTACTS + """,
proj_clients AS (
  SELECT contact_id AS client_id, first_name, last_name, email, mobile, phone, client_type, client_type_code,
    CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL THEN first_name || ' ' || substr(last_name, 1, 1)
      WHEN last_name IS NOT NULL THEN last_name ELSE contact_id END AS client_folder,
    '2020-01-01T00:00:00Z' AS created_at, updated_at, idem_key
  FROM contacts WHERE list_contains(string_split(client_type_code, ','), '1') AND active),
therapy AS (
  SELECT contact_id AS c_id, lower(email) AS c_email FROM contacts
  WHERE list_contains(string_split(client_type_code, ','), '1') AND active AND email IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY updated_at DESC, idem_key DESC) = 1)"""

SESSIONS = f"""
proj_sessions AS (
  SELECT 'S' || o_orderkey AS session_id, 'C' || o_custkey AS client_id,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS session_num,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE strftime(o_orderdate, {ISO}) END AS started_at,
    strftime(o_orderdate, {ISO}) AS ended_at, o_orderstatus AS session_status,
    'dataverse:clinic:session:S' || o_orderkey AS idem_key, o_orderdate
  FROM orders WHERE o_orderpriority <> '5-LOW')"""

TRANSCRIPTS = """
proj_transcripts AS (
  SELECT 'T' || page_id AS transcript_id, 'S' || page_id AS session_id,
    CASE WHEN url LIKE 'https%' THEN 'C' || page_id END AS client_id, html AS content, 'en' AS language,
    '2024-01-05' AS transcript_date, 'completed' AS processing_status, '2024-01-05' AS created_at, url AS updated_at,
    'dataverse:clinic:session:' || page_id || '#transcript' AS idem_key
  FROM pages)"""

DOCUMENTS = """
proj_docs AS (
  SELECT 'D' || doc_id AS document_id, 'S' || (doc_id // 3) AS session_id, 'C' || (doc_id // 2) AS client_id,
    CASE lang WHEN 'en' THEN 'soap-note' WHEN 'fr' THEN 'client-summary' WHEN 'de' THEN 'progress-report' ELSE lang END AS doc_type,
    source AS title, CASE WHEN lang <> 'es' THEN text END AS content, 'final' AS status, NULL::VARCHAR AS audience,
    '2024-01-06' AS document_date, '2024-01-06' AS created_at, '2024-01-07' AS updated_at, 'document' AS object_type,
    'dataverse:clinic:document:' || doc_id AS idem_key
  FROM documents)"""

FORMS = f"""
form_resp AS (
  SELECT 'google_forms:form_response:' || o_orderkey AS idem_key, 'R' || o_orderkey AS response_id,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'C' || (o_custkey // 2) || '@EXAMPLE.COM' END AS respondent_email,
    'submitted' AS status, strftime(o_orderdate, {ISO}) AS submitted_at, strftime(o_orderdate, {ISO}) AS last_updated_at,
    'google_forms' AS source_platform,
    CASE WHEN o_totalprice < 100000 THEN 'not at all' WHEN o_totalprice < 250000 THEN 'several days'
      WHEN o_totalprice < 400000 THEN 'nearly every day' ELSE 'unsure' END AS band,
    o_orderpriority, o_orderstatus
  FROM orders),
proj_forms AS (
  SELECT f.idem_key, response_id, respondent_email, contact_id AS client_id, status, submitted_at, last_updated_at, source_platform,
    '[' || array_to_string(list_transform([['q.priority', o_orderpriority], ['q.status', o_orderstatus], ['q.price', band]],
       lambda x: '{{"answer_type":"choice","answer_value":"' || x[2] || '","question_id":"' || x[1] || '"}}'), ',') || ']' AS answers_json
  FROM form_resp f LEFT JOIN contacts c ON lower(respondent_email) = lower(email))"""

EMAILS = f"""
mails AS (
  SELECT 'E' || user_id || '-' || floor(value)::BIGINT AS email_id, 'H' || user_id AS thread_id,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'Re: ' || event_type || ' ' || props || ' and the rest of a long subject line' END AS subject,
    CASE event_type WHEN 'click' THEN 'Owner@Example.net' WHEN 'purchase' THEN 'noreply@list.test' ELSE 'C' || (user_id // 2) || '@example.com' END AS sender,
    CASE event_type WHEN 'click' THEN 'C' || (user_id // 2) || '@example.com' WHEN 'signup' THEN 'Desk@practice.test' ELSE 'owner@example.net' END AS recipient,
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'gmail' ELSE 'exchange' END AS source_system,
    event_type AS sender_name, props AS preview, date_trunc('second', ts) AS sent_at, value, ts AS created_at, event_id,
    'mail:' || event_id AS idem_key, event_type
  FROM events)"""

CUSTOMERS = """
custs AS (SELECT 'U' || c_custkey AS cust_id, lower('C' || (c_custkey // 2) || '@EXAMPLE.com') AS cust_email FROM customer)"""

BILLING = """
pays AS (SELECT 'P' || o_orderkey AS p_id, 'U' || o_custkey AS p_customer, o_orderstatus, o_orderdate,
    CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR AS amount FROM orders),
invs AS (SELECT 'I' || (o_orderkey // 2) AS invoice_id, lower('C' || (o_custkey // 2) || '@Example.com') AS mail, o_orderstatus, o_orderdate,
    'N' || o_orderkey AS num, CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR AS amount,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS description
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey // 2 ORDER BY o_orderdate DESC, lpad(o_orderkey::VARCHAR, 12, '0') DESC) = 1),
refs AS (SELECT 'F' || l_orderkey || '-' || l_linenumber AS refund_id, 'P' || l_orderkey AS intent, l_linestatus, l_shipdate,
    CAST(l_extendedprice AS DECIMAL(15,2))::VARCHAR AS amount, l_partkey::VARCHAR AS reason
  FROM lineitem WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, concat_ws('-', l_partkey, l_suppkey,
    CAST(l_extendedprice AS DECIMAL(15,2)), CAST(l_quantity AS DECIMAL(15,2))) DESC) = 1)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


@query("proj_clients", _with(CLIENTS) + "SELECT * FROM proj_clients")
def _(spark, sf):
    return cv.proj_clients(d.canonical_objects(spark, sf, d.contacts))


@query("proj_sessions", _with(SESSIONS) + "SELECT * EXCLUDE (o_orderdate) FROM proj_sessions")
def _(spark, sf):
    return cv.proj_sessions(d.canonical_objects(spark, sf, d.sessions))


@query("proj_transcripts", _with(TRANSCRIPTS) + "SELECT * FROM proj_transcripts")
def _(spark, sf):
    return cv.proj_transcripts(d.canonical_objects(spark, sf, d.transcripts))


@query("proj_clinical_documents", _with(DOCUMENTS) + "SELECT * FROM proj_docs")
def _(spark, sf):
    return cv.proj_clinical_documents(d.canonical_objects(spark, sf, d.clinical_documents))


@query("proj_form_responses", _with(CONTACTS, FORMS) + "SELECT * FROM proj_forms")
def _(spark, sf):
    return cv.proj_form_responses(d.canonical_objects(spark, sf, d.contacts, d.form_responses))


@query("therapy_clients", _with(CLIENTS) + "SELECT * FROM therapy")
def _(spark, sf):
    return cv.therapy_clients(d.canonical_objects(spark, sf, d.contacts))


@query("billing_customers", _with(CUSTOMERS) + "SELECT * FROM custs")
def _(spark, sf):
    return cv.billing_customers(d.canonical_objects(spark, sf, d.customers))


TIMELINE = {
    "forms": """
  SELECT c_id AS contact_id, 'C' || (user_id // 2) || '@Example.COM' AS contact_email, 'form' AS event_type, event_type AS event_name,
    'google_forms' AS event_source, ts AS event_timestamp, 'measurement_events' AS source_system, 'M' || event_id AS source_record_id,
    json_object('binding_id', event_type, 'binding_version', '1.0.0', 'form_id', CASE WHEN event_type = 'error' THEN NULL ELSE props END,
      'form_submission_id', event_id::VARCHAR, 'canonical_object_id', 'co:' || event_id)::VARCHAR AS payload
  FROM events LEFT JOIN therapy ON lower('C' || (user_id // 2) || '@Example.COM') = c_email""",
    "sessions": """
  SELECT client_id, c_email, 'session', session_status, 'dataverse', o_orderdate, 'dataverse_sessions', session_id,
    json_object('session_num', session_num)::VARCHAR
  FROM proj_sessions LEFT JOIN therapy ON client_id = c_id""",
    "emails": """
  SELECT c_id, other, 'email', direction || ': ' || substr(coalesce(subject, '(no subject)'), 1, 50), source_system, sent_at,
    'email_' || source_system, email_id, json_object('subject', subject, 'thread_id', thread_id)::VARCHAR
  FROM (SELECT *, CASE WHEN event_type = 'click' THEN 'outbound' ELSE 'inbound' END AS direction,
          CASE WHEN event_type = 'click' THEN lower(recipient) ELSE lower(sender) END AS other
        FROM mails QUALIFY row_number() OVER (PARTITION BY source_system, email_id ORDER BY created_at DESC, idem_key DESC) = 1)
  LEFT JOIN therapy ON other = c_email""",
    "invoices": """
  SELECT c_id, mail, 'invoice', o_orderstatus, 'stripe', o_orderdate, 'stripe_invoice', invoice_id,
    json_object('invoice_number', num, 'amount_due', amount, 'currency', 'cad', 'description', description)::VARCHAR
  FROM invs LEFT JOIN therapy ON mail = c_email""",
    "payments": """
  SELECT c_id, cust_email, 'payment', o_orderstatus, 'stripe', o_orderdate, 'stripe_payment', p_id,
    json_object('amount', amount, 'currency', 'cad', 'payment_method_type', CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'card' END)::VARCHAR
  FROM pays LEFT JOIN custs ON p_customer = cust_id LEFT JOIN therapy ON cust_email = c_email""",
    "refunds": """
  SELECT c_id, cust_email, 'refund', l_linestatus, 'stripe', l_shipdate, 'stripe_refund', refund_id,
    json_object('amount', r.amount, 'currency', 'cad', 'reason', reason)::VARCHAR
  FROM refs r LEFT JOIN pays ON intent = p_id LEFT JOIN custs ON p_customer = cust_id LEFT JOIN therapy ON cust_email = c_email""",
}
TIMELINE_SQL = _with(CLIENTS, SESSIONS, EMAILS, CUSTOMERS, BILLING)[:-1] + ",\ntimeline AS (" + "\n  UNION ALL".join(TIMELINE.values()) + ")\n"


@query("proj_contact_events", TIMELINE_SQL + "SELECT * FROM timeline")
def _(spark, sf):
    return cv.proj_contact_events(d.canonical_objects(spark, sf), d.measurement_events(spark, sf), d.OWN_ADDRESSES)


@query("contact_events_by_type", TIMELINE_SQL + """
SELECT event_type, event_source, count(*) AS events, count(contact_id) AS known_contacts, count(DISTINCT contact_email) AS addresses,
  min(event_timestamp) AS first_at, max(event_timestamp) AS last_at FROM timeline GROUP BY 1, 2""")
def _(spark, sf):
    t = cv.proj_contact_events(d.canonical_objects(spark, sf), d.measurement_events(spark, sf), d.OWN_ADDRESSES)
    return t.groupBy("event_type", "event_source").agg(
        F.count("*").alias("events"), F.count("contact_id").alias("known_contacts"), F.count_distinct("contact_email").alias("addresses"),
        F.min("event_timestamp").alias("first_at"), F.max("event_timestamp").alias("last_at"),
    )


@query("weekly_snapshots", TIMELINE_SQL + """
SELECT time_bucket(INTERVAL '7 days', event_timestamp, TIMESTAMP '1970-01-01') AS week_start, event_type, count(*) AS events,
  count(DISTINCT contact_email) AS contacts FROM timeline WHERE event_timestamp IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    t = cv.proj_contact_events(d.canonical_objects(spark, sf), d.measurement_events(spark, sf), d.OWN_ADDRESSES)
    return rp.weekly_snapshots(t)


# --- folds ----------------------------------------------------------------------------------


def _fold(kind: str, key: str, fields: dict[str, str], event_id: str, at: str, table: str, source: str = "") -> str:
    order = f"ORDER BY {at} DESC, {event_id} DESC"
    cols = ", ".join(
        f"first(({e}) {order}) FILTER (WHERE ({e}) IS NOT NULL) AS {n}" for n, e in fields.items()
    )
    return (f"SELECT {key} AS {kind}_id, {cols}, {key} AS row_id, first({event_id} {order}) AS row_version, 'synced' AS row_state "
            f"FROM {table} {source} GROUP BY {key}")


NONE = "NULL::VARCHAR"
PRICE = "CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR"

PROJECT_FIELDS = {
    "name": "CASE WHEN event_type = 'signup' THEN 'n' || event_id END", "description": "CASE WHEN event_type = 'view' THEN props END",
    "owner": "CASE WHEN event_type = 'click' THEN 'u' || floor(value)::BIGINT END",
    "status": "CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(15,2))::VARCHAR END", "target_end_date": NONE,
}
PROJECT_STREAM = {"opsstream_id": "CASE WHEN event_type = 'view' THEN 'OS' || user_id % 5 END"}
PROJECT_FOLD, PROJECT_STATE_FOLD = [
    _fold("project", "'PR' || user_id", fields, "lpad(event_id::VARCHAR, 12, '0')", "ts", "events") for fields in (PROJECT_FIELDS, PROJECT_FIELDS | PROJECT_STREAM)
]
DELIVERABLE_FOLD = _fold(
    "deliverable", "'DL' || o_custkey",
    {
        "project_id": "CASE WHEN o_orderstatus = 'F' THEN 'PR' || (o_custkey // 10) END", "name": "o_orderpriority",
        "description": f"CASE WHEN o_orderstatus = 'O' THEN {PRICE} END", "status": "o_orderstatus", "acceptance_criteria": NONE,
        "due_date": f"strftime(o_orderdate, {ISO})",
    },
    "lpad(o_orderkey::VARCHAR, 12, '0')", "o_orderdate", "orders",
)
OPSSTREAM_FOLD = _fold(
    "opsstream", "'OS' || o_orderpriority",
    {
        "name": "o_orderstatus", "type": "CASE WHEN o_orderstatus = 'P' THEN 'pending' END", "owner": "'U' || o_custkey",
        "status": "CASE WHEN o_totalprice > 400000 THEN 'large' END", "description": f"CASE WHEN o_orderstatus <> 'F' THEN {PRICE} END",
    },
    "lpad(o_orderkey::VARCHAR, 12, '0')", "o_orderdate", "orders",
)
LINE_ID = ("concat_ws('-', lpad(l_orderkey::VARCHAR, 12, '0'), l_linenumber, l_partkey, l_suppkey, "
           "CAST(l_extendedprice AS DECIMAL(15,2)), CAST(l_quantity AS DECIMAL(15,2)))")
WORK_ITEM_FOLD = _fold(
    "work_item", "'WI' || l_orderkey",
    {
        "title": "'part ' || l_partkey", "kind": "l_returnflag", "state": "l_linestatus", "priority": "CASE WHEN l_quantity > 25 THEN 'high' END",
        "severity": "CASE WHEN l_discount > 0.05 THEN CAST(l_discount AS DECIMAL(15,2))::VARCHAR END",
        "assignees": "CASE WHEN l_returnflag = 'R' THEN '[' || l_suppkey || ']' END",
        "labels": """CASE WHEN l_returnflag = 'A' THEN '["' || l_returnflag || '","' || l_linestatus || '"]' END""",
        "due_at": f"strftime(l_shipdate, {ISO})", "project_id": "CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'PR' || l_suppkey END",
        "deliverable_id": "'DL' || l_partkey", "opsstream_id": "CASE WHEN l_tax > 0.06 THEN 'OS' || l_linenumber END", "parent_id": NONE,
    },
    LINE_ID, "l_shipdate", "lineitem",
)
ARTIFACT_FOLD = _fold(
    "artifact", "'AR' || conv_id",
    {
        "title": "'turn ' || turn", "kind": "role", "status": "CASE WHEN role = 'assistant' THEN 'done' END", "content": "text",
        "content_ref": "CASE WHEN role = 'system' THEN 'ref' || conv_id END", "delivered_via": NONE,
        "tags": """CASE WHEN role = 'user' THEN '["user"]' END""", "work_item_id": "'WI' || conv_id", "deliverable_id": NONE,
        "project_id": NONE, "opsstream_id": NONE, "contact_ref": NONE,
    },
    "concat_ws('-', lpad(conv_id::VARCHAR, 12, '0'), lpad(turn::VARCHAR, 6, '0'))", "turn", "conversations",
)


@query("view_pm_projects", PROJECT_FOLD)
def _(spark, sf):
    return ev.view_pm_projects(d.domain_events(spark, sf, d.project_log))


@query("view_pm_deliverables", DELIVERABLE_FOLD)
def _(spark, sf):
    return ev.view_pm_deliverables(d.domain_events(spark, sf, d.deliverable_log))


@query("view_pm_opsstreams", OPSSTREAM_FOLD)
def _(spark, sf):
    return ev.view_pm_opsstreams(d.domain_events(spark, sf, d.opsstream_log))


@query("view_pm_artifacts", f"SELECT * REPLACE (substr(content, 1, 500) AS content) FROM ({ARTIFACT_FOLD})")
def _(spark, sf):
    return ev.view_pm_artifacts(d.domain_events(spark, sf, d.artifact_log))


HIERARCHY = f"WITH wi AS ({WORK_ITEM_FOLD}), dl AS ({DELIVERABLE_FOLD}), os AS ({OPSSTREAM_FOLD})\n"


@query("view_pm_work_items", HIERARCHY + """
SELECT wi.*, coalesce(wi.project_id, dl.project_id) AS effective_project_id FROM wi LEFT JOIN dl ON wi.deliverable_id = dl.deliverable_id""")
def _(spark, sf):
    return ev.view_pm_work_items(d.domain_events(spark, sf, d.work_item_log, d.deliverable_log))


@query("effective_opsstream", HIERARCHY + f""", pr AS ({PROJECT_STATE_FOLD}),
x AS (SELECT wi.work_item_id, wi.opsstream_id, coalesce(wi.project_id, dl.project_id) AS effective_project_id
  FROM wi LEFT JOIN dl ON wi.deliverable_id = dl.deliverable_id)
SELECT work_item_id, effective_project_id, coalesce(x.opsstream_id, pr.opsstream_id) AS effective_opsstream_id
FROM x LEFT JOIN pr ON effective_project_id = pr.project_id""")
def _(spark, sf):
    log = d.domain_events(spark, sf, d.work_item_log, d.deliverable_log, d.project_log)
    out = ev.effective_opsstreams(
        ev.fold_entity(log, "work_item"), ev.view_pm_deliverables(log), ev.project_states(log)
    )
    return out.select("work_item_id", "effective_project_id", "effective_opsstream_id")


def _objects_sql(pick: str, where: str) -> str:
    return f"""
SELECT lpad(doc_id::VARCHAR, 12, '0') AS event_id, 'DO' || source AS aggregate_id, 'domain_object' AS aggregate_type, event_type,
  NULL::VARCHAR AS subject_id, TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS synthesized_at, TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS created_at,
  'k' || doc_id AS idem_key, source AS entity_id, lang AS object_type, NULL::VARCHAR AS object_variant, text AS content,
  NULL::VARCHAR AS model_used, '{{"n_chars":' || n_chars || '}}' AS inference_audit, 'service' AS producer_service,
  'part' AS producer_component, 'run-1' AS correlation_id
FROM (SELECT *, CASE WHEN lang = 'de' THEN 'object.deleted' ELSE 'object.created' END AS event_type FROM documents)
{where}
{pick}"""


NEWEST = "QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1"


@query("domain_objects", _objects_sql(NEWEST, "WHERE event_type NOT LIKE '%.deleted'"))
def _(spark, sf):
    return ev.domain_objects(d.domain_events(spark, sf, d.object_log)).drop("payload")


@query("domain_objects_not_deleted", _objects_sql(NEWEST + " AND event_type NOT LIKE '%.deleted'", ""))
def _(spark, sf):
    return ev.domain_objects(d.domain_events(spark, sf, d.object_log), drop_deleted="after").drop("payload")


# --- context tables -------------------------------------------------------------------------


@query("context_emails", _with(CONTACTS, EMAILS) + """
, addresses AS (SELECT DISTINCT contact_id, unnest([lower(email), email2]) AS address FROM contacts),
found AS (
  SELECT m.*, contact_id, contact_id IS NOT NULL OR regexp_extract(lower(sender), '@(.+)$', 1) IN ('list.test')
    OR lower(recipient) IN ('desk@practice.test') AS is_clinical
  FROM mails m LEFT JOIN addresses ON lower(sender) = address WHERE sent_at > TIMESTAMP '2024-01-31' - INTERVAL 14 DAY)
SELECT email_id, thread_id,
  CASE WHEN is_clinical THEN lower(substr(sender, 1, 1)) || '*****@' || regexp_extract(sender, '@(.+)$', 1) ELSE sender END AS sender_email,
  CASE WHEN is_clinical THEN 'Client ' || upper(substr(sender_name, 1, 1)) || '.' ELSE sender_name END AS sender_name,
  subject, CASE WHEN is_clinical THEN NULL ELSE preview END AS snippet, sent_at AS received_at,
  CASE WHEN event_type = 'view' THEN '' ELSE event_type || ',INBOX' END AS labels, value > 90 AS is_flagged, NOT value > 50 AS is_unread,
  NOT value > 50 AND sender NOT LIKE '%noreply%' AND sender NOT LIKE '%no-reply%' AS needs_response,
  contact_id AS clinical_contact_id, is_clinical, source_system, 'acct1' AS connection_name, idem_key, TIMESTAMP '2024-01-31' AS projected_at
FROM found""")
def _(spark, sf):
    return xv.context_emails(d.canonical_objects(spark, sf, d.contacts, d.emails), d.CLINICAL_DOMAINS, d.PRACTICE_MAILBOXES, d.AS_OF)


@query("context_calendar", _with(CONTACTS) + f"""
SELECT 'S' || o_orderkey AS session_id, o_orderpriority AS title,
  CASE WHEN contact_id IS NOT NULL THEN coalesce(first_name, '') || ' ' || coalesce(substr(last_name, 1, 1), '') END AS client_name,
  o_custkey AS session_num, o_orderdate AS scheduled_start, o_orderdate + INTERVAL 1 HOUR AS scheduled_end, o_orderdate AS actual_start,
  50::BIGINT AS duration_minutes, o_orderstatus AS status, o_orderstatus AS session_type, 'Contact/C' || o_custkey AS contact_id,
  'dataverse:clinic:session:S' || o_orderkey AS idem_key, TIMESTAMP '1998-10-03' AS projected_at
FROM orders LEFT JOIN contacts ON contact_id = 'C' || o_custkey
WHERE o_orderdate BETWEEN TIMESTAMP '1998-10-03' - INTERVAL 14 DAY AND TIMESTAMP '1998-10-03' + INTERVAL 14 DAY""")
def _(spark, sf):
    return xv.context_calendar(d.canonical_objects(spark, sf, d.contacts, d.sessions), "1998-10-03 00:00:00")


@query("context_actions", """
SELECT event_id AS action_id, user_id::VARCHAR AS user_id, 'chat' AS channel, event_type AS action_type, props AS context,
  event_type AS instruction, ts AS created_at, CASE event_type WHEN 'purchase' THEN 'pending' ELSE 'completed' END AS status,
  NULL::VARCHAR AS idem_key, TIMESTAMP '2024-01-31' AS projected_at
FROM events WHERE event_type = 'purchase' OR (event_type = 'view' AND ts > TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR)""")
def _(spark, sf):
    return xv.context_actions(d.actions(spark, sf), d.AS_OF, ordered=False)


# --- mail -----------------------------------------------------------------------------------

MAIL = """
mail AS (
  SELECT 'gmail:acct1:email:' || doc_id AS idem_key, 'gmail' AS source_system, doc_id::VARCHAR AS message_id, source AS thread_id, text AS subject,
    source || '@' || lang || '.example.com' AS from_email, 'a@example.com,' || lang AS to_emails, NULL::VARCHAR AS cc_emails,
    TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS email_date, CASE WHEN lang = 'en' THEN 'INBOX,UNREAD' ELSE 'INBOX' END AS labels,
    text AS snippet, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS first_seen, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS last_seen, doc_id, lang
  FROM documents)"""


@query("emails_mv", _with(MAIL) + "SELECT * EXCLUDE (doc_id, lang) FROM mail")
def _(spark, sf):
    return mv.emails_mv(d.raw_mail(spark, sf)).drop("payload")


@query("emails_by_subject", _with(MAIL) + "SELECT message_id, subject, from_email, email_date FROM mail WHERE subject LIKE '%the%'")
def _(spark, sf):
    return mv.subject_contains(mv.emails_mv(d.raw_mail(spark, sf)), "the")


@query("emails_by_sender", _with(MAIL) + "SELECT from_email, count(*) AS email_count FROM mail GROUP BY 1")
def _(spark, sf):
    return mv.count_by_sender(mv.emails_mv(d.raw_mail(spark, sf)))


@query("emails_with_label", _with(MAIL) + "SELECT message_id, subject, email_date FROM mail WHERE lang = 'en'")
def _(spark, sf):
    return mv.with_label(mv.emails_mv(d.raw_mail(spark, sf)), "UNREAD")


@query("inbox_threads", _with(MAIL) + """
SELECT thread_id, count(*) AS messages, count(DISTINCT lang) AS sender_domains, min(email_date) AS first_at, max(email_date) AS last_at,
  arg_max(subject, doc_id) AS subject FROM mail GROUP BY 1""")
def _(spark, sf):
    return mv.inbox_view(mv.emails_mv(d.raw_mail(spark, sf)))


@query("payload_search", r"""
SELECT doc_id, lang FROM documents
WHERE list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), ['the', 'of', 'and'])""")
def _(spark, sf):
    return mv.search_payload(d.load(spark, sf, "documents"), "of AND the", "text").select("doc_id", "lang")


@query("extracted_columns", """
SELECT 'raw:' || o_orderkey AS idem_key, o_custkey::VARCHAR AS customer, o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR AS total
FROM orders""")
def _(spark, sf):
    raw = d.raw_objects(spark, sf).select("idem_key", "payload")
    return mv.with_extracted(raw, {"customer": "$.o_custkey", "priority": "$.o_orderpriority", "total": "$.total"}).drop("payload")


# --- reports on views -----------------------------------------------------------------------


def _views(spark, sf):
    canonical = d.canonical_objects(spark, sf, d.contacts, d.sessions, d.transcripts, d.clinical_documents)
    return cv.proj_clients(canonical), cv.proj_sessions(canonical), cv.proj_transcripts(canonical), cv.proj_clinical_documents(canonical)


@query("content_counts", _with(CLIENTS, SESSIONS, TRANSCRIPTS, DOCUMENTS) + """
SELECT c.client_folder, count(DISTINCT s.session_id) AS sessions, count(DISTINCT t.transcript_id) AS transcripts,
  count(DISTINCT CASE WHEN d.doc_type = 'soap-note' THEN d.document_id END) AS notes,
  count(DISTINCT CASE WHEN d.doc_type = 'client-summary' THEN d.document_id END) AS summaries,
  count(DISTINCT CASE WHEN d.doc_type = 'progress-report' THEN d.document_id END) AS reports
FROM proj_clients c LEFT JOIN proj_sessions s ON c.client_id = s.client_id LEFT JOIN proj_transcripts t ON s.session_id = t.session_id
LEFT JOIN proj_docs d ON s.session_id = d.session_id GROUP BY c.client_id, c.client_folder""")
def _(spark, sf):
    return rp.content_counts(*_views(spark, sf))


@query("wide_sessions", _with(CLIENTS, SESSIONS, TRANSCRIPTS, DOCUMENTS) + """
SELECT c.client_folder, c.first_name, c.last_name, s.session_num, t.content AS transcript, d1.content AS session_note, d2.content AS session_summary
FROM proj_clients c JOIN proj_sessions s ON c.client_id = s.client_id LEFT JOIN proj_transcripts t ON s.session_id = t.session_id
LEFT JOIN proj_docs d1 ON s.session_id = d1.session_id AND d1.doc_type = 'soap-note'
LEFT JOIN proj_docs d2 ON s.session_id = d2.session_id AND d2.doc_type = 'client-summary'""")
def _(spark, sf):
    return rp.wide_sessions(*_views(spark, sf))


@query("client_forms", _with(CLIENTS, FORMS) + """
SELECT c.client_folder, c.first_name, f.submitted_at, f.answers_json FROM proj_clients c JOIN proj_forms f ON c.client_id = f.client_id""")
def _(spark, sf):
    canonical = d.canonical_objects(spark, sf, d.contacts, d.form_responses)
    return rp.client_forms(cv.proj_clients(canonical), cv.proj_form_responses(canonical))


@query("file_contacts", _with(CLIENTS) + """
SELECT client_folder, first_name, last_name, email, mobile, phone, client_type, created_at, idem_key, client_id FROM proj_clients""")
def _(spark, sf):
    return rp.file_contacts(_views(spark, sf)[0])


@query("file_transcripts", _with(CLIENTS, SESSIONS, TRANSCRIPTS) + """
SELECT c.client_folder, s.session_num, t.content, t.idem_key, t.transcript_id, t.session_id, t.client_id
FROM proj_transcripts t JOIN proj_sessions s ON t.session_id = s.session_id JOIN proj_clients c ON t.client_id = c.client_id
WHERE t.content IS NOT NULL""")
def _(spark, sf):
    c, s, t, _ = _views(spark, sf)
    return rp.file_transcripts(c, s, t)


def _file_docs(kind: str) -> str:
    return _with(CLIENTS, SESSIONS, DOCUMENTS) + f"""
SELECT c.client_folder, s.session_num, d.content, d.idem_key, d.document_id, d.session_id, d.client_id, d.doc_type
FROM proj_docs d JOIN proj_sessions s ON d.session_id = s.session_id JOIN proj_clients c ON d.client_id = c.client_id
WHERE d.content IS NOT NULL AND d.doc_type = '{kind}'"""


@query("file_session_notes", _file_docs("soap-note"))
def _(spark, sf):
    c, s, _, docs = _views(spark, sf)
    return rp.file_session_documents(c, s, docs, rp.NOTE)


@query("file_session_summaries", _file_docs("client-summary"))
def _(spark, sf):
    c, s, _, docs = _views(spark, sf)
    return rp.file_session_documents(c, s, docs, rp.SUMMARY)


@query("file_reports", _with(CLIENTS, DOCUMENTS) + """
SELECT c.client_folder, d.document_date, d.title, d.content, d.idem_key, d.document_id, d.client_id, d.doc_type
FROM proj_docs d JOIN proj_clients c ON d.client_id = c.client_id WHERE d.content IS NOT NULL AND d.doc_type = 'progress-report'""")
def _(spark, sf):
    c, _, _, docs = _views(spark, sf)
    return rp.file_reports(c, docs)


@query("file_session_files", _with(SESSIONS, TRANSCRIPTS, DOCUMENTS) + """
SELECT s.client_id, s.session_id, s.started_at, d.content AS session_summary_md, t.content AS transcript_md
FROM proj_sessions s LEFT JOIN proj_transcripts t ON s.session_id = t.session_id
LEFT JOIN proj_docs d ON s.session_id = d.session_id AND d.doc_type = 'client-summary'""")
def _(spark, sf):
    _, s, t, docs = _views(spark, sf)
    return rp.file_session_files(s, t, docs)


@query("proj_form_responses_hot_split", _with(CONTACTS, FORMS) + "SELECT * FROM proj_forms")
def _(spark, sf):
    """The same view with hot addresses split in the plan."""
    return cv.proj_form_responses(d.canonical_objects(spark, sf, d.contacts, d.form_responses), hot_share=0.0005)
