"""The library's base tables, derived from the TPC-H-like tables of a data folder.

Customers become contacts, orders become sessions, form responses, invoices and payments, events
become mail and log entries, documents and pages become clinical texts, and so on. Payloads are
made with ``to_json``, so every view on them parses JSON again. Nothing is sampled or cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcanon.functions.json import to_json_full
from eventcanon.plans.canonical import SCHEMAS

AS_OF = "2024-01-31 00:00:00"
OWN_ADDRESSES = ["owner@example.net"]
CLINICAL_DOMAINS = ["list.test"]
PRACTICE_MAILBOXES = ["desk@practice.test"]


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def iso(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def money(col: str) -> Column:
    return F.col(col).cast("decimal(15,2)").cast("string")


def pair(col: str) -> Column:
    """Number of the pair a key belongs to; both members share an address."""
    return F.expr(f"cast({col} div 2 as string)")


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def when(test: str, value: Column | str | None, other: Column | str | None = None) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(F.expr(test), as_col(value)).otherwise(as_col(other))


def obj(**fields: Column | str) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


def _canonical(df: DataFrame, kind: str, key: Column, payload: Column, source: Column | str, connection: Column | str,
               object_type: str, created: Column) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(
        key.alias("idem_key"), lit(source).alias("source_system"), lit(connection).alias("connection_name"),
        F.lit(object_type).alias("object_type"), F.lit(SCHEMAS[kind]).alias("canonical_schema"),
        F.lit("iglu").alias("canonical_format"), F.lit(f"{kind}@1").alias("transform_ref"), payload.alias("payload"),
        F.lit("run-1").alias("correlation_id"), created.cast("timestamp").alias("canonicalized_at"),
        created.cast("timestamp").alias("created_at"),
    )


def old() -> Column:
    return F.lit("2020-01-01 00:00:00").cast("timestamp")


def contacts(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    cid = text("C", F.col("c_custkey"))
    first = when("c_nationkey = 0", None, F.col("c_mktsegment"))
    last = when("c_nationkey <= 1", None, F.col("c_name"))
    email = when("c_nationkey = 3", None, text("c", pair("c_custkey"), "@Example.com"))
    code = F.expr(
        "case c_mktsegment when 'BUILDING' then '1' when 'MACHINERY' then '1,3,6' when 'HOUSEHOLD' then '2,1'"
        " when 'AUTOMOBILE' then '11,3' end"
    )
    payload = to_json_full(
        cid.alias("contact_id"), first.alias("first_name"), last.alias("last_name"), email.alias("email"),
        F.col("c_nationkey").cast("string").alias("mobile"), F.col("c_name").alias("phone"),
        F.col("c_mktsegment").alias("client_type_label"), code.alias("client_type_code"),
        when("c_acctbal >= 0", "active", "inactive").alias("lifecycleStage"), F.lit("2020-01-01T00:00:00Z").alias("created_at"),
        text("2024-01-", F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), "T00:00:00Z").alias("updated_at"),
        cid.alias("id"), obj(email=email, emailSecondary=text("s", pair("c_custkey"), "@example.org")).alias("telecom"),
        obj(given=first, family=last).alias("name"),
    )
    return _canonical(c, "contact", text("dataverse:clinic:contact:", cid), payload, "dataverse", "clinic", "contact", old())


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer over two connections; the newer row carries the address that counts."""
    c = load(spark, sf, "customer").withColumn("conn", F.explode(F.array(F.lit("old"), F.lit("new"))))
    email = when("conn = 'new'", text("C", pair("c_custkey"), "@EXAMPLE.com"), "gone@example.com")
    payload = to_json_full(text("U", F.col("c_custkey")).alias("customer_id"), email.alias("email"))
    created = when("conn = 'new'", F.lit("2024-01-01 00:00:00").cast("timestamp"), old())
    return _canonical(c, "customer", text("stripe:", F.col("conn"), ":customer:", F.col("c_custkey")), payload, "stripe",
                      F.col("conn"), "customer", created)


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    sid = text("S", F.col("o_orderkey"))
    payload = to_json_full(
        sid.alias("session_id"), when("o_orderpriority = '5-LOW'", None, text("C", F.col("o_custkey"))).alias("contact_id"),
        when("o_orderstatus = 'P'", "n/a", F.col("o_custkey").cast("string")).alias("session_num"),
        when("o_orderpriority = '1-URGENT'", None, iso("o_orderdate")).alias("created_at"), iso("o_orderdate").alias("updated_at"),
        F.col("o_orderstatus").alias("status"), sid.alias("id"), F.col("o_orderpriority").alias("title"),
        F.col("o_custkey").alias("sessionNumber"),
        obj(start=iso("o_orderdate"), end=iso(F.col("o_orderdate") + F.expr("interval 1 hour"))).alias("period"),
        obj(updatedAt=iso("o_orderdate")).alias("meta"), F.lit(50).alias("duration"), F.col("o_orderstatus").alias("type"),
        obj(reference=text("Contact/C", F.col("o_custkey"))).alias("subject"),
    )
    return _canonical(o, "clinical_session", text("dataverse:clinic:session:", sid), payload, "dataverse", "clinic", "session",
                      F.col("o_orderdate"))


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "pages")
    payload = to_json_full(
        text("T", F.col("page_id")).alias("id"), text("S", F.col("page_id")).alias("session_source_id"),
        obj(reference=when("url like 'https%'", text("Contact/C", F.col("page_id")), "none")).alias("subject"),
        obj(format="html", text=F.col("html")).alias("content"), F.lit("en").alias("language"), F.lit("2024-01-05").alias("date"),
        obj(status="completed").alias("processing"), obj(createdAt="2024-01-05", updatedAt=F.col("url")).alias("meta"),
    )
    return _canonical(p, "session_transcript", text("dataverse:clinic:session:", F.col("page_id"), "#transcript"), payload,
                      "dataverse", "clinic", "session", old())


def clinical_documents(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    kind = F.expr("case lang when 'en' then 'soap-note' when 'fr' then 'client-summary' when 'de' then 'progress-report' else lang end")
    body = F.when(F.col("lang") != "es", obj(format="markdown", text=F.col("text")))
    payload = to_json_full(
        text("D", F.col("doc_id")).alias("id"), text("S", F.expr("cast(doc_id div 3 as string)")).alias("session_source_id"),
        obj(reference=text("Contact/C", F.expr("cast(doc_id div 2 as string)"))).alias("subject"), kind.alias("docType"),
        F.col("source").alias("title"), body.alias("content"), F.lit("final").alias("status"), F.lit(None).cast("string").alias("audience"),
        F.lit("2024-01-06").alias("date"), obj(createdAt="2024-01-06", updatedAt="2024-01-07").alias("meta"),
    )
    return _canonical(d, "clinical_document", text("dataverse:clinic:document:", F.col("doc_id")), payload, "dataverse", "clinic",
                      "document", old())


def price_band() -> Column:
    return F.expr("case when o_totalprice < 100000 then 'not at all' when o_totalprice < 250000 then 'several days'"
                  " when o_totalprice < 400000 then 'nearly every day' else 'unsure' end")


def binding_connection() -> Column:
    return F.expr("case o_orderstatus when 'F' then 'google-forms-intake-01' when 'O' then 'google-forms-intake-02'"
                  " else 'google-forms-followup' end")


def respondent() -> Column:
    return when("o_orderpriority = '3-MEDIUM'", None, text("C", pair("o_custkey"), "@EXAMPLE.COM"))


def form_responses(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    answer = lambda q, v: obj(question_id=q, answer_type="choice", answer_value=v)
    payload = to_json_full(
        text("R", F.col("o_orderkey")).alias("response_id"), text("form-", F.col("o_orderstatus")).alias("form_id"),
        obj(email=respondent()).alias("respondent"), F.lit("submitted").alias("status"), iso("o_orderdate").alias("submitted_at"),
        iso("o_orderdate").alias("last_updated_at"), obj(platform="google_forms").alias("source"),
        F.array(answer("q.priority", F.col("o_orderpriority")), answer("q.status", F.col("o_orderstatus")), answer("q.price", price_band())).alias("answers"),
    )
    return _canonical(o, "form_response", text("google_forms:form_response:", F.col("o_orderkey")), payload, "google_forms",
                      binding_connection(), "form_response", F.col("o_orderdate"))


def emails(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    mail = text("C", pair("user_id"), "@example.com")
    sender = F.when(F.col("event_type") == "click", "Owner@Example.net").when(F.col("event_type") == "purchase", "noreply@list.test").otherwise(mail)
    to = F.when(F.col("event_type") == "click", mail).when(F.col("event_type") == "signup", "Desk@practice.test").otherwise("owner@example.net")
    payload = to_json_full(
        text("E", F.col("user_id"), "-", F.floor("value")).alias("id"),
        when("event_type = 'error'", None, text("Re: ", F.col("event_type"), " ", F.col("props"), " and the rest of a long subject line")).alias("subject"),
        iso("ts").alias("sentAt"), iso("ts").alias("receivedAt"), text("H", F.col("user_id")).alias("threadId"),
        F.array(obj(email=sender, name=F.col("event_type"))).alias("from"), F.array(obj(email=to)).alias("to"),
        F.col("props").alias("preview"), when("event_type = 'view'", None, F.array(F.col("event_type"), F.lit("INBOX"))).alias("labels"),
        F.struct((F.col("value") > 50).alias("$seen"), (F.col("value") > 90).alias("$flagged")).alias("keywords"),
    )
    system = when("event_type in ('view', 'click', 'signup')", "gmail", "exchange")
    return _canonical(e, "email", text("mail:", F.col("event_id")), payload, system, "acct1", "email", F.col("ts"))


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    payload = to_json_full(
        text("I", pair("o_orderkey")).alias("invoice_id"), text("C", pair("o_custkey"), "@Example.com").alias("customer_email"),
        F.col("o_orderstatus").alias("status"), iso("o_orderdate").alias("event_time"), text("N", F.col("o_orderkey")).alias("invoice_number"),
        money("o_totalprice").alias("amount_due"), F.lit("cad").alias("currency"), when("o_orderstatus = 'F'", None, F.col("o_orderpriority")).alias("description"),
    )
    return _canonical(o, "invoice", text("inv:", F.lpad(F.col("o_orderkey").cast("string"), 12, "0")), payload, "stripe", "new", "invoice", F.col("o_orderdate"))


def payments(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    payload = to_json_full(
        text("P", F.col("o_orderkey")).alias("payment_id"), text("U", F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderstatus").alias("status"), iso("o_orderdate").alias("event_time"), money("o_totalprice").alias("amount"),
        F.lit("cad").alias("currency"), when("o_orderstatus = 'F'", None, "card").alias("payment_method_type"),
    )
    return _canonical(o, "payment", text("pay:", F.lpad(F.col("o_orderkey").cast("string"), 12, "0")), payload, "stripe", "new", "payment", F.col("o_orderdate"))


def refunds(spark: SparkSession, sf: str) -> DataFrame:
    x = load(spark, sf, "lineitem").where("l_returnflag = 'R'")
    line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    payload = to_json_full(
        text("F", line).alias("refund_id"), F.col("l_linestatus").alias("status"), iso("l_shipdate").alias("event_time"),
        money("l_extendedprice").alias("amount"), F.lit("cad").alias("currency"), F.col("l_partkey").cast("string").alias("reason"),
        text("P", F.col("l_orderkey")).alias("payment_intent_id"),
    )
    key = text("ref:", line, "-", F.concat_ws("-", "l_partkey", "l_suppkey", money("l_extendedprice"), money("l_quantity")))
    return _canonical(x, "refund", key, payload, "stripe", "new", "refund", F.col("l_shipdate"))


KINDS = (contacts, customers, sessions, transcripts, clinical_documents, form_responses, emails, invoices, payments, refunds)


def canonical_objects(spark: SparkSession, sf: str, *kinds) -> DataFrame:
    """All canonical objects, or those of the given builders.

    A view that filters on canonical_schema reads only its own branch either way; naming the
    branches spares the analysis of the others.
    """
    return reduce(DataFrame.unionByName, [k(spark, sf) for k in kinds or KINDS])


def measurement_events(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    return e.select(
        text("M", F.col("event_id")).alias("measurement_event_id"), text("M", F.col("event_id")).alias("idem_key"),
        text("C", pair("user_id"), "@Example.COM").alias("subject_id"), F.lit("form").alias("event_type"),
        F.col("event_type").alias("event_subtype"), F.col("ts").cast("timestamp").alias("occurred_at"),
        F.col("event_type").alias("binding_id"), F.lit("1.0.0").alias("binding_version"),
        when("event_type = 'error'", None, F.col("props")).alias("form_id"), F.col("event_id").cast("string").alias("source_id"),
        text("co:", F.col("event_id")).alias("canonical_object_id"),
    )


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    kind = F.expr("case event_type when 'view' then 'ingestion.completed' when 'click' then 'validation.completed'"
                  " when 'purchase' then 'canonization.completed' when 'signup' then 'job.started' else 'job.failed' end")
    status = F.expr("case when event_type = 'error' then 'failed' when value >= 20 then 'success' else 'ok' end")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(
        F.col("event_id"), kind.alias("event_type"), text("sys", F.expr("user_id div 50")).alias("source_system"),
        text("conn", F.expr("user_id div 10")).alias("connection_name"), F.col("event_type").alias("object_type"),
        text("k", F.col("user_id")).alias("idem_key"), F.col("ts").alias("created_at"), status.alias("status"),
        when("event_type = 'error'", F.col("props")).alias("error_message"),
        to_json_full(text("obj", F.expr("user_id div 25")).alias("object_type"), k.alias("records_extracted"),
                     F.floor("value").alias("records_inserted")).alias("payload"),
    )


def raw_objects(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.select(
        text("raw:", F.col("o_orderkey")).alias("idem_key"), F.col("o_orderpriority").alias("source_system"), F.lit("main").alias("connection_name"),
        F.col("o_orderstatus").alias("object_type"), F.col("o_orderkey").cast("string").alias("external_id"),
        to_json_full("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("total")).alias("payload"),
        F.col("o_orderdate").alias("first_seen"), (F.col("o_orderdate") + F.expr("interval 1 day")).alias("last_seen"),
        F.expr("case o_orderstatus when 'F' then 'pass' when 'O' then 'fail' end").alias("validation_status"),
        F.lit("run-1").alias("correlation_id"),
    )


def raw_mail(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id"))
    sent = F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    payload = to_json_full(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("threadId"), F.col("text").alias("subject"),
        text(F.col("source"), "@", F.col("lang"), ".example.com").alias("from"), F.array(F.lit("a@example.com"), F.col("lang")).alias("to"),
        F.lit(None).cast("array<string>").alias("cc"), sent.alias("date"),
        when("lang = 'en'", F.array(F.lit("INBOX"), F.lit("UNREAD")), F.array(F.lit("INBOX"))).alias("labelIds"), F.col("text").alias("snippet"),
    )
    return d.select(
        text("gmail:acct1:email:", F.col("doc_id")).alias("idem_key"), F.lit("gmail").alias("source_system"), F.lit("email").alias("object_type"),
        payload.alias("payload"), at.alias("first_seen"), at.alias("last_seen"),
    )


def actions(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    return e.select(
        F.col("event_id").alias("action_id"), F.col("user_id").cast("string").alias("user_id"), F.lit("chat").alias("channel"),
        F.col("event_type").alias("action_type"), F.col("props").alias("context"), F.col("event_type").alias("instruction"),
        F.col("ts").alias("created_at"), F.expr("case event_type when 'purchase' then 'pending' when 'view' then 'completed' else 'dropped' end").alias("status"),
    )


# --- the domain event log -------------------------------------------------------------------


def _log(df: DataFrame, kind: str, key: Column, event_id: Column, event_type: Column, at: Column, payload: Column) -> DataFrame:
    return df.select(
        event_id.alias("event_id"), key.alias("aggregate_id"), F.lit(kind).alias("aggregate_type"), event_type.alias("event_type"),
        F.lit(None).cast("string").alias("subject_id"), at.cast("timestamp").alias("occurred_at"), at.cast("timestamp").alias("ingested_at"),
        payload.alias("payload"), F.lit("service").alias("producer_service"), F.lit("part").alias("producer_component"),
        F.lit("run-1").alias("correlation_id"),
    )


def project_log(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    only = lambda kind, c: when(f"event_type = '{kind}'", c)
    payload = to_json_full(
        only("signup", text("n", F.col("event_id"))).alias("name"), only("view", F.col("props")).alias("description"),
        only("click", text("u", F.floor("value"))).alias("owner"), only("purchase", money("value")).alias("status"),
        F.lit(None).cast("string").alias("target_end_date"), only("view", text("OS", F.col("user_id") % 5)).alias("opsstream_id"),
    )
    return _log(e, "project", text("PR", F.col("user_id")), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.col("event_type"), F.col("ts"), payload)


def deliverable_log(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    payload = F.to_json(obj(  # NULL fields are left out here: a missing key, not a JSON null
        project_id=when("o_orderstatus = 'F'", text("PR", F.expr("o_custkey div 10"))), name=F.col("o_orderpriority"),
        description=when("o_orderstatus = 'O'", money("o_totalprice")), status=F.col("o_orderstatus"), due_date=iso("o_orderdate"),
        acceptance_criteria=F.lit(None).cast("string"),
    ))
    return _log(o, "deliverable", text("DL", F.col("o_custkey")), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
                F.col("o_orderstatus"), F.col("o_orderdate"), payload)


def opsstream_log(spark: SparkSession, sf: str) -> DataFrame:
    """Five streams over all orders: every key is hot."""
    o = load(spark, sf, "orders")
    payload = F.to_json(obj(
        name=F.col("o_orderstatus"), type=when("o_orderstatus = 'P'", "pending"), owner=text("U", F.col("o_custkey")),
        status=when("o_totalprice > 400000", "large"), description=when("o_orderstatus <> 'F'", money("o_totalprice")),
    ))
    return _log(o, "opsstream", text("OS", F.col("o_orderpriority")), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
                F.col("o_orderstatus"), F.col("o_orderdate"), payload)


def line_id() -> Column:
    return F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), "l_linenumber", "l_partkey", "l_suppkey",
                       money("l_extendedprice"), money("l_quantity"))


def work_item_log(spark: SparkSession, sf: str) -> DataFrame:
    x = load(spark, sf, "lineitem")
    payload = F.to_json(obj(
        title=text("part ", F.col("l_partkey")), kind=F.col("l_returnflag"), state=F.col("l_linestatus"),
        priority=when("l_quantity > 25", "high"), severity=when("l_discount > 0.05", money("l_discount")),
        assignees=F.when(F.col("l_returnflag") == "R", F.array("l_suppkey")),
        labels=F.when(F.col("l_returnflag") == "A", F.array("l_returnflag", "l_linestatus")), due_at=iso("l_shipdate"),
        project_id=when("l_linestatus = 'O' and l_returnflag = 'N'", text("PR", F.col("l_suppkey"))),
        deliverable_id=text("DL", F.col("l_partkey")), opsstream_id=when("l_tax > 0.06", text("OS", F.col("l_linenumber"))),
        parent_id=F.lit(None).cast("string"),
    ))
    return _log(x, "work_item", text("WI", F.col("l_orderkey")), line_id(), F.col("l_returnflag"), F.col("l_shipdate"), payload)


def artifact_log(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "conversations")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("turn"))
    payload = F.to_json(obj(
        title=text("turn ", F.col("turn")), kind=F.col("role"), status=when("role = 'assistant'", "done"), content=F.col("text"),
        content_ref=when("role = 'system'", text("ref", F.col("conv_id"))), tags=F.when(F.col("role") == "user", F.array("role")),
        work_item_id=text("WI", F.col("conv_id")), delivered_via=F.lit(None).cast("string"),
    ))
    key = F.concat_ws("-", F.lpad(F.col("conv_id").cast("string"), 12, "0"), F.lpad(F.col("turn").cast("string"), 6, "0"))
    return _log(c, "artifact", text("AR", F.col("conv_id")), key, F.col("role"), at, payload)


def object_log(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("doc_id").cast("decimal(18,6)"))
    payload = F.to_json(obj(
        idem_key=text("k", F.col("doc_id")), entity_id=F.col("source"), object_type=F.col("lang"), content=F.col("text"),
        inference_audit=F.struct("n_chars"),
    ))
    kind = when("lang = 'de'", "object.deleted", "object.created")
    return _log(d, "domain_object", text("DO", F.col("source")), F.lpad(F.col("doc_id").cast("string"), 12, "0"), kind, at, payload)


LOGS = (project_log, deliverable_log, opsstream_log, work_item_log, artifact_log, object_log)


def domain_events(spark: SparkSession, sf: str, *logs) -> DataFrame:
    """The whole domain event log, or the parts made by the given builders."""
    return reduce(DataFrame.unionByName, [k(spark, sf) for k in logs or LOGS])
