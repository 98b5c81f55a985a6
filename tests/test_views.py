"""Views on small hand-written tables that hold the awkward cases."""

import json

from pyspark.sql import functions as F

from conftest import plan_of, rows
from eventcanon.plans import canonical as cn
from eventcanon.plans import client_views as cv
from eventcanon.plans import context_views as xv
from eventcanon.plans import entity_views as ev
from eventcanon.plans import forms as fm
from eventcanon.plans import mail_views as mv
from eventcanon.plans import registry, reports

S = cn.SCHEMAS
COLUMNS = "idem_key string, source_system string, connection_name string, object_type string, canonical_schema string, created_at timestamp, payload string"


def objects(spark, *items):
    """(kind, payload[, source system[, created_at]]) as canonical rows."""
    out = []
    for i, (kind, payload, *rest) in enumerate(items):
        source, created = (list(rest) + ["s", "2024-01-01 00:00:00"][len(rest):])[:2]
        out.append((f"k{i:03d}", source, "c", kind, S[kind], created, json.dumps(payload)))
    df = spark.createDataFrame(out, COLUMNS.replace("timestamp", "string"))
    return df.withColumn("created_at", F.col("created_at").cast("timestamp"))


def contact(cid, email, code="1", stage="active", updated="2024", **more):
    return ("contact", {"contact_id": cid, "email": email, "client_type_code": code, "lifecycleStage": stage, "updated_at": updated, **more})


def test_clients_folder_and_code_list(spark):
    c = objects(
        spark,
        contact("1", "a@x", "1,3", first_name="Ann", last_name="Lee"), contact("2", "b@x", "1", last_name="Lee"), contact("3", "c@x", "2,1"),
        contact("4", "d@x", "11"), contact("5", "e@x", "1", "closed"), contact("6", "f@x", None), contact("7", "g@x", "1", first_name="Bo"),
    )
    assert rows(cv.proj_clients(c).select("client_id", "client_folder")) == [("1", "Ann L"), ("2", "Lee"), ("3", "3"), ("7", "7")]


def test_timeline_reaches_one_client_from_all_sources(spark):
    own = ["me@own.test"]
    mail = lambda mid, sender, to, subject="s": {"id": mid, "subject": subject, "sentAt": "2024-01-02T00:00:00Z", "threadId": "t", "from": [{"email": sender}], "to": [{"email": to}]}
    c = objects(
        spark,
        contact("old", "A@x", updated="2020"), contact("new", "a@X", updated="2024"), contact("nomail", None),
        ("customer", {"customer_id": "u1", "email": "wrong@x"}, "s", "2023-01-01 00:00:00"),
        ("customer", {"customer_id": "u1", "email": "A@x"}, "s", "2024-01-01 00:00:00"),
        ("clinical_session", {"session_id": "s1", "contact_id": "new", "session_num": "x", "updated_at": "2024-01-03T00:00:00Z", "status": "done"}),
        ("clinical_session", {"session_id": "s2", "contact_id": "nomail", "session_num": 4, "created_at": "2024-01-01T00:00:00Z"}),
        ("clinical_session", {"session_id": "s3"}),
        ("email", mail("m1", "A@x", "me@own.test"), "gmail"),
        ("email", mail("m1", "A@x", "me@own.test", "newer"), "gmail", "2024-02-01 00:00:00"),
        ("email", mail("m2", "ME@own.test", "A@X", "y" * 60), "exchange"),
        ("email", mail("m3", "stranger@x", "me@own.test", None), "exchange"),
        ("invoice", {"invoice_id": "i1", "customer_email": "A@x", "status": "paid", "event_time": "2024-01-05", "amount_due": "250.0"}),
        ("payment", {"payment_id": "p1", "customer_id": "u1", "status": "ok", "event_time": "2024-01-06", "amount": 10}),
        ("payment", {"payment_id": "p2", "customer_id": "unknown", "status": "ok", "event_time": "bad"}),
        ("refund", {"refund_id": "r1", "payment_intent_id": "p1", "status": "ok", "event_time": "2024-01-07"}),
        ("refund", {"refund_id": "r2", "status": "ok"}),
    )
    me = spark.createDataFrame(
        [("me1", "A@X", "form", "intake_01", "b", "1", None, "src", "co1")],
        "measurement_event_id string, subject_id string, event_type string, event_subtype string, binding_id string, binding_version string, form_id string, source_id string, canonical_object_id string",
    ).withColumn("occurred_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = {(r.source_system, r.source_record_id): r for r in cv.proj_contact_events(c, me, own).collect()}
    assert len(got) == 11
    known = {k[1] for k, r in got.items() if r.contact_id == "new"}
    assert known == {"me1", "s1", "m1", "m2", "i1", "p1", "r1"}
    assert got[("measurement_events", "me1")].contact_email == "A@X"
    assert got[("measurement_events", "me1")].payload == '{"binding_id":"b","binding_version":"1","form_id":null,"form_submission_id":"src","canonical_object_id":"co1"}'
    assert got[("dataverse_sessions", "s1")].payload == '{"session_num":null}' and str(got[("dataverse_sessions", "s1")].event_timestamp) == "2024-01-03 00:00:00"
    s2 = got[("dataverse_sessions", "s2")]
    assert (s2.contact_id, s2.contact_email, s2.payload) == ("nomail", None, '{"session_num":4}')
    assert got[("email_gmail", "m1")].event_name == "inbound: newer"
    assert got[("email_exchange", "m2")].event_name == "outbound: " + "y" * 50 and got[("email_exchange", "m2")].contact_email == "a@x"
    assert got[("email_exchange", "m3")].event_name == "inbound: (no subject)" and got[("email_exchange", "m3")].contact_id is None
    assert '"amount_due":"250.0"' in got[("stripe_invoice", "i1")].payload
    assert got[("stripe_payment", "p2")].contact_email is None and got[("stripe_payment", "p2")].event_timestamp is None


def test_timeline_by_system_and_with_whole_subjects(spark):
    mail = lambda mid, sender: {"id": mid, "subject": "y" * 60, "from": [{"email": sender}], "to": [{"email": "b@x"}]}
    c = objects(spark, ("email", mail("m", "a@x"), "gmail"), ("email", mail("m", "a@x"), "exchange"), ("email", mail("m", "a@x"), "other"))
    got = cv.email_events(c, {"gmail": ["A@x"], "exchange": []}, subject_length=None).select("source_system", "event_name", "__address")
    assert rows(got) == [("email_exchange", "inbound: " + "y" * 60, "a@x"), ("email_gmail", "outbound: " + "y" * 60, "b@x")]


def test_timeline_plan_shares_lookups(spark):
    me = spark.createDataFrame([], "measurement_event_id string, subject_id string, event_type string, event_subtype string, binding_id string, binding_version string, form_id string, source_id string, canonical_object_id string, occurred_at timestamp")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(cv.proj_contact_events(objects(spark, contact("1", "A@x")), me, ["me@own.test"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 4  # by address, by id, customers, payers
    assert plan.count("Exchange hashpartitioning") <= 18


def test_form_responses_fan_out_over_shared_addresses(spark):
    c = objects(
        spark, contact("1", "A@x"), contact("2", "a@x", "9"), contact("3", None),
        ("form_response", {"response_id": "r1", "respondent": {"email": "a@X"}, "answers": [{"q": 1}]}), ("form_response", {"response_id": "r2", "respondent": {}}),
    )
    for share in (None, 0.01):
        got = cv.proj_form_responses(c, hot_share=share).select("response_id", "client_id", "answers_json")
        assert rows(got) == [("r1", "1", '[{"q":1}]'), ("r1", "2", '[{"q":1}]'), ("r2", None, None)]


AS_OF = "2024-01-31 00:00:00"


def test_context_tables_prune_by_day(spark, tmp_path):
    path = str(tmp_path / "canonical")
    day = lambda p: F.to_date(F.get_json_object("payload", p).try_cast("timestamp"))
    c = mails(spark).withColumn("day", F.coalesce(day("$.receivedAt"), day("$.period.start")))
    c.write.partitionBy("day").parquet(path)
    laid = spark.read.parquet(path)
    pruned = xv.context_emails(laid, ["listed.test"], ["desk@practice.test"], AS_OF, date_column="day")
    assert "PartitionFilters: [(isnull(day" in plan_of(pruned) and "2024-01-17" in plan_of(pruned)
    assert rows(pruned) == rows(xv.context_emails(laid, ["listed.test"], ["desk@practice.test"], AS_OF))
    assert "PartitionFilters: [(isnull(day" in plan_of(xv.context_calendar(laid, AS_OF, date_column="day"))


def mails(spark):
    def mail(mid, sender, to="t@x", received="2024-01-30T00:00:00Z", **more):
        people = [{"email": sender, "name": "zoe q"}] if sender else []
        return ("email", {"id": mid, "from": people, "to": [{"email": to}], "subject": "s", "preview": "p", "receivedAt": received, **more})

    person = lambda cid, a, b: ("contact", {"id": cid, "telecom": {"email": a, "emailSecondary": b}})
    return objects(
        spark, person("c1", "P@x", "S@x"), person("c2", "both@x", "BOTH@x"), person("c3", "shared@x", None), person("c4", None, "shared@x"), person("c5", None, None),
        mail("primary", "p@X", labels=["INBOX"]), mail("secondary", "s@x", keywords={"$flagged": True, "$seen": True}), mail("both", "both@x"), mail("shared", "Shared@x"),
        mail("domain", "Info@Listed.test"), mail("mailbox", "q@x", "Desk@practice.test"), mail("clean", "q@x"), mail("noreply", "noreply@x"),
        mail("nobody", None), mail("old", "q@x", received="2024-01-10T00:00:00Z"), mail("bad", "q@x", received="soon"), mail("noat", "listed.test", "desk@practice.test"),
    )


def test_redaction(spark):
    out = xv.context_emails(mails(spark), ["listed.test"], ["desk@practice.test"], AS_OF)
    got = {}
    for r in out.collect():
        got.setdefault(r.email_id, []).append(r)
    assert {k: len(v) for k, v in got.items()} == {
        "primary": 1, "secondary": 1, "both": 1, "shared": 2, "domain": 1, "mailbox": 1, "clean": 1, "noreply": 1, "nobody": 1, "noat": 1,
    }
    first = got["primary"][0]
    assert (first.sender_email, first.sender_name, first.snippet, first.labels, first.clinical_contact_id) == ("p*****@X", "Client Z.", None, ["INBOX"], "c1")
    assert {r.clinical_contact_id for r in got["shared"]} == {"c3", "c4"}
    assert got["secondary"][0].is_flagged and not got["secondary"][0].is_unread and not got["secondary"][0].needs_response
    assert got["domain"][0].sender_email == "i*****@Listed.test" and got["mailbox"][0].is_clinical
    clean = got["clean"][0]
    assert (clean.is_clinical, clean.sender_email, clean.snippet, clean.labels, clean.needs_response) == (False, "q@x", "p", [], True)
    assert not got["noreply"][0].needs_response
    nobody = got["nobody"][0]
    assert (nobody.is_clinical, nobody.needs_response, nobody.snippet) == (None, None, "p")
    assert got["noat"][0].is_clinical and got["noat"][0].sender_email is None
    assert "BroadcastNestedLoopJoin" not in plan_of(out) and "CartesianProduct" not in plan_of(out)


def test_redaction_with_hot_sender_split(spark):
    a = xv.context_emails(mails(spark), ["listed.test"], ["desk@practice.test"], AS_OF)
    b = xv.context_emails(mails(spark), ["listed.test"], ["desk@practice.test"], AS_OF, hot_share=0.05)
    assert rows(a) == rows(b)


def test_calendar_and_actions(spark):
    c = objects(
        spark, ("contact", {"id": "1", "name": {"given": "Ann", "family": "Lee"}}), ("contact", {"id": "2", "name": {}}),
        ("clinical_session", {"id": "a", "period": {"start": "2024-01-20T00:00:00Z"}, "subject": {"reference": "Contact/1"}, "duration": 50}),
        ("clinical_session", {"id": "b", "period": {"start": "2024-02-14T00:00:00Z"}, "subject": {"reference": "Contact/2"}}),
        ("clinical_session", {"id": "c", "period": {"start": "2024-02-20T00:00:00Z"}}), ("clinical_session", {"id": "d", "period": {}}),
    )
    got = xv.context_calendar(c, AS_OF).select("session_id", "client_name", "duration_minutes")
    assert rows(got) == [("a", "Ann L", 50), ("b", " ", None)]
    acts = spark.createDataFrame(
        [(1, "completed", "2024-01-30 12:00:00"), (2, "pending", "2020-01-01 00:00:00"), (3, "completed", "2024-01-29 00:00:00"), (4, "pending", "2024-01-01 00:00:00"), (5, "failed", "2024-01-30 12:00:00")],
        "action_id int, status string, at string",
    ).selectExpr("action_id", "'u' user_id", "'c' channel", "'t' action_type", "'x' context", "'i' instruction", "cast(at as timestamp) created_at", "status")
    assert [r.action_id for r in xv.context_actions(acts, AS_OF).collect()] == [4, 2, 1]


LOG = "event_id string, aggregate_id string, aggregate_type string, event_type string, at string, payload string"


def log(spark, *events):
    df = spark.createDataFrame([(*e[:5], json.dumps(e[5])) for e in events], LOG)
    extra = {c: F.lit(None).cast("string") for c in ("subject_id", "producer_service", "producer_component", "correlation_id")}
    return df.withColumns({"occurred_at": F.col("at").cast("timestamp"), "ingested_at": F.col("at").cast("timestamp"), **extra})


def test_fold_of_entities_and_hierarchy(spark):
    events = log(
        spark,
        ("1", "p1", "project", "created", "2024-01-01", {"name": "one", "owner": "x", "status": "open"}),
        ("2", "p1", "project", "updated", "2024-01-02", {"name": None, "status": {"not": "scalar"}}),
        ("3", "p1", "project", "updated", "2024-01-03", {"owner": "y"}),
        ("4", "d1", "deliverable", "created", "2024-01-01", {"project_id": "p1"}),
        ("5", "w1", "work_item", "created", "2024-01-01", {"deliverable_id": "d1", "labels": ["a"], "assignees": None}),
        ("6", "w2", "work_item", "created", "2024-01-01", {"deliverable_id": "d1", "project_id": "own"}),
        ("7", "w3", "work_item", "created", "2024-01-01", {"title": "t", "opsstream_id": "o9"}),
        ("8", "w1", "work_item", "updated", "2024-01-01", {"labels": ["b"]}),
        ("9", "a1", "artifact", "created", "2024-01-01", {"content": "z" * 700, "tags": []}),
    )
    assert rows(ev.view_pm_projects(events)) == [("p1", "one", None, "y", "open", None, "p1", "3", "synced")]
    items = {r.work_item_id: r for r in ev.view_pm_work_items(events).collect()}
    assert {k: r.effective_project_id for k, r in items.items()} == {"w1": "p1", "w2": "own", "w3": None}
    assert (items["w1"].labels, items["w1"].assignees, items["w1"].row_version) == ('["b"]', None, "8")
    art = ev.view_pm_artifacts(events).collect()[0]
    assert (len(art.content), art.tags) == (500, "[]")
    projects = ev.view_pm_projects(events).withColumn("opsstream_id", F.lit("o1"))
    streams = ev.effective_opsstreams(ev.fold_entity(events, "work_item"), ev.view_pm_deliverables(events), projects)
    assert rows(streams.select("work_item_id", "effective_opsstream_id")) == [("w1", "o1"), ("w2", None), ("w3", "o9")]


def test_domain_objects_and_deletes(spark):
    events = log(
        spark,
        ("1", "a", "domain_object", "x.created", "2024-01-01", {"content": "one", "inference_audit": {"m": 1}}),
        ("2", "a", "domain_object", "x.deleted", "2024-01-02", {}),
        ("3", "b", "domain_object", "x.created", "2024-01-01", {"content": "b1"}),
        ("4", "b", "domain_object", "x.updated", "2024-01-01", {"content": "b2"}),
        ("5", "c", "other", "x.created", "2024-01-01", {}),
    )
    assert rows(ev.domain_objects(events).select("event_id", "content", "inference_audit")) == [("1", "one", '{"m":1}'), ("4", "b2", None)]
    assert rows(ev.domain_objects(events, drop_deleted="after").select("event_id")) == [("4",)]


def test_mail_table_and_search(spark):
    payload = {"id": "1", "from": "a@x", "to": ["b@x"], "date": "Tue, 02 Jan 2024 03:04:05 +0000", "labelIds": ["UNREAD"], "subject": "Team meeting"}
    raw = spark.createDataFrame([("k", "gmail", "email", json.dumps(payload)), ("z", "gmail", "other", "{}")], "idem_key string, source_system string, object_type string, payload string")
    raw = raw.withColumns({"first_seen": F.lit(None).cast("timestamp"), "last_seen": F.lit(None).cast("timestamp")})
    mail = mv.emails_mv(raw)
    got = mail.collect()
    assert len(got) == 1 and str(got[0].email_date) == "2024-01-02 03:04:05" and got[0].to_emails == ["b@x"] and got[0].cc_emails is None
    assert mv.subject_contains(mail, "meeting").count() == 1 and mv.subject_contains(mail, "me_ting").count() == 0
    assert mv.with_label(mail, "UNREAD").count() == 1
    assert mv.search_payload(raw, "MEETING team").count() == 1 and mv.search_payload(raw, "meet").count() == 0


def test_registry_creates_all_views(spark, tmp_path):
    from eventcanon.sources.catalog import Catalog

    tables = {
        "canonical_objects": mails(spark), "domain_events": log(spark, ("1", "p1", "project", "c", "2024-01-01", {"name": "n"})),
        "raw_objects": spark.sql("select 'k' idem_key, 'g' source_system, 'email' object_type, '{}' payload, current_timestamp() first_seen, current_timestamp() last_seen"),
        "actions": spark.sql("select 1 action_id, 'u' user_id, 'c' channel, 't' action_type, 'x' context, 'i' instruction, current_timestamp() created_at, 'pending' status"),
        "measurement_events": spark.sql(
            "select 'm' measurement_event_id, 'p@x' subject_id, 'form' event_type, 'i' event_subtype, 'b' binding_id, '1' binding_version, 'f' form_id, 's' source_id, 'c' canonical_object_id, current_timestamp() occurred_at"
        ),
    }
    settings = {"as_of": AS_OF, "clinical_sender_domains": ["listed.test"], "practice_recipient_emails": ["desk@practice.test"]}
    made = registry.create_views(tables, settings)
    assert set(made) == set(registry.VIEWS) and len(made) == 16
    for name in made:
        assert spark.table(name).limit(1).collect() is not None
    target = Catalog(spark, str(tmp_path)).table("derived", "context_emails")
    registry.materialise("context_emails", tables, target, settings)
    assert target.read().count() == 11
    try:
        registry.view("nope", tables)
        raise AssertionError
    except KeyError:
        pass


# --- transforms and scoring -----------------------------------------------------------------


def raw(spark, payload, key="k"):
    return spark.createDataFrame([(key, "s", "c", "o", json.dumps(payload), "run")], "idem_key string, source_system string, connection_name string, object_type string, payload string, correlation_id string")


def test_session_transform_edges(spark):
    one = lambda p: json.loads(cn.clinical_session(raw(spark, p)).collect()[0].payload)
    got = one({"cre92_clientsessionid": "s", "statuscode": 5, "_cre92_client_value": "", "regardingobjectid": "r", "cre92_sessionnumber": 7})
    assert (got["status"], got["contact_id"], got["session_num"], got["source"]["platform"]) == ("no_show", "r", 7, "dataverse")
    assert one({"cre92_clientsessionid": "s", "statuscode": 9})["status"] is None


def test_canonise_two_rows(spark):
    rows_in = raw(spark, {"id": "cus_1", "email": "a@x"}, "k1").union(raw(spark, {"id": "cus_2", "email": "b@x"}, "k2"))
    out = cn.envelope(cn.billing("customer")(rows_in), S["customer"], "customer@1.0.0", "customer", AS_OF)
    assert out.columns == list(cn.CANONICAL_COLUMNS)
    assert [(r.idem_key, json.loads(r.payload)["customer_id"], r.correlation_id) for r in out.orderBy("idem_key").collect()] == [("k1#customer", "cus_1", "run"), ("k2#customer", "cus_2", "run")]


def test_forms_from_raw_response_to_scores(spark):
    """One response with 10 + 8 answers gives two scored events; 1,000 copies give 2,000."""
    phq = {f"entry.1{i:02d}": "Not at all " if i < 10 else "not difficult" for i in range(1, 11)}
    gad = {f"entry.2{i:02d}": "several days" if i < 8 else "unheard" for i in range(1, 9)}
    answers = {k: {"questionId": k, "textAnswers": {"answers": [{"value": v}]}} for k, v in {**phq, **gad}.items()}
    payload = {"responseId": "r", "formId": "f", "lastSubmittedTime": "2025-01-15T10:30:00Z", "respondentEmail": "t@x", "answers": answers}
    base = raw(spark, payload).withColumn("connection_name", F.lit("google-forms-intake-01"))
    many = base.crossJoin(spark.range(1000)).withColumn("idem_key", F.concat("idem_key", "id")).drop("id")
    canonical = cn.envelope(cn.form_response(many), S["form_response"], "form_response@1.0.0", as_of=AS_OF)
    events = fm.measurement_events(canonical, "intake_01", as_of=AS_OF)
    keys = spark.createDataFrame(
        [("intake_01", k, "phq9", k, None) for k in phq] + [("intake_01", k, "gad7", k, 3) for k in gad], "binding_id string, field_key string, instrument string, item string, reverse_from int"
    )
    values = spark.createDataFrame([(i, a, v) for i in ("phq9", "gad7") for a, v in (("not at all", 0), ("several days", 1))], "instrument string, answer string, value int")
    items = fm.scoring_items(events)
    assert items.count() == 18000 and items.agg(F.min("position"), F.max("position")).collect()[0] == (1, 18)
    assert items.select("subject_id").distinct().collect()[0][0] == "contact::t@x"
    scored = fm.scored_items(items, keys, values)
    totals = fm.score(scored)
    assert totals.count() == 2000
    assert rows(totals.select("instrument", "total", "answered", "unanswered").distinct()) == [("gad7", 14.0, 7, 1), ("phq9", 0.0, 9, 1)]
    observed = fm.observations(scored, AS_OF)
    assert observed.count() == 20000 and observed.select("idem_key").distinct().count() == 20000
    assert fm.unscored_events(events, observed, "intake_01").count() == 0
    assert fm.unformed_responses(canonical, events, "intake_01").count() == 0
    assert fm.without_binding(observed, events, "intake_01").count() == 0
    one = fm.scoring_input(events).limit(1).collect()[0]
    assert (one.form_id, one["items"][0].position, len(one["items"])) == ("googleforms::f", 1, 18)


def test_reports_on_edges(spark):
    steps = spark.createDataFrame([("r", "read", 6000, 60, None), ("r", "write", 6000, None, 30), ("q", "x", 0, None, None)], "run_id string, step_id string, duration_ms long, rows_read long, rows_written long")
    got = {r.run_id: r for r in reports.run_metrics(steps).collect()}
    assert (got["r"].bottleneck_step, got["r"].transform_throughput, got["r"].query_efficiency) == ("write", 5.0, "moderate")
    assert (got["q"].transform_throughput, got["q"].query_efficiency) == (0.0, "good")
    empty = steps.where("false").select(F.col("run_id").alias("event_id"), F.col("step_id").alias("idem_key"))
    assert tuple(reports.idempotency_ratio(empty).collect()[0]) == (0, 0, None)
    log = spark.sql("select 'a' source_system, 'c' connection_name, 'ingestion.completed' event_type, 'success' status, timestamp'2024-01-30 22:30:00' created_at, '{\"records_extracted\":\"x\"}' payload")
    assert reports.streams_health(log, "2024-01-31 00:00:00").collect()[0].hours_since_last == 1
    row = reports.pipeline_status(log, "2024-01-31 00:00:00").collect()[0]
    assert row.total_extracted is None and row.last_failure is None
