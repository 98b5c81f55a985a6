"""What a task reads, sorts and checks at once stays bounded, and rows are dealt no more often than needed."""

import json

import numpy as np
import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from eventcanon.llm import simhash
from eventcanon.operators import search_index, validate
from eventcanon.plans import client_views as cv
from eventcanon.session import MEASURED, PLANNED, tune
from eventcanon.sources.catalog import Catalog

READ = "spark.sql.files.maxPartitionBytes"
LIST = {"$ref": "#/definitions/node", "definitions": {"node": {"type": "object", "required": ["v"], "properties": {
    "v": {"type": "integer"}, "next": {"$ref": "#/definitions/node"}, "more": {"type": "array", "items": {"$ref": "#/definitions/node"}}}}}}


@pytest.fixture
def kept(spark):
    """The session's settings, put back after the test."""
    before = {k: spark.conf.get(k, None) for k in (READ, PLANNED, MEASURED)}
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_task_reads_16_mb_unless_the_session_says_otherwise(kept):
    kept.conf.unset(READ)
    assert tune(kept).conf.get(READ) == "16MB"
    kept.conf.set(READ, "77MB")
    assert tune(kept).conf.get(READ) == "77MB"


def test_rows_of_one_file_are_checked_by_all_tasks(spark):
    df = spark.range(0, 40, 1, 1).selectExpr("id", """'{"v":1,"next":{"v":"x"}}' AS payload""")
    out = validate.validate(df, LIST, all_errors="all").select("id", F.spark_partition_id().alias("task"), "all")
    got = out.collect()
    assert sorted(r.id for r in got) == list(range(40)) and len({r.task for r in got}) == 4
    assert all([(e.kind, e.text) for e in r["all"]] == [("type", "'x' is not of type 'integer'")] for r in got)


def test_values_below_values_are_found_by_their_place(spark):
    """Null, missing, scalars and arrays in the place of an object; errors in the order of the schema, the same value many times."""
    cases = {
        '{"v":1,"next":null}': ["null is not of type 'object'"],
        '{"v":1,"next":{}}': ["'v' is a required property"],
        '{"v":null,"next":[1]}': ["null is not of type 'integer'", "[1] is not of type 'object'"],
        '{"next":{"v":"a","next":{"v":"b","more":[{"v":2},{"v":"c"},7]}},"more":[{},{"v":"a"},{"v":"a"}]}': [
            "'v' is a required property", "'a' is not of type 'integer'", "'b' is not of type 'integer'", "'c' is not of type 'integer'", "7 is not of type 'object'",
            "'v' is a required property", "'a' is not of type 'integer'", "'a' is not of type 'integer'"],
        "[]": ["[] is not of type 'object'"], "null": ["null is not of type 'object'"], "{": ["payload is not JSON"], '{"v":3}': [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "payload string")
    got = {r.payload: [e.text for e in r["all"]] for r in validate.validate(df, LIST, all_errors="all").collect()}
    assert got == cases


def test_postings_are_dealt_once_and_distinct(spark, tmp_path, monkeypatch):
    texts = spark.createDataFrame([(i % 50, f"word{i % 7} the and") for i in range(200)], "id int, said string")
    catalog = Catalog(spark, str(tmp_path))
    raw = catalog.table("raw", "texts", partition_by=[search_index.ROW_BUCKET])
    index = catalog.table("derived", "postings", partition_by=[search_index.TOKEN_BUCKET], sort_by=["token", "key"])
    plans = []
    layout = type(index)._layout
    monkeypatch.setattr(type(index), "_layout", lambda self, *a: plans.append(layout(self, *a)) or plans[-1])
    search_index.add_rows(raw, index, texts, "id", "said", token_buckets=4, row_buckets=4)
    assert plan_of(plans[-1]).count("Exchange ") == 1
    want = search_index.postings(texts, "id", "said", 4, 4)
    assert rows(index.read().select(want.columns)) == rows(want)


def test_texts_are_dealt_once_to_keep_one_of_each(kept):
    kept.conf.set(PLANNED, "10MB")  # as in a session that was not tuned
    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(20)]
    df = kept.createDataFrame([(i, words[i % 20]) for i in range(60)] + [(3, words[3]), (None, "x")], "doc_id long, text string")
    out = simhash.one_of_each(df)
    assert rows(out) == rows(kept.createDataFrame([(i, w) for i, w in enumerate(words)] + [(None, "x")], df.schema))
    lines = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    leaf = max(i for i, line in enumerate(lines) if "text#" in line and "Scan" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above, at = 0, depth(lines[leaf])
    for line in reversed(lines[:leaf]):
        if depth(line) < at and ("+- " in line or ":- " in line or line is lines[0]):
            at = depth(line)
            above += "Exchange " in line
    assert above == 1


def test_no_join_where_no_cell_is_large(spark):
    """Rows of cells pass no join, and no shuffle for one, unless a cell has more fingerprints than meet at once."""
    rng = np.random.default_rng(12)
    fps = np.unique(rng.integers(0, 2**63, 30, dtype=np.uint64)[rng.integers(0, 30, 200)] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)))
    keys = simhash.exact_keys(4)
    cells = simhash.cell_rows(spark.createDataFrame([(bytearray(int(f).to_bytes(8, "big")),) for f in fps.tolist()], "fp binary"), keys)
    whole = {few: simhash.cell_links(cells, 4, keys=keys, few=few) for few in (False, True)}
    for df in whole.values():
        assert plan_of(df).count("Join") == 0 and plan_of(df).count("Exchange ") == 1
    assert plan_of(simhash.cell_links(cells, 4, 8)).count("Join") == 1  # cells of more than 8: looked up, and met in chunks
    nodes = spark.createDataFrame([(bytearray(int(f).to_bytes(8, "big")), i) for i, f in enumerate(fps.tolist())], "node binary, least long")
    groups = [rows(simhash.components(nodes, links)) for links in (*whole.values(), simhash.cell_links(cells, 4, 8), simhash.cell_links(cells, 4, 3, keys))]
    assert len(groups[0]) > 100 and all(g == groups[0] for g in groups)


def test_payments_and_refunds_are_dealt_once_for_customer_and_address(spark, monkeypatch):
    """Customers get their contacts before the lookup; a customer whose id is an address is not taken for it, nor the other way round."""
    body = lambda kind, n, **p: (f"{kind}:{n}", "stripe", kind, json.dumps(p))
    person = lambda n, email: body("contact", n, contact_id=n, email=email, client_type_code="1", lifecycleStage="active", updated_at="2024")
    given = [
        person("C1", "A@x"), person("C2", "u2"), body("customer", 1, customer_id="u1", email="a@X"), body("customer", 2, customer_id="a@x", email="none@x"),
        body("customer", 3, customer_id="u3", email=None), body("customer", 4, customer_id=None, email="a@x"),
        *[body("payment", n, payment_id=f"P{n}", customer_id=c, status="ok", event_time="2024-01-01T00:00:00Z", amount="1", currency="cad") for n, c in enumerate(("u1", "a@x", "u2", "u3", None))],
        body("refund", 1, refund_id="F1", payment_intent_id="P0", status="ok"), body("refund", 2, refund_id="F2", payment_intent_id="P9", status="ok"), body("refund", 3, refund_id="F3", status="ok"),
        body("invoice", 1, invoice_id="I1", customer_email="u1", status="ok"), body("invoice", 2, invoice_id="I2", customer_email="U2", status="ok"),
    ]
    df = spark.createDataFrame(given, "idem_key string, source_system string, kind string, payload string")
    canonical = df.select("*", F.create_map(*[F.lit(x) for k in cv.SCHEMAS for x in (k, cv.SCHEMAS[k])])[F.col("kind")].alias("canonical_schema"), F.lit("2024-01-01").cast("timestamp").alias("created_at"))
    none = spark.createDataFrame([], "measurement_event_id string, subject_id string, event_type string, event_subtype string, binding_id string, binding_version string, form_id string, source_id string, canonical_object_id string, occurred_at timestamp")
    got = {r.source_record_id: (r.contact_id, r.contact_email) for r in cv.proj_contact_events(canonical, none, ["me@own.test"]).collect()}
    assert got == {
        "P0": ("C1", "a@x"), "P1": (None, "none@x"), "P2": (None, None), "P3": (None, None), "P4": (None, None),
        "F1": ("C1", "a@x"), "F2": (None, None), "F3": (None, None), "I1": (None, "u1"), "I2": ("C2", "u2")}
    monkeypatch.setattr(cv, "billing_customers", lambda _: pytest.fail("looked up before the addresses"))
    assert plan_of(cv.money_events(canonical)).count("Join") == 1  # refunds with their payments
