"""What may go through the driver: settings, and what was measured to be small; never what is only guessed to be."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from eventcanon.plans import client_views as cv
from eventcanon.plans import derived as d
from eventcanon.plans import forms as fm
from eventcanon.plans import reports as rp
from eventcanon.session import ADVISED, MEASURED, PLANNED, tune

KEYS = "binding_id string, field_key string, instrument string, item string, reverse_from int"


@pytest.fixture
def fresh(spark):
    """A session as Spark gives it, tuned; the shared one gets its settings back."""
    before = {k: spark.conf.get(k, None) for k in (PLANNED, MEASURED)}
    spark.conf.unset(MEASURED)
    spark.conf.set(PLANNED, "10MB")
    yield tune(spark)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def folder(fresh, tmp_path):
    fresh.range(40).selectExpr("id AS c_custkey", "'n' AS c_name", "cast(id % 9 AS int) AS c_nationkey", "1D AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    fresh.range(90).selectExpr(
        "id AS o_orderkey", "id % 40 AS o_custkey", "'F' AS o_orderstatus", "id * 5000D AS o_totalprice", "timestamp_ntz'2024-01-02 00:00:00' AS o_orderdate",
        "if(id % 2 = 0, '1-URGENT', '5-LOW') AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_the_threshold_holds_for_measured_sizes_and_stays(fresh):
    assert (fresh.conf.get(PLANNED), fresh.conf.get(MEASURED)) == ("-1", "10MB")
    tune(fresh)
    assert (fresh.conf.get(PLANNED), fresh.conf.get(MEASURED)) == ("-1", "10MB")


def test_partitions_are_small_unless_the_session_says_otherwise(fresh):
    before = fresh.conf.get(ADVISED)
    try:
        for own, held in (("64MB", "16MB"), ("8m", "8m")):
            fresh.conf.set(ADVISED, own)
            assert tune(fresh).conf.get(ADVISED) == held
    finally:
        fresh.conf.set(ADVISED, before)


def test_parsed_rows_are_not_broadcast_by_a_guess(fresh, folder):
    canonical = d.canonical_objects(fresh, folder, d.contacts, d.form_responses)
    forms = rp.client_forms(cv.proj_clients(canonical), cv.proj_form_responses(canonical))
    assert "Broadcast" not in plan_of(forms)
    assert forms.count() > 0


def test_items_meet_the_settings_without_being_shuffled_or_broadcast(fresh, folder):
    keys = fresh.createDataFrame([("intake_01", "q.priority", "u", "1", None), ("intake_01", "q.status", "u", "2", 3)], KEYS)
    values = fresh.createDataFrame([("u", "1-urgent", 4), ("u", "f", 1)], "instrument string, answer string, value int")
    events = fm.measurement_events(d.form_responses(fresh, folder), "intake_01", as_of=d.AS_OF)
    scored = fm.scored_items(fm.scoring_items(events), keys, values)
    plan = plan_of(scored)
    assert "BuildLeft" not in plan and "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    assert rows(scored.groupBy("item").agg(F.count("*"), F.sum("value"))) == [("1", 90, 45 * 4.0), ("2", 90, 90 * 2.0)]
