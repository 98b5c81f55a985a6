import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from eventcanon.operators import merge
from eventcanon.operators.joins import hot_keys, left_lookup
from eventcanon.operators.latest import combine_folds, fold_latest, fold_values, fold_with_order, latest_per_key
from eventcanon.operators.shape import bad_rows, good_rows, raw_rows, shape_rows, with_external_id, with_field_params
from eventcanon.sources import incremental, reads

LOG = "k string, t int, id string, a string, b string"
EVENTS = [
    ("x", 1, "e1", "a1", "b1"),
    ("x", 2, "e2", None, "b2"),
    ("x", 3, "e3", None, None),
    ("x", 3, "e4", None, "b4"),
    ("y", 1, "e5", None, None),
]
FOLDED = [("x", "a1", "b4", "x", "e4", "synced"), ("y", None, None, "y", "e5", "synced")]


def test_fold_takes_newest_known_value(spark):
    df = spark.createDataFrame(EVENTS, LOG)
    assert rows(fold_latest(df, "k", ["a", "b"], ["t", "id"], "id")) == FOLDED


def test_fold_does_not_depend_on_batches_or_order(spark):
    fields = ["a", "b"]
    for seed in range(3):
        events = EVENTS * 2
        random.Random(seed).shuffle(events)
        cut = 3 + seed
        states = [fold_with_order(spark.createDataFrame(part, LOG), "k", fields, ["t", "id"], "id") for part in (events[:cut], events[cut:])]
        both = combine_folds(states[0].unionByName(states[1]), "k", fields)
        assert rows(fold_values(both, "k", fields)) == FOLDED


def test_latest_row_is_chosen_before_the_shuffle(spark):
    df = spark.createDataFrame(EVENTS, LOG)
    out = latest_per_key(df, ["k"], ["t", "id"])
    assert rows(out.select("k", "id")) == [("x", "e4"), ("y", "e5")]
    assert "WindowGroupLimit" in plan_of(out)


# --- merge ----------------------------------------------------------------------------------

TARGET = [(1, "old", 10, 10), (2, "old", 10, 10), (3, "old", 10, 10)]
SOURCE = [(2, "new", 20, 20), (4, "new", 20, 20)]
COLUMNS = "k int, v string, first_seen int, last_seen int"
MERGED = [(1, "old", 10, 10, "keep"), (2, "new", 10, 20, "update"), (3, "old", 10, 10, "keep"), (4, "new", 20, 20, "insert")]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_merge_both_ways(spark, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        target = spark.createDataFrame(TARGET, COLUMNS)
        source = spark.sql(f"SELECT * FROM VALUES {SOURCE[0]}, {SOURCE[1]} AS t(k, v, first_seen, last_seen)")
        out = merge.merge_into(target, source, ["k"], with_action=True)
        assert rows(out) == MERGED
        # one plan: whether the batch is broadcast is Spark's choice, and then the target is not shuffled
        assert "FullOuter" not in plan_of(out) and ("BroadcastHashJoin" in plan_of(out) or threshold == "-1")
        assert tuple(merge.merge_counts(out).collect()[0]) == (1, 1, 0, 2)
        once = out.drop(merge.ACTION)
        assert rows(merge.merge_into(once, source, ["k"])) == rows(once)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_merge_of_repeated_keys(spark):
    target = spark.createDataFrame(TARGET, COLUMNS)
    source = spark.createDataFrame([(2, "a", 1, 1), (2, "b", 2, 2)], COLUMNS)
    out = merge.merge_into(target, source, ["k"], order=["last_seen"])
    assert (2, "b", 10, 2) in rows(out)
    with pytest.raises(Exception, match="same k"):
        merge.merge_into(target, source, ["k"]).collect()


def test_merge_partial_source_columns(spark):
    target = spark.createDataFrame(TARGET, COLUMNS)
    out = merge.merge_into(target, spark.createDataFrame([(1, "n"), (9, "n")], "k int, v string"), ["k"])
    assert rows(out) == [(1, "n", 10, 10), (2, "old", 10, 10), (3, "old", 10, 10), (9, "n", None, None)]
    with pytest.raises(ValueError):
        merge.merge_into(target, spark.createDataFrame([(1, 2)], "k int, nope int"), ["k"])


def test_delete_keeps_rows_the_filter_is_null_for(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, s string")
    assert rows(merge.delete_where(df, {"s": "a"})) == [(2, None), (3, "b")]


def test_append_once(spark):
    have = spark.createDataFrame([("a",)], "id string")
    batch = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    new = merge.new_rows_only(have, batch, "id")
    assert rows(new) == [("b",)]
    assert rows(merge.new_rows_only(have.union(new), batch, "id")) == []
    assert "LeftAnti" in plan_of(new)


# --- joins ----------------------------------------------------------------------------------


def skewed(spark, n=3000):
    left = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("lk"))
    right = spark.range(n).where("id % 2 = 0").select(F.col("id").cast("string").alias("rk"), "id").withColumnRenamed("id", "rv")
    return left, right.union(spark.createDataFrame([("hot", -1), ("hot", -2)], "rk string, rv long"))


@pytest.mark.parametrize("share", [None, 0.1])
def test_lookup_gives_the_plain_left_join(spark, share):
    left, right = skewed(spark)
    plain = left.join(right, F.col("lk") == F.col("rk"), "left")
    for threshold in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert rows(left_lookup(left, right, "lk", "rk", spread=8, hot_share=share)) == rows(plain)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_hot_keys_are_bounded_by_the_share(spark):
    left, _ = skewed(spark)
    assert rows(hot_keys(left, "lk", 0.1)) == [("hot",)]


def test_null_and_hot_keys_spread_over_tasks(spark):
    """No task of the salted join holds more than a small part of the rows."""
    left, right = skewed(spark, 30000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        out = left_lookup(left, right, "lk", "rk", spread=64, hot_share=0.1)
        sizes = [r["count"] for r in out.select("id").distinct().withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
        joined = out.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count_distinct("id").alias("n")).collect()
        assert sum(sizes) == 30000
        assert max(r.n for r in joined) < 30000 / 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_aqe_splits_a_hot_key_of_a_lookup(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        pad = F.sha2(F.col("id").cast("string"), 512)
        left = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("lk"), pad.alias("pad"))
        right = spark.range(-1, 60000, 1, 4).select(F.col("id").alias("rk"))
        out = left_lookup(left, right, "lk", "rk")
        assert len(out.collect()) == 60000
        assert "skew=true" in plan_of(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- reads ----------------------------------------------------------------------------------


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, idem_key string")
    assert rows(reads.read_table(df, filters={"n": "2"})) == [(2, "b")]
    assert rows(reads.read_table(df, ["n"], [{"column": "n", "op": ">=", "value": 2}])) == [(2,), (3,)]
    with pytest.raises(ValueError):
        reads.read_table(df, filters=[{"column": "n", "op": "LIKE", "value": "x"}])


def test_limit_without_order_pages_by_key(spark):
    df = spark.createDataFrame([(1, "c"), (2, "a"), (3, "b")], "n int, idem_key string")
    assert [r.n for r in reads.read_table(df, ["n"], limit=2).collect()] == [2, 3]
    assert [r.n for r in reads.read_table(df, ["n"], order_by="n DESC", limit=1).collect()] == [3]
    assert "TakeOrderedAndProject" in plan_of(reads.read_table(df, ["n"], limit=2))
    assert reads.read_table(df, ["MAX(n) as since"]).collect()[0].since == 3


def test_cursor_of_unknown_stream_is_null(spark):
    df = spark.createDataFrame([("s", "c", "o", 5)], "source_system string, connection_name string, object_type string, last_seen int")
    assert reads.cursor(df, "s", "c", "o").collect()[0].since == 5
    assert reads.cursor(df, "s", "c", "other").collect()[0].since is None


SOURCE_ROWS = [("new", 5), ("same", 5), ("changed", 9), ("nulltime", None), ("between", 6)]
TARGET_ROWS = [("same", 5), ("same", 6), ("same", 7), ("changed", 5), ("nulltime", 1), ("between", 5), ("between", 7), (None, 1)]


def test_incremental_modes(spark):
    s = spark.createDataFrame(SOURCE_ROWS, "k string, ts int")
    t = spark.createDataFrame(TARGET_ROWS, "k string, seen int")
    run = lambda **kw: [r[0] for r in rows(incremental.changed_rows(s, t, "k", "k", "ts", "seen", columns=["k"], **kw))]
    assert run() == ["between", "changed", "new"]
    assert run(newer_than="all") == ["changed", "new"]
    assert run(limit=2) == ["between", "changed"]
    with pytest.raises(ValueError):
        run(newer_than="some")
    missing = incremental.missing_rows(s, t, "k", "k", columns=["k"])
    assert rows(missing) == [("new",)] and "LeftAnti" in plan_of(missing)
    suffixed = t.select(F.concat("k", F.lit("#x")).alias("k"))
    assert rows(incremental.missing_rows(s, suffixed, "k", "k", suffix="x", columns=["k"])) == [("new",)]
    assert [r[0] for r in rows(incremental.missing_rows(s, t, "k", "k", columns=["k"], filters={"k": "same"}))] == []


# --- shaping --------------------------------------------------------------------------------


def test_external_id_probe(spark):
    df = spark.createDataFrame(
        [('{"id":"a","uuid":"b"}',), ('{"uuid":"b"}',), ('{"id":"","responseId":"r"}',), ('{"id":0,"contactid":"c"}',), ("{}",)], "payload string"
    )
    assert [r[0] for r in with_external_id(df, "payload").select("external_id").collect()] == ["a", "b", "r", "c", None]


@pytest.mark.parametrize("value, usable", [
    ("0", None), ("0.0", None), ("-0", None), ("0e5", None), ("false", None), ("null", None), ('""', None),
    ('"0"', "0"), ('"0.0"', "0.0"), ('"false"', "false"), ("true", "true"), ("7", "7"), ('"00"', "00"), ("0.5", "0.5"),
])
def test_ids_that_look_like_nothing(spark, value, usable):
    """The number zero, false and empty text are no ids, whatever texts look like."""
    df = spark.createDataFrame([(f'{{"id":{value}}}',)], "payload string")
    assert with_external_id(df, "payload").first().external_id == usable
    raw = raw_rows(df, "gmail", "main", "email").first()
    assert raw.external_id == usable and raw.idem_key == (usable and f"gmail:main:email:{usable}")


def test_ids_of_typed_columns(spark):
    df = spark.createDataFrame([(0, "0", 1), (5, "false", 2), (None, "", 3), (0, None, 4)], "id int, uuid string, n int")
    assert [r[0] for r in with_external_id(df).orderBy("n").select("external_id").collect()] == ["0", "5", None, None]


def test_shape_order_of_steps(spark):
    items = spark.createDataFrame([("7", "x")], "id string, source_system string")
    out = shape_rows(
        items, correlation_id="run", field_defaults={"source_system": "ignored", "connection_name": "c", "object_type": "o"}, id_field="id",
        suffix="s", field_map={"key": "idem_key"}, timestamp_columns=["first_seen", "last_seen"], as_of="2024-01-01 00:00:00",
    ).collect()[0].asDict()
    # The key uses the defaults given, the row keeps its own value.
    assert out["key"] == "ignored:c:o:7#s" and out["source_system"] == "x" and out["correlation_id"] == "run"
    assert out["first_seen"] == out["last_seen"] and "idem_key" not in out


def test_shape_keeps_correlation_id_and_checks_fields(spark):
    items = spark.createDataFrame([("7", "mine")], "id string, correlation_id string")
    assert shape_rows(items, correlation_id="run").collect()[0].correlation_id == "mine"
    with pytest.raises(ValueError):
        shape_rows(items, fields=["nope"])
    with pytest.raises(ValueError):
        shape_rows(items, id_field="nope")
    gone = spark.createDataFrame([(None,)], "id string")
    with pytest.raises(Exception, match="item without id"):
        shape_rows(gone, id_field="id").collect()
    assert shape_rows(gone, id_field="id", strict=False).collect()[0].idem_key is None


def test_field_params(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert with_field_params(df, ["x", "c"], {"x": "a"}, {"c": 3, "b": 9}).collect()[0].asDict() == {"x": 1, "c": 3}


def test_four_sources_and_bad_rows(spark):
    cases = [
        ("stripe", "customer", '{"id":"cus_1","email":"e","name":"n"}', "$.id", "stripe:main:customer:cus_1"),
        ("gmail", "email", '{"id":"18c","subject":"s"}', None, "gmail:main:email:18c"),
        ("google_forms", "form_response", '{"responseId":"ACY"}', None, "google_forms:main:form_response:ACY"),
        ("dataverse", "contact", '{"contactid":"739"}', "$.contactid", "dataverse:main:contact:739"),
    ]
    for source, kind, payload, path, key in cases:
        landed = spark.createDataFrame([(payload,), ('{"x":1}',)], "payload string")
        out = raw_rows(landed, source, "main", kind, path, as_of="2024-01-01")
        assert [r.idem_key for r in good_rows(out).collect()] == [key]
        assert bad_rows(out).count() == 1
