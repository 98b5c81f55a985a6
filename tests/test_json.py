import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventcanon.functions import json as j
from eventcanon.functions.text import regex_group, stringify, template
from eventcanon.functions.time import parse_rfc2822, text_to_long

CASES = [
    ('{"a":{"b":1}}', None, '{"b":1}'),
    ('{"a":[1]}', None, "[1]"),
    ('{"a":"{x}"}', "{x}", '"{x}"'),
    ('{"a":"[music]"}', "[music]", '"[music]"'),
    ('{"a":null}', None, None),
    ("{}", None, None),
    ("nope", None, None),
    ('{"a":true}', "true", "true"),
    ('{"a":250.0}', "250.0", "250"),
    ('{"a":12345678901234567890123}', "12345678901234567890123", "12345678901234567890123"),
    ('{"a":""}', "", '""'),
]


def test_value_and_query_of_every_json_kind(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, payload string")
    got = {r.i: (r.v, r.q) for r in j.with_json(df, values={"v": "$.a"}, queries={"q": "$.a"}).collect()}
    for i, (_, value, text) in enumerate(CASES):
        assert got[i] == (value, text), CASES[i]
    single = {r.i: (r.v, r.q) for r in df.select("i", j.json_value("payload", "$.a").alias("v"), j.json_query("payload", "$.a").alias("q")).collect()}
    for i, (_, value, text) in enumerate(CASES):
        assert single[i] == (value, text), CASES[i]


def test_nested_indexed_and_odd_paths(spark):
    text = '{"from":[{"email":"a@x"},{"email":"b@x"}],"to":"c@x","keywords":{"$seen":true},"odd.key@V1":5,"tags":["p","q"]}'
    df = spark.createDataFrame([(text,), ('{"from":{"email":"z"},"tags":"p"}',), ('{"from":[]}',)], "payload string")
    out = j.with_json(
        df, values={"f0": "$.from[0].email", "seen": "$.keywords.$seen", "odd": "$['odd.key@V1']", "whole": "$.from", "to": "$.to"},
        queries={"raw": "$.from"}, arrays={"all": "$.from[*].email", "tags": "$.tags"},
    ).drop("payload").collect()
    assert out[0].asDict() == {
        "f0": "a@x", "seen": "true", "odd": "5", "whole": None, "to": "c@x", "raw": '[{"email":"a@x"},{"email":"b@x"}]',
        "all": ["a@x", "b@x"], "tags": ["p", "q"],
    }
    assert out[1].f0 is None and out[1].tags is None and out[1].raw == '{"email":"z"}'
    assert out[2].f0 is None and out[2].all == []


def test_bad_paths_fail_at_once():
    with pytest.raises(ValueError):
        j.parse_path("a.b")
    with pytest.raises(ValueError):
        j.parse_path("$.a[x]")


def test_replaces_a_column_of_the_same_name(spark):
    df = spark.createDataFrame([("old", '{"a":1}')], "a string, payload string")
    assert j.with_json(df, values={"a": "$.a"}).select("a").collect()[0].a == "1"


def test_parse_json_columns_keeps_bad_text(spark):
    df = spark.createDataFrame([('{"a":1}',), ("bad",)], "p string")
    got = [(r.t, r.p_raw) for r in j.parse_json_columns(df, ["p"]).select(F.to_json("p").alias("t"), "p_raw").collect()]
    assert got == [('{"a":1}', None), (None, "bad")]


def test_regex_group_is_null_without_match(spark):
    df = spark.createDataFrame([("Contact/5",), ("none",), (None,), ("x/",)], "r string")
    assert [r[0] for r in df.select(regex_group("r", r"/(.+)$")).collect()] == ["5", None, None, None]


def test_template_and_stringify(spark):
    df = spark.createDataFrame([("a", None, True)], "x string, y int, z boolean")
    got = df.select(template("{{{x}}} {y}"), stringify("z", "boolean"), stringify("y", "int")).collect()[0]
    assert tuple(got) == ("{a} None", "True", None)
    with pytest.raises(ValueError):
        template("{x:>5}")


def test_times(spark):
    df = spark.createDataFrame([("Tue, 02 Jan 2024 03:04:05 +0100", "7"), ("2 Jan 2024 03:04:05 +0000", "x"), ("bad", None)], "d string, n string")
    got = df.select(parse_rfc2822("d").cast("string").alias("d"), text_to_long("n").alias("n")).collect()
    assert [tuple(r) for r in got] == [("2024-01-02 02:04:05", 7), ("2024-01-02 03:04:05", None), (None, None)]
    with pytest.raises(Exception):
        df.select(text_to_long("n", strict=True)).collect()
