"""Validation and drift, against a plain Python reading of the same rules."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventcanon.operators import checks, validate

SCHEMA = {
    "type": "object",
    "required": ["id", "name", "when"],
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "name": {"type": "string", "minLength": 2, "pattern": "^[a-z]+$"},
        "when": {"type": ["string", "null"]},
        "kind": {"enum": ["a", "b"]},
        "size": {"type": "number", "maximum": 9.5},
        "ok": {"type": "boolean"},
        "who": {"oneOf": [{"$ref": "#/definitions/person"}, {"type": "null"}]},
        "items": {"type": "array", "items": {"$ref": "#/definitions/item"}},
        "free": {"type": "object"},
        "o'dd": {"type": "string"},
    },
    "definitions": {
        "person": {"type": "object", "properties": {"first": {"type": "string"}, "boss": {"$ref": "#/definitions/person"}}},
        "item": {"type": "object", "required": ["sku"], "properties": {"sku": {"type": "string"}, "n": {"type": "integer"}}},
    },
}
GOOD = {"id": 1, "name": "ab", "when": None}


def paths(value, prefix=""):
    out = []
    if isinstance(value, dict):
        for k, v in value.items():
            out.append(prefix + k)
            out += paths(v, prefix + k + ".")
    return out


def check(spark, *payloads):
    text = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = validate.validate(spark.createDataFrame(text, "i int, payload string"), SCHEMA)
    return [(r.validation_status, r.validation_error, r.unknown_fields) for r in df.orderBy("i").collect()]


def test_known_paths_follow_references_alternatives_and_items():
    known = validate.known_paths(SCHEMA)
    assert {"who", "who.first", "who.boss", "who.boss.first", "items", "items.sku", "items.n", "free"} <= set(known)
    assert max(p.count(".") for p in known) == validate.KNOWN_PATH_DEPTH


def test_good_payloads_pass(spark):
    more = {**GOOD, "kind": "a", "size": 9.5, "ok": True, "who": {"first": "x"}, "items": [{"sku": "s", "n": 2}], "id": 2.0, "when": "t", "o'dd": "x"}
    assert check(spark, GOOD, more, {**GOOD, "items": []}) == [("pass", None, None)] * 3


@pytest.mark.parametrize(
    "change, error",
    [
        ({"id": "1"}, "Type mismatch: '1' is not of type 'integer'"),
        ({"id": 1.5}, "Type mismatch: 1.5 is not of type 'integer'"),
        ({"id": 0}, "Other: 0 is less than the minimum of 1"),
        ({"name": "A"}, "Other: 'A' is shorter than 2; 'A' does not match '^[a-z]+$'"),
        ({"name": {"x": 1}}, "Type mismatch: {\"x\":1} is not of type 'string'"),
        ({"when": 5}, "Type mismatch: 5 is not of type 'string', 'null'"),
        ({"kind": "c"}, "Other: 'c' is not one of ['a', 'b']"),
        ({"size": 10}, "Other: 10 is greater than the maximum of 9.5"),
        ({"ok": None}, "Type mismatch: null is not of type 'boolean'"),
        ({"items": [{"sku": 1}, {"n": 2}]}, "Missing required: 'sku' is a required property | Type mismatch: 1 is not of type 'string'"),
        ({"items": {"sku": "x"}}, "Type mismatch: {\"sku\":\"x\"} is not of type 'array'"),
    ],
)
def test_errors(spark, change, error):
    assert check(spark, {**GOOD, **change})[0][:2] == ("fail", error)


def test_missing_grouped_and_cut(spark):
    got = check(spark, {"items": [{}, {}, {}]}, [1], "not json", {**GOOD, "name": "x" * 3000 + "1"})
    assert got[0][1] == "Missing required: " + "; ".join(f"'{n}' is a required property" for n in ("id", "name", "when"))
    assert got[1][1] == "Type mismatch: [1] is not of type 'object'"
    assert got[2][1] == "Other: payload is not JSON"
    assert len(got[3][1]) == 1000


def test_drift_matches_python(spark):
    payloads = [
        {**GOOD, "new": {"deep": {"er": 1}}, "who": {"last": "x", "boss": {"boss": {"nick": 1}}}},
        {**GOOD, "free": {"any": {"thing": 1}}, "name": {"x": {"y": 2}}},
        {**GOOD, "items": [{"zzz": 1}], "list": [{"q": 1}]},
        {**GOOD, "who": None, "free": []},
        {"b.c": 1, "a": {"": 1}},
    ]
    known = set(validate.known_paths(SCHEMA))
    for payload, (_, _, unknown) in zip(payloads, check(spark, *payloads)):
        assert (unknown or []) == sorted(set(paths(payload)) - known)


@pytest.mark.parametrize("levels", [1, 15, 16, 17, 18, 40])
def test_unknown_fields_at_any_depth(spark, levels):
    deep: dict = {"end": 1, "empty": {}, "list": [{"q": 1}]}
    for i in range(levels):
        deep = {"x": deep, f"y{i}": i}
    known = set(validate.known_paths(SCHEMA))
    [(_, _, unknown)] = check(spark, {**GOOD, "new": deep})
    assert unknown == sorted(set(paths({**GOOD, "new": deep})) - known)


def test_documents_of_any_depth_are_compared(spark):
    def nested(end):
        for _ in range(30):
            end = {"x": end, "list": [1]}
        return json.dumps(end)

    table = lambda *ends: spark.createDataFrame([(i, nested(e)) for i, e in enumerate(ends)], "k int, payload string")
    diff = checks.table_diff(table({"a": 1, "b": 2}, {"a": 1}), table({"b": 2.0, "a": 1}, {"a": 2}), ["k"], normalize=True)
    assert [(r.k, r.kind) for r in diff.collect()] == [(1, "changed")]


def test_summary(spark):
    text = [("s", json.dumps(GOOD)), ("s", json.dumps({**GOOD, "x": 1, "y": 2})), ("s", json.dumps({"x": 1})), ("t", json.dumps(GOOD))]
    df = validate.validate(spark.createDataFrame(text, "src string, payload string"), SCHEMA)
    assert rows(validate.validation_summary(df, ["src"])) == [("s", 3, 2, 1, 2), ("t", 1, 1, 0, 0)]
    assert rows(validate.validation_summary(df)) == [(4, 3, 1, 2)]


def test_stamp_columns(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),)], "payload string")
    row = validate.validate(df, SCHEMA, schema_iglu="iglu:x", stamp="2024").collect()[0]
    assert (row.schema_iglu, row.validation_stamp, row.validation_status) == ("iglu:x", "2024", "pass")


# --- checks ---------------------------------------------------------------------------------


def test_assertions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert tuple(checks.assert_rows(df, exact=3).collect()[0]) == (3, True)
    assert checks.assert_rows(df, minimum=4).collect()[0].ok is False
    assert checks.assert_rows(df, maximum=2).collect()[0].ok is False
    assert tuple(checks.assert_unique(df, ["k"]).collect()[0]) == (1, 1, False)
    assert tuple(checks.assert_unique(df, ["k", "v"]).collect()[0]) == (0, 0, True)
    found = checks.assert_schema(df, {"k": "string", "z": "int"})
    assert found == {"ok": False, "missing": ["z"], "extra": ["v"], "mismatched": {"k": ("string", "int")}}


def test_diff_of_equal_but_differently_written_rows(spark):
    schema = "idem_key string, created_at string, payload string, correlation_id string"
    left = [
        ("same", "t1", '{"a":250.0,"b":{"hosted_invoice_url":"u1","c":[1,{"attachmentId":"x"}]}}', "r1"),
        ("nested", "t1", '{"invoice_pdf":{"big":1},"a":1}', "r1"),
        ("text", "t1", '{"a":"say \\"invoice_pdf\\":1, ok"}', "r1"),
        ("left", "t1", "{}", "r1"),
        ("type", "t1", '{"a":"1"}', "r1"),
        ("empty", "t1", '{"a":{"invoice_pdf":"x"}}', "r1"),
    ]
    right = [
        ("same", "t2", '{"b":{"c":[1,{"attachmentId":"y"}],"hosted_invoice_url":"u2"},"a":250}', "r2"),
        ("nested", "t2", '{"a":1}', "r2"),
        ("text", "t2", '{"a":"say \\"invoice_pdf\\":2, ok"}', "r2"),
        ("right", "t2", "{}", "r2"),
        ("type", "t2", '{"a":1}', "r2"),
        ("empty", "t2", '{"a":{"invoice_pdf":{"y":1}}}', "r2"),
    ]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = {(r.idem_key, r.kind, r.column) for r in checks.table_diff(a, b, ["idem_key"], normalize=True).collect()}
    assert got == {("left", "left_only", None), ("right", "right_only", None), ("text", "changed", "payload"), ("type", "changed", "payload")}
    plain = checks.table_diff(a, b, ["idem_key"]).where("kind = 'changed'").groupBy("idem_key").count()
    assert {r["idem_key"] for r in plain.collect()} == {"same", "nested", "text", "type", "empty"}


KEYWORDS = [
    ({"properties": {"a": {"const": 3}}}, '{"a": 3}', '{"a": 4}'),
    ({"properties": {"a": {"exclusiveMaximum": 3}}}, '{"a": 2}', '{"a": 3}'),
    ({"properties": {"a": {"exclusiveMinimum": 3}}}, '{"a": 4}', '{"a": 3}'),
    ({"properties": {"a": {"multipleOf": 0.5}}}, '{"a": 1.5}', '{"a": 1.2}'),
    ({"properties": {"a": {"minItems": 2, "maxItems": 3}}}, '{"a": [1, 2]}', '{"a": [1]}'),
    ({"properties": {"a": {"uniqueItems": True}}}, '{"a": [1, 2]}', '{"a": [1, 2, 1]}'),
    ({"minProperties": 1, "maxProperties": 1}, '{"a": 1}', '{"a": 1, "b": 2}'),
    ({"properties": {"a": {}}, "additionalProperties": False}, '{"a": 1}', '{"a": 1, "b": 2}'),
    ({"additionalProperties": {"type": "integer"}}, '{"a": 1}', '{"a": "x"}'),
    ({"properties": {"a": {"anyOf": [{"type": "integer"}, {"minLength": 3, "type": "string"}]}}}, '{"a": "abc"}', '{"a": "ab"}'),
    ({"properties": {"a": {"oneOf": [{"type": "integer"}, {"minimum": 3}]}}}, '{"a": 1}', '{"a": 5}'),
    ({"properties": {"a": {"allOf": [{"minimum": 1}, {"maximum": 3}]}}}, '{"a": 2}', '{"a": 4}'),
    ({"properties": {"a": {"not": {"type": "string"}}}}, '{"a": 2}', '{"a": "s"}'),
    ({"properties": {"a": {"$ref": "#/properties/b"}, "b": {"type": "string"}}}, '{"a": "s"}', '{"a": 1}'),
    ({"properties": {"a": False}}, "{}", '{"a": 1}'),
]
DEEP = {"type": "integer"}
for _ in range(9):
    DEEP = {"properties": {"a": DEEP}, "required": ["a"]}
KEYWORDS.append((DEEP, '{"a": ' * 9 + "1" + "}" * 9, '{"a": ' * 9 + '"x"' + "}" * 9))


@pytest.mark.parametrize("schema,good,bad", KEYWORDS)
def test_each_keyword(spark, schema, good, bad):
    df = spark.createDataFrame([(1, good), (2, bad)], "id int, p string").selectExpr("id", "try_parse_json(p) AS v")
    out = {r.id: r.n for r in df.select("id", F.size(validate.validation_errors("v", schema)).alias("n")).collect()}
    assert out[1] == 0 and out[2] >= 1


@pytest.mark.parametrize("schema", [{"patternProperties": {"a": {}}}, {"$ref": "#/nowhere"}, {"$ref": "#"}, {"if": {}}])
def test_what_is_not_checked_raises(schema):
    with pytest.raises(ValueError):
        validate.validation_errors("v", schema)


@pytest.mark.parametrize("depth", [0, 4, 8, 50])
def test_recursive_schemas_at_any_depth(spark, depth):
    schema = {"type": "object", "properties": {"v": {"type": "integer"}, "next": {"$ref": "#"}}}
    nested = lambda n, v: '{"v": 1, "next": ' * n + f'{{"v": {v}}}' + "}" * n
    df = spark.createDataFrame([(v, nested(depth, v)) for v in ("1", '"x"')], "v string, payload string")
    out = {r.v: r for r in validate.validate(df, schema, all_errors="errors").collect()}
    assert out["1"].validation_status == "pass" and out["1"].errors == []
    assert out['"x"'].validation_error == "Type mismatch: 'x' is not of type 'integer'"
    assert [tuple(e) for e in out['"x"'].errors] == [("type", "'x' is not of type 'integer'")]


TREE = {
    "$ref": "#/definitions/node",
    "definitions": {
        "node": {
            "type": "object", "required": ["k"],
            "properties": {
                "k": {"enum": ["leaf", "pair", "list", "map", "odd"]}, "n": {"type": "integer", "minimum": 0},
                "left": {"$ref": "#/definitions/maybe"}, "right": {"$ref": "#/definitions/maybe"},
                "all": {"type": "array", "items": {"$ref": "#/definitions/node"}},
                "by": {"type": "object", "additionalProperties": {"$ref": "#/definitions/node"}},
                "two": {"items": [{"type": "integer"}, {"$ref": "#/definitions/node"}], "additionalItems": False},
                "no": {"not": {"$ref": "#/definitions/node"}},
            },
        },
        "maybe": {"oneOf": [{"type": "null"}, {"$ref": "#/definitions/node"}]},
    },
}


def valid(value, node):
    """A plain reading of the keywords that TREE uses."""
    if "$ref" in node:
        return valid(value, TREE["definitions"][node["$ref"].split("/")[-1]])
    kinds = {"object": dict, "array": list, "integer": int, "null": type(None)}
    ok = "type" not in node or isinstance(value, kinds[node["type"]])
    ok &= "enum" not in node or value in node["enum"]
    ok &= "minimum" not in node or not isinstance(value, int) or value >= node["minimum"]
    ok &= "not" not in node or not valid(value, node["not"])
    ok &= "oneOf" not in node or sum(valid(value, o) for o in node["oneOf"]) == 1
    if isinstance(value, dict):
        own = node.get("properties", {})
        ok &= all(r in value for r in node.get("required", [])) and all(valid(v, own[k]) for k, v in value.items() if k in own)
        ok &= all(valid(v, node["additionalProperties"]) for k, v in value.items() if k not in own and "additionalProperties" in node)
    if isinstance(value, list) and "items" in node:
        each = node["items"]
        ok &= all(valid(v, each) for v in value) if isinstance(each, dict) else len(value) <= len(each) and all(map(valid, value, each))
    return bool(ok)


def grown(rng, depth):
    """A node of the tree, now and then a wrong one."""
    out = {"k": rng.choice(["leaf", "pair", "list", "map"])} if rng.random() < 0.97 else {"x": 1}
    if depth:
        kind = rng.choice(["left", "both", "all", "by", "two", "no"])
        sub = lambda: grown(rng, depth - 1 - rng.randrange(min(depth, 3)))
        if kind in ("left", "both"):
            out["left"] = grown(rng, depth - 1)
        if kind == "both":
            out["right"] = rng.choice([None, sub()])
        if kind == "all":
            out["all"] = [sub() for _ in range(rng.randrange(3))]
        if kind == "by":
            out["by"] = {c: sub() for c in "pq"[: rng.randrange(3)]}
        if kind == "two":
            out["two"] = [rng.choice([1, 1, 1, "x"]), sub(), 3][: rng.choice([1, 2, 2, 2, 3])]
        if kind == "no":
            out["no"] = rng.choice([sub(), {}, 5, {}])
    elif rng.random() < 0.3:
        out["n"] = rng.choice([1, 0, -1, "1"])
    return out


def test_random_trees_against_a_plain_reading(spark):
    rng = random.Random(6)
    trees = [grown(rng, rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 12, 20])) for _ in range(300)]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)], "i int, payload string")
    got = {r.i: r.validation_status for r in validate.validate(df, TREE).select("i", "validation_status").collect()}
    want = {i: "pass" if valid(t, TREE) else "fail" for i, t in enumerate(trees)}
    assert got == want and len(set(want.values())) == 2 and sum(v == "pass" for v in want.values()) > 60


def test_references_that_go_nowhere_raise():
    for bad in ({"$ref": "#"}, {"allOf": [{"$ref": "#"}]}, {"properties": {"a": {"anyOf": [{"$ref": "#/properties/a"}]}}}):
        with pytest.raises(ValueError):
            validate.validation_errors("v", bad)


def test_items_by_place(spark):
    for schema in ({"items": [{"type": "integer"}, {"type": "string"}], "additionalItems": {"type": "boolean"}}, {"prefixItems": [{"type": "integer"}, {"type": "string"}], "items": {"type": "boolean"}}):
        texts = ['[1, "a", true, false]', "[1]", "[]", '["a"]', "[1, 2]", '[1, "a", 3]', '"none"']
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string").selectExpr("i", "try_parse_json(p) AS v")
        out = [r[0] for r in df.orderBy("i").select(F.size(validate.validation_errors("v", schema))).collect()]
        assert out == [0, 0, 0, 1, 1, 1, 0]
