import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventcanon.functions import keys
from eventcanon.operators import render
from eventcanon.sources import reads, sinks

AS_OF = "2024-01-31 00:00:00"


def test_sync_text(spark, tmp_path):
    df = spark.createDataFrame([(42, True, None), (1, False, 0.5)], "id int, active boolean, score double")
    assert rows(sinks.sync_rows(df, AS_OF)) == [("1", "False", "0.5", AS_OF), ("42", "True", None, AS_OF)]
    path = str(tmp_path / "t")
    sinks.replace_table(df, path, AS_OF)
    sinks.replace_table(df.limit(1), path, AS_OF)
    assert spark.read.parquet(path).count() == 1


def test_sheet(spark, tmp_path):
    df = spark.createDataFrame([("1", "x,\"y\"", None)], "b string, a string, c string")
    path = str(tmp_path / "sheet")
    assert sinks.write_sheet(df, path, ["c", "a", "b"]) is True
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.columns == ["c", "a", "b"] and back.collect()[0].a == 'x,"y"'
    assert sinks.write_sheet(df.where("false"), path) is False
    assert spark.read.option("header", True).csv(path).count() == 1


def test_render_and_write_files(spark, tmp_path):
    df = spark.createDataFrame([("ann", 5, None), ("bob", 6, "x")], "name string, age int, note string")
    out = render.render_files(df, "{name}/info.md", "# {name}\n{note} {age}", front_matter_spec={"who": "{name}", "n": "{age}", "map": {"a": 1, "b": {"c": "d"}}, "flag": True}, as_of=AS_OF)
    want = "---\nwho: ann\nn: '5'\nmap:\n  a: 1\n  b:\n    c: d\nflag: true\n---\n\n# ann\nNone 5"
    assert rows(out)[0] == ("ann/info.md", want)
    sinks.write_files(out, str(tmp_path))
    assert (tmp_path / "ann" / "info.md").read_text() == want
    assert render.render_files(df.where("false"), "{name}", "x").count() == 0


@pytest.mark.parametrize("text", ["plain text", "5", "2024-01-01", "true", "a: b", "- x", "it's", "", " lead", "tail ", "null", "#x", "line\nbreak", "é ü", "a #b", "1e5", "@x", "0x1F", "12:30"])
def test_yaml_scalars_read_back_as_text(spark, text):
    yaml = pytest.importorskip("yaml")
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(render.yaml_scalar(F.col("t"))).collect()[0][0]
    assert yaml.safe_load(f"k: {got}\n") == {"k": text}


def test_messages(spark):
    df = spark.createDataFrame([("a@x", "Ann"), ("b@x", None)], "mail string, name string")
    out = render.render_messages(df, "Subject:  Hi {{ name }} {x}\n\n<BODY>{{name}}</BODY>\n\n", "mail", "prov", "acct")
    got = {r.to: r for r in out.collect()}
    assert (got["a@x"].subject, got["a@x"].body, got["a@x"].is_html) == ("Hi Ann {x}", "<BODY>Ann</BODY>", True)
    assert got["b@x"].body == "<BODY></BODY>"
    plain = render.render_messages(df, "no subject {{name}}", "mail", "p", "a").collect()[0]
    assert (plain.subject, plain.body, plain.is_html) == ("", "no subject Ann", False)
    import hashlib

    sent = {"to": "a@x", "subject": "", "body": "no subject Ann", "is_html": False, "channel": "email", "provider": "p", "account": "a"}
    assert plain.idempotency_key == "email.send:" + hashlib.sha256(json.dumps(sent, sort_keys=True).encode()).hexdigest()[:16]


@pytest.mark.parametrize("text", ["plain", "é\u20ac", "\U0001f600 x", 'q"\\', "tab\t"])
def test_hash_keys_match_python_json(spark, text):
    import hashlib

    df = spark.createDataFrame([("e1", 3, text)], "event_id string, version int, other string")
    want = json.dumps({"event_id": "e1", "method": "m", "version": 3}, sort_keys=True, separators=(",", ":"))
    assert df.select(keys.content_key(df, "m")).collect()[0][0] == "sha256:" + hashlib.sha256(want.encode()).hexdigest()
    whole = df.select("other")
    want = json.dumps({"method": "m", "other": text}, sort_keys=True, separators=(",", ":"))
    assert whole.select(keys.content_key(whole, "m")).collect()[0][0] == "sha256:" + hashlib.sha256(want.encode()).hexdigest()


def test_event_rows(spark, tmp_path):
    df = spark.createDataFrame([("t", "s", "c", ""), ("t", "s", "c", "boom")], "event_type string, source_system string, correlation_id string, error_message string")
    out = sinks.event_rows(df, AS_OF)
    assert {r.error_message for r in out.collect()} == {None, "boom"} and out.select("event_id").distinct().count() == 2
    with pytest.raises(Exception, match="correlation_id must be"):
        sinks.event_rows(df.withColumn("correlation_id", F.lit(""))).collect()
    with pytest.raises(ValueError):
        sinks.event_rows(df.drop("event_type"))
    path = str(tmp_path / "log")
    sinks.append_log(out, path)
    sinks.append_log(out, path)
    back = spark.read.parquet(path)
    assert back.count() == 4 and str(back.select("created_date").first()[0]) == "2024-01-31"


def test_append_once_json_and_dry_run(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 1)], "id string, n int")
    path = str(tmp_path / "x")
    sinks.append_rows(df.limit(0), path)
    for _ in range(2):
        sinks.append_once(spark.read.parquet(path), df, path, "id")
    assert spark.read.parquet(path).count() == 2
    sinks.write_json(df, str(tmp_path / "j"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"id":"a","n":null}', '{"id":"b","n":1}']
    count, sample = sinks.dry_run(df, "id")
    assert count == 2 and len(sample) == 2


def test_landed_files(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"id":1}\n\n{"id":2}\nbad\n')
    assert reads.landed_objects(spark, str(tmp_path)).count() == 3
    got = reads.landed_rows(spark, str(tmp_path), "id int").collect()
    assert sorted((r.id, r._corrupt) for r in got if r.id) == [(1, None), (2, None)] and [r._corrupt for r in got if not r.id] == ["bad"]
