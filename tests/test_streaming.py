import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventcanon.operators.latest import fold_latest, fold_values
from eventcanon.session import checkpoint_root
from eventcanon.sources.catalog import Catalog
from eventcanon.streaming.fold import fold_batch, start_fold
from eventcanon.streaming.ingest import start_ingest


def land(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((i if isinstance(i, str) else json.dumps(i)) + "\n" for i in items))


def test_ingest_lands_each_file_once_and_merges(spark, tmp_path):
    table = Catalog(spark, str(tmp_path / "wh")).table("raw", "objects", partition_by=["source_system", "object_type"])
    inbox = tmp_path / "in"

    def run(as_of):
        start_ingest(spark, str(inbox), table, "crm", "main", "thing", "$.id", rejects=str(tmp_path / "rejects"), checkpoint=str(tmp_path / "cp"), as_of=as_of).awaitTermination()

    land(inbox, "1.jsonl", {"id": "a", "v": 1}, {"id": "b", "v": 1}, {"no": "id"}, "")
    run("2024-01-01 00:00:00")
    land(inbox, "2.jsonl", {"id": "b", "v": 2}, {"id": "c", "v": 2})
    run("2024-01-02 00:00:00")
    run("2024-01-03 00:00:00")
    got = rows(table.read().select("idem_key", "payload", F.date_format("first_seen", "dd").alias("f"), F.date_format("last_seen", "dd").alias("l")))
    assert got == [
        ("crm:main:thing:a", '{"id": "a", "v": 1}', "01", "01"), ("crm:main:thing:b", '{"id": "b", "v": 2}', "01", "02"),
        ("crm:main:thing:c", '{"id": "c", "v": 2}', "02", "02"),
    ]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1


FIELDS = ["a", "b"]
SCHEMA = "k string, occurred_at int, event_id string, a string, b string"
EVENTS = [(f"k{i % 7}", i // 3, f"e{i:03d}", f"a{i}" if i % 2 else None, f"b{i}" if i % 5 == 0 else None) for i in range(60)]


def test_fold_of_batches_in_any_order(spark, tmp_path):
    want = rows(fold_latest(spark.createDataFrame(EVENTS, SCHEMA), "k", FIELDS))
    for name, order in {"forward": [0, 1, 2], "late": [2, 0, 1], "repeated": [1, 2, 1, 0, 2]}.items():
        state = Catalog(spark, str(tmp_path / name)).table("derived", "state", partition_by=["key_bucket"])
        for i in order:
            fold_batch(state, spark.createDataFrame(EVENTS[i * 20:(i + 1) * 20], SCHEMA), "k", FIELDS, buckets=4)
        assert rows(fold_values(state.read(), "k", FIELDS)) == want, name


def test_fold_stream(spark, tmp_path):
    source, state = str(tmp_path / "log"), Catalog(spark, str(tmp_path / "wh")).table("derived", "state", partition_by=["key_bucket"])

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        start_fold(stream, state, "k", FIELDS, buckets=4, checkpoint=str(tmp_path / "cp")).awaitTermination()

    for i in (2, 0, 1):
        spark.createDataFrame(EVENTS[i * 20:(i + 1) * 20], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run()
    assert rows(fold_values(state.read(), "k", FIELDS)) == rows(fold_latest(spark.createDataFrame(EVENTS, SCHEMA), "k", FIELDS))


class Session:
    """A session that only has settings; spark.checkpoint.dir cannot be changed in a running one."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_checkpoint_folder_comes_from_the_session():
    with pytest.raises(ValueError):
        checkpoint_root(Session())
    assert checkpoint_root(Session(), "/shared") == "/shared"
    assert checkpoint_root(Session(**{"spark.checkpoint.dir": "/cluster"}), "/shared") == "/cluster"


def test_batches_do_not_change_the_result(spark, tmp_path):
    inbox, out = tmp_path / "in", {}
    land(inbox, "1.jsonl", {"id": "a", "at": "2024-02-01"}, {"id": "b", "at": "2024-01-01"})
    land(inbox, "2.jsonl", {"id": "a", "at": "2024-01-01"}, {"id": "b", "at": "2024-03-01"})
    for max_files in (None, 1):
        table = Catalog(spark, str(tmp_path / f"wh{max_files}")).table("raw", "objects", partition_by=["source_system"])
        start_ingest(spark, str(inbox), table, "crm", "main", "thing", "$.id", checkpoint=str(tmp_path / f"cp{max_files}"), as_of="2024-01-01 00:00:00", order_path="$.at", max_files=max_files).awaitTermination()
        out[max_files] = sorted(json.loads(r.payload)["at"] for r in table.read().select(F.col("payload").cast("string").alias("payload")).collect())
    assert out[None] == out[1] == ["2024-02-01", "2024-03-01"]


def test_bucket_count_stays_with_the_state(spark, tmp_path):
    events = spark.createDataFrame([(f"k{i % 20}", f"e{i:03d}", i, f"v{i}") for i in range(80)], "key string, event_id string, occurred_at int, f string")
    state = Catalog(spark, str(tmp_path / "wh")).table("state", "keys", partition_by=["key_bucket"])
    fold_batch(state, events.where("occurred_at < 40"), "key", ["f"], buckets=8)
    fold_batch(state, events.where("occurred_at >= 40"), "key", ["f"])
    assert state.read().count() == 20 and state.properties() == {"buckets": 8}
