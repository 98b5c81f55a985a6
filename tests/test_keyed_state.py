"""The keyed fold gives what one fold over the whole log gives."""

import datetime as dt
import random

import pytest
from conftest import rows

from eventcanon.operators.latest import fold_latest
from eventcanon.sources.catalog import Catalog
from eventcanon.streaming import keyed

SCHEMA = "user string, at timestamp_ntz, n bigint, name string, score double"
FIELDS = ["name", "score"]


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "tables"))


def log(n, seed=4):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    users = ["hot"] * 5 + [f"u{i}" for i in range(6)] + [None]
    at = lambda: rng.choice([None, start + dt.timedelta(minutes=rng.randrange(50), microseconds=7)])
    return [(rng.choice(users), at(), (1 << 60) + i, rng.choice([None, "a", "b", "é"]), rng.choice([None, 1.5, -2.0])) for i in range(n)]


def run(spark, catalog, tmp_path, parts, name="state"):
    """Each part as files of their own, folded by one query that is stopped and started again in between."""
    table = catalog.table("derived", name)
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / name))
        keyed.start_keyed_fold(events, table, "user", FIELDS, ["at", "n"], "n", checkpoint=str(tmp_path / f"{name}-checkpoint")).awaitTermination()
    return table


def state(df):
    return rows(df.select("user", *FIELDS, "row_version", "row_id", "row_state"))


def test_shuffled_late_and_repeated_events(spark, catalog, tmp_path):
    events = log(400)
    rng = random.Random(1)
    shuffled = rng.sample(events, len(events))
    parts = [shuffled[:150], shuffled[150:300], shuffled[100:200] + shuffled[300:], shuffled[:50]]  # some come twice
    table = run(spark, catalog, tmp_path, parts)
    want = state(fold_latest(spark.createDataFrame(events, SCHEMA), "user", FIELDS, ["at", "n"], "n"))
    assert state(keyed.current_rows(table, "user")) == want
    last = table.read().groupBy(keyed.BATCH).count().orderBy(keyed.BATCH).collect()
    assert len(last) <= 3  # the repeated part changed nothing
    before = table.read().count()
    keyed.settle(table, "user")
    assert table.read().count() == len(want) < before and state(keyed.current_rows(table, "user")) == want


def test_hot_keys_are_thinned_before_the_shuffle(spark):
    df = spark.createDataFrame(log(3000), SCHEMA).coalesce(1)
    thin = keyed._may_count(df, "user", FIELDS, ["at", "n"])
    assert thin.count() <= 3 * df.select("user").distinct().count()
    named = thin.toDF("user", "at", "n", *FIELDS)
    assert state(fold_latest(named, "user", FIELDS, ["at", "n"], "n")) == state(fold_latest(df, "user", FIELDS, ["at", "n"], "n"))
    assert keyed._may_count(df.limit(0), "user", FIELDS, ["at", "n"]).count() == 0
