"""Change feeds and cursors against states kept in Python."""

import random

import pytest
from conftest import plan_of, rows

from eventcanon.operators.merge import merge_into
from eventcanon.sources.catalog import Catalog
from eventcanon.sources.changes import advanced, changes, cursor, new_rows, run_once

SCHEMA = "k string, p string, n int"


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path))


def net(old, new):
    out = [(*new.get(k, old.get(k)), "insert" if k not in old else "delete" if k not in new else "update") for k in old.keys() | new.keys() if old.get(k) != new.get(k)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_random_histories(spark, catalog):
    rng = random.Random(2)
    table = catalog.table("raw", "t", partition_by=["p"])
    make = lambda state: spark.createDataFrame(list(state.values()), SCHEMA)
    now = {f"k{i}": (f"k{i}", rng.choice("abc"), 0) for i in range(8)}
    table.replace(make(now))
    states = [dict(now)]
    for step in range(9):
        kind = ["upsert", "delete", "compact", "upsert", "append", "settings", "upsert", "delete", "upsert"][step]
        if kind == "compact":
            table.compact()
        elif kind == "settings":
            table.set_properties({"x": step})
        elif kind == "append":
            more = {f"a{step}{i}": (f"a{step}{i}", rng.choice("abcd"), None) for i in range(2)}
            table.append(make(more))
            now = now | more
        elif kind == "delete":
            gone = rng.sample(sorted(now), 2)
            batch = make({k: now[k] for k in gone})
            table.replace_touched(lambda rows: rows.join(batch.select("k"), "k", "left_anti"), batch)
            now = {k: v for k, v in now.items() if k not in gone}
        else:
            some = {k: (k, rng.choice("abcd"), rng.choice([None, 0, step])) for k in [*rng.sample(sorted(now), 3), f"k{rng.randrange(12)}"]}
            batch = make(some)
            table.replace_touched(lambda rows: merge_into(rows, batch, ["k"], skip_update=(), order=["n"]), batch, ["k"])
            now = now | some
        states.append(dict(now))
    assert rows(table.read().select("k", "p", "n")) == rows(make(now))
    for a, b in [(0, 9), (2, 3), (1, 5), (4, 4)]:
        assert found(changes(table, a, ["k"], b).select("k", "p", "n", "_change")) == net(states[a], states[b]), (a, b)
    assert found(changes(table, None, ["k"], 0).drop("_change").select("k", "p", "n")) == sorted(states[0].values(), key=str)
    table.expire(keep=4)  # what was removed is passed over in one step; a version that is gone can't be asked for
    assert found(changes(table, 6, ["k"]).select("k", "p", "n", "_change")) == net(states[6], states[9])
    with pytest.raises(FileNotFoundError):
        changes(table, 2, ["k"])


def test_only_touched_directories_are_read(spark, catalog):
    table = catalog.table("raw", "t", partition_by=["p"])
    table.replace(spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], SCHEMA))
    assert "Scan parquet" not in plan_of(changes(table, 0, ["k"])) and changes(table, 0, ["k"]).count() == 0
    table.compact()
    assert "Scan parquet" not in plan_of(changes(table, 0, ["k"]))
    batch = spark.createDataFrame([("b", "y", 2)], SCHEMA)
    table.replace_touched(lambda now: merge_into(now, batch, ["k"]), batch)
    feed = changes(table, 0, ["k"])
    assert found(feed.select("k", "p", "n", "_change")) == [("b", "y", 2, "update")]
    assert all("p=y" in f for f in feed.inputFiles())
    with pytest.raises(ValueError, match="name the keys"):
        changes(table, 0)


def test_appends_need_no_keys_and_no_comparison(spark, catalog):
    table = catalog.table("raw", "t")
    table.append(spark.createDataFrame([("a", "x", 1)], SCHEMA))
    table.append(spark.createDataFrame([("a", "x", 1), (None, None, None)], SCHEMA))
    feed = changes(table, 0)
    assert found(feed) == [("a", "x", 1, "insert"), (None, None, None, "insert")] and "Exchange" not in plan_of(feed)


def test_cursor_moves_with_the_rows(spark, catalog):
    source, target = catalog.table("raw", "s", partition_by=["p"]), catalog.table("derived", "t")
    source.replace(spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA))

    def publish(made, properties):
        return target.append(made, properties)

    def fails(made, properties):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run_once(source, target, lambda r: r, fails, ["k"])
    assert cursor(target, source) is None
    assert run_once(source, target, lambda r: r, publish, ["k"], {"p": "x"}) == 0
    assert rows(target.read()) == [("a", "x", 1)] and cursor(target, source) == 0
    assert run_once(source, target, lambda r: r, publish, ["k"], {"p": "x"}) is None
    source.compact()
    assert run_once(source, target, lambda r: r, publish, ["k"], {"p": "x"}) == 1 and cursor(target, source) == 1
    source.append(spark.createDataFrame([("c", "x", 3)], SCHEMA))
    found, until = new_rows(source, target, ["k"], {"p": "x"}, columns=["k"])
    assert rows(found) == [("c",)] and until == 2
    assert new_rows(source, target, ["k"], reader="other")[0].count() == 3  # each reader has a cursor of its own
    assert run_once(source, target, lambda r: r, publish, ["k"], {"p": "x"}) == 2 and rows(target.read()) == [("a", "x", 1), ("c", "x", 3)]
    assert advanced(source, 2) == {k: v for k, v in target.properties().items()}
