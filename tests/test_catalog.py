import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from eventcanon.operators.merge import merge_into
from eventcanon.sources.catalog import Catalog, ConcurrentWrite


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path))


def data(spark, *triples):
    return spark.createDataFrame(list(triples), "part string, k int, v string")


def test_versions_are_kept(spark, catalog):
    t = catalog.table("raw", "objects")
    assert not t.exists()
    t.replace(data(spark, ("a", 1, "x")))
    t.append(data(spark, ("a", 2, "y")))
    assert rows(t.read()) == [("a", 1, "x"), ("a", 2, "y")]
    assert rows(t.read(0)) == [("a", 1, "x")]
    assert t.versions() == [0, 1]


def test_only_touched_partitions_are_rewritten(spark, catalog):
    odd = "o'dd/=:%"
    t = catalog.table("raw", "objects", partition_by=["part"], sort_by=["k"])
    t.replace(data(spark, ("a", 1, "x"), ("b", 2, "y"), (odd, 3, "z"), (None, 4, "n")))
    for batch, touched in [(data(spark, ("a", 1, "new"), ("a", 9, "add")), 1), (data(spark, (odd, 3, "new"), (None, 4, "new")), 2)]:
        before = set(t._manifest(t.version())["dirs"])
        t.replace_touched(lambda now: merge_into(now, batch, ["k"], skip_update=()), batch)
        after = set(t._manifest(t.version())["dirs"])
        assert len(before - after) == touched
    assert rows(t.read()) == rows(data(spark, ("a", 1, "new"), ("a", 9, "add"), ("b", 2, "y"), (odd, 3, "new"), (None, 4, "new")))


def test_partition_filter_prunes(spark, catalog):
    t = catalog.table("raw", "objects", partition_by=["part"])
    t.replace(data(spark, ("a", 1, "x"), ("b", 2, "y")))
    assert "PartitionFilters: [isnotnull(part" in plan_of(t.read().where("part = 'a'"))


def test_new_partition_and_repeat(spark, catalog):
    t = catalog.table("raw", "objects", partition_by=["part"])
    t.replace(data(spark, ("a", 1, "x")))
    batch = data(spark, ("c", 5, "q"))
    for _ in range(2):
        t.replace_touched(lambda now: merge_into(now, batch, ["k"]), batch)
    assert rows(t.read()) == [("a", 1, "x"), ("c", 5, "q")]


def test_rows_must_stay_in_their_partitions(spark, catalog):
    t = catalog.table("raw", "objects", partition_by=["part"])
    t.replace(data(spark, ("a", 1, "x"), ("b", 1, "y")))
    with pytest.raises(ValueError):
        t.replace_touched(lambda now: now.withColumn("part", F.lit("b")), data(spark, ("a", 1, "x")))


def test_second_writer_of_a_version_fails(spark, catalog):
    t = catalog.table("raw", "objects")
    t.replace(data(spark, ("a", 1, "x")))
    with pytest.raises(ConcurrentWrite):
        t._publish(0, {})


def test_names_and_isolation(spark):
    c = Catalog(spark, "/root/x/", datasets={"raw": "raw_dev"})
    assert c.table("raw", "t").path == "/root/x/raw_dev/t"
    assert c.table("canonical", "t").path == "/root/x/canonical/t"
    assert c.table("other", "t").path == "/root/x/other/t"
    run = c.isolated("r1")
    assert run.table("raw", "t").path == "/root/x/trial_r1/trial_r1__t"
    assert run.table("raw", "trial_r1__t").path == "/root/x/trial_r1/trial_r1__t"


def test_two_writers_from_one_base(spark, catalog):
    t = catalog.table("raw", "objects")
    t.replace(data(spark, ("a", 1, "x")))
    t.replace(data(spark, ("a", 1, "y")), expect=0)
    with pytest.raises(ConcurrentWrite):
        t.replace(data(spark, ("a", 1, "z")), expect=0)
    assert rows(t.read()) == [("a", 1, "y")]


def test_one_big_partition_is_written_by_several_tasks(spark, catalog):
    """A partition with most of the rows does not land in one task."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        t = catalog.table("raw", "objects", partition_by=["part"])
        big = spark.range(0, 40000, 1, 8).select(
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("p"), F.col("id") % 30)).otherwise("big").alias("part"), F.sha2(F.col("id").cast("string"), 512).alias("v")
        )
        t.replace(big)
        files = t.read().select("part", F.input_file_name().alias("f")).distinct().groupBy("part").count()
        got = {r["part"]: r["count"] for r in files.collect()}
        assert got["big"] > 4, got
        assert t.read().count() == 40000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_key_that_moves_leaves_no_row_behind(spark, catalog):
    from eventcanon.operators.merge import merge_into

    table = catalog.table("raw", "moved", partition_by=["p"])
    table.replace(spark.createDataFrame([("k1", "v1", 1), ("k2", "v2", 1), ("k3", "v4", 1)], "k string, p string, n int"))
    batch = spark.createDataFrame([("k1", "v3", 2), ("k4", "v2", 2)], "k string, p string, n int")
    table.replace_touched(lambda now: merge_into(now, batch, ["k"]), batch, ["k"])
    assert rows(table.read().select("k", "p", "n")) == [("k1", "v3", 2), ("k2", "v2", 1), ("k3", "v4", 1), ("k4", "v2", 2)]


def test_compaction_and_removal_of_versions(spark, tmp_path):
    table = Catalog(spark, str(tmp_path)).table("raw", "t", partition_by=["p"])
    df = spark.range(6).selectExpr("id", "id % 2 AS p")
    for i in range(3):
        table.append(df.where(f"id div 2 = {i}"))
    assert table.expire(keep=2) == [0] and rows(table.read()) == rows(df)  # appended directories are still listed
    table.compact()
    assert table.expire(keep=1) == [1, 2] and table.versions() == [3] and rows(table.read()) == rows(df)
    folders = {f.name.split("-")[0] for f in (tmp_path / "raw" / "t").glob("snapshot_version=*") if list(f.rglob("*.parquet"))}
    assert folders == {"snapshot_version=3"}
    with pytest.raises(ValueError):
        table.expire(keep=0)
