"""The as-of join against a plain search, and indexed search against reading every text."""

import datetime as dt
import random

import pytest
from conftest import plan_of, rows

from eventcanon.functions.text import contains_terms
from eventcanon.operators import search_index
from eventcanon.operators.asof import asof_join
from eventcanon.sources.catalog import Catalog

START = dt.datetime(2024, 1, 1)


def moments(rng, n):
    return [rng.choice([None, *[START + dt.timedelta(minutes=rng.randrange(6000))] * 15]) for _ in range(n)]


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(3)
    users = ["hot"] * 6 + ["a", "b", "c", "only left", None]
    left = [(i, rng.choice(users), t) for i, t in enumerate(moments(rng, 300))]
    right = [(rng.choice([u for u in users if u != "only left"]), t, i, rng.choice([None, "x", "y"])) for i, t in enumerate(moments(rng, 150))]
    return left, right


@pytest.mark.parametrize("strict, tolerance, width", [(False, None, 86_400), (True, None, 3_600), (False, 40_000, 86_400), (False, None, 10**9)])
def test_as_of_against_plain_search(spark, sides, strict, tolerance, width):
    left, right = sides
    df = asof_join(
        spark.createDataFrame(left, "i int, who string, at timestamp_ntz"), spark.createDataFrame(right, "who string, since timestamp_ntz, n int, v string"),
        ["who"], "at", "since", order=["n"], prefix="r_", bucket_seconds=width, tolerance_seconds=tolerance, strict=strict)
    assert df.columns == ["i", "who", "at", "r_since", "r_n", "r_v"]
    want = []
    for i, who, at in left:
        fits = [r for r in right if None not in (who, at, r[1]) and r[0] == who and (r[1] < at or r[1] == at and not strict)]
        best = max(fits, key=lambda r: (r[1], r[2]), default=None)
        if best and tolerance is not None and (at - best[1]).total_seconds() > tolerance:
            best = None
        want.append((i, who, at, *(best[1:] if best else (None, None, None))))
    assert sorted(map(tuple, df.collect())) == sorted(want, key=lambda r: r[0])


def test_as_of_names_and_empty_sides(spark, sides):
    left = spark.createDataFrame(sides[0], "i int, who string, at timestamp_ntz")
    right = spark.createDataFrame(sides[1], "who string, at timestamp_ntz, n int, v string")
    with pytest.raises(ValueError, match="at"):
        asof_join(left, right, ["who"], "at", "at")
    none = asof_join(left, right.limit(0), ["who"], "at", "at", prefix="r_")
    assert none.count() == 300 and none.where("r_n is not null").count() == 0
    assert asof_join(left.limit(0), right, ["who"], "at", "at", prefix="r_").count() == 0


TEXTS = [(1, "The cat, and the DOG"), (2, "dog_house and cats"), (3, None), (4, ""), (5, "the-dog"), (6, "Été à la mer and dog"), (None, "a dog without key"), (7, "dog"), (7, "cat dog")]


def test_indexed_search_finds_what_reading_finds(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    texts = catalog.table("raw", "texts", partition_by=[search_index.ROW_BUCKET])
    index = catalog.table("derived", "postings", partition_by=[search_index.TOKEN_BUCKET], sort_by=["token"])
    df = spark.createDataFrame(TEXTS, "id int, said string")
    for part in (df.where("id <= 4"), df.where("id > 4 or id is null")):
        search_index.add_rows(texts, index, part, "id", "said", token_buckets=8, row_buckets=8)
    for words in ("dog", "DOG the", "and dog", "été", "cat dog", "house", "dog_house", "nowhere"):
        found = search_index.search(texts, index, words, "id", "said")
        assert rows(found.select("id", "said")) == rows(df.where(contains_terms("said", words))), words
    with pytest.raises(ValueError):
        search_index.search(texts, index, " ,", "id", "said")
    # only the directories of the words' buckets, and of buckets with a hit, are listed
    scan = plan_of(search_index.candidates(index, ["house"]))
    assert "PartitionFilters: [" in scan and "token_bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]
    hit = plan_of(search_index.search(texts, index, "été", "id", "said"))
    assert "row_bucket" in "".join(part.split("]")[0] for part in hit.split("PartitionFilters: [")[1:])
