"""Operators on random small tables against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventcanon.operators import merge
from eventcanon.operators.latest import fold_latest, latest_per_key
from eventcanon.plans import reports
from eventcanon.sources import incremental


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("seed", range(3))
def test_incremental_reads(spark, seed):
    r = random.Random(seed)
    value = lambda: r.choice([None, 1, 2, 3, 4])
    source = [(r.choice("abcdef"), value()) for _ in range(40)]
    target = [(r.choice(["a", "b", "c", None]), value()) for _ in range(15)]
    s, t = table(spark, source, "k string, ts int"), table(spark, target, "k string, seen int")
    seen = lambda k: [x for key, x in target if key == k]
    known = {k for k, _ in target if k is not None}
    newer = lambda k, ts, how: k not in known or (ts is not None and how(ts, [x for x in seen(k) if x is not None]))
    any_of = [(k, ts) for k, ts in source if newer(k, ts, lambda a, xs: any(a > x for x in xs))]
    all_of = [(k, ts) for k, ts in source if newer(k, ts, lambda a, xs: bool(xs) and all(a > x for x in xs))]
    order = lambda data: sorted(data, key=lambda t: tuple((x is not None, str(x)) for x in t))
    assert rows(incremental.changed_rows(s, t, "k", "k", "ts", "seen")) == order(any_of)
    assert rows(incremental.changed_rows(s, t, "k", "k", "ts", "seen", newer_than="all")) == order(all_of)
    assert rows(incremental.missing_rows(s, t, "k", "k")) == order([x for x in source if x[0] not in known])


@pytest.mark.parametrize("seed", range(3))
def test_merge_and_newest(spark, seed):
    r = random.Random(seed)
    target = [(k, r.randint(0, 9), 1) for k in range(20) if r.random() < 0.6]
    source = [(r.randint(0, 19), r.randint(0, 9), 10 + i) for i in range(25)]
    want = {k: (v, f, f) for k, v, f in target}
    for k, v, at in sorted(source, key=lambda x: x[2]):
        want[k] = (v, want[k][1] if k in want and k in {t[0] for t in target} else at, at)
    t = table(spark, [(k, v, f, f) for k, v, f in target], "k int, v int, first_seen int, last_seen int")
    s = table(spark, [(k, v, at, at) for k, v, at in source], "k int, v int, first_seen int, last_seen int")
    out = merge.merge_into(t, s, ["k"], order=["last_seen"])
    assert {x.k: (x.v, x.first_seen, x.last_seen) for x in out.collect()} == want and out.count() == len(want)
    newest = {}
    for k, v, at in source:
        newest[k] = max(newest.get(k, (-1, -1)), (at, v))
    assert {(x.k, x.last_seen, x.v) for x in latest_per_key(s, ["k"], ["last_seen"]).collect()} == {(k, a, v) for k, (a, v) in newest.items()}


@pytest.mark.parametrize("seed", range(3))
def test_fold(spark, seed):
    r = random.Random(seed)
    events = [(r.choice("abc"), r.randint(0, 5), f"e{i:02d}", r.choice([None, "x", "y"]), r.choice([None, 1, 2])) for i in range(40)]
    want = {}
    for k, t, e, p, q in sorted(events, key=lambda x: (x[1], x[2])):
        old = want.get(k, (None, None, None))
        want[k] = (p if p is not None else old[0], q if q is not None else old[1], e)
    out = fold_latest(table(spark, events, "k string, t int, id string, p string, q int"), "k", ["p", "q"], ["t", "id"], "id")
    assert {x.k: (x.p, x.q, x.row_version) for x in out.collect()} == want


def test_content_counts_with_shared_and_repeated_ids(spark):
    r = random.Random(5)
    clients = [(f"c{i}", f"f{i}") for i in range(4)]
    sessions = [(f"s{r.randint(0, 6)}", r.choice(["c0", "c1", "c2", None])) for _ in range(14)]
    transcripts = [(f"t{r.randint(0, 5)}", r.choice([f"s{i}" for i in range(7)] + [None])) for _ in range(15)]
    documents = [(f"d{r.randint(0, 5)}", r.choice([f"s{i}" for i in range(7)]), r.choice(["soap-note", "client-summary", "progress-report", "x"])) for _ in range(25)]
    want = set()
    for cid, folder in clients:
        mine = {s for s, c in sessions if c == cid}
        of = lambda kind: len({d for d, s, k in documents if s in mine and k == kind})
        want.add((folder, len(mine), len({t for t, s in transcripts if s in mine}), of("soap-note"), of("client-summary"), of("progress-report")))
    out = reports.content_counts(
        table(spark, clients, "client_id string, client_folder string"), table(spark, sessions, "session_id string, client_id string"),
        table(spark, transcripts, "transcript_id string, session_id string"), table(spark, documents, "document_id string, session_id string, doc_type string"),
    )
    assert {tuple(x) for x in out.collect()} == want


def test_stamps_must_be_unique(spark):
    target = table(spark, [(1, None), (2, None)], "k int, s string")
    assert rows(merge.stamp(target, table(spark, [(1, "x")], "k int, s string"), ["k"], ["s"])) == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="same k"):
        merge.stamp(target, table(spark, [(1, "x"), (1, "y")], "k int, s string"), ["k"], ["s"]).collect()
