import math
from collections import Counter

import duckdb

from eventcanon.llm import mixing


def test_same_as_sql(spark, docs_of):
    rows = [(i, "x" * (i % 40), None, f"s{i % 5}") for i in range(400)] + [(1000 + i, "y" * 300, None, "big") for i in range(150)]
    rows += [(2000, None, None, None), (2001, "", None, None), (2002, "z", None, "-"), (2003, "w" * 100_000, None, "s1"), (5, "dup", None, "s0"), (5, "dup", None, "s0")]
    out = Counter((r.doc_id, r.source, r.copy, r.n_copies, r.shuffle_key) for r in mixing.replicate(docs_of(rows, "rate COPY size")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in rows])
    want = Counter(con.execute(f"SELECT doc_id, source, copy, n_copies, shuffle_key FROM ({mixing.MIX_SQL})").fetchall())
    assert out == want


def test_rates_reach_the_targets(spark, docs_of):
    rows = [(i, "a" * 99, None, "a") for i in range(3000)] + [(10_000 + i, "b" * 99, None, "b") for i in range(1000)] + [(20_000 + i, "c" * 99, None, "c") for i in range(20)]
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 1.0), ("c", 2.0), ("none", 9.0)], "source string, weight double")
    known = weights.where("source <> 'none'")
    out = Counter(r.source for r in mixing.replicate(docs_of(rows), known, epochs=2.0).collect())
    total = 2 * len(rows)
    for s, share in (("a", 0.2), ("b", 0.4), ("c", 0.4)):  # c: 160 copies of each, in several parts
        assert abs(out[s] - share * total) < 5 * math.sqrt(share * total)
    zero = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", None)], "source string, weight double")
    assert {r.source for r in mixing.replicate(docs_of(rows), zero).collect()} == {"a"}


def test_counts_are_poisson_and_order_is_global(docs_of):
    rows = [(i, "t", None, "s") for i in range(6000)]
    out = mixing.replicate(docs_of(rows)).collect()
    n = Counter(Counter(r.doc_id for r in out).values())
    n[0] = 6000 - sum(n.values())
    for k in range(5):
        p = math.exp(-1) / math.factorial(k)
        assert abs(n[k] - 6000 * p) < 5 * math.sqrt(6000 * p)
    keys = [r.shuffle_key for r in out]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    assert mixing.replicate(docs_of([])).count() == 0
