import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from conftest import SF

from eventcanon.llm import periodic


def brute(words):
    """All runs (start, end, period) by comparing words q apart, for every q."""
    best = {}
    for q in range(1, len(words) // 3 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            if not s and start is not None:
                if i + q - start >= max(24, 3 * q):
                    best.setdefault((start, i + q), q)
                start = None
    return sorted((s, e, q) for (s, e), q in best.items())


def odd_words(rng):
    """Words with runs of all sorts: nested, beside each other, broken, with long inner repetitions."""
    out = []
    for _ in range(rng.randrange(0, 6)):
        if rng.random() < 0.3:
            out += [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(60))]
            continue
        unit = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 30, 33, 65]))]
        if rng.random() < 0.4:
            unit = [0] * rng.randrange(1, 60) + [1] + unit[: rng.randrange(3)]
        if rng.random() < 0.2:
            unit = unit * rng.randrange(1, 4) + [2]
        out += [unit[i % len(unit)] for i in range(int(len(unit) * rng.uniform(2.5, 6)))]
    if rng.random() < 0.15 and 0 < len(out) < 100:
        out = out + [7] + out + [8] + out + [7] + out + [8] + out + [7] + out
    return out


def test_runs_against_brute_force():
    rng = random.Random(1)
    n = 0
    for _ in range(150):
        docs = [odd_words(rng) for _ in range(rng.randrange(1, 4))]
        ends = np.cumsum([len(d) for d in docs])
        got = list(zip(*(c.tolist() for c in periodic.runs(np.array([w for d in docs for w in d], np.int64), ends))))
        want = sorted(((s + end - len(d), e + end - len(d), q) for d, end in zip(docs, ends.tolist()) for s, e, q in brute(d)), key=lambda r: (r[0], r[2]))
        assert got == want
        n += len(got)
    assert n > 150


def test_few_candidates():
    """Progressions give two candidates, however many occurrences they have."""
    words = np.array(([0] * 500 + [1]) * 4, np.int64)
    at, period = periodic.candidates(periodic.Doubling(words, np.array([len(words)])))
    assert (period == 501).any() and len(at) < len(words)


def expected(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [(s, e - s, q) for s, e, q in sorted(brute(words), key=lambda r: (r[0], r[2]))]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)), n)


def test_report(spark, sample, docs_of):
    short = [(i, t) for i, t in sample if t is None or len(t) < 4000]
    odd = [(None, "a b " * 40), (90_001, None), (90_002, ""), (90_003, "x" * 200_000), (90_004, "a\tb\nc d " * 30), (90_004, "a\tb\nc d " * 30), (90_005, " ".join("xy"[i % 2] for i in range(24)))]
    rows = short + odd
    rows_of = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    got = rows_of(periodic.report(docs_of(rows)))
    assert got == sorted(repr((i, *expected(i, t))) for i, t in rows)
    assert rows_of(periodic.report(docs_of(rows, extra="runs h words"))) == got
    out = periodic.report(docs_of(rows))
    assert sum(r.n_runs > 0 for r in out.collect()) > 10
    assert periodic.report(docs_of(rows).limit(0)).count() == 0


def test_blocks_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    one, many = ({r.doc_id: r for r in periodic.periodic_runs(periodic.planted(docs), n).collect()} for n in (10_000_000, 5_000))
    assert one == many
