import hashlib
import random
import re
from collections import Counter

import numpy as np
from conftest import SF, plan_of

from eventcanon.llm import decontaminate as dc


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, w=10):
    windows = []
    for i, t in items:
        ws = words(t)
        windows += [(str(i), ws[k : k + w]) for k in range(max(1, len(ws) - w + 1) if ws else 0)]
    out = []
    for d, t in docs:
        ws, hit, ids = words(t), set(), set()
        for i, win in windows:
            for k in range(len(ws) - len(win) + 1):
                if ws[k] == win[0] and ws[k : k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    ids.add(i)
        out.append((str(d), len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def found(df):
    return Counter((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def cases():
    rng = random.Random(8)
    vocabulary = "a b c d e f Été g1 h".split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 25)))) for i in range(20)]
    items += [(50, "b a"), (51, None), (52, ""), (53, "A, B; c d e f g1 h a b c"), (53, "other item"), (10, items[3][1]), (9, "a a a a a a a a a a a a")]
    docs = [(i, " ".join(rng.choice([*vocabulary, "zz", "yy"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    docs += [(100 + i, "x y " + items[i][1].upper() + " -- " + items[(i + 1) % 20][1]) for i in range(20)]
    docs += [(200, None), (201, ""), (202, "a " * 3000), (202, "a " * 3000), (None, "b, A.")]
    return docs, items


def test_same_as_plain_search(spark, docs_of):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert found(dc.report(docs_of(docs, "starts Items n_words"), bench)) == want
    many = dc.find_phrases(docs_of(docs).select("doc_id", "text"), bench, block_chars=60)  # several blocks
    small = dc.find_phrases(docs_of(docs).select("doc_id", "text"), bench, block_chars=60, shard_chars=300)
    for df in (many, small):
        assert plan_of(df).count("MapInArrow") == 1  # for any number of blocks
    one = dc.find_phrases(docs_of(docs).select("doc_id", "text"), bench)
    assert len(list(dc.benchmark_blocks(dc.stored(bench), 60))) >= 12
    assert Counter(map(str, many.collect())) == Counter(map(str, one.collect())) == Counter(map(str, small.collect()))
    assert dc.report(docs_of([]), bench).count() == 0
    none = dc.report(docs_of(docs), bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)


def test_given_tables(spark, sample):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(dc.report(docs, bench)) == brute(sample, [(r.item_id, r.text) for r in bench.collect()])


def test_index_against_plain_counts():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 6, 700)
    index = dc.FMIndex(text, 6)
    windows = rng.integers(1, 6, (40, 4))
    lengths = rng.integers(1, 5, 40)
    lo, hi = index.search(windows, lengths)
    for w, n, a, b in zip(windows, lengths, lo, hi):
        places = [i for i in range(len(text) - n + 1) if (text[i : i + n] == w[4 - n :]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_passages_are_cut_and_the_rest_stays(spark, docs_of):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, f"Keep this. One, two three four five six seven eight nine TEN, and this."), (2, item), (3, "clean"), (4, None), (5, "")]
    out = {r.doc_id: r.text for r in dc.decontaminate(docs_of(rows), bench).collect()}
    assert out == {1: "Keep this., and this.", 3: "clean", 4: None, 5: ""}
