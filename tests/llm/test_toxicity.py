import random
import zlib

import numpy as np
import pytest
from conftest import SF

from eventcanon.llm import toxicity
from eventcanon.llm.letters import SIZE, codes, log_probabilities

BAD = "idiot moron trash pathetic loser clown".split()


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        said = [rng.choice(words) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                said.insert(rng.randrange(40), rng.choice(BAD))
        rows.append((i, " ".join(said)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def restorer():
    rows, _ = corpus()
    c = codes("\n".join(t for _, t in rows)).astype(np.int64)
    return toxicity.Restorer(log_probabilities(np.bincount((c[:-2] << 12) | (c[1:-1] << 6) | c[2:], minlength=SIZE**3)))


def test_restores_disguises(restorer):
    said = {"1d10t": "idiot", "m0r0n": "moron", "tr@$h": "trash", "p.a.t.h.e.t.i.c": "pathetic", "l-o-s-e-r": "loser", "iiidiooot": "idiot", "c|0wn": "clown"}
    assert {k: restorer.restore(k) for k in said} == said
    assert restorer.text("An i d i o t, plain words. 1234 stay") == "an idiot, plain words. 1234 stay"
    assert restorer.features("") == set()


def test_decode_is_the_best_of_all_paths(restorer):
    def every(token):
        paths = [(0.0, "")]
        for options in restorer.lattice(token):
            paths = [(s + c, said + t) for s, said in paths for t, c in options]
        out = []
        for s, said in paths:
            a = b = 0
            for ch in (*said, " "):
                z = toxicity.code_of(ch)
                s += restorer.logp[(a << 12) | (b << 6) | z]
                a, b = b, z
            out.append((s, said))
        return max(out)[1]

    for token in ("1d10t", "l0s3r", "a-b.c", "$1||y", "ooo0oo", "x!!!y"):
        assert restorer.decode(token) == every(token)


def test_reader_gives_the_same_features(restorer):
    rows, _ = corpus(60)
    names = sorted(set().union(*[restorer.features(t) for _, t in rows]))[::3]
    read = toxicity.Reader(restorer, names)
    assert all(read(t) == restorer.features(t) & set(names) for _, t in rows)


def test_scores_of_held_out_rows(spark, docs_of):
    rows, labels = corpus()
    disguised = {i: t.replace("idiot", "1d10t").replace("loser", "l o s e r").replace("trash", "tr@$h") for i, t in rows}
    extra = [(1000, None), (1001, ""), (1002, "1d10t m0r0n " * 3), (1002, "1d10t m0r0n " * 3), (None, "plain " * 30_000)]
    docs = docs_of([*disguised.items(), *extra], "Score toxic label")
    out = {r.doc_id: r for r in toxicity.report(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(out[i].held_out == (i in held) for i, _ in rows)
    right = sum(out[i].predicted == labels[i][1] for i in held)
    assert right >= 0.95 * len(held)
    assert out[1000].score == out[1001].score and out[1002].predicted == 1 and out[None].predicted == 0


def test_labels_of_held_out_rows_are_not_read(spark, docs_of):
    rows, labels = corpus(150)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (toxicity.report(docs_of(rows), spark.createDataFrame(x, "doc_id bigint, toxic int")).collect() for x in (labels, flipped))
    assert [(r.doc_id, round(r.score, 9)) for r in a] == [(r.doc_id, round(r.score, 9)) for r in b]


def test_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.report(docs_of([(1, "a"), (2, None)]), none).collect()} == {0.5}
    assert toxicity.report(docs_of([]), none).count() == 0


def test_restored_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert toxicity.restored(docs).count() == docs.count()
