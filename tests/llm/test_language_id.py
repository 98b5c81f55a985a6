import random
import zlib

import pytest
from conftest import SF

from eventcanon.llm import language_id

PARTS = {"aa": "ba ke lo mi su ta".split(), "bb": "sch ein ung ver ach lich".split(), "cc": "çé què eau oir ê aux".split()}


def corpus(n=300):
    rng = random.Random(4)
    out = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3]
        out.append((i, " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(30)), lang))
    return out


def test_held_out_rows(docs_of):
    rows = corpus()
    extra = [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !", "aa"), (903, "ungschlich", None), (903, "ungschlich", None), (None, "eau" * 50_000, "cc")]
    out = {r.doc_id: r for r in language_id.identify(docs_of(rows + extra, "Score lang_pred grams")).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(out[i].lang_pred == lang for i, _, lang in held)
    assert all(out[r[0]].held_out == (r in held) for r in rows)
    assert [out[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and out[903].lang_pred == "bb" and out[None].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in out.values())


def test_langs_of_held_out_rows_are_not_read(docs_of):
    rows = corpus(120)
    odd = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a, b = ([(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs_of(x)).collect()] for x in (rows, odd))
    assert a == b


SCRIPTS = {"ru": 0x430, "el": 0x3B1, "he": 0x5D0, "ar": 0x627, "hi": 0x905}


@pytest.mark.parametrize("n_words", [20, 1500])
def test_scripts_beyond_latin(docs_of, n_words):
    """Five languages of other scripts, and two that share one script and differ in their syllables."""
    rng = random.Random(n_words)
    words = {lang: ["".join(chr(first + rng.randrange(22)) for _ in range(rng.randint(2, 8))) for _ in range(3000)] for lang, first in SCRIPTS.items()}
    words["uk"] = ["".join(rng.choice(["ій", "ов", "ськ", "ен", "ко", "ра"]) for _ in range(rng.randint(1, 3))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words[lang], k=n_words)), lang) for i, lang in enumerate(sorted(words) * 25)]
    out = {r.doc_id: r.lang_pred for r in language_id.identify(docs_of(rows)).where("held_out").collect()}
    assert sum(out[i] == lang for i, _, lang in rows if i in out) >= 0.95 * len(out) and len(out) > 20


def test_repeated_rows_are_learned_once(docs_of):
    rows = corpus(60)
    once, often = (language_id.learn(docs_of(r)) for r in (rows, rows + rows[:6] * 200))
    assert once.langs == often.langs and (once.marks == often.marks).all() and (once.weights == often.weights).all()


def test_model_against_a_plain_solution():
    """With every text a landmark, Nystroem is the full kernel, and the regression that of the normal equations."""
    import numpy as np

    grams = language_id.Grams()
    rows = corpus(24)
    texts, langs = [grams(t) for _, t, _ in rows], [lang for _, _, lang in rows]
    model = language_id.Model(texts, texts, langs)
    sets = [set(t.tolist()) for t in texts]
    kernel = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets])
    assert np.abs(model.kernel(texts) - kernel).max() < 1e-5
    for k, lang in enumerate(model.langs):
        want = np.array([1.0 if own == lang else -1.0 for own in langs])
        weight = np.where(want > 0, 0.5 / (want > 0).sum(), 0.5 / (want < 0).sum()) * len(want)
        loss = lambda w: (weight * (kernel @ w - want) ** 2).sum() + language_id.RIDGE * len(want) * w @ kernel @ w + 1e-6 * w @ w  # noqa: B023, E731
        best = loss(model.weights[:, k].astype(float))
        rng = np.random.default_rng(k)
        assert all(best <= loss(model.weights[:, k] + rng.normal(0, 0.05, len(want))) for _ in range(50))


def test_nothing_to_learn(docs_of):
    assert {r.lang_pred for r in language_id.identify(docs_of([(1, "text"), (3, None)])).collect()} == {"und"}
    assert language_id.identify(docs_of([])).count() == 0


def test_kernel_is_the_share_of_common_grams():
    grams = language_id.Grams()
    a, b = grams("abc abd"), grams("abc")
    model = language_id.Model([a, b], [a, b], ["x", "y"])
    assert abs(model.kernel([a])[0, 1] - len(set(a) & set(b)) / (len(a) * len(b)) ** 0.5) < 1e-6
    assert abs(model.kernel([a])[0, 0] - 1) < 1e-6


def test_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
