import random
import zlib

import numpy as np
import pytest
from conftest import SF

from eventcanon.llm import packing

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a  b", "foo \n bar\t\t x ", "foo\n\n bar", "x <|endoftext|> y", "a \x1c c", "trailing  ", "\n", "日本 語  テ", "u2028   x", "᠎ a ᠎", "word" * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def whole(tokenizer, texts):
    return [[*e.ids, packing.END_ID] for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def encoded(encoder, texts):
    ids, ends = encoder.encode(texts)
    return [p.tolist() for p in np.split(ids, ends[:-1])]


def test_ids_are_those_of_whole_texts(tokenizer, sample):
    texts = [*ODD, *[t or "" for _, t in sample]]
    encoder = packing.Encoder(PATH, packing.END_ID)
    assert encoder.ranked is not None and encoded(encoder, texts) == whole(tokenizer, texts)
    blanks = ["a" + " " * 300_000 + "b"]  # more than the matcher's stack holds
    assert encoded(encoder, blanks) == whole(tokenizer, blanks)


def test_files_of_other_kinds_go_through_the_tokenizer(sample):
    path = P.path("word_bpe_49k.json")
    encoder = packing.Encoder(path, packing.END_ID)
    texts = [*ODD, *[t or "" for _, t in sample[:30]]]
    assert encoder.ranked is None and encoded(encoder, texts) == whole(encoder.tokenizer, texts)


def test_ids_of_any_blanks(tokenizer):
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab1.' \t\n\u2028\u3000\u180eé漢", k=rng.randrange(30))) for _ in range(5000)]
    assert encoded(packing.Encoder(PATH, packing.END_ID), texts) == whole(tokenizer, texts)


def test_complements_against_brute_force():
    rng = random.Random(5)
    for _ in range(40):
        counts = [0, *[rng.choice([0, 0, 1, 2, 3]) for _ in range(24)]]
        index = packing.Complements(counts)
        for _ in range(20):
            gap = rng.randrange(1, 25)
            held = [n for n, c in enumerate(counts) for _ in range(c)]
            sums = [{(a,) for a in held}]
            for k in (2, 3):
                sums.append({tuple(sorted((*s, a))) for s in sums[-1] for a in set(held) if s.count(a) < counts[a]})
            ways = [sorted(s for s in level if sum(s) == gap) for level in sums]
            found = index.exact(gap, {})
            least = next((k for k, w in enumerate(ways, 1) if w), None)
            assert (len(found) if found else None) == least and (not found or tuple(sorted(found)) in ways[least - 1])
            for n in found or ():
                counts[n] -= 1


def best_fit(counts):
    """Sequences that plain best fit by falling length needs."""
    gaps = [0] * len(counts)  # open sequences by gap
    n = 0
    for length in range(len(counts) - 1, 0, -1):
        for _ in range(counts[length]):
            gap = next((g for g in range(length, len(gaps)) if gaps[g]), None)
            if gap is None:
                n, gap = n + 1, len(counts) - 1
            else:
                gaps[gap] -= 1
            gaps[gap - length] += 1
    return n


def test_plan_uses_all_and_few():
    rng = random.Random(9)
    for capacity in (1, 7, 64, 256):
        counts = [0, *[rng.choice([0, 1, 5, 1000]) for _ in range(capacity)]]
        for most in range(4):
            used = [0] * len(counts)
            for one, times in packing.patterns(counts, most):
                assert sum(k * c for k, c in one.items()) <= capacity
                for k, c in one.items():
                    used[k] += c * times
            assert used == counts
        _, n = packing.plan(counts)
        total, large = sum(k * c for k, c in enumerate(counts)), sum(counts[capacity // 2 + 1 :])
        assert max(-(-total // capacity), large) <= n <= best_fit(counts) * 1.002 + 1
    assert list(packing.patterns([0, 0, 0])) == []


def check(rows, expected, capacity):
    docs, places = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(places) == list(range(len(places)))
    for doc_id, ids in expected:
        found = sorted(docs[doc_id], key=lambda r: r.piece)
        lengths = [r.length for r in found]
        assert [r.piece for r in found] == list(range(len(found))) and sum(lengths) == len(ids) and all(n == capacity for n in lengths[1:])
        assert [r.start for r in found] == np.cumsum([0, *lengths[:-1]]).tolist()
        assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in found]
    return places


def test_given_documents(spark, sample, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, PATH).collect()
    expected = list(zip([i for i, _ in sample], whole(tokenizer, [t or "" for _, t in sample])))
    places = check(rows, expected, packing.CAPACITY)
    assert len(places) <= -(-sum(len(i) for _, i in expected) // packing.CAPACITY) + 1


def test_odd_documents_and_sequences(spark, docs_of, tokenizer):
    texts = [*ODD, None]
    docs = docs_of([(i, t) for i, t in enumerate(texts)], extra="length offset item sequence_id")
    rows = packing.pack(packing.pieces(docs, PATH, 64, keep_ids=True), "length", 64, bucket_rows=3)
    expected = list(enumerate(whole(tokenizer, [t or "" for t in texts])))
    check(rows.collect(), expected, 64)
    held = packing.sequences(rows).collect()
    assert sum(len(r.ids) for r in held) == sum(len(i) for _, i in expected) and all(len(r.ids) <= 64 for r in held)
    for r in held:
        for i in set(r.doc_ids):
            assert set(r.ids) & set(expected[i][1])
    same = packing.pack_documents(docs_of([(1, "a b c")] * 50 + [(None, "x")]), PATH).collect()
    assert len({(r.sequence_id, r.offset) for r in same}) == 51
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_lengths_out_of_bounds_fail(spark):
    with pytest.raises(Exception, match="between 1 and 8"):
        packing.pack(spark.createDataFrame([(9,)], "length int"), "length", 8).collect()
