import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from eventcanon.llm import sharding


def check(out, rows, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, homes = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        homes[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    sums = Counter()
    for r in out:
        sums[r.shard] += r.size
    return [sums[s] for s in range(shards)]


def test_shards_are_even_and_groups_whole(docs_of):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(0, 300) + str(i)) for i in range(1500)] + [(5000 + i, "copy of a text") for i in range(200)]
    rows += [(1, None), (2, ""), (2, ""), (None, "né"), (9999, "long" * 2000)]
    sums = check(sharding.shard_documents(docs_of(rows, "Shard size rest KEY"), cell_groups=100).collect(), rows, 24)
    assert max(sums) - min(sums) < 0.02 * max(sums)
    few = [(i, "t" * i) for i in range(3)]
    check(sharding.shard_documents(docs_of(few)).collect(), few, 24)
    assert sharding.shard_documents(docs_of([])).count() == 0


def test_a_group_larger_than_a_shard_is_alone(docs_of):
    rows = [(i, "hot text") for i in range(400)] + [(1000 + i, f"{i:06d}") for i in range(600)]
    out = sharding.shard_documents(docs_of(rows)).collect()
    check(out, rows, 24)
    home = {r.shard for r in out if r.doc_id < 1000}
    assert len(home) == 1 and not any(r.shard in home for r in out if r.doc_id >= 1000)


def test_differencing():
    rng = np.random.default_rng(2)
    vectors = np.zeros((500, 7), np.int64)
    vectors[:, 0] = rng.integers(1, 10_000, 500)
    maps, sums = sharding.difference(vectors)
    assert all(sorted(m) == list(range(7)) for m in maps.tolist())
    again = np.zeros(7, np.int64)
    for v, m in zip(vectors, maps):
        np.add.at(again, m, v)
    assert again.tolist() == sums.tolist() and sums.max() - sums.min() <= 20
    assert sharding.difference(np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]]))[1].tolist() == [16, 14]  # by hand, as Karmarkar and Karp have it


def test_other_columns_stay(docs_of):
    out = sharding.shard_documents(docs_of([(1, "a", "en", "s"), (2, "b", "de", "t")], "Slot more"), keep=True)
    assert sorted(out.columns) == sorted("doc_id size text_crc32 law shard slot grown_shard text lang source n_chars more".split())
    assert sorted(r.lang for r in out.collect()) == ["de", "en"]
