import random

import numpy as np
import xxhash

from conftest import SF

from eventcanon.llm import simhash


def print_of(text, size=4):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    said = [" ".join(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))] if ws else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in said]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute(rows, size=4, radius=4):
    fps = [print_of(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    return sorted((d, f"{fps[i]:016x}", min(least[top(i)])) for i, (d, _) in enumerate(rows))


def variants(seed, n, length, changes):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        v = list(base)
        for _ in range(changes):
            v[rng.randrange(length)] = f"v{rng.randrange(9)}"
        out.append(" ".join(v))
    return out


def test_same_as_all_pairs(docs_of, sample):
    rows = [(50 + i, t) for i, t in enumerate(variants(1, 60, 300, 2) + variants(2, 40, 150, 3))]
    rows += [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one  two"), (6, "é x y z w"), (7, "w " * 50_000), (7, "w " * 50_000)]
    for cell in (2, 8, simhash.CELL):  # small cells: parts of cells, and the grid of chunks
        out = simhash.linked_components(docs_of(rows, "fp FINGERPRINT key node"), cell=cell).collect()
        assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == brute(rows)
    out = simhash.linked_components(docs_of(sample)).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == brute(sample)
    assert simhash.linked_components(docs_of([])).count() == 0
    null = simhash.linked_components(docs_of([(None, "a b c d e"), (None, "a b c d e"), (3, "z")])).collect()
    assert sorted(str(r.component_id) for r in null) == ["3", "None", "None"]


def test_tree_finds_all_pairs():
    rng = np.random.default_rng(3)
    for words in (1, 2):
        centres = rng.integers(0, 2**63, (6, words), dtype=np.uint64)
        fps = centres[rng.integers(0, 6, 400)]
        for _ in range(4):
            fps[np.arange(400), rng.integers(0, words, 400)] ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
        fps = np.unique(fps, axis=0)
        order = np.lexsort(simhash.gray_rank(fps).T[::-1])
        fps = fps[order]
        for radius in (3, 5, 9):
            want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if np.bitwise_count(fps[i] ^ fps[j]).sum() <= radius}
            a, b, _ = simhash.links(fps, None, radius)
            assert {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())} == want
            half = len(fps) // 2
            a, b, _ = simhash.links(fps[:half], fps[half:], radius)
            assert {(x, y + half) for x, y in zip(a.tolist(), b.tolist())} == {(i, j) for i, j in want if i < half <= j}


def test_parts_of_cells_lose_no_link(spark):
    """Random fingerprints with 0 to 4 bits changed: all links survive the parting, which cells of one size only would not show."""
    rng = np.random.default_rng(8)
    fps = rng.integers(0, 2**63, 40, dtype=np.uint64)[rng.integers(0, 40, 900)]
    for _ in range(3):
        fps ^= np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)
    fps = np.unique(fps)
    df = spark.createDataFrame([(bytearray(int(f).to_bytes(8, "big")), i) for i, f in enumerate(fps.tolist())], "fp binary, least long")
    keys = simhash.exact_keys(4)
    cells = simhash.cell_rows(df, keys)
    assert simhash._large(cells, 3).where("chunks > 5").count() > 20
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 4).tolist():
            root[max(top(i), top(j))] = min(top(i), top(j))
    found = simhash.components(df.withColumnRenamed("fp", "node"), simhash.cell_links(cells, 4, 3, keys))
    got = {int.from_bytes(r.node, "big"): r.component for r in found.collect()}
    assert [got.get(f, i) for i, f in enumerate(fps.tolist())] == [top(i) for i in range(len(fps))]


def test_gray_rank_orders_the_code():
    codes = [i ^ (i >> 1) for i in range(200)]
    wide = np.array([[0, c] for c in codes], np.uint64)
    assert simhash.gray_rank(wide)[:, 1].tolist() == list(range(200))
    high = np.array([[1, c] for c in codes], np.uint64)
    assert simhash.gray_rank(high)[:, 1].tolist() == [2**64 - 1 - i for i in range(200)]


def test_stage_keeps_one_of_each(docs_of):
    rng = random.Random(9)
    rows, n = [], 0
    for g in range(60):
        base = [f"g{g}w{rng.randrange(900)}" for _ in range(200)]
        for copy in range(4):
            v = list(base)
            for _ in range(2 * copy):
                v[rng.randrange(200)] = f"c{rng.randrange(50)}"
            rows.append((n, " ".join(v)))
            n += 1
    rows += [(5000 + i, " ".join(f"alone{i}x{rng.randrange(900)}" for _ in range(80))) for i in range(60)] + [(7000, None), (7001, ""), (None, "no id"), (None, "other no id"), (5000, "same id, other text")]

    def alike(s, t):
        x, y = (set(simhash.shingles(v or "", 5)) for v in (s, t))
        return len(x & y) >= 0.8 * len(x | y)

    out = simhash.one_of_each(docs_of(rows, "near_group FP me")).collect()
    kept = [(r.doc_id, r.text) for r in out]
    assert all(any(r == k for k in kept) for r in rows[240:300]) and {(None, "no id"), (None, "other no id"), (5000, "same id, other text"), (7000, None)} <= set(kept)
    pairs = [(a, b) for i, a in enumerate(rows[:240]) for b in rows[:i] if a[0] // 4 == b[0] // 4 and alike(a[1], b[1])]
    missed = [p for p in pairs if p[0] in kept and p[1] in kept]
    assert len(missed) <= 0.1 * len(pairs) and len(pairs) > 60
    assert len(simhash.one_of_each(docs_of([(1, "a b c d e f"), (1, "a b c d e f")])).collect()) == 1
    assert simhash.one_of_each(docs_of([])).count() == 0


def groups_of(docs):
    return {r.doc_id: r.near_group for r in simhash.near_groups(docs).collect()}


def test_one_repeated_line_does_not_join_texts(docs_of):
    """Repeats outvote all else in a fingerprint with repeats; different sets of shingles are verified all the same."""
    line = "this very line stands in many of the logs\n"
    rows = [(i, line * 40 + " ".join(f"d{i}w{k}" for k in range(60))) for i in (1, 2)] + [(i, "again " * 120 + " ".join(f"d{i}w{k}" for k in range(100))) for i in (3, 4)]
    assert simhash.fingerprint(rows[0][1], 5, 2) == simhash.fingerprint(rows[1][1], 5, 2)
    rows += [(5, "a b c d e f " * 9), (6, "a b c d e f " * 11)]  # one set of shingles
    assert groups_of(docs_of(rows)) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5}


def test_repeats_do_not_hide_near_copies(docs_of):
    """Texts and the same with a line repeated 30 or 60 times are alike in the set of shingles, so nearly all of them meet."""
    rng = random.Random(4)
    rows = []
    for i in range(40):
        words = [f"t{i}w{rng.randrange(4000)}" for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + words[-9:] * (30 + 30 * (i % 2))))]
    sets = {d: set(simhash.shingles(t, 5)) for d, t in rows}
    assert all(len(sets[d] & sets[d + 1]) >= 0.9 * len(sets[d] | sets[d + 1]) for d in range(0, 80, 2))
    found = groups_of(docs_of(rows))
    assert sum(found[d + 1] == d for d in range(0, 80, 2)) >= 36
    assert all(found[d] // 2 == d // 2 for d in found)


def test_what_drawn_bits_part_meets_by_pigeonhole(docs_of, monkeypatch):
    def apart(s, t):
        a, b = (np.unpackbits(np.frombuffer(simhash.set_print(x, 5, 2)[:16], np.uint8)) for x in (s, t))
        return np.flatnonzero(a != b).tolist()

    words = [f"w{i}" for i in range(600)]
    whole = " ".join(words)
    other = next(t for t in (" ".join([*words[:-1], f"v{i}"]) for i in range(200)) if 1 <= len(apart(whole, t)) <= simhash.EXACT)
    texts, differ = [(1, whole), (2, other), (3, " ".join(f"x{i}" for i in range(400)))], apart(whole, other)
    monkeypatch.setattr(simhash, "drawn_keys", lambda *_: [differ])  # the only table parts them
    for cell in (1, simhash.CELL):
        got = {r.doc_id: r.near_group for r in simhash.near_groups(docs_of(texts), cell=cell).collect()}
        assert got == {1: 1, 2: 1, 3: 3}


def test_no_candidate_goes_unverified(docs_of):
    """A family of alike texts, most below the similarity and within the radius: every pair above it that shares a cell is joined."""
    rng = random.Random(6)
    base = [f"b{k}" for k in range(400)]
    rows = []
    for i in range(150):
        v = list(base)
        for k in rng.sample(range(400), 16):
            v[k] = f"x{i}y{k}"
        rows.append((i, v))
    for i in range(30):
        v = list(rows[5 * i][1])
        for k in rng.sample(range(400), 6):
            v[k] = f"z{i}y{k}"
        rows.append((1000 + i, v))
    rows = [(d, " ".join(v)) for d, v in rows]
    sets = [set(simhash.shingles(t, 5)) for _, t in rows]
    bits = [np.unpackbits(np.frombuffer(simhash.set_print(t, 5, 2)[:16], np.uint8)) for _, t in rows]
    keys = simhash.drawn_keys(24, 12, 128)
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (bits[i] != bits[j]).sum() <= 32 and any((bits[i][k] == bits[j][k]).all() for k in keys)]
    holds = [(i, j) for i, j in near if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(near) > 3000 and 20 <= len(holds) < 60
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in holds:
        root[max(top(i), top(j))] = min(top(i), top(j))
    want = {rows[i][0]: rows[top(i)][0] for i in range(len(rows))}
    for cell in (32, simhash.CELL):  # a small one: the grid of chunks
        assert {r.doc_id: r.near_group for r in simhash.near_groups(docs_of(rows), cell=cell).collect()} == want


def test_groups_are_pruned_on_the_given_table(spark):
    """The tree over the given fingerprints leaves whole groups closed and loses no link."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    fps = sorted({r.fp for r in simhash.fingerprints(docs, 4).collect()})
    words = np.frombuffer(b"".join(fps), ">u8").astype(np.uint64).reshape(-1, 1)
    words = words[np.argsort(simhash.gray_rank(words)[:, 0])]
    pruned = {}
    a, b, _ = simhash.links(words, None, 4, pruned)
    x, y = np.triu_indices(len(words), 1)
    near = np.bitwise_count(words[x] ^ words[y]).sum(axis=1) <= 4
    assert sorted(zip(a.tolist(), b.tolist())) == list(zip(x[near].tolist(), y[near].tolist())) and len(a)
    assert pruned[1] > 1000 and pruned[2] > 0
