"""Near duplicates by SimHash over a hierarchical index in Gray order.

A fingerprint has a bit for each bit of the hash of a document's word shingles that is set in over half of them. Fingerprints within a
radius are linked, links are followed to components. Only distinct fingerprints are compared; copies share one.

Candidates meet in cells. With ``radius`` differing bits at most, two fingerprints cut into radius + 1 stretches agree on at least one
stretch, so a cell for each stretch and value loses no link (`exact_keys`). Within a cell the same holds for the bits outside its
stretch, so a cell that would need more chunks (below) than that takes copies is first parted by stretches of those bits (`finer_rows`),
which loses no link either. A cell's fingerprints are sorted by Gray rank, so that
neighbours differ in few bits; runs of them form leaves, runs of leaves upper nodes. A node holds the bits that all below
it share (mask and pattern). Two nodes are compared by their masks first: bits shared on both sides that differ are a
lower bound of any distance below, and pairs of groups beyond the radius are pruned whole; the rest is opened. Per cell
only a shortest spanning forest of the links found is kept (at most one link per fingerprint), which leaves components as they are.
Cells with more than CELL fingerprints are split by hash into a grid of chunks; every pair of chunks meets in one
task, so no cell grows with the data and none is cut.

For a similarity below what a small radius reaches (`near_groups`), further cells come from drawn sets of bits of a 128-bit fingerprint, and links
are verified by the shingles' Jaccard similarity: first those of each cell's forest, then all others between groups that are still apart
(`apart_links`), so no candidate goes unverified. The recall of the cells is measured in the tests.

NULL and empty texts have fingerprint zero and link like any other. Repeated rows are copies. NULL ids are passed over when the
least doc_id is taken; a component of NULL ids alone has a NULL id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventcanon.llm.common import cut, fresh, map_batches, modest, text_of, with_new

SEED = 42
CELL = 1024
LEAF = 4
FAN = 4
SHINGLES_AT_ONCE = 65_536


def shingles(text: str, size: int) -> list[bytes]:
    words = text.encode("utf-8", "replace").lower().split()  # bytes: lowers A-Z, splits at \\x20 and \\x09-\\x0D
    if not words:
        return []
    if len(words) <= size:
        return [b" ".join(words)]
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    return [joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :])]


def fingerprint(text: str, size: int, words: int = 1) -> bytes:
    """`words` times 64 bits, most significant byte first; further words hash with the seeds that follow."""
    return print_of_shingles(shingles(text, size), words)


def print_of_shingles(said: list[bytes], words: int = 1) -> bytes:
    out = b""
    for w in range(words):
        digest = xxhash.xxh64_digest
        counts = np.zeros(64, np.int64)
        for i in range(0, len(said), SHINGLES_AT_ONCE):
            part = b"".join([digest(s, SEED + w) for s in said[i : i + SHINGLES_AT_ONCE]])
            counts += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out += np.packbits(counts * 2 > len(said)).tobytes()
    return out


def set_print(text: str, size: int, words: int) -> bytes:
    """A fingerprint of the distinct shingles, and behind it 128 bits that name their set: texts share it only if they have the same shingles."""
    said = sorted(set(shingles(text, size)))
    return print_of_shingles(said, words) + xxhash.xxh3_128_digest(b"\n".join(said))


def fingerprints(docs: DataFrame, size: int, words: int = 1) -> DataFrame:
    """doc_id and fp (binary) of each row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, size, words) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], names=["doc_id", "fp"])

    return map_batches(fresh(docs, doc_id=F.col("doc_id").cast("long"), text=text_of()), lambda: work, "doc_id bigint, fp binary")


# -- cells ---------------------------------------------------------------------------------------------------------


def exact_keys(radius: int, bits: int = 64) -> list[list[int]]:
    """Places of the bits of each key: radius + 1 stretches that cover all bits."""
    return [p.tolist() for p in np.array_split(np.arange(bits), radius + 1)]


def drawn_keys(tables: int, width: int, bits: int, seed: int = 5) -> list[list[int]]:
    """`tables` sets of `width` bits, drawn so that all bits are used about equally often."""
    rng = np.random.default_rng(seed)
    pool: list[int] = []
    out = []
    for _ in range(tables):
        own: list[int] = []
        while len(own) < width:
            if not pool:
                pool = rng.permutation(bits).tolist()
            b = pool.pop()
            if b not in own:
                own.append(b)
        out.append(sorted(own))
    return out


def cell_rows(fps: DataFrame, keys: list[list[int]]) -> DataFrame:
    """fps (fp) -> table, key, fp: a row for each key."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(0).to_pylist()
        bits = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), axis=1)
        values = [bits[:, k].astype(np.int64) @ (1 << np.arange(len(k), dtype=np.int64)) for k in keys]
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.tile(np.arange(n, dtype=np.int32), len(raw))), pa.array(np.stack(values, 1).reshape(-1)), pa.array([r for r in raw for _ in keys], pa.binary())],
            names=["table", "key", "fp"])

    return map_batches(fps.select("fp"), lambda: work, "table int, key bigint, fp binary")


def finer_rows(cells: DataFrame, keys: list[list[int]], radius: int, bits: int = 64) -> DataFrame:
    """cells (table, key, fp) of `keys` -> the same columns for parts of the cells: a row for each of radius + 1 stretches of the other bits."""
    parts = [[p.tolist() for p in np.array_split(np.setdiff1d(np.arange(bits), k), radius + 1)] for k in keys]
    wide = max(len(p) for own in parts for p in own)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        set_bits = np.unpackbits(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(table), -1), axis=1)
        tables, inner, at = [], [], []
        for t in np.unique(table).tolist():
            own = np.flatnonzero(table == t)
            for i, p in enumerate(parts[t]):
                tables.append(np.full(len(own), len(keys) + t * (radius + 1) + i, np.int32))
                inner.append((key[own] << wide) | (set_bits[own][:, p].astype(np.int64) @ (1 << np.arange(len(p), dtype=np.int64))))
                at.append(own)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(tables)), pa.array(np.concatenate(inner)), batch.column(2).take(pa.array(np.concatenate(at)))], names=["table", "key", "fp"])

    return map_batches(cells.select("table", "key", "fp"), lambda: work, "table int, key bigint, fp binary")


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Places of fingerprints (n x words, most significant first) in the reflected Gray code: each bit XORed with all before it."""
    g = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        g ^= g >> np.uint64(shift)
    odd = np.cumsum(np.bitwise_count(words), axis=1) & 1
    g[:, 1:] ^= np.where(odd[:, :-1] == 1, np.uint64(2**64 - 1), np.uint64(0))
    return g


class GrayTree:
    """Fingerprints in Gray order under nodes that hold the bits shared by all below them."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps  # n x words, in Gray order
        every, some = [fps], [fps]
        width, self.spans = 1, [np.stack([np.arange(len(fps)), np.arange(1, len(fps) + 1)], 1)]
        step = LEAF
        while len(every[-1]) > 1:
            at = np.arange(0, len(every[-1]), step)
            every.append(np.bitwise_and.reduceat(every[-1], at, axis=0))
            some.append(np.bitwise_or.reduceat(some[-1], at, axis=0))
            width *= step
            self.spans.append(np.stack([np.arange(len(at)) * width, np.minimum((np.arange(len(at)) + 1) * width, len(fps))], 1))
            step = FAN
        self.every, self.some = every, some

    def level_pairs(self, other: GrayTree, level: int, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
        """Which pairs of nodes may hold a link: bits that are 1 in all of one and 0 in all of the other count."""
        apart = np.bitwise_count((self.every[level][a] & ~other.some[level][b]) | (other.every[level][b] & ~self.some[level][a])).sum(axis=1)
        return apart <= radius

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children of nodes."""
        step = LEAF if level == 1 else FAN
        first = nodes * step
        return first, np.minimum(first + step, len(self.every[level - 1])) - first


def links(left: np.ndarray, right: np.ndarray | None, radius: int, pruned: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs within the radius, of `left` with itself or with `right`, and their distances.

    `pruned` counts, by level from the fingerprints (0) up, the pairs of nodes that were left closed.
    """
    a_tree = GrayTree(left)
    b_tree = a_tree if right is None else GrayTree(right)
    level = min(len(a_tree.every), len(b_tree.every)) - 1
    na, nb = len(a_tree.every[level]), len(b_tree.every[level])
    a, b = np.repeat(np.arange(na), nb), np.tile(np.arange(nb), na)
    while True:
        if right is None:
            a, b = a[a <= b], b[a <= b]
        near = a_tree.level_pairs(b_tree, level, a, b, radius)
        if pruned is not None:
            pruned[level] = pruned.get(level, 0) + int((~near).sum())
        a, b = a[near], b[near]
        if level == 0:
            break
        fa, ca = a_tree.children(level, a)
        fb, cb = b_tree.children(level, b)
        many = ca * cb
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        wide = np.repeat(cb, many)
        a, b = np.repeat(fa, many) + nth // wide, np.repeat(fb, many) + nth % wide
        level -= 1
    if right is None:
        a, b = a[a != b], b[a != b]
    apart = np.bitwise_count(left[a] ^ (left if right is None else right)[b]).sum(axis=1).astype(np.int64)
    return a, b, apart


def forest(n: int, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> list[int]:
    """Places of the links of a shortest spanning forest (Kruskal)."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in np.lexsort((b, a, apart)).tolist():
        x, y = top(int(a[i])), top(int(b[i]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(i)
    return out


def _large(cells: DataFrame, cell: int) -> DataFrame:
    """table, key and chunks of the cells with more than `cell` fingerprints: at most one for each `cell` rows."""
    counted = cells.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
    return counted.select("table", "key", F.ceil(F.col("n") / cell).cast("int").alias("chunks"))


def _sized(cells: DataFrame, large: DataFrame, few: bool = False) -> DataFrame:
    """`cells` with their number of chunks (NULL: one). `few`: keys of so few bits made the cells that what is `large` can be broadcast,
    which spares a shuffle of all rows. Where nothing is `large` (written down by `cut`, so that it is counted once) nothing is joined."""
    if not large.limit(1).count():
        return cells.withColumn("chunks", F.lit(None).cast("int"))
    return cells.join(F.broadcast(large) if few else large, ["table", "key"], "left")


def _grid(sized: DataFrame) -> DataFrame:
    """Cells with their number of chunks (NULL: one), dealt so that every pair of chunks (i, j) of a cell lies together."""
    n = F.coalesce("chunks", F.lit(1))
    chunk = F.pmod(F.xxhash64("fp"), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda o: F.struct(
        F.least(chunk, o).alias("i"), F.greatest(chunk, o).alias("j"), F.when(chunk <= o, 0).otherwise(1).alias("side")))
    grid = sized.select("table", "key", "fp", F.explode(pairs).alias("p")).select("table", "key", "p.i", "p.j", "p.side", "fp")
    return grid.repartition("table", "key", "i", "j").sortWithinPartitions("table", "key", "i", "j", "side")


def cell_links(
    cells: DataFrame, radius: int, cell: int = CELL, keys: list[list[int]] | None = None, width: int | None = None, few: bool = False
) -> DataFrame:
    """Links (a, b: fingerprints) of a shortest forest of each cell; `cells` as made by `cell_rows`.

    With `width`, only so many leading bytes of fp are the fingerprint; what follows tells apart what has the same one.
    With `keys`, the `exact_keys` of the whole fingerprint that made the cells, cells of more than radius + 1 chunks are parted first.
    `few` as in `_sized`.
    """
    large = cut(_large(cells, cell))
    sized = _sized(cells, large, few)
    crowded = large.where(F.col("chunks") > radius + 1)
    if keys and crowded.limit(1).count():
        parted = finer_rows(cells.join(crowded, ["table", "key"], "left_semi"), keys, radius, 8 * (width or 8))
        sized = sized.where(F.coalesce("chunks", F.lit(1)) <= radius + 1).unionByName(_sized(parted, cut(_large(parted, cell))))
    dealt = _grid(sized)

    def solve(rows: list[np.ndarray], sides: list[np.ndarray], out: list) -> None:
        fps, side = np.concatenate(rows), np.concatenate(sides)
        if len(fps) < 2:
            return
        words = np.ascontiguousarray(fps[:, :width]).view(">u8").astype(np.uint64).reshape(len(fps), -1)
        order = np.lexsort([*gray_rank(words).T[::-1], side])
        fps, words, n_left = fps[order], words[order], int((side == 0).sum())
        a, b, apart = links(words, None, radius) if n_left in (0, len(fps)) else links(words[:n_left], words[n_left:], radius)
        if n_left not in (0, len(fps)):
            b = b + n_left
        for i in forest(len(fps), a, b, apart):
            out.append((fps[a[i]].tobytes(), fps[b[i]].tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        rows: list[np.ndarray] = []
        sides: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], 1)
            side = batch.column(4).to_numpy(zero_copy_only=False)
            raw = batch.column(5).to_pylist()
            fps = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            out: list = []
            for lo, hi in zip(cuts, cuts[1:]):
                this = tuple(ids[lo].tolist())
                if this != held and rows:
                    solve(rows, sides, out)
                    rows, sides = [], []
                held = this
                rows.append(fps[lo:hi])
                sides.append(side[lo:hi])
            if out:
                yield _pairs(out)
        out = []
        if rows:
            solve(rows, sides, out)
        if out:
            yield _pairs(out)

    return dealt.mapInArrow(modest(run), "a binary, b binary")


def _pairs(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], names=["a", "b"])


# -- components ------------------------------------------------------------------------------------------------------


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """`nodes` (node, least) and undirected `edges` (a, b) -> node, component: the least value reachable.

    Each round takes the least value among neighbours; nodes then jump to the label of the node whose own value they hold, so
    rounds grow with the logarithm of a component's width. Sums are made before rows are dealt by node, and hot nodes are
    split by the engine's join, since links stay on the left.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(nodes.join(both.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("node", F.col("least").alias("label"), F.col("least").alias("own")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", "own", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        owner = stepped.groupBy("own").agg(F.min("label").alias("jump")).withColumnRenamed("own", "held")
        jumped = cut(stepped.join(owner, F.col("label").eqNullSafe(F.col("held")), "left").select(
            "node", "own", "old", F.least("label", F.coalesce("jump", "label")).alias("label")))
        moved = jumped.where("not (label <=> old)").limit(1).count()
        labels = jumped.select("node", "own", "label")
        if not moved:
            return labels.select("node", F.col("label").alias("component"))


def _hex(fp: Column) -> Column:
    return F.lower(F.hex(fp))


def linked_components(docs: DataFrame, size: int = 4, radius: int = 4, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of each row: the least doc_id reachable over links of at most `radius` bits."""
    prints = cut(fingerprints(docs, size))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    keys = exact_keys(radius)
    edges = cell_links(cell_rows(distinct, keys), radius, cell, keys)
    found = components(distinct.withColumnRenamed("fp", "node"), edges)
    own = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return prints.join(own, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def jaccard_links(docs: DataFrame, edges: DataFrame, size: int, similarity: float) -> DataFrame:
    """The edges whose two texts share at least `similarity` of their distinct shingles; docs (fp, text), one row per fp."""
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = pairs.join(docs.select(F.col("fp").alias("a"), F.col("text").alias("s")), "a").join(docs.select(F.col("fp").alias("b"), F.col("text").alias("t")), "b")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = set(shingles(s, size)), set(shingles(t, size))
            keep.append(len(x & y) >= similarity * len(x | y))
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("a", "b", "s", "t"), lambda: work, "a binary, b binary")


def _by_cell(dealt: DataFrame, solve, schema: str) -> DataFrame:
    """What ``solve(cell, rows)`` gives for the rows of each pair of chunks; rows start with table, key, i, j and lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        rows: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], 1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            for lo, hi in zip(cuts, cuts[1:]):
                this = tuple(ids[lo].tolist())
                if this != held and rows:
                    yield from solve(held, pa.Table.from_batches(rows))
                    rows = []
                held = this
                rows.append(batch.slice(lo, hi - lo))
        if rows:
            yield from solve(held, pa.Table.from_batches(rows))

    return dealt.mapInArrow(modest(run), schema)


def _apart(rows: pa.Table, table: int, keys: list[list[int]], radius: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The raw rows, and the pairs of places within the radius that are in two groups and meet in no table before this one.

    Rows have side and fp: `width` bytes of fingerprint first, the 16 bytes of the group last.
    """
    raw = rows.column("fp").to_pylist()
    fps, side = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), rows.column("side").to_numpy()
    words = np.ascontiguousarray(fps[:, :width]).view(">u8").astype(np.uint64)
    order = np.lexsort([*gray_rank(words).T[::-1], side])
    fps, side, words, n_left = fps[order], side[order], words[order], int((side == 0).sum())
    one = n_left in (0, len(fps))
    a, b, _ = links(words, None, radius) if one else links(words[:n_left], words[n_left:], radius)
    b = b if one else b + n_left
    group = np.unique(fps[:, -16:], axis=0, return_inverse=True)[1].reshape(-1)
    other = group[a] != group[b]
    a, b = a[other], b[other]
    bits = np.unpackbits(fps[:, :width], axis=1)
    for k in keys[:table]:
        value = bits[:, k].astype(np.int64) @ (1 << np.arange(len(k), dtype=np.int64))
        new = value[a] != value[b]
        a, b = a[new], b[new]
    return fps, side, a, b


def verified_links(a: np.ndarray, b: np.ndarray, group: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that pass, of the pairs (a, b) of places: enough of them to join all groups that any passing pair joins.

    Every pair is verified unless links that passed have joined its ends before.
    """
    root = list(range(int(group.max()) + 1))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    sizes = np.array([len(s) for s in sets])
    said, held = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    has = np.zeros(len(said), np.int64)
    out = []
    cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
    for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
        x = int(a[lo])
        mine = held[ends[x] - sizes[x] : ends[x]]
        has[mine] = 1
        for y in b[lo:hi].tolist():
            if top(int(group[x])) != top(int(group[y])):
                both = int(has[held[ends[y] - sizes[y] : ends[y]]].sum())
                if both >= similarity * (int(sizes[x]) + int(sizes[y]) - both):
                    root[top(int(group[x]))] = top(int(group[y]))
                    out.append((x, y))
        has[mine] = 0
    return out


def apart_links(
    nodes: DataFrame, texts: DataFrame, keys: list[list[int]], size: int, similarity: float, radius: int, width: int, cell: int = CELL, few: bool = False
) -> DataFrame:
    """Links that pass between groups: every two `nodes` (fp, group: 16 bytes) that share a cell, are within the radius and in two
    groups are verified on their distinct shingles, but for those joined by such links in the same task before -> a, b: groups.

    Fingerprints meet first; only those with such a partner get their shingles (`texts`: fp, text), and a pair counts in the first table it meets in.
    """
    cells = cell_rows(nodes.select(F.concat("fp", "group").alias("fp")), keys)
    dealt = _grid(_sized(cells, cut(_large(cells, cell)), few))

    def meet(at: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        fps, side, a, b = _apart(rows, at[0], keys, radius, width)
        named = np.unique(np.concatenate([a, b]))
        if len(named):
            whole = [fps[k].tobytes() for k in named.tolist()]
            ids = [pa.array(np.full(len(named), v), t) for v, t in zip(at, (pa.int32(), pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array(side[named], pa.int32()), pa.array(whole, pa.binary()), pa.array([w[:-16] for w in whole], pa.binary())],
                names=["table", "key", "i", "j", "side", "fp", "node"])

    met = cut(_by_cell(dealt, meet, "table int, key bigint, i int, j int, side int, fp binary, node binary"))

    def hashes(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [b"".join(sorted({xxhash.xxh64_digest(s, SEED) for s in shingles(t, size)})) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "said"])

    named = texts.join(met.select(F.col("node").alias("fp")).distinct(), "fp", "left_semi").select(F.col("fp").alias("node"), "text")
    sets = map_batches(named, lambda: hashes, "node binary, said binary")
    again = met.join(sets, "node").select("table", "key", "i", "j", "side", "fp", "said").repartition("table", "key", "i", "j").sortWithinPartitions("table", "key", "i", "j", "side")

    def verify(at: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        said = dict(zip(rows.column("fp").to_pylist(), rows.column("said").to_pylist()))
        fps, _, a, b = _apart(rows, at[0], keys, radius, width)
        sets = [np.frombuffer(said[f.tobytes()], np.uint64) for f in fps]
        group = np.unique(fps[:, -16:], axis=0, return_inverse=True)[1].reshape(-1)
        out = verified_links(a, b, group, sets, similarity)
        if out:
            yield _pairs([(fps[x, -16:].tobytes(), fps[y, -16:].tobytes()) for x, y in out])

    return _by_cell(again, verify, "a binary, b binary")


NEAR = {"bits": 128, "tables": 24, "width": 12, "radius": 32}
EXACT = 4


def _me() -> tuple[Column, Column]:
    """What names a row: its doc_id, or a negative number made from its text where that is NULL, and a hash of its text."""
    rid = F.coalesce(F.col("doc_id").cast("long"), -F.pmod(F.xxhash64(text_of()), F.lit(1 << 62)) - 1)
    return rid.alias("rid"), F.xxhash64(text_of()).alias("tid")


def _groups(docs: DataFrame, size: int, similarity: float, cell: int) -> DataFrame:
    """me (rid, tid) of each different row of `docs` and group, the me that stands for its group of near duplicates.

    128-bit fingerprints of the distinct shingles, whose similarity is what counts, meet in the cells of op10 (by pigeonhole, so that
    every link of at most EXACT bits is found) and in 24 tables of 12 drawn bits, where they link within 32 bits; links are then verified on the
    shingles themselves: first those of the cells' forests, then every candidate whose ends are still in two groups. Only texts with the same set of shingles are taken as one; different sets under one fingerprint are links like others.
    """
    keyed = docs.select(F.struct(*_me()).alias("me"), text_of().alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [set_print(t, size, NEAR["bits"] // 64) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], names=["me", "fp"])

    prints = cut(map_batches(keyed, lambda: work, "me struct<rid: bigint, tid: bigint>, fp binary"))
    distinct = cut(prints.groupBy("fp").agg(F.min("me").alias("least")))
    # few: at most 24 * 2 ** 12 cells, however many rows
    keys, width = drawn_keys(NEAR["tables"], NEAR["width"], NEAR["bits"]), NEAR["bits"] // 8
    # op10's own cells: whatever is within EXACT bits meets for certain; the drawn bits reach further, but by chance
    sure = exact_keys(EXACT, NEAR["bits"])
    certain = cell_links(cell_rows(distinct, sure), EXACT, cell, sure, width)
    edges = cut(certain.union(cell_links(cell_rows(distinct, keys), NEAR["radius"], cell, width=width, few=True)).distinct())
    ends = edges.select(F.col("a").alias("fp")).union(edges.select("b")).distinct()
    chosen = distinct.join(ends, "fp", "left_semi").select("fp", F.col("least").alias("me"))
    read = cut(chosen.join(keyed, "me").groupBy("fp").agg(F.min("text").alias("text")))
    found = components(distinct.withColumnRenamed("fp", "node"), jaccard_links(read, edges, size, similarity))
    own = cut(distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "least").alias("group")))
    named = F.concat(*[F.unhex(F.lpad(F.hex(F.col(f"group.{c}")), 16, "0")) for c in ("rid", "tid")])
    # the forests leave out links that hold where shorter ones joined their ends and then failed: those are verified here
    more = cut(apart_links(own.join(ends, "fp", "left_semi").select("fp", named.alias("group")), read, keys, size, similarity, NEAR["radius"], width, cell, few=True).distinct())
    if more.limit(1).count():
        groups = own.select(named.alias("node"), F.col("group").alias("least")).distinct()
        joined = components(groups, more).withColumnRenamed("component", "joined")
        own = own.withColumn("node", named).join(joined, "node", "left").select("fp", F.coalesce("joined", "group").alias("group"))
    return prints.join(own, "fp").groupBy("me").agg(F.min("group").alias("group"))


def near_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, cell: int = CELL) -> DataFrame:
    """Columns of `docs` with `near_group`, the least doc_id of the documents linked by a similarity of at least `similarity`, and
    `near_first`, true for the row that stands for its group (of equal rows, for each). The links are those of `_groups`.

    A document without doc_id goes by a negative number made from its text. Columns named like the new ones are replaced.
    """
    of_doc = _groups(docs, size, similarity, cell)
    joined = docs.withColumn("__me", F.struct(*_me())).join(of_doc.withColumnRenamed("me", "__me").withColumnRenamed("group", "__group"), "__me")
    return with_new(joined, near_group=F.col("__group.rid"), near_first=F.col("__me") == F.col("__group")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("near_group", "near_first")], "near_group", "near_first", "__me")


def one_of_each(docs: DataFrame, size: int = 5, similarity: float = 0.8, cell: int = CELL) -> DataFrame:
    """`docs` with one document of each group of near duplicates: the one with the least doc_id. Of repeated rows one stays.

    Who stays is settled without the texts, which are then dealt once, by what names a row, for the lookup and for repeated rows alike.
    """
    first = _groups(docs, size, similarity, cell).where("me = group").select(F.col("me.rid").alias("__rid"), F.col("me.tid").alias("__tid"))
    rid, tid = _me()
    named = docs.select("*", rid.alias("__rid"), tid.alias("__tid")).repartition("__rid", "__tid")
    kept = named.join(first, ["__rid", "__tid"], "left_semi").dropDuplicates(["__rid", "__tid"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("near_group", "near_first")])
