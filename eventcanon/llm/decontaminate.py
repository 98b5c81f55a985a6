"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded block of documents. Its text is a sequence of word numbers: words of the benchmark are numbered, all
others are one separator, and stretches of benchmark words shorter than the shortest window become separators too, since no
window fits there. The FM-index of the shard holds the Burrows-Wheeler transform in a wavelet matrix, word counts, and the suffix
positions of every SAMPLE-th place of the text. All windows are searched backwards together through wavelet ranks; occurrences are
located by stepping to a sampled place, and the spans found are merged into removal spans.

The benchmark is written to the shared folder once. Every task reads it from there as a stream of blocks of at most BLOCK_CHARS characters (or one
item): first to learn which of its shard's words the benchmark asks for, then, with the shard's index built, to search block by
block. So the index is built once, one block is held at a time, and the plan is one pass for a benchmark of any size. A
benchmark of one block is kept by the task.

NULL text has no words; items without words have no windows; a NULL item_id is written as an empty string; repeated items
count once for each item_id. One row comes out per row that went in. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import modest, parts, shared_folder, text_of, with_new

WINDOW = 10
SAMPLE = 16
SHARD_CHARS = 4_000_000
BLOCK_CHARS = 4_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing
#: UTF-8 bytes: A-Z lower-cased, all that is in no word turned into a space.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(TO_WORDS).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places of `symbols` in the order of the suffixes that start there, by prefix doubling; the last symbol is the least and unique."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class Wavelet:
    """A wavelet matrix: ranks of any symbol in time proportional to the bits of the alphabet."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n, self.levels = len(symbols), max(1, int(n_symbols - 1).bit_length())
        self.bits, self.upto, self.zeros = [], [], []
        at = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = ((at >> level) & 1).astype(np.uint8)
            packed = np.zeros(-(-(self.n + 1) // 64) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view("<u8")
            self.bits.append(words)
            self.upto.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))))
            self.zeros.append(int(self.n - bit.sum()))
            at = np.concatenate((at[bit == 0], at[bit == 1]))

    def ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word, part = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << part) - np.uint64(1)
        return self.upto[level][word] + np.bitwise_count(self.bits[level][word] & mask)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before place i."""
        lo = np.zeros(len(i), np.int64)
        hi = i.astype(np.int64)
        for level in range(self.levels):
            bit = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            ones_lo, ones_hi = self.ones(level, lo), self.ones(level, hi)
            lo = np.where(bit, self.zeros[level] + ones_lo, lo - ones_lo)
            hi = np.where(bit, self.zeros[level] + ones_hi, hi - ones_hi)
        return hi - lo

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places i, and how often each occurs before its place."""
        symbol, lo, hi = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64), i.astype(np.int64)
        for level in range(self.levels):
            bit = ((self.bits[level][hi >> 6] >> (hi & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            symbol = (symbol << 1) | bit
            ones_lo, ones_hi = self.ones(level, lo), self.ones(level, hi)
            lo = np.where(bit, self.zeros[level] + ones_lo, lo - ones_lo)
            hi = np.where(bit, self.zeros[level] + ones_hi, hi - ones_hi)
        return symbol, hi - lo


class FMIndex:
    """Full-text index of a sequence of numbers from 1 on; number 0 ends it."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        text = np.concatenate((symbols, [0])).astype(np.int64)
        order = suffix_array(text)
        self.n = len(text)
        self.wavelet = Wavelet(text[order - 1], n_symbols)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        self.kept = order % SAMPLE == 0
        self.kept_before = np.concatenate(([0], np.cumsum(self.kept)))
        self.samples = order[self.kept]

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the windows (right-aligned in the array), found from their last symbol backwards."""
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), self.n, np.int64)
        for step in range(windows.shape[1]):
            live = np.flatnonzero((lengths > step) & (lo < hi))
            if not len(live):
                break
            symbol = windows[live, windows.shape[1] - 1 - step]
            lo[live], hi[live] = self.below[symbol] + self.wavelet.rank(symbol, lo[live]), self.below[symbol] + self.wavelet.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of index rows: steps back to a sampled place."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            known = self.kept[at[live]]
            done = live[known]
            out[done] = self.samples[self.kept_before[at[done]]] + steps[done]
            live = live[~known]
            symbol, before = self.wavelet.access(at[live])
            at[live] = self.below[symbol] + before
            steps[live] += 1
        return out


class Phrases:
    """The windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            ws = words_of(text)
            for i in range(max(1, len(ws) - window + 1) if ws else 0):
                found.setdefault(tuple(ws[i : i + window]), set()).add(item)
        self.window, self.windows, self.items = window, list(found), list(found.values())
        self.words = {w for ws in found for w in ws}
        self.shortest = min(map(len, found), default=0)


class Shard:
    """The texts of a shard, an FM-index over their words that the benchmark asks for, and what is found in them."""

    def __init__(self, texts: list[str]):
        per_doc = [words_of(t) for t in texts]
        self.counts = np.array([len(w) for w in per_doc], np.int64)
        self.number: dict[bytes, int] = {b"": 0}  # no word: the end of a text
        setdefault = self.number.setdefault
        self.ids = np.fromiter((setdefault(w, len(self.number)) for ws in per_doc for w in (*ws, b"")), np.int64, int(self.counts.sum()) + len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.counts + 1)))
        self.asked = np.zeros(len(self.number), bool)
        self.shortest = 0
        self.index: FMIndex | None = None
        self.cover = np.zeros(len(self.ids) + 1, np.int64)
        self.items: list[set[str]] = [set() for _ in texts]

    def ask(self, phrases: Phrases) -> None:
        if phrases.shortest:
            self.shortest = min(self.shortest or phrases.shortest, phrases.shortest)
            get = self.number.get
            self.asked[[k for k in (get(w) for w in phrases.words) if k]] = True

    def build(self) -> None:
        """The index over the stretches of words asked for that are long enough for a window."""
        if not self.shortest:
            return
        inside = np.concatenate(([False], self.asked[self.ids], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        starts, lengths = starts[long], (ends - starts)[long]
        if not len(starts):
            return
        to = np.concatenate(([0], np.cumsum(lengths + 1)))
        before = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        run = np.arange(lengths.sum())
        spots, source = run + np.repeat(to[:-1] - before, lengths), run + np.repeat(starts - before, lengths)
        self.symbol = np.zeros(len(self.number), np.int64)  # 1 is the separator, words asked for start at 2
        self.symbol[self.asked] = np.arange(2, 2 + self.asked.sum())
        symbols, self.place = np.ones(to[-1], np.int64), np.zeros(to[-1], np.int64)
        symbols[spots], self.place[spots] = self.symbol[self.ids[source]], source
        self.index = FMIndex(symbols, int(self.asked.sum()) + 2)

    def search(self, phrases: Phrases) -> None:
        if self.index is None or not phrases.windows:
            return
        get = self.number.get
        known = [(k, [get(w, 0) for w in ws]) for k, ws in enumerate(phrases.windows)]
        known = [(k, ws) for k, ws in known if all(ws)]
        if not known:
            return
        lengths = np.array([len(ws) for _, ws in known], np.int64)
        windows = np.zeros((len(known), phrases.window), np.int64)
        for r, (_, ws) in enumerate(known):
            windows[r, phrases.window - len(ws) :] = self.symbol[ws]
        lo, hi = self.index.search(windows, lengths)
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return
        many = hi[hit] - lo[hit]
        window = np.repeat(hit, many)
        rows = np.arange(many.sum()) + np.repeat(lo[hit] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
        begin = self.place[self.index.locate(rows)]
        np.add.at(self.cover, begin, 1)
        np.add.at(self.cover, begin + lengths[window], -1)
        owner = np.searchsorted(self.first, begin, side="right") - 1
        for p in np.unique(owner * len(known) + window).tolist():
            self.items[p // len(known)].update(phrases.items[known[p % len(known)][0]])

    def found(self) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: number of words, merged spans of words (end exclusive), items found, sorted."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.items]
        covered = np.concatenate(([False], np.cumsum(self.cover[:-1]) > 0, [False]))
        turns = np.flatnonzero(covered[1:] != covered[:-1])
        owner = np.searchsorted(self.first, turns[::2], side="right") - 1
        for d, a, b in zip(owner.tolist(), turns[::2].tolist(), turns[1::2].tolist()):
            spans[d].append((a - int(self.first[d]), b - int(self.first[d])))
        return list(zip(self.counts.tolist(), spans, map(sorted, self.items)))


def scan(texts: list[str], blocks_of: Callable[[], Iterable[Phrases]]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """What `Shard.found` gives for the texts and all blocks of the benchmark."""
    shard = Shard(texts)
    for phrases in blocks_of():
        shard.ask(phrases)
    shard.build()
    if shard.index is not None:
        for phrases in blocks_of():
            shard.search(phrases)
    return shard.found()


def stored(benchmark: DataFrame) -> list[str]:
    """Files in the shared folder with the benchmark's items and texts."""
    spark = benchmark.sparkSession
    path = f"{shared_folder(spark)}/benchmark/{uuid.uuid4().hex}"
    benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), text_of().alias("t")).write.parquet(path)
    return sorted(spark.read.parquet(path).inputFiles())


def benchmark_blocks(files: list[str], most: int = BLOCK_CHARS) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size, read as they are needed."""
    held, size = [], 0
    for file in files:
        system, path = pafs.FileSystem.from_uri(file)
        with system.open_input_file(path) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(batch_size=256):
                for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if held and size + len(text) > most:
                        yield held
                        held, size = [], 0
                    held.append((item, text))
                    size += len(text)
    if held:
        yield held


class Blocks:
    """The benchmark's blocks of windows, again and again; kept where there is but one."""

    def __init__(self, files: list[str], most: int, window: int):
        self.files, self.most, self.window = files, most, window
        self.only: Phrases | None = None

    def __call__(self) -> Iterator[Phrases]:
        if self.only is not None:
            yield self.only
            return
        n, phrases = 0, None
        for items in benchmark_blocks(self.files, self.most):
            n, phrases = n + 1, Phrases(items, self.window)
            yield phrases
        self.only = phrases if n == 1 else None


FOUND = "n_words bigint, starts array<int>, ends array<int>, items array<string>"


def find_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Columns of `docs` (of plain types) with n_words, starts and ends (merged spans of words) and items (ids found, as text, sorted).

    Columns of those names are replaced.
    """
    none = F.array().cast("array<int>")
    schema = with_new(docs, n_words=F.lit(None).cast("long"), starts=none, ends=none, items=F.array().cast("array<string>")).schema
    names = schema.names
    kept = docs.select(*[F.col(f"`{c}`") for c in names[:-4]])

    def rows(part: pa.RecordBatch, found: list[tuple[int, list[tuple[int, int]], list[str]]]) -> pa.RecordBatch:
        new = [
            pa.array([n for n, _, _ in found], pa.int64()), pa.array([[a for a, _ in s] for _, s, _ in found], pa.list_(pa.int32())),
            pa.array([[b for _, b in s] for _, s, _ in found], pa.list_(pa.int32())), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    return _shards(kept, benchmark, window, block_chars, shard_chars, rows, schema)


def _shards(docs: DataFrame, benchmark: DataFrame, window: int, block_chars: int, shard_chars: int, rows, schema) -> DataFrame:
    """What ``rows(part, found)`` makes of each shard of `docs`."""
    at = [c.lower() for c in docs.columns].index("text")
    files = stored(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_of = Blocks(files, block_chars, window)
        for batch in batches:
            for part in parts(batch, at, shard_chars):
                yield rows(part, scan([t or "" for t in part.column(at).to_pylist()], blocks_of))

    return docs.mapInArrow(modest(run), schema)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the characters from the first to the last word of each span, and without the space left at the cut."""
    if not spans:
        return text
    at = [m.span() for m in WORD.finditer(text)]
    out, start = [], 0
    for a, b in spans:
        out.append(text[start : at[a][0]].rstrip(" "))
        start = at[b - 1][1]
    return "".join([*out, text[start:]]).strip(" ")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the passages of the benchmark; documents of which no word is left go. Columns stay as they are."""
    names = docs.columns
    at = [c.lower() for c in names].index("text")

    def rows(part: pa.RecordBatch, found: list[tuple[int, list[tuple[int, int]], list[str]]]) -> pa.RecordBatch:
        keep = [not spans or sum(b - a for a, b in spans) < n for n, spans, _ in found]
        texts = [without_spans(t, spans) if spans else t for t, (_, spans, _) in zip(part.column(at).to_pylist(), found)]
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(part.columns)]
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return _shards(docs.select(*[F.col(f"`{c}`") for c in names]), benchmark, window, BLOCK_CHARS, SHARD_CHARS, rows, docs.schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The contract's columns for each document, and the removal spans as ``start:end`` in words."""
    found = find_phrases(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), benchmark, window)
    hits = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
        F.array_join(F.zip_with("starts", "ends", lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string"))), ",").alias("spans"),
    )


def items_digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
