"""Runs of repeating words, found by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are identical), of at least max(LEAST, REPEATS * q) words, that no
neighbouring word extends. Documents are taken in bounded blocks, one after the other; words of different documents never match.

Prefix doubling gives every place the rank of its next 1, 2, 4, ... words, and in the end the suffix array. A run of period q, 2**k <= q < 2**(k+1),
holds a whole dyadic block of 2**k words that occurs again q words on, so each dyadic block asks for its occurrences in the window
from 2**k to 2**(k+1) - 1 words on (blocks of 8 words also ask nearer by, for the small periods). Its suffixes are one interval of the suffix array,
and a wavelet matrix over the array gives the successors of a place in that interval. Up to two occurrences are candidates themselves. Three or
more so close together are an arithmetic progression, whose difference p is a period of the block: a longer period has to map the end of the
p-periodic stretch around the block onto the end of the one around the progression, on one side at least, which leaves two candidates.
Every candidate is extended in both directions by the ranks and kept if it is long enough; of several periods of one stretch, the least
is the run's.

NULL and empty texts have no words and no runs; a text without blanks is one word. Texts are taken whole and each one's ranks are held at once (4 bytes a
word for each doubling), so a text has to fit in a task's memory. Repeated rows and ties give a row each. Columns other than doc_id and text
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import blocks, text_of
from eventcanon.llm.decontaminate import Wavelet

LEAST, REPEATS = 24, 3
#: Words of the smallest dyadic block: a run of LEAST words holds one that occurs again within its length.
SMALLEST = 3
BLOCK_CHARS = 3_000_000


class Doubling:
    """Ranks of each place's next 2**k words, within its document, until all differ.

    A rank is the number of places before its class in the suffix array, so that a class is an interval of the array. A word that
    is no part of a document's last 2**k words has no place to be mistaken for: stretches that reach a document's end are unique.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        """`ends`: where each document ends, ascending."""
        self.n = n = len(symbols)
        lengths = np.diff(np.concatenate(([0], ends)))
        end = np.repeat(ends, lengths)
        key = np.repeat(np.arange(len(ends)), lengths) * (int(symbols.max(initial=0)) + 1) + symbols
        self.places, rank = np.arange(n), np.zeros(n, np.int32)
        self.ranks, self.starts, self.sizes, self.open = [], [], [], []
        self._classes(key, np.zeros(n, np.int64), rank)
        step = 1
        while len(self.places):
            rank = rank.copy()
            after = self.places + step
            known = after < end[self.places]
            second = np.where(known, self.ranks[-1][np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
            of = self.ranks[-1][self.places].astype(np.int64)
            self._classes(of * (n + 1) + second, of, rank)
            step *= 2

    def _classes(self, key: np.ndarray, of: np.ndarray, rank: np.ndarray) -> None:
        """Parts the classes `of` by `key`; places alone in their class are settled and leave."""
        order = np.argsort(key, kind="stable")
        places, key, of = self.places[order], key[order], of[order]
        at = np.arange(len(key))
        begins = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        whole = np.concatenate(([True], of[1:] != of[:-1])) if len(key) else np.zeros(0, bool)
        first = np.maximum.accumulate(np.where(begins, at, 0))
        rank[places] = of + first - np.maximum.accumulate(np.where(whole, at, 0))
        size = np.diff(np.concatenate((np.flatnonzero(begins), [len(key)])))[np.cumsum(begins) - 1] if len(key) else at
        several = size > 1
        self.places = places[several]
        self.ranks.append(rank)
        self.open.append(self.places)
        self.sizes.append(size[several])

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places a and b on are the same (a < b)."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            i, j = a + out, b + out
            inside = j < self.n
            out += ((self.ranks[k][np.where(inside, i, 0)] == self.ranks[k][np.where(inside, j, 0)]) & inside).astype(np.int64) << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before places a and b are the same (a < b)."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            i, j = a - out - (1 << k), b - out - (1 << k)
            inside = i >= 0
            out += ((self.ranks[k][np.where(inside, i, 0)] == self.ranks[k][np.where(inside, j, 0)]) & inside).astype(np.int64) << k
        return out


class Successors(Wavelet):
    """Wavelet matrix that finds the values of an interval in ascending order."""

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many entries of each interval are below a value."""
        lo, hi, out = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for level in range(self.levels):
            bit = ((value >> (self.levels - 1 - level)) & 1).astype(bool)
            ones_lo, ones_hi = self.ones(level, lo), self.ones(level, hi)
            out += np.where(bit, (hi - lo) - (ones_hi - ones_lo), 0)
            lo = np.where(bit, self.zeros[level] + ones_lo, lo - ones_lo)
            hi = np.where(bit, self.zeros[level] + ones_hi, hi - ones_hi)
        return out

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th least entry (from 0) of each interval."""
        lo, hi, n, out = lo.copy(), hi.copy(), n.copy(), np.zeros(len(lo), np.int64)
        for level in range(self.levels):
            ones_lo, ones_hi = self.ones(level, lo), self.ones(level, hi)
            zeros = (hi - lo) - (ones_hi - ones_lo)
            bit = n >= zeros
            n -= np.where(bit, zeros, 0)
            out = (out << 1) | bit
            lo = np.where(bit, self.zeros[level] + ones_lo, lo - ones_lo)
            hi = np.where(bit, self.zeros[level] + ones_hi, hi - ones_hi)
        return out


def candidates(ranks: Doubling) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that may belong to a run."""
    none = np.zeros(0, np.int64)
    if len(ranks.open) <= SMALLEST or not len(ranks.open[SMALLEST]):
        return none, none
    # Only stretches of eight words that occur again in their document matter; they are a union of intervals of the suffix array.
    held = np.sort(ranks.open[SMALLEST])
    by_rank = ranks.ranks[-1][held]
    order = np.argsort(by_rank)
    array, rank_of = order, by_rank[order]  # numbers of held places in suffix order
    tree = Successors(array.astype(np.int64), len(held) + 1)
    places, periods = [], []
    for k in range(SMALLEST, len(ranks.open)):
        block = 1 << k
        dyadic = ranks.open[k] % block == 0
        starts, sizes = ranks.open[k][dyadic].astype(np.int64), ranks.sizes[k][dyadic]
        if not len(starts):
            continue
        lo = np.searchsorted(rank_of, ranks.ranks[k][starts])
        for near, far in ([(1, block)] if k == SMALLEST else []) + [(block + (k == SMALLEST), 2 * block - 1)]:
            least, most = np.searchsorted(held, starts + near), np.searchsorted(held, starts + far, side="right")
            before = tree.below(lo, lo + sizes, least)
            count = tree.below(lo, lo + sizes, most) - before
            found = np.flatnonzero(count)
            b, low, high, before, count = starts[found], lo[found], (lo + sizes)[found], before[found], count[found]
            one = held[tree.nth(low, high, before)]
            places.append(b)
            periods.append(one - b)
            more = count > 1
            b, one, low, high, before, count = b[more], one[more], low[more], high[more], before[more], count[more]
            two = held[tree.nth(low, high, before + 1)]
            places.append(b)
            periods.append(two - b)
            row = count > 2
            b, one, step = b[row], one[row], (two - one)[row]
            for shift in (ranks.forward(one, one + step) - ranks.forward(b, b + step), ranks.backward(b, b + step) - ranks.backward(one, one + step)):
                period = one - b + shift
                fits = (period >= near) & (period <= far)
                places.append(b[fits])
                periods.append(period[fits])
    return np.concatenate(places or [none]), np.concatenate(periods or [none])


def runs(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs in documents that lie one after the other, by start and period."""
    ranks = Doubling(symbols, ends)
    at, period = candidates(ranks)
    if not len(at):
        return at, at, at
    start = at - ranks.backward(at, at + period)
    stop = at + period + ranks.forward(at, at + period)
    long = stop - start >= np.maximum(LEAST, REPEATS * period)
    start, stop, period = start[long], stop[long], period[long]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    least = np.concatenate(([True], (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])))[: len(start)]
    start, stop, period = start[least], stop[least], period[least]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def words_of(text: str) -> list[bytes]:
    """Words are what lies between blanks, tabs and line ends of ASCII."""
    return text.encode("utf-8", "replace").split()


RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"doc_id bigint, n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run (start, length, period) with the greatest length by period; ties go to the smallest start, then period."""
    return max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def periodic_runs(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document: doc_id, n_words, runs (by start, then period), strongest (NULL without runs), and collapsed, the text with
    each run cut down to its first period, its words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in blocks(texts, block_chars):
                words = [words_of(t) for t in texts[lo:hi]]
                counts = np.array([len(w) for w in words])
                number: dict[bytes, int] = {}
                symbols = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, int(counts.sum()))
                ends = np.cumsum(counts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in words]
                begin, stop, period = runs(symbols, ends)
                owner = np.searchsorted(ends, begin, side="right")
                for d, s, e, q in zip(owner.tolist(), begin.tolist(), stop.tolist(), period.tolist()):
                    found[d].append((s - int(ends[d] - counts[d]), e - s, q))
                collapsed = []
                for ws, rs in zip(words, found):
                    keep = np.ones(len(ws), bool)
                    for s, length, q in rs:
                        keep[s + q : s + length] = False
                    collapsed.append(b" ".join([w for w, k in zip(ws, keep) if k] if rs else ws))
                as_rows = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found]
                best = [dict(zip(("start", "length", "period"), b)) if (b := strongest(rs)) else None for rs in found]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(as_rows, pa.list_(schema)), pa.array(best, schema), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, FOUND)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a repeating end planted in about one document of ten, as its doc_id's crc32 says.

    A NULL doc_id counts as the empty text there.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), h.alias("h"))
    chosen = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, r'[^\x20\x09-\x0D]+', 0)")))
    chosen = chosen.withColumns({"n": F.size("words").cast("long"), "g": F.expr("h div 10")})
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    chosen = chosen.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns for each document with planted repetitions, and the words of each."""
    found = periodic_runs(planted(docs))
    said = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(said, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
