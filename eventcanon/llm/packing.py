"""Sequences of at most CAPACITY tokens, packed by exact complements and best fit.

Documents become pieces: token ids by a public tokenizer, an end id after each document, and only documents longer than a sequence are
cut, into whole sequences and a first piece that may be shorter. What is packed are lengths, of which there are at most CAPACITY
different ones, so the plan is made from how many pieces have each length and does not grow with the data. A sequence is begun with the
longest length left. The index of complements says for the gap that is left whether one, two or three lengths sum up to
it; while none do, the longest length that fits is put in (best fit). The pattern found is used as often as its lengths are
available. Pieces of a length are then numbered, in buckets of bounded size, at least LEAST_BUCKETS a length, and the number says which pattern's place a piece takes.

Every pattern but for ties uses up the length that bounds it, or leaves less than half of it, so there are at most CAPACITY * log2(pieces) patterns
of at most sqrt(2 * CAPACITY) lengths: that bounds the plan on the driver and its broadcast (a few thousand places on the given tables).

NULL and empty texts are one end id. Repeated rows are pieces of their own. Ties are decided by the rows' places in the table, so
which of two pieces of one length goes where is arbitrary; lengths, counts and ids are not. An empty table gives no sequences.
A NULL doc_id stays. Very long texts are encoded whole. Columns named like a result column are replaced.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventcanon.llm.common import cut, modest, parts, text_of

CAPACITY = 2048
END_ID = 0
PART_BYTES = 4_000_000
BUCKET_ROWS = 50_000
LEAST_BUCKETS = 32
#: Fixed value: where byte-level tokenizers of this kind cut a text before they merge bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts by a tokenizer's file, special tokens taken as text.

    A byte-level file whose merges are numbered in the order they are made gives the same ids through ranks of byte strings, some four times
    faster. Other files, and texts that overflow that way's matcher (very long runs of blanks), go through the tokenizer itself.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.end = np.array([end_id], np.uint32)
        self.ranked = self._ranked(json.loads(self.tokenizer.to_str()))

    @staticmethod
    def _ranked(file: dict):
        import tiktoken

        model, cut = file["model"], file.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or file.get("normalizer") or file.get("post_processor") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        byte = byte_of_character()
        added = {t["content"] for t in file.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # the matcher's stack
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id after it, and where each text ends."""
        found = [a for t in texts for a in (self.ids(t), self.end)]
        ends = np.cumsum([len(a) for a in found], dtype=np.int64)[1::2]
        return (np.concatenate(found) if found else self.end[:0]).astype("<u4"), ends


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids: each document's pieces of at most `capacity` tokens.

    `tokenizer` is the path of a byte-level tokenizer's file, the same on all executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end_id)
        for batch in batches:
            for part in parts(batch, 1, PART_BYTES):
                ids, ends = encoder.encode(part.column(1).to_pylist())
                out = []
                begin = 0
                for doc_id, end in zip(part.column(0).to_pylist(), ends.tolist()):
                    cuts = [begin, *range(begin + (end - begin - 1) % capacity + 1, end + 1, capacity)]
                    out += [(doc_id, k, a - begin, b - a, zlib.crc32(ids[a:b].tobytes()), a) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                    begin = end
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                if keep_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array([*columns[5], begin], pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return read.mapInArrow(modest(run), PIECES + (", ids array<int>" if keep_ids else ""))


class Complements:
    """Which one, two or three lengths that are left sum up to a gap.

    For each sum the index holds the longest member that may still have a partner. Counts only fall, so what is out stays out, and
    looking up all sums costs no more than the index has entries.
    """

    def __init__(self, counts: list[int]):
        self.left = counts
        self.two = [s - 1 for s in range(len(counts))]
        self.three = [s - 2 for s in range(len(counts))]

    def free(self, length: int, used: dict[int, int]) -> int:
        return self.left[length] - used.get(length, 0)

    def pair(self, total: int, used: dict[int, int]) -> tuple[int, ...] | None:
        least = -(-total // 2)
        for a in range(self.two[total], least - 1, -1):
            b = total - a
            if not self.left[a] or not self.left[b] or (a == b and self.left[a] < 2):
                if a == self.two[total]:
                    self.two[total] = a - 1
            elif self.free(a, used) > (a == b) and self.free(b, used) > 0:
                return a, b
        return None

    def triple(self, total: int, used: dict[int, int]) -> tuple[int, ...] | None:
        for a in range(self.three[total], -(-total // 3) - 1, -1):
            rest = total - a
            if not self.left[a] or self.two[rest] < -(-rest // 2):
                if a == self.three[total]:
                    self.three[total] = a - 1
            elif self.free(a, used) > 0:
                found = self.pair(rest, {**used, a: used.get(a, 0) + 1})
                if found:
                    return a, *found
        return None

    def exact(self, gap: int, used: dict[int, int], most: int = 3) -> tuple[int, ...] | None:
        """Up to `most` lengths that fill the gap: one if possible, else two, else three."""
        if most and self.free(gap, used) > 0:
            return (gap,)
        return (self.pair(gap, used) if most > 1 else None) or (self.triple(gap, used) if most > 2 else None)


def patterns(counts: list[int], most: int = 3) -> Iterator[tuple[dict[int, int], int]]:
    """Sequences for counts[length] pieces of each length up to the capacity (the last index): how often each length is in a sequence,
    and how many sequences are like that. Up to `most` lengths may complete one exactly; with 0 it is best fit alone."""
    left = list(counts)
    index = Complements(left)
    longest = len(left) - 1

    def fitting(most: int, used: dict[int, int]) -> int:
        while most > 0 and index.free(most, used) <= 0:
            most -= 1
        return most

    while True:
        while longest > 0 and not left[longest]:
            longest -= 1
        if not longest:
            return
        used, gap, last = {longest: 1}, len(left) - 1 - longest, longest
        while gap:
            found = index.exact(gap, used, most)
            if found is None:
                last = fitting(min(gap, last), used)
                if not last:
                    break
                found = (last,)
            for length in found:
                used[length] = used.get(length, 0) + 1
                gap -= length
        times = min(left[length] // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
        yield used, times


@dataclass
class Places:
    """Which place the pieces of one length take, by their number: from `first` on, `each` in a sequence, from `offset` on."""

    first: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)


def plan(counts: list[int]) -> tuple[dict[int, Places], int]:
    """The places of the pieces of each length, and the number of sequences.

    Where nearly all lengths are over half a sequence, triples use up short lengths too soon; so fewer at a time are tried as well, and the
    plan of fewest sequences is taken.
    """
    best = min((list(patterns(counts, most)) for most in (3, 2, 1, 0)), key=lambda found: sum(times for _, times in found))
    out: dict[int, Places] = {}
    given = [0] * len(counts)
    sequences = 0
    for used, times in best:
        offset = 0
        for length in sorted(used, reverse=True):
            at = out.setdefault(length, Places())
            at.first.append(given[length])
            at.sequence.append(sequences)
            at.each.append(used[length])
            at.offset.append(offset)
            given[length] += used[length] * times
            offset += used[length] * length
        sequences += times
    return out, sequences


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`items` with sequence_id (gapless from 0) and offset (place in the sequence, gapless from 0).

    `length` names a column of numbers from 1 to `capacity`; others make the job fail.
    """
    spark = items.sparkSession
    fits = F.col(f"`{length}`").cast("long").between(1, capacity)
    size = F.when(fits, F.col(f"`{length}`").cast("int")).otherwise(F.raise_error(F.lit(f"a length is not between 1 and {capacity}")).cast("int"))
    names = [c for c in items.columns if c.lower() not in ("sequence_id", "offset")]
    rows = cut(items.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("item"), size.alias("size"), F.monotonically_increasing_id().alias("pos")))
    counts = [0] * (capacity + 1)
    for r in rows.groupBy("size").count().collect():  # at most `capacity` rows
        counts[r["size"]] = r["count"]
    placed, _ = plan(counts)
    shared = spark.sparkContext.broadcast({k: [np.array(c, np.int64) for c in (p.first, p.sequence, p.each, p.offset)] for k, p in placed.items()})

    buckets = max(LEAST_BUCKETS, sum(counts) // bucket_rows)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("pos"), F.lit(buckets)))
    own = Window.partitionBy("size", "bucket").orderBy("pos")
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n")).select("size", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    numbered = dealt.withColumn("nth", F.row_number().over(own)).join(starts, ["size", "bucket"])
    numbered = numbered.select("item", "size", (F.col("begin") + F.col("nth") - 1).cast("long").alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value
        for batch in batches:
            sizes, number = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for s in np.unique(sizes).tolist():
                rows_of = np.flatnonzero(sizes == s)
                first, begins, each, at = where[s]
                k = np.searchsorted(first, number[rows_of], side="right") - 1
                over = number[rows_of] - first[k]
                sequence[rows_of], offset[rows_of] = begins[k] + over // each[k], at[k] + over % each[k] * s
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)], names=["item", "sequence_id", "offset"])

    item = rows.select("item").schema
    out = numbered.mapInArrow(modest(place), item.add("sequence_id", "long").add("offset", "long"))
    return out.select(*[F.col("item").getField(c).alias(c) for c in names], "sequence_id", "offset")


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """sequence_id, ids, doc_ids: the packed sequences themselves, from pieces that kept their ids. No sequence holds more than a capacity."""
    held = F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids"), "doc_id")))
    whole = packed.groupBy("sequence_id").agg(held.alias("held"))
    return whole.select("sequence_id", F.flatten(F.transform("held", lambda p: p["ids"])).alias("ids"), F.transform("held", lambda p: p["doc_id"]).alias("doc_ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Each document's pieces with the sequence and the place in it that they take."""
    return pack(pieces(docs, tokenizer, capacity, end_id, keep_ids), "length", capacity)
