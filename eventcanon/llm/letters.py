"""Characters as a small alphabet, and counts of character trigrams over a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import modest, parts, text_of

OTHER, SIZE = 63, 64


def _alphabet() -> np.ndarray:
    """0: no letter; 1-26: a-z; then the small letters of Latin-1. Beyond Latin-1, see `codes`."""
    out = np.zeros(256, np.uint8)
    out[97:123] = np.arange(1, 27)
    small = [c for c in range(0xDF, 0x100) if c != 0xF7]
    out[small] = np.arange(27, 27 + len(small))
    return out


ALPHABET = _alphabet()


def codes(text: str) -> np.ndarray:
    """A code for each character of lower-cased text, with one 0 for each stretch of other characters and at both ends.

    Letters beyond Latin-1 share the codes from 58 on by their place; anything there counts as a letter.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(len(points) + 2, np.uint8)
    out[1:-1] = ALPHABET[np.minimum(points, 255)]
    far = points > 255
    if far.any():
        out[1:-1][far] = 58 + points[far] % (SIZE - 58)
    return out[~((out == 0) & (np.concatenate(([1], out[:-1])) == 0))]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """code, n: how often each character trigram occurs in all texts. At most SIZE ** 3 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for part in parts(batch, 0, 2_000_000):
                c = codes("\n".join(part.column(0).to_pylist())).astype(np.int32)
                total += np.bincount((c[:-2] << 12) | (c[1:-1] << 6) | c[2:], minlength=SIZE**3)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    counted = docs.select(text_of().alias("text")).mapInArrow(modest(run), "code int, n bigint")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def log_probabilities(counts: np.ndarray, weight: float = 8.0) -> np.ndarray:
    """Log probability of a character after two others, each order smoothed by the one below; `counts` has SIZE ** 3 numbers."""
    three = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + weight * p1) / (two.sum(axis=1, keepdims=True) + weight)
    p3 = (three + weight * p2[None]) / (three.sum(axis=2, keepdims=True) + weight)
    return np.log(p3)
