"""Language identification with string kernels.

Two texts are as alike as the character n-grams (n = 1 to 3, a blend of spectra) that both hold: shared n-grams over the root of the product of
how many each holds. N-grams are of the letters (and combining marks) of any script, lower-cased, by code point, with one gap for each stretch of other
characters, and are numbered by a hash of GRAM_BITS bits. Landmark texts, LANDMARKS for each language, stand for the rest (Nyström); one-versus-rest kernel ridge regression
gives each language's weight of each landmark. Documents are scored in blocks: presence vectors times the landmarks' presence vectors, then times
the weights.

Languages are learned from rows whose crc32(doc_id as text) mod 4 is not 2 and whose lang is not NULL, at most SAMPLE rows
for each language, those with the least hash of doc_id and text; rows with the same doc_id, text and lang count once. Documents with NULL text or without a letter are `und` with score 0, as
is every document if nothing can be learned. Repeated rows get the same answer; other columns are not read.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventcanon.llm.common import learning_rows, map_batches, remainder, text_of

MODULUS, HELD_OUT = 4, 2
SAMPLE, LANDMARKS = 300, 32
RIDGE = 1e-3
BLOCK = 64
GRAM_BITS = 18
N_GRAMS = 1 << GRAM_BITS
#: Odd factors that spread the code points at each place of an n-gram, and the sum, over 64 bits.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
SPREAD = np.uint64(0xFF51AFD7ED558CCD)


@functools.cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter or a mark that belongs to one."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def points_of(text: str) -> np.ndarray:
    """Code points of the letters of lower-cased text, with one 0 for each stretch of other characters and at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(len(points) + 2, np.uint64)
    out[1:-1] = np.where(letters()[points], points, 0)
    return out[~((out == 0) & (np.concatenate(([1], out[:-1])) == 0))]


class Grams:
    """Which n-grams a text holds, as sorted numbers below N_GRAMS."""

    def __init__(self):
        self.seen = np.zeros(N_GRAMS, bool)

    def __call__(self, text: str) -> np.ndarray:
        c = points_of(text)
        one = c * FACTORS[0]
        two = one[:-1] + c[1:] * FACTORS[1] + np.uint64(1)
        three = two[:-1] + c[2:] * FACTORS[2] + np.uint64(1)
        for n in (one[c > 0], two, three):
            n *= SPREAD
            n ^= n >> np.uint64(32)
            self.seen[(n * SPREAD) >> np.uint64(64 - GRAM_BITS)] = True
        out = np.flatnonzero(self.seen)
        self.seen[out] = False
        return out.astype(np.int32)


class Model:
    """Weights of landmarks for each language; `parts` are its plain arrays, as they are sent to the tasks."""

    @classmethod
    def of(cls, parts: tuple) -> Model:
        self = cls.__new__(cls)
        self.langs, self.place, self.marks, self.weights = parts
        return self

    @property
    def parts(self) -> tuple:
        return self.langs, self.place, self.marks, self.weights

    def __init__(self, landmarks: list[np.ndarray], texts: list[np.ndarray], langs: list[str]):
        self.langs = sorted(set(langs))
        known = np.unique(np.concatenate(landmarks)) if landmarks else np.empty(0, np.int32)
        self.place = np.full(N_GRAMS, -1, np.int32)
        self.place[known] = np.arange(len(known))
        self.marks = np.zeros((len(known), len(landmarks)), np.float32)
        for j, g in enumerate(landmarks):
            self.marks[self.place[g], j] = 1 / np.sqrt(max(1, len(g)))
        if not texts:
            self.weights = np.zeros((len(landmarks), len(self.langs)), np.float32)
            return
        near = self.kernel(texts).astype(np.float64)
        among = self.kernel(landmarks).astype(np.float64)
        want = np.where(np.array(langs)[:, None] == np.array(self.langs)[None], 1.0, -1.0)
        share = np.where(want > 0, 0.5 / np.maximum(1, (want > 0).sum(0)), 0.5 / np.maximum(1, (want < 0).sum(0))) * len(texts)
        self.weights = np.zeros((len(landmarks), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            left = near.T @ (near * share[:, k : k + 1]) + RIDGE * len(texts) * among + 1e-6 * np.eye(len(landmarks))
            self.weights[:, k] = np.linalg.solve(left, near.T @ (want[:, k] * share[:, k]))

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(grams), self.marks.shape[1]), np.float32)
        for lo in range(0, len(grams), BLOCK):
            part = grams[lo : lo + BLOCK]
            dense = np.zeros((len(part), len(self.marks)), np.float32)
            for i, g in enumerate(part):
                at = self.place[g]
                dense[i, at[at >= 0]] = 1 / np.sqrt(max(1, len(g)))
            out[lo : lo + BLOCK] = dense @ self.marks
        return out

    def predict(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the languages, and scores: half of one plus the regression's value, in 0 to 1."""
        values = self.kernel(grams) @ self.weights
        best = values.argmax(axis=1)
        return best, np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)


def learn(docs: DataFrame) -> Model | None:
    """The model; the driver gets the n-gram numbers of at most SAMPLE texts for each language."""
    own = Window.partitionBy("lang").orderBy("order", "doc_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_of().alias("text")).where("lang is not null")
    rows = learning_rows(rows, "doc_id", MODULUS, HELD_OUT).withColumn("order", F.xxhash64("doc_id", "text"))
    key = ["lang", "order", "doc_id"]
    picked = rows.select(*key).distinct().withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= SAMPLE)
    matches = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    same = rows.join(picked.select(*[F.col(c).alias(f"__{c}") for c in key]), matches, "left_semi")
    chosen = same.groupBy(*key).agg(F.first("text").alias("text")).select("lang", "order", "text")  # one of rows that repeat

    def start():
        grams = Grams()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([grams(t).tobytes() for t in batch.column(2).to_pylist()], pa.binary())], names=["lang", "order", "grams"])

        return work

    found = sorted(map_batches(chosen, start, "lang string, order bigint, grams binary").collect(), key=lambda r: (r.lang, r.order, r.grams))
    texts = [np.frombuffer(r.grams, np.int32) for r in found]
    full = [i for i, g in enumerate(texts) if len(g)]
    if not full:
        return None
    used: dict[str, int] = {}
    landmarks = []
    for i in full:
        used[found[i].lang] = used.get(found[i].lang, 0) + 1
        if used[found[i].lang] <= LANDMARKS:
            landmarks.append(texts[i])
    return Model(landmarks, [texts[i] for i in full], [found[i].lang for i in full])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    spark = docs.sparkSession
    learned = learn(docs)
    shared = spark.sparkContext.broadcast(learned and learned.parts)

    def start():
        model, grams = shared.value and Model.of(shared.value), Grams()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if t and model and any(c.isalpha() for c in t)]
            for lo in range(0, len(at), BLOCK):
                part = at[lo : lo + BLOCK]
                best, values = model.predict([grams(texts[i]) for i in part])
                for i, b, v in zip(part, best.tolist(), values.tolist()):
                    langs[i], scores[i] = model.langs[b], v
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = map_batches(rows, start, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
