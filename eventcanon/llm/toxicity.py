"""Toxicity scores of restored text: a noisy channel undoes disguises, then a linear model scores what was meant.

Text is taken to have been disguised by swaps (leetspeak), by repeated letters and by spaces or marks between letters. Each token
that could be disguised becomes a lattice of what its characters may stand for; the likeliest path under a character trigram model,
counted over all documents, is found with the Viterbi algorithm. Tokens with a single path are left as they are.
The score is a logistic regression on words and word beginnings of the restored text, and on how often beginnings occur.

Labels are learned from rows whose crc32(doc_id as text) mod 3 is not 1 only, from at most SAMPLE labelled documents,
those with the least hash of the doc_id. A document labelled more than once is toxic if any label says so; rows that share a doc_id count once, with their least text. Only texts reach the score.
NULL and empty texts score as a text without any known feature. Without labels of both kinds every score is the smoothed share
of toxic labels (0.5 without any). Repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import cut, fresh, learning_rows, map_batches, modest, parts, remainder, text_of
from eventcanon.llm.letters import ALPHABET, SIZE, log_probabilities, trigram_counts

MODULUS, HELD_OUT = 3, 1
SAMPLE = 20_000
FEATURES = 2000
LEAST_DOCS, LEAST_Z = 2, 2.0
THRESHOLD = 0.7
BEGINNINGS = (4, 5, 6)
SHARES = (0.003, 0.006, 0.012, 0.025, 0.05)
#: A task's memory of restored tokens is cleared beyond so many characters of them.
CACHE_CHARS = 1_000_000
PART_BYTES = 4_000_000

#: What characters may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c",
}
EDGES = ".,;:?\"'()[]{}<>#%&*=~^_-/\\!"
SWAP, DROP_MARK, DROP_SWAP, DROP_DIGIT, BREAK, DOUBLE = -0.5, -0.2, -5.0, -8.0, -3.0, -1.5

RUNS = re.compile(r"(.)\1{2,}", re.S)
SPACED = re.compile(r"(?<!\S)[^\s](?:[ \t][^\s]){2,}(?=[,.;:!?]*(?!\S))")
WORDS = re.compile(r"[^\W\d_]+")


def code_of(c: str) -> int:
    o = ord(c)
    return int(ALPHABET[o]) if o < 256 else (58 + o % (SIZE - 58) if c.isalpha() else 0)


class Restorer:
    """The likeliest clean form of disguised tokens."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp.reshape(-1).tolist()
        self.known: dict[str, tuple[str, ...]] = {}
        self.chars = 0

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each character, or run of three and more equal ones, what it may stand for and at what cost."""
        out = []
        i = 0
        while i < len(token):
            c, n = token[i], 1
            while i + n < len(token) and token[i + n] == c:
                n += 1
            if n < 3:
                n = 1
            if c.isalpha():
                out.append([(c, 0.0)] if n == 1 else [(c, 0.0), (c + c, DOUBLE)])
            elif c in LEET:
                swaps = [(s, SWAP) for s in LEET[c]]
                gone = [("", DROP_MARK if n > 1 else DROP_DIGIT if c.isdigit() else DROP_SWAP)]
                out.append(swaps + gone + ([] if n == 1 else [(s + s, SWAP + DOUBLE) for s in LEET[c]]))
            else:
                out.append([("", DROP_MARK), (" ", BREAK)])
            i += n
        return out

    def decode(self, token: str) -> str:
        logp = self.logp
        best = {(0, 0): (0.0, "")}
        for options in self.lattice(token):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, said) in best.items():
                for text, cost in options:
                    s, x, y = score + cost, a, b
                    for c in text:
                        z = code_of(c)
                        s += logp[(x << 12) | (y << 6) | z]
                        x, y = y, z
                    old = after.get((x, y))
                    if old is None or s > old[0]:
                        after[(x, y)] = (s, said + text)
            best = after
        return max((s + logp[(a << 12) | (b << 6)], said) for (a, b), (s, said) in best.items())[1]

    def restore(self, token: str) -> str:
        """One token or spaced run of lower-cased text, restored; numbers and tokens with one path stay."""
        core = token.strip(EDGES)
        if not any(c.isalpha() for c in core) and not (len(core) > 3 and any(c in "@$!|+" for c in core)):
            return token
        if core.isalpha() and not RUNS.search(core):
            return token
        return self.decode(core)

    def words(self, token: str) -> tuple[str, ...]:
        out = self.known.get(token)
        if out is None:
            self.chars += len(token)
            if self.chars > CACHE_CHARS:
                self.known.clear()
                self.chars = len(token)
            out = self.known[token] = tuple(WORDS.findall(self.restore(token)))
        return out

    def text(self, text: str) -> str:
        """Whole restored text, lower-cased."""
        spaced = SPACED.sub(lambda m: self.restore(m[0]), text.lower())
        return re.sub(r"\S+", lambda m: self.restore(m[0]), spaced)

    def features(self, text: str) -> set[str]:
        """Words of the restored text, beginnings of words with a mark, and shares of all words that a beginning reaches."""
        low = text.lower()
        counts: dict[str, int] = {}
        for t, n in Counter(low.split()).items():
            for w in self.words(t):
                counts[w] = counts.get(w, 0) + n
        for m in SPACED.finditer(low):
            for w in self.words(m[0]):
                counts[w] = counts.get(w, 0) + 1
        out = set(counts)
        begun: dict[str, int] = {}
        for w, n in counts.items():
            for k in BEGINNINGS:
                if len(w) > k:
                    b = "^" + w[:k]
                    begun[b] = begun.get(b, 0) + n
        out.update(begun)
        total = sum(counts.values())
        for i, share in enumerate(SHARES, 1):
            least = max(2, share * total)
            begun = {b: n for b, n in begun.items() if n >= least}
            out.update([f"{b}{i}" for b in begun])
        return out


class Reader:
    """Which features of a model a text has: `Restorer.features` restricted to the given names, at little cost for other tokens."""

    def __init__(self, restorer: Restorer, names: list[str]):
        self.restorer, self.names = restorer, set(names)
        self.begun = {n[: k + 1] for n in names if n[0] == "^" for k in BEGINNINGS if len(n) in (k + 1, k + 2)}
        self.known: dict[str, tuple[int, tuple[str, ...], tuple[str, ...]]] = {}
        self.chars = 0

    def token(self, token: str) -> tuple[int, tuple[str, ...], tuple[str, ...]]:
        """Number of words, words and beginnings that matter."""
        out = self.known.get(token)
        if out is None:
            self.chars += len(token)
            if self.chars > CACHE_CHARS:
                self.known.clear()
                self.chars = len(token)
            core = token.strip(EDGES)
            words = (core,) if core.isalpha() and not RUNS.search(core) else tuple(WORDS.findall(self.restorer.restore(token)))
            begun = tuple("^" + w[:k] for w in words for k in BEGINNINGS if len(w) > k and "^" + w[:k] in self.begun)
            out = self.known[token] = (len(words), tuple(w for w in words if w in self.names), begun)
        return out

    def __call__(self, text: str) -> set[str]:
        low = text.lower()
        total, out, begun = 0, set(), {}
        counts = Counter(low.split())
        for m in SPACED.finditer(low):
            counts[m[0]] += 1
        for t, n in counts.items():
            words, said, starts = self.token(t)
            total += n * words
            if said:
                out.update(said)
            for b in starts:
                begun[b] = begun.get(b, 0) + n
        out.update(b for b in begun if b in self.names)
        for i, share in enumerate(SHARES, 1):
            least = max(2, share * total)
            out.update(f"{b}{i}" for b, n in begun.items() if n >= least and f"{b}{i}" in self.names)
        return out


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of character trigrams over all documents."""
    counts = np.zeros(SIZE**3, np.int64)
    found = trigram_counts(docs).toArrow()  # at most SIZE ** 3 rows, in one job
    counts[found.column("code").to_numpy()] = found.column("n").to_numpy()
    return log_probabilities(counts)


def learn(docs: DataFrame, labels: DataFrame, shared) -> tuple[dict[str, float], float]:
    """Weights of features, and the bias."""
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    chosen = learning_rows(said, "doc_id", MODULUS, HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = fresh(docs, doc_id=F.col("doc_id").cast("long"), text=text_of())
    # one text for each doc_id, however often its row is repeated
    rows = cut(rows.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        tally = (Counter(), Counter())
        for batch in batches:
            for part in parts(batch, 0, PART_BYTES):
                for t, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    tally[y > 0].update(restorer.features(t))
        names = sorted(tally[0].keys() | tally[1].keys())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([tally[0][f] for f in names], pa.int64()), pa.array([tally[1][f] for f in names], pa.int64())], names=["feature", "clean", "toxic"])

    classes = {r.toxic: r.n for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = classes.get(True, 0), classes.get(False, 0)
    prior = float(np.log((n_toxic + 0.5) / (n_clean + 0.5)))
    if not n_toxic or not n_clean:
        return {}, prior
    counted = rows.mapInArrow(modest(count), "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where(F.col("c") + F.col("t") >= LEAST_DOCS)
    a, b, c, d = F.col("t") + 0.5, F.lit(n_toxic) - F.col("t") + 0.5, F.col("c") + 0.5, F.lit(n_clean) - F.col("c") + 0.5
    z = F.log(a / b * d / c) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    names = [r.feature for r in counted.withColumn("z", F.abs(z)).where(F.col("z") >= LEAST_Z).orderBy(F.col("z").desc(), "feature").limit(FEATURES).collect()]
    number = {f: i for i, f in enumerate(names)}

    def start():
        reader = Reader(Restorer(shared.value), names)

        def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [np.array(sorted(number[f] for f in reader(t)), np.int32).tobytes() for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1)], names=["at", "toxic"])

        return vectors

    found = map_batches(rows, start, "at binary, toxic int").collect()
    weights, bias = logistic([np.frombuffer(r["at"], np.int32) for r in found], np.array([r.toxic > 0 for r in found], float), len(names), prior)
    return dict(zip(names, weights.tolist())), bias


def logistic(rows: list[np.ndarray], y: np.ndarray, n: int, bias: float, penalty: float = 0.1, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features with an L2 penalty, by accelerated gradient descent."""
    order = np.lexsort((y, [len(r) for r in rows]))  # the order of rows from the tasks doesn't matter but for rounding
    rows, y = [rows[i] for i in order], y[order]
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows) if len(at) else np.empty(0, np.int64)
    size = np.array([len(r) + 1 for r in rows], float)
    step = 4.0 / (np.bincount(col, size[at], n) + 4 * penalty)  # each weight's own: the sum of its rows' sizes bounds the curvature
    step_bias = 4.0 / size.sum()
    w, v, b, vb = np.zeros(n), np.zeros(n), bias, bias
    for k in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(at, v[col], len(rows)) + vb)))
        g = np.bincount(col, (p - y)[at], n) + penalty * v
        w_next, b_next = v - step * g, vb - step_bias * (p - y).sum()
        m = k / (k + 3)
        v, vb = w_next + m * (w_next - w), b_next + m * (b_next - b)
        w, b = w_next, b_next
    return w, float(b)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns of `docs` (of plain types) with `score` and `predicted`; columns of those names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(language_model(docs))
    weights, bias = learn(docs, labels, shared)
    model = spark.sparkContext.broadcast((weights, bias))
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    given = docs.select(*[F.col(f"`{c}`") for c in names])
    at = [c.lower() for c in names].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        reader = Reader(Restorer(shared.value), list(weights))
        for batch in batches:
            for part in parts(batch, at, PART_BYTES):
                said = np.array([bias + sum(weights[f] for f in sorted(reader(t or ""))) for t in part.column(at).to_pylist()])
                scores = 1 / (1 + np.exp(-np.clip(said, -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32))], names=[*names, "score", "predicted"])

    fields = given.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    return given.mapInArrow(modest(run), fields.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    return scored.select("doc_id", (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "score", "predicted")


def restored(docs: DataFrame) -> DataFrame:
    """doc_id and the whole restored text of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(language_model(docs))

    def start():
        restorer = Restorer(shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([restorer.text(t) for t in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "restored"])

        return work

    return map_batches(fresh(docs, doc_id=F.col("doc_id").cast("long"), text=text_of()), start, "doc_id bigint, restored string")
