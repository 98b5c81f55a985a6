"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams. Every block of documents gets an inverted
index (trigram -> places of the documents that hold it), queries are answered by intersecting and uniting its postings, and
only the documents they leave are verified with the expression. A rule without mandatory trigrams scans all
documents. Blocks are bounded by size, so the index is distributed as the table is and nothing is shuffled.

NULL texts count as empty and have no spans; one row comes out per row that went in, repeated rows included.
"""

from __future__ import annotations

import hashlib
import re
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import blocks, fresh, map_batches, text_of

# kind, expression, group whose length counts, least length. The first three are fixed by contract; all are in the
# order in which kinds are listed. A run that may be long is matched where it begins only, so time stays linear.
RULES = (
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,255}", 0, 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,250}", 0, 0),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 0),
)
BASE = 3
MOST_STRINGS, MOST_CLASS = 64, 4

SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_candidates int"


class Always:
    """The query that every document answers."""


ALWAYS = Always()


def _all(a, b):
    return b if a is ALWAYS else a if b is ALWAYS else ("and", a, b)


def _any(queries: list):
    if not queries or any(q is ALWAYS for q in queries):
        return ALWAYS
    out = queries[0]
    for q in queries[1:]:
        out = ("or", out, q)
    return out


def _of_strings(strings: set[str]):
    """One of the strings occurs: OR of ANDs of their trigrams."""
    options = []
    for s in sorted(strings):
        grams = sorted({s[i : i + 3] for i in range(len(s) - 2)})
        query = ALWAYS
        for g in grams:
            query = _all(query, ("gram", g))
        options.append(query)
    return _any(options)


def _sequence(items) -> tuple[set[str] | None, object]:
    """Strings that a sequence matches, where they are few, and the query that holds for any match."""
    run: set[str] = {""}
    query, exact = ALWAYS, True
    for op, arg in items:
        strings, inner = _item(op, arg)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        query, exact = _all(_all(query, _of_strings(run)), inner), False
        run = strings if strings is not None else {""}
    return (run if exact else None), _all(query, _of_strings(run))


def _item(op, arg) -> tuple[set[str] | None, object]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, ALWAYS
    if op is sre.IN:
        if all(kind is sre.LITERAL for kind, _ in arg) and len(arg) <= MOST_CLASS:
            return {chr(c).lower() for _, c in arg}, ALWAYS
        return None, ALWAYS
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        query = _any([q if s is None else _of_strings(s) for s, q in parts])
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MOST_STRINGS:
            return set().union(*[s for s, _ in parts]), query
        return None, query
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = arg
        strings, query = _sequence(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ALWAYS
        if least == most and strings is not None and len(strings) == 1:
            return {next(iter(strings)) * least}, ALWAYS
        return None, (query if least else ALWAYS)
    if op is sre.AT:
        return {""}, ALWAYS
    return None, ALWAYS


def trigram_query(expression: str):
    """The Boolean trigram query that each match of `expression` answers, over lower-cased text."""
    return _sequence(_parser.parse(expression))[1]


def grams_of(query) -> set[str]:
    if query is ALWAYS:
        return set()
    return {query[1]} if query[0] == "gram" else grams_of(query[1]) | grams_of(query[2])


class TrigramIndex:
    """Postings of the wanted trigrams over one block of texts (UTF-8, ASCII letters lower-cased)."""

    def __init__(self, grams: list[bytes]):
        self.grams = [g for g in grams if len(g) == 3]
        letters = sorted({b for g in self.grams for b in g})
        self.bits = max(1, int(len(letters)).bit_length())
        self.letter = np.zeros(256, np.uint32)
        for i, b in enumerate(letters, 1):
            self.letter[b] = i
        self.number = np.zeros(1 << (3 * self.bits), np.uint16)
        for i, g in enumerate(self.grams, 1):
            a, b, c = (int(self.letter[x]) for x in g)
            self.number[(a << (2 * self.bits)) | (b << self.bits) | c] = i

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        out = {g: np.empty(0, np.int64) for g in self.grams}
        joined = np.frombuffer(b"\n".join(texts), np.uint8)
        if len(joined) < 3 or not self.grams:
            return out
        c = self.letter[joined]
        found = self.number[(c[:-2] << (2 * self.bits)) | (c[1:-1] << self.bits) | c[2:]]
        at = np.flatnonzero(found)
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, at, side="right")
        keys = np.unique(found[at].astype(np.int64) * len(texts) + owner)
        which, places = keys // len(texts), keys % len(texts)
        cuts = np.searchsorted(which, np.arange(1, len(self.grams) + 2))
        for i, g in enumerate(self.grams):
            out[g] = places[cuts[i] : cuts[i + 1]]
        return out


def candidates(query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Places of the texts that answer the query."""
    if query is ALWAYS:
        return np.arange(n)
    if query[0] == "gram":
        return postings[query[1].encode()]
    a, b = candidates(query[1], postings, n), candidates(query[2], postings, n)
    return np.intersect1d(a, b, assume_unique=True) if query[0] == "and" else np.union1d(a, b)


def find_secrets(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every rule in every whole text; see the contract columns in SCHEMA.

    `spans` is ``kind:start:end`` in code points, end exclusive, by start and then in the order of the rules.
    ``n_candidates`` counts the rules whose query the document answered.
    """
    compiled = [(k, re.compile(e), g, least, trigram_query(e)) for k, e, g, least in rules]
    grams = sorted(set().union(*[grams_of(q) for *_, q in compiled]))

    def start():
        index = TrigramIndex([g.encode() for g in grams])

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            rows: list[tuple] = []
            for lo, hi in blocks(texts):
                block = texts[lo:hi]
                postings = index.postings([t.encode("utf-8", "replace").lower() for t in block])
                found: list[list] = [[] for _ in block]
                looked = np.zeros(len(block), np.int32)
                for order, (kind, pattern, group, least, query) in enumerate(compiled):
                    places = candidates(query, postings, len(block))
                    looked[places] += 1
                    for i in places.tolist():
                        for m in pattern.finditer(block[i]):
                            if m.end(group) - m.start(group) >= least:
                                found[i].append((m.start(), order, m.end(), kind))
                for i, spans in enumerate(found):
                    spans.sort()
                    base = [s for s in spans if s[1] < BASE]
                    said = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
                    counts = [sum(s[1] == n for s in base) for n in range(BASE)]
                    rows.append((*counts, hashlib.sha256(said.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans), int(looked[i])))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int32()]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_candidates"]
            return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=names)

        return work

    return map_batches(fresh(docs, doc_id=F.col(doc_id).cast("long"), text=text_of(text)), start, SCHEMA)
