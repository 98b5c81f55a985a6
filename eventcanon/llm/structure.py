"""Conversation structure repair by prefix-doubling path ranking.

A conversation is whole if the initials of its roles read ``(s?(ua)+)?``. Each row may be kept, given the role that fits (Rerole) or deleted,
and empty turns may be inserted anywhere; blank and repeated rows must go, truncated rows that stay cost extra. The cheapest edits win, and of
those the ASCII-least string of their initials (the audit).

Nodes are (rows done, state), arcs are edits. The cost DP gives each node its least cost to the end; arcs on cheapest ways are the optimal
ones. Nodes are then ranked by the least audit of 1, 2, 4, ... edits that optimal arcs spell from them: a rank of twice the length is the pair of the
ranks of a node and of the node that its doubled pointer leads to. An edit and a state settle the next state, so the arc of least rank at
a node is one arc, and the pointers of all lengths put together walk the least path without going step by step.

Rows are laid out in one global order by ranges, so that a long conversation spans many tasks, and cut into segments of at most SEGMENT rows.
A segment is the matrix of least costs from state to state; the matrices of a conversation give the cost to go behind each segment
(backwards), the segments then spell their audits from each state they may be entered in, and one more pass (forwards) picks those that are
entered. Only small rows a segment meet in one task per conversation, and there one by one. The digest of a repaired conversation has to
be taken in order; it reads its rows as they come and holds one segment.

Order: turn (NULL first), then role, then text; copies lie side by side. A NULL role or text is one space. A NULL conv_id is a conversation
of its own. A role without an initial of s, u or a (the empty role too) fits nowhere and can be given a role or deleted. Repeated rows are
duplicates. Conversations that lose all rows give zeros, an empty audit and the digest of the empty text. Very long texts are
neither sorted nor compared whole (64 characters and a digest stand for them; texts that agree in turn, role and 64 characters go by digest).
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import cut

#: States: nothing said, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
N = 4
SEGMENT = 2048
FAR = 1 << 40
DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: The next role's state where user and assistant take turns.
TURN = (USER, USER, ASSISTANT, USER)
SAID = {USER: "user", ASSISTANT: "assistant"}
#: Least cost from each state to the end of a conversation, by inserts.
ENDS = (0, 2 * COST[INSERT], COST[INSERT], 0)
FIRST_CHARACTERS = 64
COPIES_AT_ONCE = 65_536


def kept_state(state: int, initial: str) -> int | None:
    """The state after keeping a row, None where it does not fit."""
    if state == START and initial == "s":
        return SYSTEM
    return TURN[state] if initial == ("u", "u", "a", "u")[state] else None


def arcs(state: int, initial: str, must_go: bool, truncated: bool) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what may be done with a row."""
    out = [(DELETE, COST[DELETE], state)]
    if not must_go:
        extra = TRUNCATED if truncated else 0
        to = kept_state(state, initial)
        if to is not None:
            out.append((KEEP, COST[KEEP] + extra, to))
        out.append((REROLE, COST[REROLE] + extra, TURN[state]))
    return out


def _with_inserts(after: list[int]) -> list[int]:
    """Least costs to go where turns may be inserted first; two are enough to get from any state to any that can be reached."""
    once = [min(after[s], COST[INSERT] + after[TURN[s]]) for s in range(N)]
    return [min(after[s], COST[INSERT] + once[TURN[s]]) for s in range(N)]


KINDS = {(i, g, t): [arcs(s, i, g, t) for s in range(N)] for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


def costs_to_go(rows: list[tuple[str, bool, bool]], end: list[int]) -> list[list[int]]:
    """For each place between rows (initial, must go, truncated) the least cost to the end from each state; `end` is that after the last row."""
    out = [list(end)]
    for row in reversed(rows):
        after, ways = out[-1], KINDS[row]
        out.append(_with_inserts([min(c + after[to] for _, c, to in ways[s]) for s in range(N)]))
    return out[::-1]


def matrix(rows: list[tuple[str, bool, bool]]) -> np.ndarray:
    """Least costs from state to state over the rows."""
    return np.array([np.minimum(costs_to_go(rows, [0 if s == e else FAR for s in range(N)])[0], FAR) for e in range(N)]).T


def audits(segments: list[tuple[list[tuple[str, bool, bool]], list[int]]]) -> list[list[tuple[str, int]]]:
    """For each segment (rows, cost to go behind it) and each state before it: the least audit of the cheapest edits, and the state after.

    Nodes of all segments are ranked and doubled together.
    """
    sizes = [N * (len(rows) + 1) for rows, _ in segments]
    first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    total = int(first[-1])
    label = np.zeros(total, np.int64)  # 0: behind the segment's last row
    pointer = np.arange(total)
    for (rows, end), base in zip(segments, first.tolist()):
        go = costs_to_go(rows, end)
        for i, row in enumerate(rows):
            for s in range(N):
                ways = [(edit, i + 1, to) for edit, cost, to in KINDS[row][s] if cost + go[i + 1][to] == go[i][s]]
                if COST[INSERT] + go[i][TURN[s]] == go[i][s]:
                    ways.append((INSERT, i, TURN[s]))
                edit, at, to = min(ways)
                label[base + N * i + s], pointer[base + N * i + s] = ord(edit), base + N * at + to
    starts = (first[:-1, None] + np.arange(N)).reshape(-1)
    path = walk(label, pointer, starts)
    spelled = label[path].astype(np.uint8)
    out = []
    for k in range(len(segments)):
        rows_of = range(N * k, N * k + N)
        out.append([(spelled[r][spelled[r] > 0].tobytes().decode(), int(path[r, -1] - first[k + 1] + N)) for r in rows_of])
    return out


def doubled(label: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the nodes by the audits spelled from them, and pointers 1, 2, 4, ... edits on, until all paths have ended.

    Nodes of one rank spell the same audit, and the lesser rank the lesser audit; the end of a path is less than any edit.
    """
    rank, pointers = np.unique(label, return_inverse=True)[1].astype(np.int64), [pointer]
    while True:
        by = pointers[-1]
        rank = np.unique(rank * len(label) + rank[by], return_inverse=True)[1].astype(np.int64)
        twice = by[by]
        if (twice == by).all():
            return rank, pointers
        pointers.append(twice)


def walk(label: np.ndarray, pointer: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The nodes of the paths from `starts`, one path a row; each doubled pointer doubles the stretch that is known.

    Starts of one rank spell the same audit, so it is enough to walk from one of each rank and end.
    """
    rank, pointers = doubled(label, pointer)
    last = pointers[-1][starts]
    _, one, same = np.unique(np.stack((rank[starts], last)), axis=1, return_index=True, return_inverse=True)
    path = starts[one][:, None]
    for by in pointers:
        path = np.concatenate((path, by[path]), axis=1)
    return path[same.reshape(-1)]


BLANKS = " \t\n\x0b\x0c\r"
FAULTS = ("", "blank", "duplicate", "truncated")


def marked(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """A row for each row of `turns` in the order of `pos`: conv_id, turn, role, text (NULL where it must go), initial, fault.

    Each conv_id of `every`, too, has a row, without a fault number where it is but a mark.
    """
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"), F.lit(1).alias("here"))
    none = F.lit(None)
    marks = (turns if every is None else every).select(
        F.col("conv_id").cast("long").alias("conv_id"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).alias("here"))
    grouped = rows.unionAll(marks).groupBy("conv_id", "turn", "role", "text").agg(F.sum("here").alias("copies"))
    same = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.length("role").cast("string"), "role", "text")
    grouped = grouped.withColumn("said", F.unhex(F.sha2(same, 256)))
    earliest = grouped.where("copies > 0").groupBy(F.col("said").alias("s")).agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn").alias("t"))).alias("first"))
    joined = grouped.join(earliest, F.col("said") == F.col("s"), "left")
    ends = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    some = joined.select("conv_id", "turn", "role", "text", "said", "copies", (F.col("turn").eqNullSafe(F.col("first.t"))).alias("is_first"), ends.alias("last"))
    chunks = some.withColumn("chunk", F.explode(F.expr(f"sequence(0L, greatest(copies - 1, 0L) div {COPIES_AT_ONCE})")))
    within = F.expr(f"if(copies = 0, array(-1L), sequence(chunk * {COPIES_AT_ONCE}, least(copies, (chunk + 1) * {COPIES_AT_ONCE}) - 1))")
    all_rows = chunks.withColumn("copy", F.explode(within))
    fault = (
        F.when(F.col("copies") == 0, F.lit(None)).when(F.col("last") == "", 1).when((F.col("copy") > 0) | ~F.col("is_first"), 2)
        .when(~F.col("last").isin(".", "!", "?"), 3).otherwise(0).cast("int"))
    initial = F.substring("role", 1, 1)
    all_rows = all_rows.select(
        "conv_id", "turn", "role", F.when(initial.isin("s", "u", "a"), initial).otherwise("").alias("initial"), fault.alias("fault"),
        F.substring("text", 1, FIRST_CHARACTERS).alias("head"), "said", "copy", "text")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "said", "copy")]
    laid = all_rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stays = F.col("fault").isin(0, 3)
    return cut(laid.select("conv_id", "turn", "role", "initial", "fault", F.when(stays, F.col("text")).alias("text"), F.monotonically_increasing_id().alias("pos")))


SUMMARY = (
    "conv_id bigint, segment bigint, codes binary, costs array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_turn bigint, last_turn bigint, turns bigint")
CODES = [(i, f) for i in ("s", "u", "a", "") for f in range(4)]
CODE_OF = {c: k for k, c in enumerate(CODES)}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def rows_of(codes: bytes) -> list[tuple[str, bool, bool]]:
    """(initial, must go, truncated) of each row."""
    return [(CODES[c][0], CODES[c][1] in (1, 2), CODES[c][1] == 3) for c in codes]


def _illegal(initials: list[str]) -> int:
    return sum(p not in LEGAL for p in zip(initials, initials[1:]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _stretches(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows of equal first `n_keys` columns."""
    held, part = None, []
    for row in _rows(batches):
        if row[:n_keys] != held:
            if part:
                yield held, part
            held, part = row[:n_keys], []
        part.append(row)
    if part:
        yield held, part


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(spark_schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in spark_schema.split(", "))])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for (conv_id, segment), part in _stretches(batches, 2):
            real = [r for r in part if r[4] is not None]
            codes = bytes(CODE_OF[r[3], r[4]] for r in real)
            turns = [r[2] for r in real if r[2] is not None]
            count = [sum(r[4] == f for r in real) for f in (1, 2, 3)]
            yield (conv_id, segment, codes, matrix(rows_of(codes)).reshape(-1).tolist(), *count, _illegal([r[3] for r in real]), turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)))

    yield from _batches(rows(), _arrow(SUMMARY))


def _costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from a conversation's last to its first, with the cost to go behind each in place of its matrix."""

    def rows():
        held, go = (), ENDS
        for row in _rows(batches):
            if held != row[:1]:
                held, go = row[:1], ENDS
            yield (*row[:3], list(go), *row[4:])
            go = [min(row[3][N * s + t] + go[t] for t in range(N)) for s in range(N)]

    yield from _batches(rows(), _arrow(SUMMARY))


SPELLED = SUMMARY.replace("costs array<bigint>", "audits array<string>, states array<bigint>")


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with the least audit from each state they may be entered in, and the state each leads to."""
    for batch in batches:
        rows = sorted(_rows([batch]), key=lambda r: len(r[2]))
        out, lo = [], 0
        while lo < len(rows):  # segments of like length together, so that short paths are not drawn out
            hi = lo + 1
            while hi < len(rows) and len(rows[hi][2]) <= 2 * len(rows[lo][2]) + 8 and (hi - lo) * len(rows[hi][2]) < 1 << 16:
                hi += 1
            for row, found in zip(rows[lo:hi], audits([(rows_of(r[2]), r[3]) for r in rows[lo:hi]])):
                out.append((*row[:3], [a for a, _ in found], [s for _, s in found], *row[4:]))
            lo = hi
        yield from _batches(iter(out), _arrow(SPELLED))


def _segments(turns: DataFrame, every: DataFrame | None, segment: int) -> DataFrame:
    """Segments with their audits, and after each the rows that may stay, in order within a conversation's partition."""
    laid = marked(turns, every).withColumn("segment", F.expr(f"pos div {segment}"))
    whole = laid.select("conv_id", "segment", "turn", "initial", "fault").mapInArrow(_summaries, SUMMARY)
    behind = whole.repartition("conv_id").sortWithinPartitions("conv_id", F.col("segment").desc()).mapInArrow(_costs_behind, SUMMARY)
    spelled = behind.repartition("conv_id", "segment").mapInArrow(_spelled, SPELLED)
    stays = laid.where("fault in (0, 3)").select("conv_id", "segment", "pos", "role", "text")
    both = spelled.withColumn("pos", F.lit(-1).cast("long")).unionByName(stays, allowMissingColumns=True)
    names = ["conv_id", "segment", "pos", "role", "text", *(c for c in spelled.columns if c not in ("conv_id", "segment"))]
    return both.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "segment", "pos")


class Repaired:
    """The repaired turns of a conversation, from its segments and rows in order; `said` is called with each turn's edit, role and text."""

    def __init__(self, said):
        self.said, self.state, self.audit, self.cost = said, START, [], 0
        self.counts, self.low, self.high, self.turns, self.before = [0, 0, 0, 0], None, None, 0, None
        self.open = iter(())

    def segment(self, codes: bytes, audits: list[str], states: list[int], counts: list[int], first: int | None, last: int | None, turns: int) -> None:
        audit = audits[self.state]
        self.audit.append(audit)
        self.open = self._edits(rows_of(codes), audit, self.state)
        self.state = states[self.state]
        next(self.open)
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        if codes:
            self.counts[3] += self.before is not None and (self.before, CODES[codes[0]][0]) not in LEGAL
            self.before = CODES[codes[-1]][0]
        if turns:
            self.turns += turns - (self.high == first)
            self.low, self.high = first if self.low is None else self.low, last

    def _edits(self, rows: list[tuple[str, bool, bool]], audit: str, state: int):
        """Takes (role, text) of each row that may stay, one by one, and tells the turns."""
        row, at = None, 0
        for edit in audit:
            self.cost += COST[edit]
            if edit == INSERT:
                state = TURN[state]
                self.said(edit, SAID[state], "")
                continue
            initial, must_go, truncated = rows[at]
            at += 1
            if not must_go:
                row = yield
            if edit == DELETE:
                continue
            self.cost += TRUNCATED * truncated
            state = kept_state(state, initial) if edit == KEEP else TURN[state]
            self.said(edit, row[0] if edit == KEEP else SAID[state], row[1])
        while True:
            yield

    def row(self, role: str, text: str) -> None:
        self.open.send((role, text))

    def end(self) -> None:
        for _ in range(ENDS[self.state] // COST[INSERT]):
            self.state = TURN[self.state]
            self.cost += COST[INSERT]
            self.audit.append(INSERT)
            self.said(INSERT, SAID[self.state], "")

    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)


def _conversations(batches: Iterator[pa.RecordBatch], said_to) -> Iterator[tuple[int | None, Repaired]]:
    """Each conversation when all its rows have been read; `said_to(conv_id)` gives what its turns are told to."""
    held, now = None, None
    for conv_id, _, pos, role, text, codes, audits_, states, blank, duplicate, truncated, illegal, first, last, turns in _rows(batches):
        if now is None or held != conv_id:
            if now is not None:
                now.end()
                yield held, now
            held, now = conv_id, Repaired(said_to(conv_id))
        if pos < 0:
            now.segment(codes, audits_, states, [blank, duplicate, truncated, illegal], first, last, turns)
        else:
            now.row(role, text)
    if now is not None:
        now.end()
        yield held, now


SUMS = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "conv_id bigint, place bigint, edit string, role string, text string"


def repair(turns: DataFrame, every: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """A row for each conversation, and each conv_id of `every`: its faults, the least cost, the audit and the digest of the repaired turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, begun = None, False

        def said(_, role: str, text: str) -> None:
            nonlocal begun
            digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "replace"))
            begun = True

        def said_to(_):
            nonlocal digest, begun
            digest, begun = hashlib.sha256(), False
            return said

        def rows():
            for conv_id, c in _conversations(batches, said_to):
                yield (conv_id, c.gaps(), *c.counts, c.cost, "".join(c.audit), digest.hexdigest())

        yield from _batches(rows(), _arrow(SUMS))

    return _segments(turns, every, segment).mapInArrow(run, SUMS)


def repaired_turns(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), edit, role, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: list[tuple] = []

        def said_to(conv_id):
            place = 0

            def said(edit: str, role: str, text: str) -> None:
                nonlocal place
                told.append((conv_id, place, edit, role, text))
                place += 1

            return said

        def pieces():
            for batch in batches:
                yield batch
                if told:
                    out.append(list(told))
                    told.clear()

        out: list[list[tuple]] = []
        for _ in _conversations(pieces(), said_to):
            while out:
                yield from _batches(iter(out.pop(0)), _arrow(TURNS))
        while out:
            yield from _batches(iter(out.pop(0)), _arrow(TURNS))
        yield from _batches(iter(told), _arrow(TURNS))

    return _segments(turns, None, segment).mapInArrow(run, TURNS)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults planted by the crc32 of ``conv_id:turn``; NULLs are one space, but conv_id and turn stay NULL."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    by = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), by.alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times: Column = F.when(F.col("d") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("d != 0").select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def report(turns: DataFrame) -> DataFrame:
    """The contract's columns for each conv_id of damaged conversations."""
    return repair(damaged(turns), turns.select("conv_id"))


REPAIR_SQL = r"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS d
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked WHERE d <> 0
), placed AS (
  SELECT coalesce(conv_id::VARCHAR, '') AS c, turn, role, text, left(role, 1) AS ini, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS ends,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM damaged
), faults AS (
  SELECT *, CASE WHEN ends = '' THEN 1 WHEN again THEN 2 WHEN ends NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, lag(ini) OVER (PARTITION BY c ORDER BY i) AS before FROM placed
), sums AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c
), ins(state, mid, label, cost, said) AS (
  VALUES ('', '', '', 0, ''), ('', 'u', 'I', 5, chr(10) || 'user:'), ('', 'a', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('s', 's', '', 0, ''), ('s', 'u', 'I', 5, chr(10) || 'user:'), ('s', 'a', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('u', 'u', '', 0, ''), ('u', 'a', 'I', 5, chr(10) || 'assistant:'), ('a', 'a', '', 0, ''), ('a', 'u', 'I', 5, chr(10) || 'user:')
), edits AS (
  SELECT c, i, mid, 'D' AS label, 2 AS cost, mid AS after, '' AS said FROM faults, (VALUES (''), ('s'), ('u'), ('a')) AS m(mid)
  UNION ALL SELECT c, i, mid, 'K', CASE WHEN fault = 3 THEN 5 ELSE 0 END, ini, chr(10) || role || ':' || text
  FROM faults JOIN (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) AS m(mid, next) ON next = ini WHERE fault IN (0, 3)
  UNION ALL SELECT c, i, mid, 'R', CASE WHEN fault = 3 THEN 6 ELSE 1 END, next, chr(10) || CASE next WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
  FROM faults, (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) AS m(mid, next) WHERE fault IN (0, 3)
), dp(c, i, state, best) AS (
  SELECT c, 0::BIGINT, '', {'cost': 0::BIGINT, 'audit': '', 'said': ''} FROM sums
  UNION ALL
  SELECT c, i, state, min(best) FROM (
    SELECT dp.c, edits.i, edits.after AS state,
      {'cost': dp.best.cost + ins.cost + edits.cost, 'audit': dp.best.audit || ins.label || edits.label, 'said': dp.best.said || ins.said || edits.said} AS best
    FROM dp JOIN ins ON ins.state = dp.state JOIN edits ON edits.c = dp.c AND edits.i = dp.i + 1 AND edits.mid = ins.mid) AS step
  GROUP BY c, i, state
), done AS (
  SELECT dp.c, min({'cost': dp.best.cost + ins.cost, 'audit': dp.best.audit || ins.label, 'said': dp.best.said || ins.said}) AS best
  FROM dp JOIN sums ON sums.c = dp.c AND sums.n = dp.i JOIN ins ON ins.state = dp.state AND ins.mid = CASE dp.state WHEN '' THEN '' ELSE 'a' END
  GROUP BY dp.c
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS k LEFT JOIN sums ON sums.c = coalesce(k.conv_id::VARCHAR, '') LEFT JOIN done ON done.c = sums.c
"""
