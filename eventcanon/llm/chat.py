"""Chat formatting by minimum-cost role repair.

A conversation is legal if it has at most one system turn, at its start, and then user and assistant turns by turns, from
a user to an assistant. Dynamic programming over the automaton of legal turns chooses for each turn what costs least: keep it, merge it
into the turn before, give it another role, and insert an empty turn before it. The repaired sequence is rendered turn by turn.

A turn's choice only depends on the state before it, so stretches of a conversation are min-plus matrices: turns are dealt in blocks of
at most BLOCK turns, each block becomes the matrix of the least costs from state to state, the matrices of a conversation are
joined from the left, and each block is then decoded between its known end states. No task holds more than a block of turns, or
the small matrices of one conversation's blocks.

NULL and empty texts are turns like any other (a NULL text renders as empty); a role that is none of the three, or NULL, is unknown and
is relabelled. Turns are taken by `turn`, then role, then text; NULLs first; a NULL conv_id is a conversation of its own.
Repeated rows are repeated turns. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventcanon.llm.common import cut

ROLES = ("system", "user", "assistant")
#: States: nothing said, after system, after user, after assistant. A conversation may end after an assistant only, or be empty.
START, SYSTEM, USER, ASSISTANT = range(4)
N = 4
BLOCK = 256
MERGE, RELABEL, UNKNOWN, INSERT, TAIL = 2, 3, 1, 5, 4
FAR = 1 << 40
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
AFTER = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
#: Legal next turns of each state.
NEXT = {START: ("system", "user"), SYSTEM: ("user",), USER: ("assistant",), ASSISTANT: ("user",)}
SAID = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}


def options(role: str | None) -> list[tuple[int, int, int, str, str, tuple[str, ...]]]:
    """What may be done with a turn: (state before, state after, cost, action, role given, roles of empty turns put before it)."""
    out = []
    for before in range(N):
        for given in ROLES:
            price = 0 if role == given else UNKNOWN if role not in ROLES else RELABEL
            name = "keep" if role == given else "relabel"
            if SAID.get(before) == given:
                out.append((before, before, MERGE + price, "merge" if role == given else "relabel+merge", given, ()))
            for empty in ((), *[(r,) for r in NEXT[before]], *[(r, q) for r in NEXT[before] for q in NEXT[AFTER[r]]]):
                state = AFTER[empty[-1]] if empty else before
                if given in NEXT[state]:
                    out.append((before, AFTER[given], INSERT * len(empty) + price, "+".join([*["insert"] * bool(empty), name]), given, empty))
    return sorted(out, key=lambda o: (o[0], o[1], o[2], o[3], o[4], o[5]))


def steps() -> dict[str | None, list]:
    """The cheapest option from state to state, for each role a turn may have."""
    out = {}
    for role in (*ROLES, None):
        best: dict[tuple[int, int], tuple] = {}
        for o in options(role):
            if (o[0], o[1]) not in best or o[2] < best[o[0], o[1]][2]:
                best[o[0], o[1]] = o
        out[role] = best
    return out


STEPS = steps()
#: Cost of ending in a state, by an empty assistant turn where the last turn has no answer.
ENDS = {START: 0, SYSTEM: INSERT + TAIL, USER: TAIL, ASSISTANT: 0}


def matrix(roles: list[str | None]) -> np.ndarray:
    """Least cost of a stretch of turns from state to state."""
    out = np.where(np.eye(N) > 0, 0, FAR).astype(np.int64)
    for r in roles:
        step = np.full((N, N), FAR, np.int64)
        for (a, b), o in STEPS[r if r in ROLES else None].items():
            step[a, b] = o[2]
        out = np.minimum((out[:, :, None] + step[None]).min(axis=1), FAR)
    return out


def decode(roles: list[str | None], start: int, end: int) -> list[tuple]:
    """The cheapest options of a stretch between two states; ties go to the lower state."""
    costs = [[0 if s == start else FAR for s in range(N)]]
    back = []
    for r in roles:
        now, by = [FAR] * N, [None] * N
        for (a, b), o in sorted(STEPS[r if r in ROLES else None].items()):
            if costs[-1][a] + o[2] < now[b]:
                now[b], by[b] = costs[-1][a] + o[2], o
        costs.append(now)
        back.append(by)
    out, state = [], end
    for by in reversed(back):
        out.append(by[state])
        state = by[state][0]
    return out[::-1]


def path(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """States before and after each block on the cheapest way from the start to an end."""
    costs = [np.where(np.arange(N) == START, 0, FAR).astype(np.int64)]
    back = []
    for m in matrices:
        all_ways = costs[-1][:, None] + m
        back.append(all_ways.argmin(axis=0))
        costs.append(all_ways.min(axis=0))
    state = int((costs[-1] + np.array([ENDS[s] for s in range(N)])).argmin())
    out = []
    for by in reversed(back):
        out.append((int(by[state]), state))
        state = int(by[state])
    return out[::-1]


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each turn: conv_id, turn, role, action, new_role, inserted (roles of empty turns before it, comma-joined), starts
    (whether it begins a turn of the repaired sequence), closes (empty turns after the last), piece (its part of the rendering).

    A conversation's pieces in the order of `turn_index` are its rendering.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = _numbered(rows, block)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in _runs(batches, ("conv_id", "block")):
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([matrix(part["role"]).reshape(-1).tolist()], pa.list_(pa.int64()))], names=["conv_id", "block", "costs"])

    dealt = rows.select("conv_id", "block", "turn_index", "role").repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn_index")
    whole = dealt.mapInArrow(matrices, "conv_id bigint, block bigint, costs array<bigint>")

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in _runs(batches, ("conv_id",)):
            found = path([np.array(c, np.int64).reshape(N, N) for c in part["costs"]])
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * n, pa.int64()), pa.array(part["block"], pa.int64()), pa.array([a for a, _ in found], pa.int32()), pa.array([b for _, b in found], pa.int32()), pa.array([i == n - 1 for i in range(n)])],
                names=["conv_id", "block", "before", "after", "last"])

    ends = cut(whole.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(ways, "conv_id bigint, block bigint, before int, after int, last boolean"))
    known = rows.join(ends.withColumnsRenamed({"conv_id": "c", "block": "b"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    ordered = known.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn_index")
    schema = "conv_id bigint, turn bigint, turn_index bigint, role string, action string, new_role string, inserted string, starts boolean, closes string, piece string"
    return ordered.select("conv_id", "block", "turn", "turn_index", "role", "text", "before", "after", "last").mapInArrow(_render, schema)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "turn", "turn_index", "role", "action", "new_role", "inserted", "starts", "closes", "piece"]
    for key, part in _runs(batches, ("conv_id", "block")):
        out = []
        chosen = decode(part["role"], part["before"][0], part["after"][0])
        for i, (before, _, _, action, role, empty) in enumerate(chosen):
            merges = "merge" in action
            piece = "" if before == START and not empty else "\n" if merges else f"{CLOSE}\n"
            for k, r in enumerate(empty):
                opened = piece if k == 0 and before != START else ""
                piece = f"{opened}{OPEN}{r}\n{CLOSE}\n" if k == 0 else f"{piece}{OPEN}{r}\n{CLOSE}\n"
            piece += ("" if merges else f"{OPEN}{role}\n") + (part["text"][i] or "")
            closes = ""
            if part["last"][i] and i == len(chosen) - 1:
                closes = {SYSTEM: "user,assistant", USER: "assistant"}.get(part["after"][0], "")
                piece += f"{CLOSE}\n" + "".join(f"{OPEN}{r}\n{CLOSE}\n" for r in closes.split(",") if r)
            out.append((key[0], part["turn"][i], part["turn_index"][i], part["role"][i], action, role, ",".join(empty), not merges, closes, piece))
        kinds = [pa.int64()] * 3 + [pa.string()] * 4 + [pa.bool_()] + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of equal keys that follow each other, across batches, as columns."""
    held, part = None, None
    for batch in batches:
        columns = batch.to_pydict()
        names = list(columns)
        for row in zip(*columns.values()):
            key = tuple(row[names.index(k)] for k in keys)
            if part is None or key != held:
                if part is not None:
                    yield held, part
                held, part = key, {n: [] for n in names}
            for n, v in zip(names, row):
                part[n].append(v)
    if part is not None:
        yield held, part


def _numbered(rows: DataFrame, block: int) -> DataFrame:
    """With turn_index, from 0 in each conversation, and block.

    Conversations are first cut at multiples of `block` in the turn number, and turns numbered in each cut, so that a long
    conversation is numbered in many tasks; the cuts' sizes give the start of each.
    """
    cuts = rows.withColumn("cut", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / block).cast("long"))
    sizes = cuts.groupBy("conv_id", "cut").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv_id").alias("c"), F.col("cut").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("conv_id", "cut").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    nth = cuts.withColumn("nth", F.row_number().over(own))
    placed = nth.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("cut") == F.col("k")))
    index = F.col("start") + F.col("nth") - 1
    return placed.select("conv_id", "turn", "role", "text", index.cast("long").alias("turn_index"), F.floor(index / block).cast("long").alias("block"))
