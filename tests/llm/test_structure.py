import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF

from eventcanon.llm import structure

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def legal_next(state, role):
    return role[:1] if (state == "" and role[:1] in ("s", "u")) or (state and state + role[:1] in ("su", "ua", "au")) else None


def brute(rows):
    """One row after the other, with the least (cost, audit) and its turns for each last role."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        s = text.rstrip(BLANKS)
        faults.append("blank" if not s else "duplicate" if (role, text) in seen else "" if s[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def with_inserts(best):
        for _ in range(3):
            for s, (c, a, o) in list(best.items()):
                for r in ("user", "assistant"):
                    n, way = legal_next(s, r), (c + 5, a + "I", (*o, (r, "")))
                    if n is not None and (n not in best or way[:2] < best[n][:2]):
                        best[n] = way
        return best

    best = with_inserts({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new, extra = {}, 5 * (fault == "truncated")
        for s, (c, a, o) in best.items():
            ways = [(s, (c + 2, a + "D", o))]
            if fault not in ("blank", "duplicate"):
                ways.append((legal_next(s, role), (c + extra, a + "K", (*o, (role, text)))))
                ways += [(legal_next(s, r), (c + 1 + extra, a + "R", (*o, (r, text)))) for r in ("user", "assistant")]
            for n, way in ways:
                if n is not None and (n not in new or way[:2] < new[n][:2]):
                    new[n] = way
        best = with_inserts(new)
    cost, audit, turns = min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        held += [(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    out = []
    for conv in [None, *range(250)]:
        long = conv == 7
        for _ in range(500 if long else rng.randrange(9)):
            text = rng.choice(["a.", "b.", "c!", "d", "", "  ", "e?\n", None]) if rng.random() < 0.3 else f"x{rng.random()}" + rng.choice([".", ".", ""])
            out.append((conv, rng.randrange(450) if long else rng.choice([None, *range(9)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), text))
    return out


@pytest.mark.parametrize("segment", [2048, 5])
def test_odd_conversations_against_brute_force(spark, odd_rows, segment):
    df = spark.createDataFrame(odd_rows, SCHEMA).selectExpr("*", "1 AS segment", "2 AS pos", "3 AS fault", "4 AS copies")
    got = {r.conv_id: tuple(r)[1:] for r in structure.repair(structure.damaged(df), df.select("conv_id"), segment).collect()}
    assert got == {c: brute(rows) for c, rows in damaged(odd_rows).items()}


def test_turns_of_repaired_conversations(spark, odd_rows):
    df = structure.damaged(spark.createDataFrame(odd_rows, SCHEMA))
    sums = {r.conv_id: r for r in structure.repair(df).collect()}
    turns = {}
    for r in structure.repaired_turns(df, 16).collect():
        turns.setdefault(r.conv_id, []).append(r)
    for conv, held in turns.items():
        held.sort(key=lambda r: r.place)
        assert [r.place for r in held] == list(range(len(held)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in held)) and "".join(r.edit for r in held) == sums[conv].audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in held).encode()).hexdigest() == sums[conv].repaired_sha256
    assert all(set(r.audit) <= {"D"} for c, r in sums.items() if c not in turns)


def test_ranks_order_nodes_by_their_audits():
    rng = random.Random(4)
    rows = [(rng.choice(["s", "u", "a", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(60)]
    go = structure.costs_to_go(rows, list(structure.ENDS))
    label, pointer = np.zeros(4 * 61, np.int64), np.arange(4 * 61)
    for i, row in enumerate(rows):
        for s in range(4):
            ways = [(e, i + 1, to) for e, c, to in structure.KINDS[row][s] if c + go[i + 1][to] == go[i][s]]
            ways += [("I", i, structure.TURN[s])] if 5 + go[i][structure.TURN[s]] == go[i][s] else []
            edit, at, to = min(ways)
            label[4 * i + s], pointer[4 * i + s] = ord(edit), 4 * at + to
    spelled = []
    for node in range(len(label)):
        text = ""
        while label[node]:
            text, node = text + chr(label[node]), pointer[node]
        spelled.append(text)
    rank, _ = structure.doubled(label, pointer)
    assert np.unique(spelled, return_inverse=True)[1].tolist() == rank.tolist()


def test_many_copies_and_empty_table(spark, monkeypatch):
    rows = [(1, 0, "user", "hello."), *[(1, 1, "assistant", "again.")] * 500, (1, 2, "user", "x" * 100_000), (2, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(structure, "COPIES_AT_ONCE", 64)
    got = {r.conv_id: tuple(r)[1:] for r in structure.repair(df, segment=100).collect()}
    assert got[1] == brute([r[1:] for r in rows[:-1]]) and got[2][:7] == (0, 1, 0, 0, 0, 2, "D")
    assert structure.repair(df.limit(0)).count() == 0 and structure.report(df.limit(0)).count() == 0


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in structure.report(df).collect()} == {c: brute(v) for c, v in damaged(rows).items()}
