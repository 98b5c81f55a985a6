import itertools
import random
import re

from conftest import SF

from eventcanon.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_cost(roles):
    """Least cost over all ways, one turn after the other."""
    costs = {chat.START: 0}
    for r in roles:
        now = {}
        for before, after, price, *_ in chat.options(r if r in chat.ROLES else None):
            if before in costs:
                now[after] = min(now.get(after, chat.FAR), costs[before] + price)
        costs = now
    return min(c + chat.ENDS[s] for s, c in costs.items())


def cost_of(rows):
    total = 0
    for r in rows:
        known = r.role in chat.ROLES
        total += chat.MERGE * ("merge" in r.action) + chat.INSERT * len([x for x in r.inserted.split(",") if x])
        total += 0 if r.role == r.new_role else chat.RELABEL if known else chat.UNKNOWN
        total += {"": 0, "assistant": chat.TAIL, "user,assistant": chat.INSERT + chat.TAIL}[r.closes]
    return total


def rendered(rows):
    return "".join(r.piece for r in sorted(rows, key=lambda r: r.turn_index))


def legal(text):
    turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
    assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns) == text
    roles = [r for r, _ in turns]
    body = roles[1:] if roles[:1] == ["system"] else roles
    return body and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body)) and len(body) % 2 == 0


def test_every_short_conversation(spark):
    kinds = ["system", "user", "assistant", "robot"]
    all_ways = [w for n in (1, 2, 3, 4) for w in itertools.product(kinds, repeat=n)]
    rows = [(i, k, r, f"t{k}") for i, w in enumerate(all_ways) for k, r in enumerate(w)]
    out = {}
    for r in chat.repair(spark.createDataFrame(rows, SCHEMA), block=2).collect():
        out.setdefault(r.conv_id, []).append(r)
    for i, w in enumerate(all_ways):
        text = rendered(out[i])
        assert legal(text) and cost_of(out[i]) == brute_cost(w), w
        assert [m for m in re.findall(r"t\d", text)] == [f"t{k}" for k in range(len(w))]


def test_long_and_odd_conversations(spark):
    rng = random.Random(6)
    long = [(1, i, rng.choice(["user", "assistant", "system", None]), f"x{i}") for i in range(1000)]
    odd = [(2, None, "user", None), (2, None, "user", None), (2, 5, "assistant", ""), (None, 0, "user", "a"), (None, 1, "assistant", "b" * 100_000), (3, 0, "assistant", "only"), (3, 0, "user", "tie")]
    df = spark.createDataFrame(long + odd, SCHEMA).selectExpr("*", "1 AS block", "2 AS piece", "3 AS cut")
    out = {}
    for r in chat.repair(df, block=64).collect():
        out.setdefault(r.conv_id, []).append(r)
    assert [r.turn_index for r in sorted(out[1], key=lambda r: r.turn_index)] == list(range(1000))
    assert legal(rendered(out[1])) and cost_of(out[1]) == brute_cost([r[2] for r in long])
    assert all(legal(rendered(out[k])) for k in (2, 3, None))
    assert rendered(out[3]).index("only") < rendered(out[3]).index("tie")
    assert chat.repair(df.limit(0)).count() == 0


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    out = {}
    for r in chat.repair(df).collect():
        out.setdefault(r.conv_id, []).append(r)
    assert sum(map(len, out.values())) == df.count() and all(legal(rendered(v)) for v in out.values())
