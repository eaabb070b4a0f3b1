import itertools
import random
import re

import pytest
from cases import bag

from tidewell.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place string, part string, block string"
KNOWN = {"system": 1, "user": 2, "assistant": 3, " Human ": 2, "gpt": 3}


def cheapest(codes):
    """Least cost, trying every empty turn, role and merge."""
    now = {0: 0}
    for code in codes:
        after = {}
        for state, cost in now.items():
            for empty in itertools.chain([()], itertools.product((1, 2, 3), repeat=1), itertools.product((1, 2, 3), repeat=2)):
                at = state
                for role in empty:
                    at = role if role in chat.NEXT[at] else None
                    if at is None:
                        break
                if at is None:
                    continue
                for to in (1, 2, 3):
                    change = 0 if to == code else 2 if code else 1
                    for way in [0] * (to in chat.NEXT[at]) + [1] * (to == at):
                        after[to] = min(after.get(to, 10**9), cost + 3 * len(empty) + change + way)
        now = after
    return min(cost + 3 * (state == 1) for state, cost in now.items())


def cost_of(actions, roles):
    total, source = 0, iter(roles)
    for action in actions:
        if action == "insert":
            total += 3
        else:
            code = KNOWN.get(next(source), 0)
            total += ("merge" in action) + (2 if code else 1) * ("relabel" in action)
    return total


def conversations(seed=1):
    pick = random.Random(seed)
    roles = [*KNOWN, "tool", None]
    rows = [(c, t, pick.choice(roles), f"{c}.{t}") for c in range(40) for t in range(pick.randint(1, 7))]
    rows += [(100, t, pick.choice(["system", "user", "user", "assistant"]), f"x{t}") for t in range(150)]
    rows += [(None, 0, "user", "n"), (None, None, "user", None), (7, None, "user", "last"), (101, 0, "system", "alone")]
    return [(*r, "", "", "") for r in rows]


@pytest.mark.parametrize("bits", [3, 10])
def test_repairs_cost_least_and_are_legal(spark, monkeypatch, bits):
    monkeypatch.setattr(chat, "BLOCK_BITS", bits)
    rows = conversations()
    found = chat.repaired(spark.createDataFrame(rows, SCHEMA).repartition(3)).toPandas()
    by_id = {}
    for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0)):
        by_id.setdefault(r[0], []).append(r)
    assert sum(found["action"] != "insert") == len(rows)
    for conv, group in found.sort_values(["place", "part"]).groupby("conv_id", dropna=False):
        source = by_id[None if conv != conv else conv]
        assert cost_of(group["action"], [r[2] for r in source]) == cheapest([KNOWN.get(r[2], 0) for r in source])
        text = "".join(group["rendered"])
        turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
        assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns) == text
        assert re.fullmatch(r"(system )?(user assistant )*(user )?", "".join(f"{r} " for r, _ in turns)) and "user" in dict(turns)
        assert [w for _, t in turns for w in t.split()] == [r[3] for r in source if r[3]]


def test_legal_conversations_stay(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"), (2, 5, "user", "u")]
    found = chat.repaired(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA))
    assert bag(found.select("conv_id", "action").collect()) == bag([(1, "keep")] * 3 + [(1, "merge"), (2, "keep")])


def test_no_conversations(spark):
    assert chat.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
