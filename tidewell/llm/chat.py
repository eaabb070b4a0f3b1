"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
turn, beginning with the user.  For every turn the repair may keep its role, give it
another one, merge it into the turn before, or put empty turns before it.  A dynamic
programme over the automaton of the last role finds the cheapest repair; the state
costs compose like matrices (smallest sum), so a conversation need not be in one
place: rows are sorted and cut into even blocks, each block contributes one matrix
for a conversation that crosses its border, matrices are combined in levels of
bounded groups, and the chosen states go back down the levels to the blocks.

Costs: 2 for another role (1 for a turn whose role is unknown), 1 for a merge, 3 for
an empty turn.  Of equal repairs the one through the earlier state (start, system,
user, assistant) is taken, and a merge before an insertion.

The result has one row per input turn and per empty turn, in the order of
(conv_id, place, part); its ``rendered`` texts joined in this order are the
formatted conversation, so that no conversation has to fit in one row.  Turns are
ordered by turn (nulls last), then role and text.  Null texts are empty; rows with a
null conv_id form one conversation; repeated rows are turns of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import settle

ROLES = ("system", "user", "assistant")
OTHER_NAMES = {"developer": "system", "human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (USER, ASSISTANT)
RELABEL, NAME, MERGE, INSERT = 2, 1, 1, 3
NEVER = 1 << 40
BLOCK_BITS = 10
OPEN, CLOSE, JOIN = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"


def _ways(state: int) -> dict[int, tuple[int, ...]]:
    """Roles that may come after a state, with the empty turns needed before them."""
    found: dict[int, tuple[int, ...]] = {}
    paths = [(state, ())]
    while paths:
        at, between = paths.pop(0)
        for role in NEXT[at]:
            if role not in found:
                found[role] = between
                paths.append((role, (*between, role)))
    return found


def _step(role: int, state: int, to: int) -> tuple[int, bool, tuple[int, ...]]:
    """Cost of a turn of a role (0: unknown) becoming ``to`` after a state; merged; empty turns before."""
    if to == START:
        return NEVER, False, ()
    cost = 0 if role == to else RELABEL if role else NAME
    if state == to:
        return cost + MERGE, True, ()
    between = _ways(state).get(to)
    if between is None:
        return NEVER, False, ()
    return cost + INSERT * len(between), False, between


STEPS = [[[_step(role, state, to) for to in range(4)] for state in range(4)] for role in range(4)]
STEP_COSTS = np.array([[[STEPS[r][s][t][0] for t in range(4)] for s in range(4)] for r in range(4)], np.int64)
# what must follow the last turn: an empty user turn after a lone system turn
END_COSTS = np.array([0 if s in (*FINAL, START) else INSERT for s in range(4)], np.int64)


def _compose(matrices: list[np.ndarray]) -> np.ndarray:
    whole = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for m in matrices:
        whole = np.minimum((whole[:, :, None] + m[None]).min(axis=1), NEVER)
    return whole


def _path(matrices: list[np.ndarray], entry: int, leave: int | None) -> list[int]:
    """States before, between and after the steps; the cheapest end where none is given."""
    costs = [np.where(np.arange(4) == entry, 0, NEVER)]
    for m in matrices:
        costs.append((costs[-1][:, None] + m).min(axis=0))
    states = [int((costs[-1] + END_COSTS).argmin()) if leave is None else leave]
    for m, before in zip(reversed(matrices), reversed(costs[:-1])):
        states.append(int((before + m[:, states[-1]]).argmin()))
    return states[::-1]


def _code(role) -> object:
    """1 to 3 for the roles, 0 for an unknown one."""
    name = F.lower(F.trim(role))
    known = {**{r: r for r in ROLES}, **OTHER_NAMES}
    found = F.lit(0)
    for other, meant in known.items():
        found = F.when(name == other, ROLES.index(meant) + 1).otherwise(found)
    return found


def _same(a, b) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))


def _fragments(conversations: pd.Series) -> list[tuple[int, int]]:
    """Ranges of equal neighbours; nulls are equal."""
    values = conversations.tolist()
    cuts = [0, *[k for k in range(1, len(values)) if not _same(values[k], values[k - 1])], len(values)]
    return list(zip(cuts, cuts[1:]))


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, place, part, role, action, rendered of all conversations."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turn_kind = conversations.schema["turn"].dataType.simpleString()
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("was"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("code", _code(F.col("was"))).withColumn("spread", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), "was", F.xxhash64("text"), "spread"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread")
    placed = settle(placed.withColumn("place", F.monotonically_increasing_id()), "turns")
    placed = placed.withColumn("block", F.shiftright("place", BLOCK_BITS))
    states = _border_states(placed, kind)

    def render(turns: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        turns = turns.sort_values("place", ignore_index=True)
        borders = {None if pd.isna(c) else c: (int(e), None if pd.isna(x) else int(x), bool(last)) for c, e, x, last in known[["conv_id", "entry", "leave", "last"]].itertuples(index=False)}
        out = []
        codes = turns["code"].tolist()
        data = list(turns[["conv_id", "turn", "place", "text"]].itertuples(index=False, name=None))
        for first, end in _fragments(turns["conv_id"]):
            conversation = data[first][0]
            entry, leave, last = borders.get(None if pd.isna(conversation) else conversation, (START, None, True))
            path = _path([STEP_COSTS[c] for c in codes[first:end]], entry, leave)
            for k in range(first, end):
                conv, turn, place, text = data[k]
                before, after = path[k - first], path[k - first + 1]
                _, merged, between = STEPS[codes[k]][before][after]
                part = 0
                for role in between:
                    closing = CLOSE if before != START or part else ""
                    out.append((conv, turn, place, part, ROLES[role - 1], "insert", closing + OPEN.format(ROLES[role - 1])))
                    part += 1
                done = JOIN + text if merged else (CLOSE if before != START or part else "") + OPEN.format(ROLES[after - 1]) + text
                action = ("merge" if merged else "keep") if codes[k] == after else ("merge and relabel" if merged else "relabel")
                if last and k == end - 1:
                    done += CLOSE
                out.append((conv, turn, place, part, ROLES[after - 1], action, done))
                if last and k == end - 1 and after == SYSTEM:
                    out.append((conv, turn, place, part + 1, "user", "insert", OPEN.format("user") + CLOSE))
        columns = ["conv_id", "turn", "place", "part", "role", "action", "rendered"]
        made = pd.DataFrame(out, columns=columns)
        return made.assign(conv_id=made["conv_id"].astype(turns["conv_id"].dtype), turn=made["turn"].astype(turns["turn"].dtype))

    schema = f"conv_id {kind}, turn {turn_kind}, place long, part int, role string, action string, rendered string"
    return placed.groupBy("block").cogroup(states.groupBy("block")).applyInPandas(render, schema)


def _border_states(placed: DataFrame, kind: str) -> DataFrame:
    """block, conv_id, entry, leave, last for conversations at the borders of blocks.

    Conversations inside a block need no entry here: they start and end in it.
    """
    matrix = f"conv_id {kind}, key long, cost array<long>"

    def border(turns: pd.DataFrame) -> pd.DataFrame:
        turns = turns.sort_values("place", ignore_index=True)
        fragments = _fragments(turns["conv_id"])
        found = []
        for first, end in dict.fromkeys([fragments[0], fragments[-1]]):
            whole = _compose([STEP_COSTS[c] for c in turns["code"].iloc[first:end]])
            found.append((turns["conv_id"].iloc[first], turns["block"].iloc[0], whole.ravel()))
        made = pd.DataFrame(found, columns=["conv_id", "key", "cost"])
        return made.assign(conv_id=made["conv_id"].astype(turns["conv_id"].dtype))

    def combine(level: pd.DataFrame) -> pd.DataFrame:
        level = level.sort_values("key", ignore_index=True)
        whole = _compose([np.asarray(c).reshape(4, 4) for c in level["cost"]])
        return pd.DataFrame({"conv_id": level["conv_id"].iloc[:1], "key": level["above"].iloc[:1], "cost": [whole.ravel()]})

    levels = [settle(placed.drop("text").groupBy("block").applyInPandas(border, matrix), "borders")]
    rules = []
    # every level joins up to 2^BLOCK_BITS neighbours of a conversation
    while True:
        widest = levels[-1].groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if widest <= 1:
            break
        rules.append(F.lit(0).cast("long") if widest <= 1 << BLOCK_BITS else F.shiftright("key", BLOCK_BITS))
        upper = levels[-1].withColumn("above", rules[-1]).groupBy("conv_id", "above").applyInPandas(combine, matrix)
        levels.append(settle(upper, "borders"))
    known = levels[-1].select("conv_id", "key", F.lit(START).alias("entry"), F.lit(None).cast("int").alias("leave"), F.lit(True).alias("last"))

    def split(level: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        level = level.sort_values("key", ignore_index=True)
        leave = outer["leave"].iloc[0]
        path = _path([np.asarray(c).reshape(4, 4) for c in level["cost"]], int(outer["entry"].iloc[0]), None if pd.isna(leave) else int(leave))
        last = [False] * (len(level) - 1) + [bool(outer["last"].iloc[0])]
        return pd.DataFrame({"conv_id": level["conv_id"], "key": level["key"], "entry": path[:-1], "leave": path[1:], "last": last})

    schema = f"conv_id {kind}, key long, entry int, leave int, last boolean"
    for level, rule in zip(reversed(levels[:-1]), reversed(rules)):
        lower = level.withColumn("above", rule).groupBy("conv_id", "above")
        upper = known.withColumnRenamed("key", "above").groupBy("conv_id", "above")
        known = settle(lower.cogroup(upper).applyInPandas(split, schema), "states")
    return known.withColumnRenamed("key", "block")
