"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in turn, ending with the assistant.  A
dynamic program over the automaton of legal turns chooses for each message, at least cost, whether it keeps or changes
its role, merges into the turn before it, or needs an empty turn inserted first.

One step of the program is a min-plus matrix over the automaton's states, and such matrices combine in any grouping.
A conversation longer than a block is therefore cut into blocks, whose matrices are combined first: each block then
learns its entry and exit state and is repaired on its own, so no conversation has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep, none_as_empty

#: States of the automaton: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = ("start", "system", "user", "assistant")
#: Costs of a changed role, of a merge into the turn before, and of an inserted empty turn.
RELABEL, MERGE, INSERT = 3.0, 1.0, 2.0
#: Turn numbers of a block; blocks whose matrices one task combines.
BLOCK, FAN = 2048, 256

# Other names of the three roles in public chat datasets.
ALIASES = {"human": "user", "prompter": "user", "question": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "answer": "assistant", "developer": "system"}

#: Turns that may follow each state.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def role_of(role: str | None) -> int:
    """State of a role name; 0 for one that is unknown or missing, which takes any role at no cost."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return STATES.index(name) if name in STATES[1:] else START


def _moves(said: int) -> list[tuple[int, int, float, str, bool]]:
    """(from, to, cost, action, inserted) for one message of a role."""
    out = []
    for state in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            change = 0.0 if said in (START, to) else RELABEL
            action = "keep" if not change else "relabel"
            if to in LEGAL[state]:
                out.append((state, to, change, action, False))
            elif to == state:
                out.append((state, to, change + MERGE, "merge" if not change else "relabel+merge", False))
            elif any(to in LEGAL[mid] for mid in LEGAL[state]):
                out.append((state, to, change + INSERT, action, True))
    return out


_MOVES = [sorted(_moves(said), key=lambda m: (m[2], m[1], m[0])) for said in range(4)]
_STEPS = np.full((4, 4, 4), np.inf)
for _said in range(4):
    for _from, _to, _cost, _, _ in _MOVES[_said]:
        _STEPS[_said, _from, _to] = min(_STEPS[_said, _from, _to], _cost)
#: Cost of ending in each state: an unanswered user gets an empty answer.
_FINAL = np.array([0.0, 2 * INSERT, INSERT, 0.0])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def block_matrix(said: list[int]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for role in said:
        out = combine(out, _STEPS[role])
    return out


def repair(said: list[int], entry: int, leave: int) -> list[tuple[int, str, int]]:
    """Cheapest (state, action, inserted state or -1) of each message from one state to another; ties by state number."""
    cost = [np.full(4, np.inf)]
    cost[0][entry] = 0.0
    for role in said:
        cost.append((cost[-1][:, None] + _STEPS[role]).min(axis=0))
    out, state = [], leave
    for i in range(len(said), 0, -1):
        best = min((m for m in _MOVES[said[i - 1]] if m[1] == state), key=lambda m: (cost[i - 1][m[0]] + m[2], m[0], m[4]))
        middle = next(x for x in LEGAL[best[0]] if state in LEGAL[x]) if best[4] else -1
        out.append((state, best[3], middle))
        state = best[0]
    return out[::-1]


def path(matrices: list[np.ndarray], entry: int = START, leave: int | None = None) -> list[tuple[int, int]]:
    """Entry and exit state of each of the blocks in a row; without `leave`, the end that is cheapest to close."""
    cost = [np.full(4, np.inf)]
    cost[0][entry] = 0.0
    for m in matrices:
        cost.append((cost[-1][:, None] + m).min(axis=0))
    state = int(np.argmin(cost[-1] + _FINAL)) if leave is None else leave
    out = []
    for i in range(len(matrices), 0, -1):
        before = int(np.argmin(cost[i - 1] + matrices[i - 1][:, state]))
        out.append((before, state))
        state = before
    return out[::-1]


def _matrices(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.array(m, float).reshape(4, 4) for m in rows["matrix"]]


def _ends(blocks: DataFrame, fan: int | None = None) -> DataFrame:
    """(conv, block, entry, leave) from (conv, block, matrix), by combining neighbours until few are left of each."""
    fan = fan or FAN
    most = blocks.groupBy("conv").count().agg(F.max("count")).first()[0]
    schema = "conv string, block long, entry int, leave int"

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        given = "entry" in rows
        states = path(_matrices(rows), int(rows["entry"].iloc[0]) if given else START, int(rows["leave"].iloc[0]) if given else None)
        return rows[["conv", "block"]].assign(entry=[s[0] for s in states], leave=[s[1] for s in states])

    if (most or 0) <= fan:
        return blocks.groupBy("conv").applyInPandas(solve, schema)

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
        for m in _matrices(rows.sort_values("block")):
            out = combine(out, m)
        return pd.DataFrame({"conv": [key[0]], "block": [key[1]], "matrix": [out.ravel().tolist()]})

    marked = blocks.withColumn("above", F.floor(F.col("block") / fan))
    folded = keep(marked.groupBy("conv", "above").applyInPandas(fold, "conv string, block long, matrix array<double>"))
    ends = _ends(folded, fan).withColumnRenamed("block", "above")
    return marked.join(ends, ["conv", "above"]).groupBy("conv", "above").applyInPandas(solve, schema)


def _in_blocks(batches: Iterator[pa.RecordBatch], solve: Callable[[list[dict]], list[dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Applies `solve` to the rows of each block, which come one after another, and passes on its rows by the batch."""
    held: list[dict] = []
    out: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["conv"], row["block"]) != (held[0]["conv"], held[0]["block"]):
                out += solve(held)
                held = []
            held.append(row)
        if len(out) >= BLOCK:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if held:
        out += solve(held)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv", "block").sortWithinPartitions("conv", "block", F.col("turn").asc_nulls_first(), F.coalesce("role", F.lit("")), F.col("role").asc_nulls_first())


def _messages(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, new_role, action, inserted, first, last): the repair of each message.

    Only conversations of several blocks need the matrices; all others are repaired in one pass.
    """
    light = turns.select("conv", "block", "turn", "role").distinct()
    several = light.groupBy("conv").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo < hi").select("conv", "hi")

    def measure(rows: list[dict]) -> list[dict]:
        return [{"conv": rows[0]["conv"], "block": rows[0]["block"], "matrix": block_matrix([role_of(r["role"]) for r in rows]).ravel().tolist()}]

    def mend(rows: list[dict]) -> list[dict]:
        said, (entry, leave, closing) = [role_of(r["role"]) for r in rows], (rows[0][c] for c in ("entry", "leave", "closing"))
        if entry is None:
            (entry, leave), closing = path([block_matrix(said)])[0], True
        steps = repair(said, entry, leave)
        return [
            {"conv": r["conv"], "turn": r["turn"], "role": r["role"], "new_role": STATES[s], "action": a, "inserted": STATES[m] if m >= 0 else None, "first": k == 0 and entry == START, "last": closing and k == len(rows) - 1}
            for k, (r, (s, a, m)) in enumerate(zip(rows, steps, strict=True))
        ]

    blocks = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("matrix", pa.list_(pa.float64()))])
    matrices = _by_block(light.join(several, "conv", "left_semi")).mapInArrow(lambda it: _in_blocks(it, measure, blocks), "conv string, block long, matrix array<double>")
    ends = _ends(keep(matrices)).join(several, "conv").select("conv", "block", "entry", "leave", (F.col("block") == F.col("hi")).alias("closing"))
    done = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("new_role", pa.string()), ("action", pa.string()), ("inserted", pa.string()), ("first", pa.bool_()), ("last", pa.bool_())])
    rows = _by_block(light.join(ends, ["conv", "block"], "left"))
    return rows.mapInArrow(lambda it: _in_blocks(it, mend, done), "conv string, turn long, role string, new_role string, action string, inserted string, first boolean, last boolean")


def repaired(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per message: conv_id, turn, role, part, new_role, action, inserted, rendered.

    Messages of a conversation are taken by turn (null first), then role (null as empty); rows of equal turn and role are
    parts of one message, in the order of their texts, numbered by `part` from 1, and all but the first merge into it.
    Turn, role and part so give each row its place (`in_order` sorts by them).  `action` is keep, relabel, merge or
    relabel+merge; `inserted` is the role of an empty turn placed before the message, or null.  An unknown or null role
    takes any legal one at no cost; a null text is empty; a null conv_id is a conversation like any other; other columns
    are ignored; an empty table gives an empty result.  The repair has the least total cost of all legal sequences; ties
    go to the smaller state number, block by block.  The `rendered` pieces of a conversation, in order, are its rendered form: every turn
    is `<|role|>`, a line end, its texts joined by a line end, and `<|end|>` with a line end.
    """
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 52))).cast("long").alias("block"),
        F.col("turn").cast("long").alias("turn"), "role", none_as_empty().alias("text"),
    )
    steps = _messages(rows)
    parts = W.partitionBy("conv", "turn", "role")
    numbered = rows.withColumn("part", F.row_number().over(parts.orderBy("text"))).withColumn("parts", F.count("*").over(parts))
    steps = steps.select(*(F.col(c).alias(f"s_{c}") for c in steps.columns))
    same = (F.col("conv") == F.col("s_conv")) & F.col("turn").eqNullSafe(F.col("s_turn")) & F.col("role").eqNullSafe(F.col("s_role"))
    out = numbered.join(steps, same)
    inner = F.col("part") > 1
    action = F.when(inner, F.when(F.col("s_action").startswith("relabel"), "relabel+merge").otherwise("merge")).otherwise(F.col("s_action"))
    opened = lambda role: F.concat(F.lit("<|"), role, F.lit("|>\n"))
    close = F.lit("<|end|>\n")
    starts = ~action.endswith("merge")
    inserted = F.when(~inner, F.col("s_inserted"))
    before = F.when(starts, F.concat(F.when(F.col("s_first"), F.lit("")).otherwise(close), F.coalesce(F.concat(opened(inserted), close), F.lit("")), opened(F.col("s_new_role")))).otherwise(F.lit("\n"))
    is_last = F.col("s_last") & (F.col("part") == F.col("parts"))
    missing = F.when(F.col("s_new_role") == "user", F.concat(opened(F.lit("assistant")), close)).when(F.col("s_new_role") == "system", F.concat(opened(F.lit("user")), close, opened(F.lit("assistant")), close)).otherwise(F.lit(""))
    rendered = F.concat(before, F.col("text"), F.when(is_last, F.concat(close, missing)).otherwise(F.lit("")))
    return out.select(
        F.expr("cast(nullif(conv, '') as long)").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "part", F.col("s_new_role").alias("new_role"),
        action.alias("action"), inserted.alias("inserted"), rendered.alias("rendered"),
    )


def in_order(messages: DataFrame) -> DataFrame:
    """The rows of `repaired` sorted by conversation and place, so that their `rendered` pieces follow each other.

    A total sort: ranges of rows go to tasks, so a long conversation is dealt to several.
    """
    return messages.orderBy("conv_id", F.col("turn").asc_nulls_first(), F.coalesce("role", F.lit("")), F.col("role").asc_nulls_first(), "part")
