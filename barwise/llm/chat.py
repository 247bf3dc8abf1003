"""Chat formatting: minimum-cost role repair, then rendering.

A legal conversation is an optional system turn, then user and assistant turns
in alternation, the last one the assistant's. Each given turn is kept,
relabelled, merged into the turn before it, or preceded by an inserted empty
turn; the repair of least total cost is found by dynamic programming over the
automaton of the last emitted role. Ties go to fewer output turns, then to the
first action in the order keep, merge, relabel, insert at the earliest turn.

A conversation may be long beyond one task. Turns are range-partitioned in
order, so a long one lies in several partitions. Costs over a stretch of turns
form a small matrix (state before by state after) and such matrices compose,
so only the two conversations at a partition's edges (its fragments) are
summarised; from these come, for each fragment, the cost still to go after
its last turn, its state on entry, and the number of its first output turn.
The repair itself then runs per partition. The driver sees two rows a
partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.session import checkpoint_root

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # the last emitted role; role r leads to state r + 1
LEGAL = {START: (0, 1), SYSTEM: (1,), USER: (2,), ASSISTANT: (1,)}
# To put words into the other party's mouth costs most.
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 5, 1, 1, 3
INF = 1 << 60
_UNIT = 1 << 40  # a cost point outweighs any number of output turns


def _options(state: int, role: int) -> list[tuple[int, int, int, int]]:
    """(cost, next state, inserted role or -1, merged) for a turn, in order of preference."""
    relabel = lambda q: 0 if q == role else RELABEL_UNKNOWN if role == 3 else RELABEL
    emit = [((relabel(q)) * _UNIT + 1, q + 1, -1, 0) for q in LEGAL[state]]
    merge = [((MERGE + relabel(state - 1)) * _UNIT, state, -1, 1)] if state else []
    insert = [((INSERT + relabel(q)) * _UNIT + 2, q + 1, x, 0) for x in LEGAL[state] for q in LEGAL[x + 1]]
    keep = [o for o in emit if o[0] < _UNIT]
    return keep + merge + [o for o in emit if o[0] >= _UNIT] + insert


OPTIONS = [[_options(s, r) for r in range(4)] for s in range(4)]
# Closing an ended conversation: nothing, or the empty turns that lead to the assistant.
CLOSING = {START: (0, ()), SYSTEM: (2 * INSERT * _UNIT + 2, (1, 2)), USER: (INSERT * _UNIT + 1, (2,)), ASSISTANT: (0, ())}
END = [CLOSING[s][0] for s in range(4)]


def to_go(roles: list[int], after: list[int]) -> list[list[int]]:
    """For each turn and state before it, the least cost from there on, given that after the last turn."""
    out = [list(after)]
    for r in reversed(roles):
        then = out[-1]
        out.append([min((c + then[n] for c, n, _, _ in OPTIONS[s][r]), default=INF) for s in range(4)])
    return out[::-1]


def repair(roles: list[int], state: int, after: list[int]) -> tuple[list[tuple[int, int, int, int]], int]:
    """(the chosen option for each turn, state after the last)."""
    costs = to_go(roles, after)
    chosen = []
    for i, r in enumerate(roles):
        best = costs[i][state]
        option = next(o for o in OPTIONS[state][r] if o[0] + costs[i + 1][o[1]] == best)
        chosen.append(option)
        state = option[1]
    return chosen, state


def _role(name: str | None) -> int:
    name = (name or "").strip().lower()
    return ROLES.index(name) if name in ROLES else 3


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list[int], list[str]]]:
    """(partition, conversation, roles, texts) of each stretch of one conversation in a partition."""
    held: tuple[int, int | None, list[int], list[str]] | None = None
    for b in batches:
        for pid, conv, role, text in zip(*(b.column(k).to_pylist() for k in range(4))):
            if held is None or held[1] != conv:
                if held:
                    yield held
                held = (pid, conv, [], [])
            held[2].append(_role(role))
            held[3].append(text or "")
    if held:
        yield held


def _fragments(turns: DataFrame) -> list:
    """(pid, conv_id, place in the partition, least costs by state before and after) of the first
    and last stretch of each partition that continue in a neighbouring one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for k, (pid, conv, roles, _) in enumerate(_runs(batches)):
            last = (pid, conv, k, roles)
            first = first or last
        rows = [x for x in (first, last) if x is not None][: 1 if first is last else 2]
        flat = [[to_go(roles, [0 if s == e else INF for s in range(4)])[0][b] for b in range(4) for e in range(4)] for _, _, _, roles in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array(flat, pa.list_(pa.int64()))], names=["pid", "conv_id", "k", "m"])

    return turns.mapInArrow(run, "pid long, conv_id long, k long, m array<long>").orderBy("pid", "k").collect()


def _exits(turns: DataFrame, after: dict) -> dict:
    """(pid, conv_id) -> for each state on entry (state on exit, cost): where the chosen repair leads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for pid, conv, roles, _ in _runs(batches):
            if (pid, conv) in after:
                for s in range(4):
                    if to_go(roles, after[pid, conv])[0][s] < INF:
                        chosen, end = repair(roles, s, after[pid, conv])
                        out.append((pid, conv, s, end, sum(o[0] for o in chosen)))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], names=["pid", "conv_id", "s", "e", "c"])

    rows = turns.mapInArrow(run, "pid long, conv_id long, s long, e long, c long").collect()
    return {(r["pid"], r["conv_id"], r["s"]): (r["e"], r["c"]) for r in rows}


def _plan(turns: DataFrame) -> dict:
    """(pid, conv_id) -> (cost to go after its last turn, state on entry, output turns before) for
    stretches of conversations that lie in several partitions."""
    chains: list[list] = []
    for r in _fragments(turns):
        if chains and chains[-1][-1]["conv_id"] == r["conv_id"] and chains[-1][-1]["pid"] < r["pid"]:
            chains[-1].append(r)
        else:
            chains.append([r])
    chains = [c for c in chains if len(c) > 1]
    after: dict = {}
    for chain in chains:
        then = END
        for r in reversed(chain):
            after[r["pid"], r["conv_id"]] = then
            m = np.array(r["m"], dtype=object).reshape(4, 4)
            then = [min(min(int(m[s][e]) + then[e] for e in range(4)), INF) for s in range(4)]
    exits = _exits(turns, after) if after else {}
    plan: dict = {}
    for chain in chains:
        state, before = START, 0
        for r in chain:
            key = (r["pid"], r["conv_id"])
            plan[key] = (after[key], state, before, r is chain[-1])
            state, cost = exits[key[0], key[1], state]
            before += cost % _UNIT
    return plan


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, out_turn (from 0), role, n_source (given turns in it, 0 if inserted), cost, rendered.

    Turns are taken by (turn, role, text), nulls last; a null conv_id is one
    conversation. Unknown and null roles are relabelled at a lower cost; null
    texts are empty. Repeated rows are turns of their own. Merged texts are
    joined by a line break. An empty table gives no rows.
    """
    spark = conversations.sparkSession
    checkpoint_root(spark)
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns = rows.repartitionByRange(parts, *order[:4]).sortWithinPartitions(*order) \
        .select(F.spark_partition_id().cast("long").alias("pid"), "conv_id", "role", "text").checkpoint()
    plan = _plan(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for pid, conv, roles, texts in _runs(batches):
            after, state, number, ends = plan.get((pid, conv), (END, START, 0, True))
            split = (pid, conv) in plan
            chosen, last = repair(roles, state, after)
            number -= 1
            for (cost, to, inserted, merged), text in zip(chosen, texts):
                if inserted >= 0:
                    number += 1
                    out.append((conv, number, inserted, 0, INSERT, pid, "", split))
                    cost -= INSERT * _UNIT
                if merged and out and out[-1][:2] == (conv, number):
                    _, _, role, n, c, _, old, _ = out.pop()
                    out.append((conv, number, role, n + 1, c + cost // _UNIT, pid, f"{old}\n{text}", split))
                    continue
                number += not merged
                out.append((conv, number, to - 1, 1, cost // _UNIT, pid, text, split))
            for role in CLOSING[last][1] if ends else ():
                number += 1
                out.append((conv, number, role, 0, INSERT, pid, "", split))
            if len(out) > 5000:  # the last turn may still be merged into, but only by its own stretch, which is done
                yield _batch(out)
                out = []
        yield _batch(out)

    done = turns.mapInArrow(run, "conv_id long, out_turn long, role int, n_source long, cost long, pid long, text string, split boolean")
    whole = done.filter("not split").select("conv_id", "out_turn", "role", "n_source", "cost", "text")
    # A turn of a split conversation may go on in the next partition.
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pid", "text"))), lambda x: x["text"]), "\n")
    joined = done.filter("split").groupBy("conv_id", "out_turn").agg(
        F.max("role").alias("role"), F.sum("n_source").alias("n_source"), F.sum("cost").alias("cost"), text.alias("text"))
    name = F.get(F.array(*[F.lit(r) for r in ROLES]), F.col("role"))
    return whole.unionByName(joined).select("conv_id", "out_turn", name.alias("role"), "n_source", "cost",
                                            F.concat(F.lit("<|"), name, F.lit("|>\n"), F.col("text"), F.lit("<|end|>\n")).alias("rendered"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    names = ["conv_id", "out_turn", "role", "n_source", "cost", "pid", "text", "split"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
