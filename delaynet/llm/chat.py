"""Minimum-cost repair of chat roles, and rendering of the repaired turns.

Legal conversations are an optional system turn, then user and assistant turns in
alternation, ending with the assistant. A turn may keep its role, be relabelled, be
merged into the turn before it, or have empty turns put in front of it; a dynamic
program over the automaton of legal turns finds the cheapest repair.

The program is a product of small min-plus matrices, so a conversation can be cut
anywhere: rows are range-partitioned by conversation and turn, and one that spans
partitions is summarised by one matrix per partition. The driver chains these (two
conversations per partition at most reach over its ends) and hands back the states
at the cuts. So a single conversation with most of all rows is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaynet.llm.common import map_batches
from delaynet.session import materialize

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, or the role of the last turn
FOLLOWERS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    insert: int = 2
    relabel: int = 3
    name: int = 1  # a role for a turn whose role is missing or unknown


def role_number(role: str | None) -> int:
    """State of a role name, whatever its case or padding; START if it is no role."""
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else START


def _fillers() -> dict[tuple[int, int], tuple[int, ...]]:
    """The empty turns that make each role legal after each state; absent if none do."""
    found = {}
    for state, legal in FOLLOWERS.items():
        for role in (SYSTEM, USER, ASSISTANT):
            if role in legal:
                found[state, role] = ()
            else:
                between = [via for via in legal if via != SYSTEM and role in FOLLOWERS[via]]
                if between:
                    found[state, role] = (between[0],)
    return found


FILLERS = _fillers()
CLOSERS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
IMPOSSIBLE = 1 << 40


def choices(role: int, costs: Costs) -> list[list[tuple[int, int, int]]]:
    """For a turn's role, the ways out of each state: cost, next state, and 1 for a merge; the preferred first."""
    ways = []
    for state in range(4):
        out = []
        for target in (SYSTEM, USER, ASSISTANT):
            label = 0 if target == role else costs.name if role == START else costs.relabel
            if (state, target) in FILLERS:
                out.append((label + costs.insert * len(FILLERS[state, target]), target, 0))
            if state == target:
                out.append((label + costs.merge, target, 1))
        ways.append(sorted(out))
    return ways


def forward(roles: list[int], costs: Costs) -> np.ndarray:
    """Least cost from each state before the turns to each state after them."""
    ways = [choices(role, costs) for role in range(4)]
    total = np.full((4, 4), IMPOSSIBLE, dtype=np.int64)
    for entry in range(4):
        now = [IMPOSSIBLE] * 4
        now[entry] = 0
        for role in roles:
            after = [IMPOSSIBLE] * 4
            for state, cost in enumerate(now):
                if cost < IMPOSSIBLE:
                    for extra, target, _ in ways[role][state]:
                        if cost + extra < after[target]:
                            after[target] = cost + extra
            now = after
        total[entry] = now
    return total


def repair(roles: list[int], costs: Costs, entry: int = START, leave: int | None = None) -> list[tuple[int, int, int]]:
    """The cheapest way through all turns: state before, state after and merge flag of each.

    With `leave` the last state is given; otherwise closing turns count as well.
    Ties go to the smaller last state, then to the smaller state before it.
    """
    ways = [choices(role, costs) for role in range(4)]
    now = [IMPOSSIBLE] * 4
    now[entry] = 0
    back: list[list[tuple[int, int] | None]] = []
    for role in roles:
        after, via = [IMPOSSIBLE] * 4, [None] * 4
        for state, cost in enumerate(now):
            if cost < IMPOSSIBLE:
                for extra, target, merge in ways[role][state]:
                    if cost + extra < after[target]:
                        after[target], via[target] = cost + extra, (state, merge)
        now = after
        back.append(via)
    if leave is None:
        leave = min(range(4), key=lambda s: (now[s] + costs.insert * len(CLOSERS[s]), s))
    path, state = [], leave
    for via in reversed(back):
        before, merge = via[state]
        path.append((before, state, merge))
        state = before
    return path[::-1]


def rendered(role: int, text: str, merge: bool) -> str:
    """One turn in the template, or the text that a merge adds to the turn before; marks inside a text are broken up."""
    text = text.replace("<|", "< |")
    return f"\n{text}" if merge else f"<|{ROLES[role - 1]}|>\n{text}"


_OUT = "conv_id bigint, place int, turn bigint, role string, new_role string, action string, cost int, rendered string"
_OUT_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("new_role", pa.string()),
    ("action", pa.string()), ("cost", pa.int32()), ("rendered", pa.string()),
])


def told(run: list[tuple], path: list[tuple[int, int, int]], costs: Costs, closed: bool) -> Iterator[tuple]:
    """Output rows of consecutive turns (conv, turn, role, text): the turns, and the empty ones put in."""
    state = START
    for (conv, turn, role, text), (before, state, merge) in zip(run, path):
        number = role_number(role)
        for filler in () if merge else FILLERS[before, state]:
            yield conv, -1, turn, None, ROLES[filler - 1], "insert", costs.insert, rendered(filler, "", False)
        label = 0 if state == number else costs.name if number == START else costs.relabel
        action = "+".join(n for n, on in (("relabel", label), ("merge", merge)) if on) or "keep"
        yield conv, 0, turn, role, ROLES[state - 1], action, label + merge * costs.merge, rendered(state, text or "", bool(merge))
    if closed:
        for at, filler in enumerate(CLOSERS[state]):
            yield run[-1][0], 1 + at, run[-1][1], None, ROLES[filler - 1], "insert", costs.insert, rendered(filler, "", False)


def _batches(rows: Iterator[tuple], schema: pa.Schema, step: int = 5000):
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == step:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _turns(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in names])


def _runs(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows of the same conversation."""
    run: list[tuple] = []
    for row in rows:
        if run and row[0] != run[0][0]:
            yield run
            run = []
        run.append(row)
    if run:
        yield run


_PART = _OUT + ", task bigint, edge int, at bigint, text string, matrix array<bigint>"
_PART_SCHEMA = pa.schema([*_OUT_SCHEMA, ("task", pa.int64()), ("edge", pa.int32()), ("at", pa.int64()), ("text", pa.string()), ("matrix", pa.list_(pa.int64()))])


def repair_roles(
    conversations: DataFrame, costs: Costs = Costs(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", partitions: int | None = None,
) -> DataFrame:
    """`conv_id, place, turn, role, new_role, action, cost, rendered` of all repaired turns.

    One row per given turn (`place` 0) with what was done to it, and one per empty
    turn put in: before the given turn of that number (`place` -1), or behind the
    last one (1, 2). The rendered strings of a conversation, in the order of turn,
    place and, for repeated turn numbers, role and hash of the text, are its repaired form.

    Rows without conv_id are one conversation, turns without a number come first,
    and a missing or unknown role is named. Null texts are empty. Other columns
    are not read.
    """
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"),
    )
    keys = ["conv_id", "turn", "role", F.xxhash64("text")]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)

    def first(batches):
        """Repaired rows of conversations inside the partition; of the outer two, their turns and a matrix."""
        task = TaskContext.get().partitionId()

        def out():
            runs, ahead = _runs(_turns(batches, ("conv_id", "turn", "role", "text"))), []
            for number, run in enumerate(runs):
                ahead.append((number, run))
                if len(ahead) == 2:
                    yield from one(*ahead.pop(0), last=False)
            for number, run in ahead:
                yield from one(number, run, last=True)

        def one(number, run, last):
            if number and not last:
                path = repair([role_number(r[2]) for r in run], costs)
                for row in told(run, path, costs, closed=True):
                    yield (*row, None, None, None, None, None)
                return
            edge = 1 if last and number else 0
            matrix = forward([role_number(r[2]) for r in run], costs)
            yield (run[0][0], None, None, None, None, None, None, None, task, edge, None, None, matrix.ravel().tolist())
            for at, (conv, number_, name, content) in enumerate(run):
                yield (conv, None, number_, name, None, None, None, None, task, edge, at, content, None)

        yield from _batches(out(), _PART_SCHEMA)

    found = materialize(map_batches(ranged.sortWithinPartitions(*keys, "text"), first, _PART), "turns")
    inner = found.filter("task is null").select(*[f.name for f in _OUT_SCHEMA])
    states = spark.sparkContext.broadcast(_chained(found.filter("matrix is not null").select("conv_id", "task", "edge", "matrix").collect(), costs))

    def second(batches):
        """Repaired rows of the outer conversations, between the states at their cuts."""

        def out():
            for run in _runs(((t, e), c, n, r, x) for t, e, _, c, n, r, x in _turns(batches, ("task", "edge", "at", "conv_id", "turn", "role", "text"))):
                entry, leave, closed = states.value[run[0][0]]
                turns = [row[1:] for row in run]
                yield from told(turns, repair([role_number(r[2]) for r in turns], costs, entry, leave), costs, closed)

        yield from _batches(out(), _OUT_SCHEMA)

    outer = found.filter("at is not null").select("task", "edge", "at", "conv_id", "turn", "role", "text")
    outer = outer.repartition("task", "edge").sortWithinPartitions("task", "edge", "at")
    return inner.unionByName(map_batches(outer, second, _OUT))


def _chained(summaries: list, costs: Costs) -> dict[tuple[int, int], tuple[int, int, bool]]:
    """State before and after each part of the outer conversations, and whether it is the last part."""
    states: dict[tuple[int, int], tuple[int, int, bool]] = {}
    ordered = sorted(summaries, key=lambda s: (s.task, s.edge))
    at = 0
    while at < len(ordered):
        end = at + 1
        while end < len(ordered) and ordered[end].conv_id == ordered[at].conv_id:
            end += 1
        parts = [np.array(s.matrix, dtype=np.int64).reshape(4, 4) for s in ordered[at:end]]
        now, back = np.array([0, IMPOSSIBLE, IMPOSSIBLE, IMPOSSIBLE]), []
        for part in parts:
            ways = now[:, None] + part
            back.append(ways.argmin(axis=0))
            now = np.minimum(ways.min(axis=0), IMPOSSIBLE)
        state = int(np.argmin([now[s] + costs.insert * len(CLOSERS[s]) for s in range(4)]))
        for number in range(end - 1, at - 1, -1):
            before = int(back[number - at][state])
            states[ordered[number].task, ordered[number].edge] = (before, state, number == end - 1)
            state = before
        at = end
    return states
