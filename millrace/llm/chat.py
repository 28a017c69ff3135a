"""Chat formatting: minimum-cost role repair, then rendering.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, the assistant last. `repair` finds the cheapest way to make a sequence of roles
legal, by dynamic programming over the automaton of legal turns. A turn is

* kept, or relabelled to another role;
* merged with the turn before it, which keeps its role;
* preceded by an empty turn of the role that is missing; an unanswered end gets empty turns too.

Costs are in `COSTS`. The costs to come are worked out from the end, the choices from the
start, so equally cheap repairs are told apart by the order of the choices alone: keep, merge,
relabel, insert.

Only row numbers and roles are sorted by conversation, in ranges that may part one, and cut
to blocks of at most `BLOCK` turns. A block is reduced to its least costs from each state before it
to each after it; from the last block on these give the costs to come after each block. Then
a block's choices are followed from each state before it, and from the first block on these give
the state in which each begins. So a conversation of any length is one small row for each of its
blocks in one task, and blocks are decided by themselves. Texts are joined to the decisions by row.
The result has one row for each turn or inserted turn; the parts of a conversation in order
of (position, part) are its rendering.

Defined cases
  * roles are compared without case and outer white space; null and other roles are unknown,
    and take any role at a low cost;
  * null text: empty; turns of equal number are in order of role and text, null numbers last;
  * null conversation ids are one conversation; repeated rows are turns of their own; no rows: no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise

ROLES = ("system", "user", "assistant")
SYSTEM, USER, ASSISTANT, UNKNOWN = range(4)
START = 3  # states are the role of the last turn, or START
# Merging turns of one role, or of two; a new role for a known role, or for an unknown one; an empty turn.
COSTS = {"merge": 1, "merge_other": 4, "relabel": 3, "name": 1, "insert": 2}
# Turns of one conversation that are decided at once.
BLOCK = 10_000
TEMPLATE = ("<|{role}|>\n", "<|end|>\n")
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _bridge(state: int, role: int) -> list[int] | None:
    """The empty turns that lead from a state to where `role` is legal; None if none do."""
    if role in _NEXT[state]:
        return []
    for between in _NEXT[state]:
        if between != SYSTEM and role in _NEXT[between]:
            return [between]
    return None


def _choices(role: int) -> list[list[tuple[int, str, int, tuple[int, ...]]]]:
    """For each state, the choices for a turn of `role`: cost, action, state after it, empty turns before it."""
    table = []
    for state in range(4):
        found = []
        for target in range(3):
            bridge = _bridge(state, target)
            if bridge is None:
                continue
            cost = 0 if target == role else COSTS["name"] if role == UNKNOWN else COSTS["relabel"]
            action = "keep" if target == role else "relabel"
            found.append((cost + COSTS["insert"] * len(bridge), action, target, tuple(bridge)))
        if state != START:
            cost = COSTS["merge"] if role == state else COSTS["name"] if role == UNKNOWN else COSTS["merge_other"]
            found.append((cost, "merge", state, ()))
        order = {"keep": 0, "merge": 1, "relabel": 2}
        table.append(sorted(found, key=lambda c: (len(c[3]) > 0, order[c[1]], c[2])))
    return table


_TABLE = [_choices(role) for role in range(4)]
_ENDING = {ASSISTANT: (), USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT), START: ()}


def repair(roles: list[int]) -> tuple[int, list[tuple[str, int, tuple[int, ...]]], tuple[int, ...]]:
    """Cost; action, role and empty turns before it for each turn; empty turns at the end."""
    to_come = [[COSTS["insert"] * len(_ENDING[s]) for s in range(4)]]
    for role in reversed(roles):
        after = to_come[-1]
        to_come.append([min(c[0] + after[c[2]] for c in _TABLE[role][s]) for s in range(4)])
    to_come.reverse()
    state, found = START, []
    for at, role in enumerate(roles):
        cost, action, state, bridge = next(
            c for c in _TABLE[role][state] if c[0] + to_come[at + 1][c[2]] == to_come[at][state])
        found.append((action, state, bridge))
    return to_come[0][START], found, _ENDING[state]


# ------------------------------------------------------------------ blocks

# What a way that does not exist costs.
_NO_WAY = 1 << 40
_VECTORS: list[tuple[int, ...]] = []
_NUMBERS: dict[tuple[int, ...], int] = {}


def _number(costs) -> tuple[int, int]:
    """The number of the vector of costs less its least, and the least. Differences are small, so vectors are few."""
    least = min(costs)
    if least >= _NO_WAY:
        least = 0
    vector = tuple(min(c - least, _NO_WAY) for c in costs)
    if vector not in _NUMBERS:
        _NUMBERS[vector] = len(_VECTORS)
        _VECTORS.append(vector)
    return _NUMBERS[vector], least


@cache
def _before(number: int, role: int) -> tuple[int, int]:
    """The costs to come before a turn of `role`, given those after it."""
    after = _VECTORS[number]
    return _number([min(c[0] + after[c[2]] for c in _TABLE[role][s]) for s in range(4)])


@cache
def _choose(state: int, role: int, number: int) -> tuple[str, int, tuple[int, ...]]:
    after = _VECTORS[number]
    return min(_TABLE[role][state], key=lambda c: c[0] + after[c[2]])[1:]


_END = tuple(COSTS["insert"] * len(_ENDING[s]) for s in range(4))


def block_costs(roles: bytes) -> list[int]:
    """The least cost from each state before a block to each role after it, by role and state."""
    found = []
    for target in range(3):
        number, total = _number([0 if s == target else _NO_WAY for s in range(4)])
        for role in reversed(roles):
            number, more = _before(number, role)
            total += more
        found += [min(c + total, _NO_WAY) for c in _VECTORS[number]]
    return found


def costs_before(costs: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The costs to come before a block, less their least."""
    return _VECTORS[_number([min(costs[4 * t + s] + after[t] for t in range(3)) for s in range(4)])[0]]


def choices(roles: bytes, after: tuple[int, ...], *states: int) -> Iterator[Iterator[tuple[str, int, tuple[int, ...]]]]:
    """For each state before a block: action, role and empty turns before it of each turn."""
    numbers = array("H", [_number(after)[0]])
    for role in reversed(roles[1:]):
        numbers.append(_before(numbers[-1], role)[0])

    def walk(state: int):
        for role, number in zip(roles, reversed(numbers), strict=True):
            choice = _choose(state, role, number)
            state = choice[1]
            yield choice

    return (walk(state) for state in states)


def block_walks(roles: bytes, after: tuple[int, ...]) -> list[int]:
    """For each state before a block: state after it, turns it adds, part of its last, whether its first is merged."""
    found = []
    for walk in choices(roles, after, 0, 1, 2, 3):
        added, part, merged = 0, 0, None
        for action, state, bridge in walk:
            merged = action == "merge" if merged is None else merged
            added += len(bridge) + (action != "merge")
            part = part + 1 if action == "merge" else 0
        found += [state, added, part, int(merged)]
    return found


def _cut(ordered: DataFrame) -> DataFrame:
    """Blocks of turns of one conversation; `edge` if it may have others, and then `costs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 36
        held, turns = [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            held.clear()
            types = [pa.int64(), kind, pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        def add(rows: array, roles: bytearray, edge: bool):
            nonlocal block, turns
            held.append((block, conv, edge, rows.tobytes(), bytes(roles), block_costs(roles) if edge else None))
            block, turns = block + 1, turns + len(roles)

        stream = ((c, r, k) for b in batches for c, r, k in zip(*(x.to_pylist() for x in b.columns), strict=True))
        groups = groupby(stream, key=lambda t: t[0])
        first, after = True, next(groups, None)
        while after is not None:
            conv, own = after
            rows, roles, edge = array("q"), bytearray(), first
            for _, row, role in own:
                if len(roles) == BLOCK:
                    edge = True
                    add(rows, roles, True)
                    rows, roles = array("q"), bytearray()
                    if turns >= 50_000:
                        yield flush()
                        turns = 0
                rows.append(row)
                roles.append(role)
            # the first and the last of a range may go on in others
            first, after = False, next(groups, None)
            add(rows, roles, edge or after is None)
            if turns >= 50_000:
                yield flush()
                turns = 0
        if held:
            yield flush()

    names = ["block", "conv", "edge", "rows", "roles", "costs"]
    kind, named = _kind(ordered)
    return ordered.mapInArrow(run, f"block long, conv {named}, edge boolean, rows binary, roles binary, costs array<bigint>")


def _kind(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv"].dataType), df.schema["conv"].dataType.simpleString()


def _chain(summaries: DataFrame, column: str, follow: Callable, backward: bool, fields: str) -> DataFrame:
    """`follow(summaries of one conversation in order)` gives each block's numbers; one row for each block of turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (t for b in batches for t in zip(*(x.to_pylist() for x in b.columns), strict=True))
        for _, own in groupby(stream, key=lambda t: t[0]):
            blocks = list(own)
            found = follow([b[2] for b in blocks])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[1] for b in blocks], pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["block", fields])

    order = F.col("block").desc() if backward else F.col("block")
    dealt = summaries.select("conv", "block", column).repartition("conv").sortWithinPartitions("conv", order)
    return dealt.mapInArrow(run, f"block long, {fields} array<bigint>")


def _follow_costs(costs: list[list[int]]) -> list[tuple[int, ...]]:
    """The costs to come after each block, the last block first."""
    found = [_END]
    for own in costs[:-1]:
        found.append(costs_before(own, found[-1]))
    return found


def _follow_walks(walks: list[list[int]]) -> list[list[int]]:
    """State, turn and part before each block, whether the next block's first turn is merged, and whether there is none."""
    found, state, position, part = [], START, -1, 0
    for own in walks:
        if found:
            found[-1] += [own[4 * state + 3], 0]
        found.append([state, position, part])
        after, added, last_part, _ = own[4 * state:4 * state + 4]
        part = last_part if added else part + last_part
        state, position = after, position + added
    found[-1] += [0, 1]
    return found


def _walk_edges(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, convs, roles, after = batch.columns
            walks = [block_walks(r.as_py(), tuple(a.as_py())) for r, a in zip(roles, after, strict=True)]
            yield pa.RecordBatch.from_arrays([blocks, convs, pa.array(walks, pa.list_(pa.int64()))], names=["block", "conv", "walks"])

    return edges.select("block", "conv", "roles", "after").mapInArrow(run, f"block long, conv {_kind(edges)[1]}, walks array<bigint>")


def _decide(blocks: DataFrame) -> DataFrame:
    """One row for each turn (row, turn number in the repaired sequence, part of it) and inserted turn (row null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "row", "position", "part", "role", "action", "last"]
        out = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                conv, packed, roles, after, entry = (v.as_py() for v in values)
                rows = array("q", packed)
                state, position, part, next_merged, ends = entry or (START, -1, 0, 0, 1)
                walk = next(choices(roles, tuple(after or _END), state))
                coming = next(walk)
                for row in rows:
                    action, state, bridge = coming
                    for empty in bridge:
                        position += 1
                        out.append((conv, None, position, 0, ROLES[empty], "insert", True))
                    if action == "merge":
                        part += 1
                    else:
                        position, part = position + 1, 0
                    coming = next(walk, None)
                    merged = next_merged if coming is None else coming[0] == "merge"
                    out.append((conv, row, position, part, ROLES[state], action, not merged))
                    if len(out) >= 50_000:
                        yield flush()
                for empty in _ENDING[state] if ends else ():
                    position += 1
                    out.append((conv, None, position, 0, ROLES[empty], "insert", True))
        if out:
            yield flush()

    kind, named = _kind(blocks)
    return blocks.select("conv", "rows", "roles", "after", "entry").mapInArrow(
        run, f"conv {named}, row long, position long, part long, role string, action string, last boolean")


def _repaired(ordered: DataFrame) -> DataFrame:
    """The decisions for turns in ranges of (conversation, order)."""
    blocks = materialise(_cut(ordered), "blocks")
    edges = blocks.where("edge")
    after = _chain(edges, "costs", _follow_costs, True, "after")
    edges = materialise(edges.drop("costs").join(after, "block"), "edges")
    entries = _chain(_walk_edges(edges), "walks", _follow_walks, False, "entry")
    nothing = F.lit(None).cast("array<bigint>")
    whole = blocks.where("not edge").select("conv", "rows", "roles", nothing.alias("after"), nothing.alias("entry"))
    return _decide(whole.unionByName(edges.join(entries, "block").select("conv", "rows", "roles", "after", "entry")))


def format_chats(
    turns: DataFrame, template: tuple[str, str] = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """conversation, position, part, role, action, original turn (null: inserted) and rendered text, per turn."""
    keyed = materialise(turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.lower(F.trim(F.col(role_col).cast("string"))).alias("said_by"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id()), "turns")
    code = F.coalesce(*[F.when(F.col("said_by") == r, F.lit(k)) for k, r in enumerate(ROLES)], F.lit(UNKNOWN))
    order = ["conv", F.col("turn").asc_nulls_last(), "role", "tie", "row"]
    light = (
        keyed.select("conv", "row", "turn", code.alias("role"), F.xxhash64("text").alias("tie"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "row", "role")
    )
    decided = materialise(_repaired(light), "decisions")
    opening = F.when(F.col("part") == 0, F.format_string(template[0].replace("{role}", "%s"), "role")).otherwise(F.lit("\n"))
    closing = F.when(F.col("last"), F.lit(template[1])).otherwise(F.lit(""))
    texts = keyed.select("row", "turn", "text")
    # inserted turns have no row; joined by null they would all meet in one task
    inserted = decided.where("row is null").withColumns({
        "turn": F.lit(None).cast(texts.schema["turn"].dataType), "text": F.lit(None).cast("string")})
    return decided.where("row is not null").join(texts, "row").unionByName(inserted).select(
        F.col("conv").alias(conv_col), "position", "part", "role", "action", F.col("turn").alias("source_turn"),
        F.concat(opening, F.coalesce("text", F.lit("")), closing).alias("rendered"))
