"""Chat formatting by minimum-cost role repair.

A legal conversation may open with a system turn; then user and assistant take turns, and
the assistant has the last word. For each turn of a conversation, dynamic programming over
this automaton chooses to append it, to merge it into the turn before, to give it another
role, or to insert an empty turn before it, at the least cost in all.

The costs of a run of turns form a small matrix from the state before to the state after,
and matrices of neighbouring runs combine. So a conversation of any length is cut in blocks
of turns by their place in it: blocks are folded to matrices, the matrices of a conversation are chained,
and each block is then repaired between the states the chain gave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import ranked, written_table

#: Turns that one task repairs at a time.
BLOCK = 4_096
#: Turns of longer conversations that one task numbers, about.
SLICE = 1 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {number: name for name, number in ROLES.items()}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 1, 2, 3
NEVER = 1 << 40

Step = tuple[int, int, bool, bool, int]  #: cost, state after, merged, relabelled, inserted role or START


def _steps(role: int | None) -> list[list[Step]]:
    """What may be done with a turn of ``role``, by the state before; ties go to the first."""
    table = []
    for state in range(4):
        found: list[Step] = []
        for goal in NEXT[state]:
            found.append((RELABEL * (goal != role), goal, False, goal != role, START))
        if state != START:
            found.append((MERGE + RELABEL * (state != role), state, True, state != role, START))
        for between in NEXT[state]:
            for goal in NEXT[between]:
                found.append((INSERT + RELABEL * (goal != role), goal, False, goal != role, between))
        table.append(found)
    return table


STEPS = {role: _steps(role) for role in (None, *NAMES)}


def _role(name: str | None) -> int | None:
    return ROLES.get((name or "").strip().lower())


def fold(roles: list[int | None]) -> list[int]:
    """The least cost [state before * 4 + state after] of repairing a run of turns."""
    costs = [[0 if a == b else NEVER for b in range(4)] for a in range(4)]
    for role in roles:
        steps = STEPS[role]
        for line in costs:
            after = [NEVER] * 4
            for state in range(4):
                if line[state] < NEVER:
                    for cost, goal, _, _, _ in steps[state]:
                        after[goal] = min(after[goal], line[state] + cost)
            line[:] = after
    return [cost for line in costs for cost in line]


def ending(state: int) -> list[int]:
    """Roles of empty turns that end a conversation legally."""
    return {START: [], SYSTEM: [USER, ASSISTANT], USER: [ASSISTANT], ASSISTANT: []}[state]


def chain(matrices: list[list[int]]) -> list[tuple[int, int]]:
    """(state before, state after) of each run, at the least cost in all."""
    best, back = [0, NEVER, NEVER, NEVER], []
    for matrix in matrices:
        ways = [[(best[a] + matrix[4 * a + b], a) for a in range(4)] for b in range(4)]
        back.append([min(way)[1] for way in ways])
        best = [min(min(way)[0], NEVER) for way in ways]
    state = min(range(4), key=lambda s: (best[s] + INSERT * len(ending(s)), s))
    found = []
    for line in reversed(back):
        found.append((line[state], state))
        state = line[state]
    return found[::-1]


def repair(roles: list[int | None], before: int, after: int) -> list[Step]:
    """The steps of the least cost from state ``before`` to state ``after``."""
    best, back = [0 if s == before else NEVER for s in range(4)], []
    for role in roles:
        reached: list[tuple[int, int, Step] | None] = [None] * 4
        for state in range(4):
            if best[state] < NEVER:
                for step in STEPS[role][state]:
                    total = best[state] + step[0]
                    if reached[step[1]] is None or total < reached[step[1]][0]:
                        reached[step[1]] = (total, state, step)
        back.append(reached)
        best = [NEVER if r is None else r[0] for r in reached]
    state, found = after, []
    for reached in reversed(back):
        _, state, step = reached[state]
        found.append(step)
    return found[::-1]


def _open(role: int) -> str:
    return f"<|{NAMES[role]}|>\n"


CLOSE = "<|end|>\n"


def render(steps: list[Step], texts: list[str], before: int, last: bool) -> tuple[str, int]:
    """The text of a run and its cost; runs one after another make the conversation."""
    parts, state, cost = [], before, 0
    for (step_cost, goal, merged, _, between), text in zip(steps, texts, strict=True):
        cost += step_cost
        if merged:
            parts.append("\n")
        else:
            if state != START:
                parts.append(CLOSE)
            if between != START:
                parts += [_open(between), CLOSE]
            parts.append(_open(goal))
        parts.append(text)
        state = goal
    if last:
        if state != START:
            parts.append(CLOSE)
        for role in ending(state):
            parts += [_open(role), CLOSE]
            cost += INSERT
    return "".join(parts), cost


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows with equal keys, which lie side by side in the batches."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            mine = tuple(row[name] for name in keys)
            if mine != key and rows:
                yield key, rows
                rows = []
            key = mine
            rows.append(row)
    if rows:
        yield key, rows


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


MATRIX = "conv_id bigint, block bigint, costs array<bigint>"
ENDS = "conv_id bigint, block bigint, before int, after int, last boolean"
CHUNK = (
    "conv_id bigint, chunk bigint, n_turns bigint, cost bigint, n_merged bigint, "
    "n_relabelled bigint, n_inserted bigint, rendered string"
)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (part.strip().split(" ") for part in ddl.split(","))])


def _blocked(rows: DataFrame) -> DataFrame:
    """Adds ``block``: a turn's place in its conversation, by BLOCK.

    Only conversations of more than BLOCK turns are numbered. Their turns are put in slices of
    like size in the stated order and numbered slice by slice, so a conversation that holds a
    third of all turns is many small groups. Equal turns are told apart by a number written
    with them, so a turn repeated very often is cut as well.
    """
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    sizes = written_table(sizes, "long-chats")
    total = sizes.agg(F.sum("size")).first()[0]
    first = F.lit(0).cast("bigint")
    if not total:
        return rows.withColumn("block", first)
    short = rows.join(sizes, "conv_id", "left_anti").withColumn("block", first)
    turns = rows.join(sizes, "conv_id", "left_semi").withColumn("copy", F.monotonically_increasing_id())
    order = [F.col(name) for name in ("turn", "role", "text", "copy")]
    slices = 1 + total // SLICE
    cut = written_table(turns, "long-turns").repartitionByRange(slices, "conv_id", *order)
    cut = written_table(cut.withColumn("slice", F.spark_partition_id()), "turn-slices")
    placed = ranked(cut, ["conv_id"], order, F.col("slice"), slices, "place")
    return short.unionByName(placed.select(*rows.columns, F.floor(F.col("place") / BLOCK).alias("block")))


def formatted(
    turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation and block: counts, cost and the rendered text of the block.

    A conversation's chunks, in order, make its text; those of up to BLOCK turns have
    one, others one for every BLOCK turns begun. Turns are ordered by number, ties (also repeated rows) by role and text, and those
    without a number come first. A null text is empty, an unknown or null role counts as one
    that must be relabelled. Turns without conversation are left out. Other columns play no
    part; an empty table gives an empty table.
    """
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = _blocked(rows)
    order = ["conv_id", "block", "turn", "role", "text"]
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions(*order)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            {"conv_id": key[0], "block": key[1], "costs": fold([_role(row["role"]) for row in run])}
            for key, run in _runs(batches, ("conv_id", "block"))
        )
        return _batches(found, _schema(MATRIX))

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for key, run in _runs(batches, ("conv_id",)):
                ends = chain([row["costs"] for row in run])
                for place, (row, (before, after)) in enumerate(zip(run, ends, strict=True)):
                    yield {"conv_id": key[0], "block": row["block"], "before": before, "after": after, "last": place == len(run) - 1}

        return _batches(each(), _schema(ENDS))

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for key, run in _runs(batches, ("conv_id", "block")):
                before, after, last = (run[0][name] for name in ("before", "after", "last"))
                steps = repair([_role(row["role"]) for row in run], before, after)
                rendered, cost = render(steps, [row["text"] for row in run], before, last)
                yield {
                    "conv_id": key[0],
                    "chunk": key[1],
                    "n_turns": len(run),
                    "cost": cost,
                    "n_merged": sum(step[2] for step in steps),
                    "n_relabelled": sum(step[3] for step in steps),
                    "n_inserted": sum(step[4] != START for step in steps) + (len(ending(after)) if last else 0),
                    "rendered": rendered,
                }

        return _batches(each(), _schema(CHUNK))

    matrices = dealt.select("conv_id", "block", "role").mapInArrow(folded, MATRIX)
    lines = matrices.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    ends = written_table(lines.mapInArrow(chained, ENDS), "chat-ends")
    both = rows.join(ends, ["conv_id", "block"])
    done = both.repartition("conv_id", "block").sortWithinPartitions(*order).mapInArrow(repaired, CHUNK)
    return done.withColumnRenamed("conv_id", id_col)
