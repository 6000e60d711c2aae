"""Chat formatting: minimum-cost role repair, then rendering.

A conversation is legal when it has at most one system turn, at its start, then user and
assistant turns by turns, ending with the assistant. Its states are the role last given
(start, system, user, assistant). A turn may keep its role, be given another one, be merged
into the turn before, or have an empty turn inserted before it, each at a cost; dynamic
programming finds the cheapest way through, and among equally cheap ones the one whose
states come first in the order above, from the first turn on.

Conversations are sorted over the cluster by ranges of (conversation, turn), so one of any
length is spread over many tasks. A step of the programme is a (min, +) matrix of four
states; the matrices of the runs at partition borders are multiplied at the driver (at most
two rows per partition), which gives each task the costs to go after its last run and the
state before its first one.

Defined results
* turns are ordered by turn (nulls last), then role, then a hash of the text; rows equal in
  all are interchangeable; a null conv_id is a conversation of its own
* roles are trimmed and lower-cased; any other role than the three, or null, is unknown and
  must be relabelled; a null text is empty
* one row per turn kept or merged and per turn inserted, in the order of ``seq``; the
  ``rendered`` pieces of a conversation, put one after the other, are its rendering
* an empty table gives no rows; other columns are not read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import fixed_in_place, map_arrow

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
UNKNOWN = -1
#: costs: giving a known role another name, naming an unknown one, merging, inserting
RELABEL, NAME, MERGE, INSERT = 3, 1, 1, 2
_NEVER = 1 << 60

#: which role may follow which state
_FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: cost of ending in each state: the empty turns still to insert
_END = (0, 2 * INSERT, INSERT, 0)
_ENDING = ((), (USER, ASSISTANT), (ASSISTANT,), ())

Matrix = tuple[tuple[int, ...], ...]
REPAIRED = ("conv_id long, seq long, turn long, role string, action string, cost int, "
            "rendered string")


def _move(role: int, before: int, after: int) -> tuple[int, str, tuple[int, ...]]:
    """Cost, action and inserted turns of giving a turn the role ``after``."""
    if after == START:
        return _NEVER, "", ()
    cost, action = (0, "keep") if role == after else (
        (NAME, "name") if role == UNKNOWN else (RELABEL, "relabel"))
    if after in _FOLLOWS[before]:
        return cost, action, ()
    if before == after:
        return cost + MERGE, "merge" if action == "keep" else f"{action}+merge", ()
    between = [x for x in _FOLLOWS[before] if after in _FOLLOWS[x]]
    if between:
        return cost + INSERT, action, (between[0],)
    return _NEVER, "", ()


MOVES = {role: [[_move(role, p, q) for q in range(4)] for p in range(4)]
         for role in (UNKNOWN, SYSTEM, USER, ASSISTANT)}
STEPS: dict[int, Matrix] = {role: tuple(tuple(m[0] for m in row) for row in moves)
                            for role, moves in MOVES.items()}
IDENTITY: Matrix = tuple(tuple(0 if p == q else _NEVER for q in range(4)) for p in range(4))


def times(a: Matrix, b: Matrix) -> Matrix:
    """(min, +) product."""
    return tuple(tuple(min(min(x + y for x, y in zip(row, column)), _NEVER)
                       for column in zip(*b)) for row in a)


def before(step: Matrix, to_go: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go one step (or run) earlier."""
    return tuple(min(min(x + y for x, y in zip(row, to_go)), _NEVER) for row in step)


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else UNKNOWN


def walk(roles: list[int], state: int, to_go: tuple[int, ...]) -> list[int]:
    """The states after each turn of the best way from ``state``."""
    later = [to_go]
    for role in reversed(roles[1:]):
        later.append(before(STEPS[role], later[-1]))
    out = []
    for role, rest in zip(roles, reversed(later)):
        costs = [c + r for c, r in zip(STEPS[role][state], rest)]
        state = costs.index(min(costs))
        out.append(state)
    return out


def _header(role: int, first: bool) -> str:
    return ("" if first else "<|end|>\n") + f"<|{ROLES[role - 1]}|>\n"


@dataclass
class Run:
    """Turns of one conversation in one partition."""

    conv: int | None
    turns: list[int | None] = field(default_factory=list)
    roles: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)


@dataclass
class Border:
    """What a partition must know of its neighbours."""

    state: int = START  # before its first run
    done: int = 0  # turns of the first run's conversation in earlier partitions
    to_go: tuple[int, ...] = _END  # after its last run
    goes_on: bool = False  # the last run's conversation goes on


def repaired(run: Run, border: Border) -> Iterator[tuple]:
    """The rows of one run; ``border`` describes both its ends."""
    state, first = border.state, border.state == START
    for i, after in enumerate(walk(run.roles, state, border.to_go)):
        cost, action, inserted = MOVES[run.roles[i]][state][after]
        place = 2 * (border.done + i)
        for x in inserted:
            yield (run.conv, place, None, ROLES[x - 1], "insert", INSERT, _header(x, first))
            cost, first = cost - INSERT, False
        merged = action.endswith("merge")
        text = "\n" + run.texts[i] if merged else _header(after, first) + run.texts[i]
        yield (run.conv, place + 1, run.turns[i], ROLES[after - 1], action, cost, text)
        state, first = after, False
    if not border.goes_on:
        place = 2 * (border.done + len(run.roles))
        for j, x in enumerate(_ENDING[state]):
            yield (run.conv, place + j, None, ROLES[x - 1], "insert", INSERT, _header(x, False))
        yield (run.conv, place + 2, None, ROLES[ASSISTANT - 1], "end", 0, "<|end|>\n")


def _runs(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[tuple[int, Run, bool, bool]]:
    """(partition, run, is first, is last) of a sorted partition, one run in memory."""
    run: Run | None = None
    part, first = 0, True
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for part, conv, turn, role, text in zip(*columns):
            if run is None or run.conv != conv:
                if run is not None:
                    yield part, run, first, False
                    first = False
                run = Run(conv)
            run.roles.append(role_number(role))
            if texts:
                run.turns.append(turn)
                run.texts.append(text or "")
    if run is not None:
        yield part, run, first, True


SUMMARY = "part int, first boolean, last boolean, conv long, n long, matrix array<long>"


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last run of a partition: conversation, length, matrix."""
    rows = []
    for part, run, first, last in _runs(batches, texts=False):
        if first or last:
            matrix = IDENTITY
            for role in run.roles:
                matrix = times(matrix, STEPS[role])
            rows.append((part, first, last, run.conv, len(run.roles),
                         [x for row in matrix for x in row]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
        ["part", "first", "last", "conv", "n", "matrix"])


def _exits(borders: dict[int, Border]):
    """For last runs whose conversation goes on: the state after it, for every state
    before it."""
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part, run, _, last in _runs(batches, texts=False):
            if last and part in borders and borders[part].goes_on:
                to_go = borders[part].to_go
                rows.append((part, [walk(run.roles, s, to_go)[-1] for s in range(4)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()),
             pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["part", "after"])
    return run_batches


def _repair(borders: dict[int, Border]):
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for part, run, first, last in _runs(batches, texts=True):
            edge = borders.get(part, Border())
            own = Border()
            if first:
                own.state, own.done = edge.state, edge.done
            if last:
                own.to_go, own.goes_on = edge.to_go, edge.goes_on
            for row in repaired(run, own):
                rows.append(row)
                if len(rows) >= 1000:
                    yield _rows(rows)
                    rows = []
        yield _rows(rows)
    return run_batches


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
        ["conv_id", "seq", "turn", "role", "action", "cost", "rendered"])


def _borders(rows: DataFrame) -> dict[int, Border]:
    """Of all partitions at whose ends a conversation is cut: from the border runs'
    matrices, backwards the costs to go, then forwards the states and lengths."""
    found = map_arrow(rows.drop("text").withColumn("text", F.lit("")), _summarise, SUMMARY)
    runs = sorted(found.collect(), key=lambda r: (r.part, not r.first))
    borders: dict[int, Border] = {}
    cut = [(a, b) for a, b in zip(runs, runs[1:]) if a.part != b.part and a.conv == b.conv]
    to_go = _END
    for a, b in reversed(cut):
        steps = tuple(tuple(b.matrix[4 * p:4 * p + 4]) for p in range(4))
        # ``b`` goes on itself if it ends its partition and that border is cut too
        after = borders[b.part].to_go if b.last and b.part in borders and \
            borders[b.part].goes_on else _END
        to_go = before(steps, after)
        borders.setdefault(a.part, Border()).to_go = to_go
        borders[a.part].goes_on = True
        borders.setdefault(b.part, Border())
    if not cut:
        return {}
    after = {r.part: r.after for r in map_arrow(
        rows.drop("text").withColumn("text", F.lit("")), _exits(borders),
        "part int, after array<int>").collect()}
    for a, b in cut:
        whole = a.first and a.part in borders
        state = borders[a.part].state if whole else START
        done = borders[a.part].done if whole else 0
        borders[b.part].state = after[a.part][state]
        borders[b.part].done = done + a.n
    return borders


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, seq, turn (null for inserted turns), role, action, cost, rendered."""
    spark = conversations.sparkSession
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"), conversations["role"],
        F.coalesce(conversations["text"], F.lit("")).alias("text"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("turn"), F.asc_nulls_last("role"),
             F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = fixed_in_place(rows.repartitionByRange(n, *order).sortWithinPartitions(*order))
    placed = placed.select(F.spark_partition_id().alias("part"), "conv_id", "turn", "role", "text")
    return map_arrow(placed, _repair(_borders(placed)), REPAIRED)
