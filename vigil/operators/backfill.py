"""Folding many snapshots into the type-2 history in one job.

The result equals, row for row, ``history.apply_snapshot`` once per load in order. Per
terminal, the loads in which it is present are put in order with its values, beside its open
versions; going through them gives the terminal's events: new (present after an absence),
changed (a pair of current and snapshot row differs) and deleted (absent from the load after).
Equal neighbours give none, so a run of equal rows is one version. Comparisons are with the
current version, not with the day before, since a change between a value and null may count
for nothing (``null_safe``).

Every event opens rows at its load: new and changed ones versions, a deletion tombstones.
Every open row of a terminal, tombstones included, ends one second before the next change or
deletion of that terminal; a return ends tombstones only with ``close_tombstones``. Rows
closed before are not touched.

The history's open rows and all snapshots are shuffled once, by terminal. A terminal's group
holds one row per load (and duplicate), whatever the length of its history. Rows without an id
match nothing: each is new in its load, and in every later load a tombstone is written for
it while it stays open.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import ts_lit
from vigil.schemas import OPEN_END, TERMINAL_ATTRS, TERMINALS_HIST

_ID = "terminal_id"
_VALUES = ("terminal_type", "terminal_city", "terminal_address")
_HIST = TERMINALS_HIST.fieldNames()
_VALUE = "struct<" + ",".join(f"{c}:string" for c in _VALUES) + ">"
_EVENTS = f"array<struct<load:int,kind:string,rows:array<{_VALUE}>>>"
_STATE = f"struct<last:int,cur:array<{_VALUE}>,events:{_EVENTS}>"

Loads = Sequence[tuple[dt.date, dt.datetime]]


def _differs(null_safe: bool):
    def one(a: Column, b: Column) -> Column:
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    def any_of(a: Column, b: Column) -> Column:
        return one(a[_VALUES[0]], b[_VALUES[0]]) | one(a[_VALUES[1]], b[_VALUES[1]]) | one(
            a[_VALUES[2]], b[_VALUES[2]])
    return any_of


def _state(last: Column, cur: Column, events: Column) -> Column:
    return F.struct(last.cast("int").alias("last"), cur.alias("cur"), events.alias("events"))


def _with_event(events: Column, load: Column, kind: str, rows: Column) -> Column:
    event = F.struct(load.cast("int").alias("load"), F.lit(kind).alias("kind"), rows.alias("rows"))
    return F.concat(events, F.array(event))


def _gone(state: Column, before: Column) -> Column:
    """The state with the deletion of a terminal that is current and absent from the load
    after its last one, when that load is before ``before``."""
    deleted = (F.size(state["cur"]) > 0) & (state["last"] + 1 < before)
    return F.when(deleted, _state(
        state["last"], F.array().cast(f"array<{_VALUE}>"),
        _with_event(state["events"], state["last"] + 1, "deleted", state["cur"]))).otherwise(state)


def _events(current: Column, present: Column, n_loads: int, null_safe: bool) -> Column:
    """The events of a terminal: ``current`` its live open values, ``present`` its rows by load
    (ordered structs of load and rows)."""
    differs = _differs(null_safe)

    def step(state: Column, entry: Column) -> Column:
        state = _gone(state, entry["load"])
        pairs = F.flatten(F.transform(state["cur"], lambda c: F.filter(
            entry["rows"], lambda s: differs(c, s))))
        return (F.when(F.size(state["cur"]) == 0, _state(
                    entry["load"], entry["rows"],
                    _with_event(state["events"], entry["load"], "new", entry["rows"])))
                .when(F.size(pairs) > 0, _state(
                    entry["load"], pairs,
                    _with_event(state["events"], entry["load"], "changed", pairs)))
                .otherwise(_state(entry["load"], state["cur"], state["events"])))

    start = _state(F.lit(0), current, F.array().cast(_EVENTS)).cast(_STATE)
    return F.aggregate(present, start, lambda s, e: step(s, e).cast(_STATE),
                       lambda s: _gone(s, F.lit(n_loads + 1))["events"])


def _at(load: Column) -> Column:
    """The time of a load (null for load 0)."""
    return F.get("_times", load.cast("int") - 1)


def _end(after: Column) -> Column:
    """When rows opened at load ``after`` (0: before all) end."""
    close = _at(F.array_min(F.filter("_closing", lambda x: x > after)))
    return F.coalesce(close - F.expr("INTERVAL 1 SECOND"), ts_lit(OPEN_END))


def _rows(values: Column, deleted: Column, start: Column, end: Column) -> list[Column]:
    key = [F.col(_ID), *[values[c].alias(c) for c in _VALUES]]
    return [F.xxhash64(*key, deleted, start).alias("id"), *key,
            deleted.cast("int").alias("deleted_flg"), start.alias("effective_from"),
            end.alias("effective_to")]


def apply_snapshots(hist: DataFrame, snapshots: DataFrame, loads: Loads, *,
                    null_safe: bool = False, close_tombstones: bool = False) -> DataFrame:
    """The history after loading the snapshots of several days.

    ``snapshots`` has ``batch_date`` and the terminal attributes; ``loads`` lists every load's
    batch date and time, in order (a load without snapshot rows deletes everything). Rows
    of other dates are not read. Columns are those of the history and ``_open``: whether the
    row was open before or is new, i.e. all rows that the loads may have written."""
    times = [at for _, at in loads]
    if not loads or any(b <= a for a, b in zip(times, times[1:])):
        raise ValueError("load times must grow from load to load")
    spark = hist.sparkSession
    numbers = spark.createDataFrame([(d, i) for i, (d, _) in enumerate(loads, 1)],
                                    "batch_date date, load int")
    clock = F.array(*[ts_lit(t) for t in times])
    is_open = F.coalesce(F.col("effective_to") == ts_lit(OPEN_END), F.lit(False))
    hist = hist.select(*_HIST).withColumn("_open", is_open)
    # the caller's own list of loads: a few bytes a day
    rows = (snapshots.select("batch_date", *TERMINAL_ATTRS).join(F.broadcast(numbers), "batch_date")
            .select(_ID, "load", F.struct(*_VALUES).alias("value")))
    old = hist.filter("_open").select(_ID, F.struct("*").alias("old"))
    events = _terminal_events(rows, old, clock, len(loads), null_safe, close_tombstones)

    kept = events.select(F.explode("olds").alias("o"), "_closing", "_times").select(
        *[F.col("o")[c].alias(c) for c in _HIST if c != "effective_to"],
        _end(F.lit(0)).alias("effective_to")).select(*_HIST)
    happened = (events.select(_ID, "_closing", "_times", F.explode("events").alias("e"))
                .select(_ID, F.col("e.kind").alias("kind"), F.explode("e.rows").alias("v"),
                        _at(F.col("e.load")).alias("at"),
                        _end(F.col("e.load")).alias("end")))
    opened = happened.select(*_rows(F.col("v"), F.when(F.col("kind") == "deleted", 1).otherwise(0),
                                    F.col("at"), F.col("end")))
    named = kept.unionByName(opened).unionByName(_without_id(rows, old, clock, len(loads)))
    return hist.filter("NOT _open").unionByName(named.withColumn("_open", F.lit(True)))


def _terminal_events(rows: DataFrame, old: DataFrame, clock: Column, n_loads: int, null_safe: bool,
                     close_tombstones: bool) -> DataFrame:
    """Per terminal: olds (its open rows), events, _closing (loads that end its open rows)
    and the load times."""
    none_old = F.lit(None).cast(old.schema["old"].dataType)
    both = rows.withColumn("old", none_old).unionByName(old.select(
        _ID, F.lit(0).alias("load"), F.lit(None).cast(_VALUE).alias("value"), "old"))
    # one shuffle: both groupings below find their keys together
    by_load = (both.filter(F.col(_ID).isNotNull()).repartition(_ID).groupBy(_ID, "load")
               .agg(F.collect_list("value").alias("rows"), F.collect_list("old").alias("olds")))
    grouped = by_load.groupBy(_ID).agg(
        F.array_sort(F.collect_list(F.when(F.col("load") > 0, F.struct("load", "rows"))))
        .alias("present"), F.flatten(F.collect_list("olds")).alias("olds"))
    live = F.transform(F.filter("olds", lambda o: o["deleted_flg"] == 0),
                       lambda o: F.struct(*[o[c].alias(c) for c in _VALUES]))
    events = grouped.withColumn("events", _events(live.cast(f"array<{_VALUE}>"), F.col("present"),
                                                  n_loads, null_safe))
    ends = F.filter("events", lambda e: F.lit(close_tombstones) | (e["kind"] != "new"))
    return events.select(_ID, "olds", "events", F.transform(ends, lambda e: e["load"]).alias("_closing"),
                         clock.alias("_times"))


def _without_id(rows: DataFrame, old: DataFrame, clock: Column, n_loads: int) -> DataFrame:
    """Rows without an id: the open ones as they are, a version for each snapshot row, and a
    tombstone for each live one in every later load."""
    null_old = old.filter(F.col(_ID).isNull())
    stay = null_old.select(*[F.col("old")[c].alias(c) for c in _HIST])
    values = F.struct(*[F.col("old")[c].alias(c) for c in _VALUES])
    live = (null_old.filter(F.col("old.deleted_flg") == 0)
            .select(_ID, F.lit(0).alias("load"), values.alias("value"))
            .unionByName(rows.filter(F.col(_ID).isNull())).withColumn("_times", clock))
    at = _at(F.col("load"))
    new = live.filter(F.col("load") > 0).select(
        *_rows(F.col("value"), F.lit(0), at, ts_lit(OPEN_END)))
    gone = (live.filter(F.col("load") < n_loads)
            .withColumn("load", F.explode(F.sequence(F.col("load") + 1, F.lit(n_loads))))
            .select(*_rows(F.col("value"), F.lit(1), at, ts_lit(OPEN_END))))
    return stay.unionByName(new).unionByName(gone)
