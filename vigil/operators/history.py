"""Type-2 history of terminals.

A load folds one full terminal snapshot into the history at a load time
``as_of``:

* ids in the snapshot but not current are inserted (new);
* current ids whose type, city or address differ are closed at
  ``as_of - 1 second`` and inserted again with the new values (changed);
* current ids missing from the snapshot are closed and get an open tombstone
  row with ``deleted_flg = 1`` (deleted).

Parquet tables cannot be updated in place, so ``apply_snapshot`` is a pure
function ``(history, snapshot, as_of) -> history'`` built from one full outer
join of the current view with the snapshot, a flag join against the distinct
keys to close, and a union. The caller writes
the result as a new table version and never over its own input.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import close_time, ts_lit
from vigil.schemas import OPEN_END, TERMINAL_ATTRS, TERMINALS_HIST

_ID = "terminal_id"
_VALUE_ATTRS = ("terminal_type", "terminal_city", "terminal_address")


def _as_of(as_of: dt.datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else ts_lit(as_of)


def empty_history(spark) -> DataFrame:
    return spark.createDataFrame([], TERMINALS_HIST)


def current_terminals(hist: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Terminals valid at ``as_of`` and not deleted."""
    at = _as_of(as_of)
    return (hist.filter((F.col("deleted_flg") == 0)
                        & at.between(F.col("effective_from"), F.col("effective_to")))
            .select(*TERMINAL_ATTRS))


def new_terminals(snapshot: DataFrame, current: DataFrame) -> DataFrame:
    """Snapshot rows whose id is not current."""
    return snapshot.select(*TERMINAL_ATTRS).join(current.select(_ID), _ID, "left_anti")


def deleted_terminals(current: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Current rows whose id is missing from the snapshot."""
    return current.select(*TERMINAL_ATTRS).join(snapshot.select(_ID), _ID, "left_anti")


def changed_terminals(current: DataFrame, snapshot: DataFrame, *, null_safe: bool = False) -> DataFrame:
    """Snapshot rows (new values) of current ids with another type, city or address.

    By default a change between a value and null is not seen (``<>`` on null
    is unknown); ``null_safe=True`` compares with ``<=>``.
    """
    cur = current.select(*[F.col(c).alias(f"_cur_{c}") for c in TERMINAL_ATTRS])
    snap = snapshot.select(*TERMINAL_ATTRS)

    def differs(c: str) -> Column:
        a, b = F.col(f"_cur_{c}"), F.col(c)
        return ~a.eqNullSafe(b) if null_safe else a != b

    cond = (F.col(f"_cur_{_ID}") == F.col(_ID)) & reduce(lambda x, y: x | y,
                                                         [differs(c) for c in _VALUE_ATTRS])
    return cur.join(snap, cond, "inner").select(*TERMINAL_ATTRS)


def _versions(rows: DataFrame, deleted_flg: int, at: Column) -> DataFrame:
    return rows.select(
        F.xxhash64(*TERMINAL_ATTRS, F.lit(deleted_flg), at).alias("id"),
        *TERMINAL_ATTRS,
        F.lit(deleted_flg).cast("int").alias("deleted_flg"),
        at.alias("effective_from"),
        ts_lit(OPEN_END).alias("effective_to"),
    )


def snapshot_delta(current: DataFrame, snapshot: DataFrame, *, null_safe: bool = False) -> DataFrame:
    """New, deleted and changed rows in one full outer join on ``terminal_id``.

    Rows are tagged ``_kind`` = 'new' (snapshot row, id not current),
    'deleted' (current row, id not in the snapshot) or 'changed' (a current and
    snapshot pair of one id with another type, city or address; the snapshot
    values are kept). Equal to the three separate joins above, pairs of
    duplicate ids included, but each side is shuffled once.
    """
    cur = current.select(*[F.col(c).alias(f"_cur_{c}") for c in TERMINAL_ATTRS],
                         F.lit(True).alias("_in_cur"))
    snap = snapshot.select(*TERMINAL_ATTRS, F.lit(True).alias("_in_snap"))
    joined = cur.join(snap, F.col(f"_cur_{_ID}") == F.col(_ID), "full_outer")

    def differs(c: str) -> Column:
        a, b = F.col(f"_cur_{c}"), F.col(c)
        return ~a.eqNullSafe(b) if null_safe else a != b

    any_diff = reduce(lambda x, y: x | y, [differs(c) for c in _VALUE_ATTRS])
    # a null id never matches, so such a row is new (snapshot) or deleted (current)
    kind = (F.when(F.col("_in_cur").isNull(), F.lit("new"))
            .when(F.col("_in_snap").isNull(), F.lit("deleted"))
            .when(any_diff, F.lit("changed")))
    deleted = F.col("_kind") == "deleted"
    return (joined.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
            .select("_kind", *[F.when(deleted, F.col(f"_cur_{c}")).otherwise(F.col(c)).alias(c)
                               for c in TERMINAL_ATTRS]))


def apply_snapshot(hist: DataFrame, snapshot: DataFrame, as_of: dt.datetime | Column, *,
                   null_safe: bool = False, close_tombstones: bool = False) -> DataFrame:
    """The history after loading ``snapshot`` at ``as_of``.

    Parity defaults: duplicate snapshot ids each become a row; a terminal that
    comes back after deletion is inserted as new while its tombstone stays
    open (``close_tombstones=True`` closes it); value<->null is no change
    (``null_safe=True`` makes it one).

    The history is read twice (current view, and the rows to keep or close);
    the delta once per output branch over one shuffled full outer join.
    """
    at = _as_of(as_of)
    hist = hist.select(*TERMINALS_HIST.fieldNames())
    delta = snapshot_delta(current_terminals(hist, at), snapshot, null_safe=null_safe)

    to_close = delta.filter(F.col("_kind") != "new").select(_ID)
    if close_tombstones:
        open_tombstones = hist.filter((F.col("deleted_flg") == 1)
                                      & (F.col("effective_to") == ts_lit(OPEN_END))).select(_ID)
        returning = delta.filter(F.col("_kind") == "new").select(_ID)
        to_close = to_close.union(returning.join(open_tombstones, _ID, "left_semi"))
    to_close = to_close.distinct().withColumn("_close", F.lit(True))

    closing = F.col("_close") & (F.col("effective_to") == ts_lit(OPEN_END))
    kept = (hist.join(to_close, _ID, "left")
            .withColumn("effective_to",
                        F.when(closing, close_time(at)).otherwise(F.col("effective_to")))
            .select(*TERMINALS_HIST.fieldNames()))
    flag = F.when(F.col("_kind") == "deleted", 1).otherwise(0)
    versions = delta.select(
        F.xxhash64(*TERMINAL_ATTRS, flag, at).alias("id"), *TERMINAL_ATTRS,
        flag.cast("int").alias("deleted_flg"), at.alias("effective_from"),
        ts_lit(OPEN_END).alias("effective_to"))
    return kept.unionByName(versions)


def history_from_snapshot(snapshot: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """First load: every snapshot row becomes an open version."""
    return _versions(snapshot.select(*TERMINAL_ATTRS), 0, _as_of(as_of))


def latest_load(hist: DataFrame) -> dt.datetime | None:
    """Start of the newest version (one aggregate row reaches the driver)."""
    return hist.agg(F.max("effective_from").alias("m")).collect()[0]["m"]


_UNKNOWN = object()


def check_load_time(hist: DataFrame, as_of: dt.datetime, latest=_UNKNOWN) -> None:
    """Refuse a load time not after the latest version start: closing at
    ``as_of - 1s`` would otherwise end a version before it began. ``latest``
    may be passed when already known."""
    if latest is _UNKNOWN:
        latest = latest_load(hist)
    if latest is not None and as_of <= latest:
        raise ValueError(f"load time {as_of} is not after the latest version start {latest}")
