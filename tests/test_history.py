"""Type-2 terminal history: edge rows and properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL, T, make_snapshot, rows_of
from vigil.operators import history
from vigil.plans import bindings
from vigil.schemas import OPEN_END
from vigil.session import reliable_checkpoint

T1, T2, T3, T4, T5 = (T(f"2021-03-0{i} 01:00:00") for i in range(1, 6))
COLS = ("terminal_id", "terminal_type", "terminal_city", "terminal_address", "deleted_flg",
        "effective_from", "effective_to")


def _load(spark, hist, rows, at, **kw):
    # each load is materialised, as the daily job writes every history version
    return reliable_checkpoint(history.apply_snapshot(hist, make_snapshot(spark, rows), at, **kw))


def test_history_sequence(spark):
    h0 = history.empty_history(spark)
    h1 = _load(spark, h0, [("T1", "ATM", "X", "a1"), ("T2", "POS", "Y", "a2"),
                           ("T3", "POS", "Z", None)], T1)
    assert h1.count() == 3 and h1.filter(F.col("effective_to") == OPEN_END).count() == 3

    # city change, unchanged, value<->null (not a change by default), new
    snap2 = [("T1", "ATM", "X2", "a1"), ("T2", "POS", "Y", "a2"), ("T3", "POS", "Z", "a3"),
             ("T4", "POS", "W", "a4")]
    h2 = _load(spark, h1, snap2, T2)
    assert rows_of(h2, *COLS) == rows_of(spark.createDataFrame([
        ("T1", "ATM", "X", "a1", 0, T1, T("2021-03-02 00:59:59")),
        ("T1", "ATM", "X2", "a1", 0, T2, OPEN_END),
        ("T2", "POS", "Y", "a2", 0, T1, OPEN_END),
        ("T3", "POS", "Z", None, 0, T1, OPEN_END),
        ("T4", "POS", "W", "a4", 0, T2, OPEN_END),
    ], h2.select(*COLS).schema), *COLS)
    strict = _load(spark, h1, snap2, T2, null_safe=True)
    assert strict.filter(F.col("terminal_id") == "T3").count() == 2

    # T2 and T3 deleted: closed + open tombstone
    h3 = _load(spark, h2, [("T1", "ATM", "X2", "a1"), ("T4", "POS", "W", "a4")], T3)
    tomb = h3.filter(F.col("deleted_flg") == 1)
    assert rows_of(tomb, "terminal_id", "effective_from", "effective_to") == [
        ("T2", T3, OPEN_END), ("T3", T3, OPEN_END)]
    assert h3.filter((F.col("terminal_id") == "T2") & (F.col("deleted_flg") == 0)).first()[
        "effective_to"] == T("2021-03-03 00:59:59")

    # same snapshot again: nothing changes; deleted ids are not deleted twice
    h4 = _load(spark, h3, [("T1", "ATM", "X2", "a1"), ("T4", "POS", "W", "a4")], T4)
    assert rows_of(h4, *COLS) == rows_of(h3, *COLS)

    # T2 returns: new open row, its tombstone stays open unless asked otherwise
    back = [("T1", "ATM", "X2", "a1"), ("T4", "POS", "W", "a4"), ("T2", "POS", "Y", "a2")]
    h5 = _load(spark, h4, back, T5)
    open_t2 = h5.filter((F.col("terminal_id") == "T2") & (F.col("effective_to") == OPEN_END))
    assert sorted(r.deleted_flg for r in open_t2.collect()) == [0, 1]
    h5c = _load(spark, h4, back, T5, close_tombstones=True)
    open_t2c = h5c.filter((F.col("terminal_id") == "T2") & (F.col("effective_to") == OPEN_END))
    assert [r.deleted_flg for r in open_t2c.collect()] == [0]

    # current view after each load equals the snapshot
    cur = history.current_terminals(h5, T5)
    assert rows_of(cur, "terminal_id", "terminal_city") == sorted(
        [("T1", "X2"), ("T2", "Y"), ("T4", "W")])


def test_null_ids_are_new_or_deleted(spark):
    h1 = _load(spark, history.empty_history(spark), [(None, "ATM", "X", "a"), ("T1", "POS", "Y", "b")], T1)
    assert h1.count() == 2
    h2 = _load(spark, h1, [(None, "ATM", "X", "a"), ("T1", "POS", "Y", "b")], T2)
    # a null id never matches: the snapshot row is new again, the current row gets a
    # tombstone, and the old row stays open (an IN test on a null id is never true)
    assert h2.filter(F.col("terminal_id").isNull()).count() == 3
    assert h2.filter(F.col("terminal_id").isNull() & (F.col("deleted_flg") == 1)).count() == 1


def test_delta_equals_separate_joins(spark):
    cur = history.current_terminals(bindings.hist0(spark, SF_SMALL), bindings.HIST1_AS_OF)
    snap = bindings.terminals_second(spark, SF_SMALL)
    delta = history.snapshot_delta(cur, snap)
    cols = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")
    for kind, ref in (("new", history.new_terminals(snap, cur)),
                      ("deleted", history.deleted_terminals(cur, snap)),
                      ("changed", history.changed_terminals(cur, snap))):
        assert rows_of(delta.filter(F.col("_kind") == kind), *cols) == rows_of(ref, *cols)


def test_empty_snapshot_tombstones_everything(spark):
    h1 = _load(spark, history.empty_history(spark), [("T1", "ATM", "X", "a"), ("T2", "POS", "Y", "b")], T1)
    h2 = _load(spark, h1, [], T2)
    assert h2.filter(F.col("deleted_flg") == 1).count() == 2
    assert history.current_terminals(h2, T2).count() == 0


def test_duplicate_snapshot_ids_each_open(spark):
    h1 = _load(spark, history.empty_history(spark), [("T9", "ATM", "X", "a"), ("T9", "ATM", "Y", "a")], T1)
    assert h1.filter(F.col("effective_to") == OPEN_END).count() == 2
    # a later change closes both and does not multiply the history
    h2 = _load(spark, h1, [("T9", "ATM", "Z", "a")], T2)
    assert h2.filter(F.col("effective_to") == OPEN_END).count() == 2  # pairs differ -> 2 rows
    assert h2.filter((F.col("effective_to") != OPEN_END)).count() == 2


def test_check_load_time(spark):
    import pytest
    h1 = _load(spark, history.empty_history(spark), [("T1", "ATM", "X", "a")], T2)
    history.check_load_time(h1, T3)
    with pytest.raises(ValueError):
        history.check_load_time(h1, T2)


def test_fixture_history_properties(spark):
    hist = bindings.hist1(spark, SF_SMALL).cache()
    snap = bindings.terminals_second(spark, SF_SMALL)
    # at most one open live row per id (the snapshot has unique ids)
    open_live = hist.filter((F.col("deleted_flg") == 0) & (F.col("effective_to") == OPEN_END))
    assert open_live.groupBy("terminal_id").count().filter("count > 1").count() == 0
    # versions of an id do not overlap
    a, b = hist.alias("a"), hist.alias("b")
    overlap = a.join(b, (F.col("a.terminal_id") == F.col("b.terminal_id"))
                     & (F.col("a.effective_from") < F.col("b.effective_from"))
                     & (F.col("a.effective_to") >= F.col("b.effective_from"))
                     & (F.col("a.deleted_flg") == 0) & (F.col("b.deleted_flg") == 0))
    assert overlap.count() == 0
    # current view equals the snapshot
    cur = history.current_terminals(hist, bindings.HIST1_AS_OF)
    assert cur.exceptAll(snap).count() == 0 and snap.exceptAll(cur).count() == 0
    # applying the same snapshot again adds nothing
    again = history.apply_snapshot(hist, snap, T("2024-01-17 00:00:00"))
    assert again.count() == hist.count()
