"""Many snapshots in one job equal one load after the other."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import D, T, make_hist
from vigil.operators import history
from vigil.operators.backfill import apply_snapshots
from vigil.schemas import OPEN_END
from vigil.session import written

COLS = ("id", "terminal_id", "terminal_type", "terminal_city", "terminal_address", "deleted_flg",
        "effective_from", "effective_to")
SNAP = ("batch_date date, terminal_id string, terminal_type string, terminal_city string, "
        "terminal_address string")


def _sorted(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=repr)


def _one_by_one(spark, hist, rows, loads, **options):
    for d, at in loads:
        snap = spark.createDataFrame([r[1:] for r in rows if r[0] == d], SNAP.split(", ", 1)[1])
        hist = written(history.apply_snapshot(hist, snap, at, **options))
    return hist


def _loads(n):
    first = D("2021-03-01")
    return [(first + dt.timedelta(days=i), T("2021-03-01 05:00:00") + dt.timedelta(days=i, seconds=i))
            for i in range(n)]


def _random_rows(seed, loads, ids=9):
    rnd = random.Random(seed)
    rows = []
    for d, _ in loads:
        for i in range(ids):
            for _ in range(rnd.choice([0, 0, 1, 1, 1, 1, 1, 2])):
                rows.append((d, f"T{i}", rnd.choice(["ATM", "ATM", None]),
                             rnd.choice(["X", "X", "X", "Y", None]), rnd.choice(["a", "a", None])))
        if rnd.random() < 0.3:
            rows.append((d, None, "ATM", "X", "a"))
    return rows


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("close_tombstones", [False, True])
def test_equal_to_single_loads(spark, null_safe, close_tombstones):
    options = {"null_safe": null_safe, "close_tombstones": close_tombstones}
    start = written(make_hist(spark, [
        ("T0", "ATM", "X", "a", 0, T("2020-01-01 00:00:00"), OPEN_END),
        ("T1", "ATM", "X", "a", 0, T("2020-01-01 00:00:00"), T("2020-02-01 00:00:00")),
        ("T1", "ATM", "X", "a", 1, T("2020-02-01 00:00:01"), OPEN_END),
        ("T2", "POS", None, "a", 0, T("2020-01-01 00:00:00"), OPEN_END),
        ("T2", "POS", None, "b", 0, T("2020-01-01 00:00:00"), OPEN_END),
        ("T8", "POS", "Z", "b", 0, T("2020-01-01 00:00:00"), OPEN_END),
        (None, "POS", "Z", "b", 0, T("2020-01-01 00:00:00"), OPEN_END)]))
    loads = _loads(5)
    for seed in (1, 2):
        rows = _random_rows(seed, loads)
        snaps = spark.createDataFrame(rows + [(D("2022-01-01"), "T1", "other", "day", None)], SNAP)
        got = apply_snapshots(start, snaps, loads, **options)
        assert _sorted(got) == _sorted(_one_by_one(spark, start, rows, loads, **options))


def test_first_loads_and_empty_days(spark):
    loads = _loads(4)
    rows = [r for r in _random_rows(5, loads) if r[0] != loads[2][0]]  # an empty third day
    got = apply_snapshots(history.empty_history(spark), spark.createDataFrame(rows, SNAP), loads)
    assert _sorted(got) == _sorted(_one_by_one(spark, history.empty_history(spark), rows, loads))
    empty = apply_snapshots(history.empty_history(spark), spark.createDataFrame([], SNAP), loads)
    assert empty.count() == 0


def test_sixty_days_are_one_plan(spark):
    """One shuffle of snapshots and open rows, whatever the number of days; rows closed before
    are only passed on."""
    loads = _loads(60)
    rows = _random_rows(7, loads, ids=20)
    start = written(make_hist(spark, [("T1", "ATM", "X", "a", 0, T("2020-01-01 00:00:00"),
                                       T("2020-02-01 00:00:00"))] * 50))
    got = apply_snapshots(start, spark.createDataFrame(rows, SNAP), loads)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "SortMergeJoin" not in plan
    done = written(got)
    assert done.filter("NOT _open").count() == 50
    # in parts, the same rows come out
    half = written(apply_snapshots(start, spark.createDataFrame(rows, SNAP), loads[:30]))
    rest = apply_snapshots(half, spark.createDataFrame(rows, SNAP), loads[30:])
    assert _sorted(done) == _sorted(rest)


def test_load_times_must_grow(spark):
    loads = _loads(2)
    snaps = spark.createDataFrame([], SNAP)
    for bad in ([], loads[::-1], [loads[0], loads[0]]):
        with pytest.raises(ValueError):
            apply_snapshots(history.empty_history(spark), snaps, bad)
