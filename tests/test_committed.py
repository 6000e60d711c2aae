"""Runs of a committed table become visible in one step."""

from __future__ import annotations

import os

import pytest

from conftest import D, T
from vigil.operators.committed import CommittedDays
from vigil.schemas import REPORT


def _row(day, passport):
    return (T(f"{day} 10:00:00"), passport, "A B C", "+1", "account cheat",
            T("2021-04-01 06:00:00"), D(day))


def _found(table):
    return sorted((r.batch_date.isoformat()[-2:], r.passport) for r in table.read().collect())


def test_days_of_a_run_appear_together(spark, tmp_path):
    table = CommittedDays(spark, str(tmp_path / "rep"), REPORT)
    days = [D("2021-03-01"), D("2021-03-02"), D("2021-03-03")]
    assert _found(table) == [] and table.vacuum() == 0
    first = [_row("2021-03-01", "a"), _row("2021-03-02", "b"), _row("2021-03-02", "c")]
    run = table.stage(spark.createDataFrame(first, REPORT), days[:2])
    assert _found(table) == []  # written, not yet visible
    table.commit(run, days[:2])
    assert _found(table) == [("01", "a"), ("02", "b"), ("02", "c")]

    # a run that stops after its rows changes nothing; its number is used again
    half = table.stage(spark.createDataFrame([_row("2021-03-02", "half")], REPORT), days[1:])
    assert _found(table) == [("01", "a"), ("02", "b"), ("02", "c")]
    again = [_row("2021-03-03", "d"), _row("2021-03-09", "not a day of the run")]
    table.write(spark.createDataFrame(again, REPORT), days[1:])
    # the second day has no rows in its new run: it is empty now
    assert _found(table) == [("01", "a"), ("03", "d")]
    assert table.commits()[-1][0] == half
    other = CommittedDays(spark, str(tmp_path / "rep"), REPORT)
    assert _found(other) == _found(table) and table.read().schema == REPORT

    # replaced folders go, live ones stay
    assert table.vacuum() == 1 and table.vacuum() == 0
    assert _found(table) == [("01", "a"), ("03", "d")]
    assert not os.path.exists(tmp_path / "rep/data/commit=1/batch_date=2021-03-02")


def test_only_live_day_folders_are_read(spark, tmp_path):
    table = CommittedDays(spark, str(tmp_path / "rep"), REPORT)
    for i in range(4):
        table.write(spark.createDataFrame([_row("2021-03-01", f"v{i}")], REPORT), [D("2021-03-01")])
    assert _found(table) == [("01", "v3")]
    assert all("commit=4" in p for p in table.read().inputFiles())


def test_a_run_needs_days(spark, tmp_path):
    table = CommittedDays(spark, str(tmp_path / "rep"), REPORT)
    with pytest.raises(ValueError):
        table.write(spark.createDataFrame([], REPORT), [])
