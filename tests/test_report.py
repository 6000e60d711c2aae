"""Report sink: rerunning a day replaces its rows; other days stay."""

from __future__ import annotations

from conftest import D, T
from vigil.operators import report
from vigil.schemas import REPORT


def _rows(spark, path):
    df = spark.read.parquet(path)
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def test_report_write_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "rep")
    day1 = spark.createDataFrame([
        (T("2021-03-01 10:00:00"), "P1", "A B C", "+1", "account cheat", T("2021-03-02 06:00:00"),
         D("2021-03-01")),
        (None, "P2", None, "+2", "passport cheat", T("2021-03-02 06:00:00"), D("2021-03-01"))],
        REPORT)
    day2 = spark.createDataFrame([
        (T("2021-03-02 11:00:00"), "P3", "D E F", "+3", "city cheat", T("2021-03-03 06:00:00"),
         D("2021-03-02"))], REPORT)
    report.write_report(report.fraud_report([day1]), path)
    first = _rows(spark, path)
    report.write_report(report.fraud_report([day1]), path)          # the same day again
    assert _rows(spark, path) == first and len(first) == 2
    report.write_report(report.fraud_report([day2]), path)          # another day
    assert len(_rows(spark, path)) == 3
    # a rerun of day 1 where one rule no longer fires drops that rule's old row
    report.write_report(report.fraud_report([day1.limit(1)]), path)
    assert len(_rows(spark, path)) == 2


def test_report_day_without_rows_is_cleared(spark, tmp_path):
    path = str(tmp_path / "rep")
    day1 = spark.createDataFrame([
        (T("2021-03-01 10:00:00"), "P1", "A B C", "+1", "account cheat", T("2021-03-02 06:00:00"),
         D("2021-03-01"))], REPORT)
    day2 = spark.createDataFrame([
        (T("2021-03-02 11:00:00"), "P3", "D E F", "+3", "city cheat", T("2021-03-03 06:00:00"),
         D("2021-03-02"))], REPORT)
    report.write_report(report.fraud_report([day1, day2]), path)
    # day 1 reported again and now empty; day 2 not part of this run
    report.write_report(report.fraud_report([day1.limit(0)]), path, batch_dates=[D("2021-03-01")])
    assert [r.batch_date for r in spark.read.parquet(path).collect()] == [D("2021-03-02")]
    # a day with rows is replaced, not cleared
    report.write_report(report.fraud_report([day2]), path, batch_dates=[D("2021-03-02")])
    assert spark.read.parquet(path).count() == 1
