"""Scalar helpers: names, minutes, file dates."""

from __future__ import annotations

from conftest import D, T
from vigil.functions import batch_date_of, feed_of, full_name, minutes_between, within_minutes


def test_full_name_null_if_any_part_null(spark):
    df = spark.createDataFrame([("A", "B", "C"), ("A", None, "C")], "l string, f string, m string")
    assert [r.n for r in df.select(full_name("l", "f", "m").alias("n")).collect()] == ["A B C", None]


def test_minutes(spark):
    df = spark.createDataFrame([(T("2021-03-01 10:00:00"), T("2021-03-01 10:59:59.999999")),
                                (T("2021-03-01 10:00:00"), T("2021-03-01 11:00:00")),
                                (None, T("2021-03-01 11:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    rows = df.select(minutes_between("a", "b").alias("m"),
                     within_minutes("a", "b", 60).alias("w")).collect()
    assert [r.w for r in rows] == [True, False, None]
    assert rows[1].m == 60.0 and rows[2].m is None and 59.99 < rows[0].m < 60.0


def test_file_dates(spark):
    names = ["transactions_01032021.txt", "passport_blacklist_31122020.xlsx",
             "terminals_31022021.xlsx", "notes.txt", "transactions_01032021_v2.txt",
             "x12345678y.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [(r.d, r.f) for r in df.select(batch_date_of("n").alias("d"),
                                         feed_of("n").alias("f")).collect()]
    assert got == [(D("2021-03-01"), "transactions"), (D("2020-12-31"), "passport_blacklist"),
                   (None, "terminals"), (None, None), (D("2021-03-01"), "transactions"),
                   (None, None)]
    paths = spark.createDataFrame([("/data/2021/transactions_01032021.txt/part-00000-12345678.csv",)],
                                  "p string")
    assert paths.select(batch_date_of("p", in_path=True).alias("d")).first().d == D("2021-03-01")
