"""Feeds and runs with awkward files: nothing is lost, mixed or misread in silence."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from test_daily import DAYS, RUN_TIME, _landing, _rows, _seeds, load_time
from xlsx_util import write_xlsx

from vigil.plans import daily
from vigil.sources import delimited, files, workbook
from vigil.streaming import ingest

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def test_columns_by_name_and_quotes(spark, tmp_path):
    (tmp_path / "transactions_01032021.txt").write_text(
        "amount;extra;card_num;transaction_id;terminal;oper_type;oper_result;transaction_date\n"
        '"1,5";x;"k""1";t1;T;PAYMENT;SUCCESS;2021-03-01 10:00:00\n'
        "2;x;k;t2;T;PAYMENT;SUCCESS;yesterday\n"
        "3;x;k;t3;T;PAYMENT;SUCCESS;2021-03-01 10:00:00;more\n")
    (tmp_path / "transactions_02032021.txt").write_text(
        HEADER + "t4;2021-03-02 10:00:00;4;k;PAYMENT;SUCCESS;T\n")
    raw = delimited.read_transactions_raw(spark, str(tmp_path))
    rows = {r.transaction_id: r for r in delimited.accepted_lines(raw).collect()}
    assert set(rows) == {"t1", "t2", "t4"}
    assert (rows["t1"].amount, rows["t1"].card_num) == ("1,5", 'k"1')
    assert rows["t1"].transaction_date == dt.datetime(2021, 3, 1, 10)
    assert [r.reason for r in delimited.rejected_lines(raw).collect()] == [
        "more fields than the header"]
    assert [(r.key_value, r.n_rows) for r in delimited.bad_values(raw).collect()] == [
        ("yesterday", 1)]
    (tmp_path / "transactions_03032021.txt").write_text("transaction_id;amount\n1;2\n")
    with pytest.raises(ValueError, match="no column"):
        delimited.read_transactions(spark, str(tmp_path))


def test_workbooks_empty_missing_and_other_formats(spark, tmp_path):
    write_xlsx(str(tmp_path / "passport_blacklist_01032021.xlsx"), ["passport", "date"], [])
    (tmp_path / "passport_blacklist_02032021.csv").write_text("date;passport\n2021-03-01;p1\n")
    rows = workbook.read_blacklist(spark, str(tmp_path)).collect()
    assert [(r.passport, r.date, r.batch_date) for r in rows] == [
        ("p1", dt.date(2021, 3, 1), dt.date(2021, 3, 2))]
    write_xlsx(str(tmp_path / "passport_blacklist_03032021.xlsx"), ["passport_num", "date"],
               [["p2", "2021-03-01"]])
    with pytest.raises(Exception, match="has no column"):
        workbook.read_blacklist(spark, str(tmp_path)).collect()


def test_partial_uploads_are_not_feeds(spark):
    names = ["transactions_01032021.txt.part", "passport_blacklist_01032021.xlsx",
             "terminals_01032021.xlsx", "transactions_02032021.txt",
             "passport_blacklist_02032021.csv", "terminals_02032021.xlsx"]
    listed = files.feed_files(spark.createDataFrame([(n,) for n in names], "file_name string"))
    assert [r.batch_date for r in files.complete_batches(listed).collect()] == [dt.date(2021, 3, 2)]
    assert [r.file_name for r in files.quarantined_files(listed).collect()] == names[:1]


def test_late_feed_second_file_archive_and_equal_load_times(spark, tmp_path):
    """A day whose snapshot comes late runs then; a second file of a processed day loads
    the day again from all its files, also from the archive; all equals one clean run."""
    full, land, arch = (str(tmp_path / n) for n in ("full", "land", "archive"))
    _landing(spark, full, DAYS[:2])
    shutil.copytree(full, land)
    stamp = DAYS[1].strftime("%d%m%Y")
    os.remove(os.path.join(land, f"terminals_{stamp}.xlsx"))
    wh = daily.Warehouse(str(tmp_path / "wh"))
    one = lambda d: RUN_TIME  # noqa: E731  the same load time for every day
    run = lambda **o: ingest.run_daily_stream(
        spark, land, wh, str(tmp_path / "ckpt"), RUN_TIME, one, archive_dir=arch, **o)
    run(seeds=_seeds(spark))
    assert daily.processed_dates(spark, wh) == {DAYS[0]}
    first = DAYS[0].strftime("%d%m%Y")
    assert os.path.exists(os.path.join(arch, f"transactions_{first}.txt"))
    assert os.path.exists(os.path.join(land, f"transactions_{stamp}.txt"))
    shutil.copy(os.path.join(full, f"terminals_{stamp}.xlsx"), land)
    run()
    assert daily.processed_dates(spark, wh) == set(DAYS[:2])
    again = os.path.join(land, f"transactions_{first}_2.txt")
    with open(again, "w") as f:
        f.write(HEADER + "t9;2024-01-01 10:00:00;9;c9;PAYMENT;SUCCESS;T9\n")
    shutil.copy(again, full)
    run()
    clean = daily.Warehouse(str(tmp_path / "clean"))
    daily.run_daily(spark, full, clean, _seeds(spark), RUN_TIME, one)
    assert _rows(spark, wh.transactions) == _rows(spark, clean.transactions)
    assert _rows(spark, daily.read_report(spark, wh)) == _rows(spark, daily.read_report(spark, clean))
    # two loads made two versions, the clean run one; days and times are the same
    assert [x[1:] for x in daily.history_loads(spark, wh)] == [
        x[1:] for x in daily.history_loads(spark, clean)]
    assert [t for _, _, t in daily.history_loads(spark, wh)] == [
        RUN_TIME, RUN_TIME + dt.timedelta(seconds=1)]


def test_retry_after_a_stop_equals_a_clean_run(spark, tmp_path, monkeypatch):
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS[:2])
    wh, clean = (daily.Warehouse(str(tmp_path / n)) for n in ("wh", "clean"))
    with monkeypatch.context() as m:
        m.setattr(daily, "check_quality", lambda *a, **k: (_ for _ in ()).throw(OSError("stop")))
        with pytest.raises(OSError):
            daily.run_daily(spark, land, wh, _seeds(spark), RUN_TIME, load_time)
    later = RUN_TIME + dt.timedelta(hours=1)
    assert daily.run_daily(spark, land, wh, _seeds(spark), later, load_time) == DAYS[:2]
    daily.run_daily(spark, land, clean, _seeds(spark), later, load_time)
    assert daily.history_loads(spark, wh) == daily.history_loads(spark, clean)
    assert _rows(spark, daily.read_report(spark, wh)) == _rows(spark, daily.read_report(spark, clean))
    # a day that is loaded again without rows loses its old ones
    name = f"transactions_{DAYS[0].strftime('%d%m%Y')}.txt"
    with open(os.path.join(land, name), "w") as f:
        f.write(HEADER)
    daily.load_facts(spark, land, wh, DAYS[:1])
    facts = spark.read.parquet(wh.transactions)
    assert {r.batch_date for r in facts.select("batch_date").distinct().collect()} == {DAYS[1]}


def test_history_versions_are_committed(spark, tmp_path, monkeypatch):
    """A stop between a version's rows and its record leaves the old version readable; a load
    writes open rows and those it closed, not the rows closed before."""
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS)
    wh = daily.Warehouse(str(tmp_path / "wh"))
    daily.load_history(spark, land, wh, DAYS[:1], load_time)
    first = sorted(map(str, daily.read_history(spark, wh).collect()))
    real = spark.createDataFrame
    with monkeypatch.context() as m:
        def stop(rows, schema=None, *a, **k):
            if schema == daily.HISTORY_LOADS:
                raise OSError("stop")
            return real(rows, schema, *a, **k)
        m.setattr(type(spark), "createDataFrame", lambda self, *a, **k: stop(*a, **k))
        with pytest.raises(OSError):
            daily.load_history(spark, land, wh, DAYS[1:], load_time)
    assert os.path.exists(f"{wh.history}/v=000002")
    assert sorted(map(str, daily.read_history(spark, wh).collect())) == first
    daily.load_history(spark, land, wh, DAYS[1:2], load_time)
    daily.load_history(spark, land, wh, DAYS[2:], load_time)
    hist = daily.read_history(spark, wh)
    closed = hist.filter(hist.effective_to < daily.OPEN_END)
    # the third day repeats the second: nothing is closed again
    assert closed.count() > 0 and not os.path.exists(f"{wh.history}/v=000003/state=closed")
    whole = daily.Warehouse(str(tmp_path / "whole"))
    daily.load_history(spark, land, whole, DAYS, load_time)
    assert sorted(map(str, hist.collect())) == sorted(map(str, daily.read_history(spark, whole).collect()))
