"""Structured Streaming ingest: files read once; stream-driven job = batch job."""

from __future__ import annotations

import os
import shutil

from test_daily import DAYS, RUN_TIME, _landing, _rows, _seeds, load_time
from vigil.plans import daily
from vigil.sources import delimited
from vigil.streaming import ingest


def test_ingest_each_file_once(spark, tmp_path):
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS[:1])
    table, ckpt = str(tmp_path / "facts"), str(tmp_path / "ckpt")
    ingest.ingest_transactions(spark, land, table, ckpt)
    first = spark.read.parquet(table).count()
    ingest.ingest_transactions(spark, land, table, ckpt)          # nothing new
    assert spark.read.parquet(table).count() == first
    batch = delimited.read_transactions(spark, land, "transactions_*.txt")
    assert first == batch.count() > 0


def test_stream_job_equals_batch_job(spark, tmp_path):
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS[:2])
    wh_s = daily.Warehouse(str(tmp_path / "wh_stream"))
    ckpt = str(tmp_path / "ckpt")
    ingest.run_daily_stream(spark, land, wh_s, ckpt, RUN_TIME, load_time, seeds=_seeds(spark))
    # the third day arrives later: a second run picks up only the new files
    full = str(tmp_path / "full")
    _landing(spark, full, DAYS)
    stamp = DAYS[2].strftime("%d%m%Y")
    for name in (f"transactions_{stamp}.txt", f"passport_blacklist_{stamp}.xlsx",
                 f"terminals_{stamp}.xlsx"):
        shutil.copy(os.path.join(full, name), os.path.join(land, name))
    ingest.run_daily_stream(spark, land, wh_s, ckpt, RUN_TIME, load_time)

    wh_b = daily.Warehouse(str(tmp_path / "wh_batch"))
    assert daily.run_daily(spark, full, wh_b, _seeds(spark), RUN_TIME, load_time) == DAYS
    assert _rows(spark, daily.read_report(spark, wh_s)) == _rows(spark, daily.read_report(spark, wh_b))
    assert [d for _, d, _ in daily.history_loads(spark, wh_s)] == DAYS


def test_archive_after_processing(spark, tmp_path):
    land, arch = tmp_path / "land", tmp_path / "archive"
    land.mkdir()
    header = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
    for day in ("01", "02"):
        (land / f"transactions_{day}032021.txt").write_text(
            header + f"{day};2021-03-{day} 10:00:00;1,5;c;PAYMENT;SUCCESS;T\n")
    table, ckpt = str(tmp_path / "facts"), str(tmp_path / "ckpt")
    ingest.ingest_transactions(spark, str(land), table, ckpt, archive_dir=str(arch))
    assert spark.read.parquet(table).count() == 2
    (land / "transactions_03032021.txt").write_text(
        header + "03;2021-03-03 10:00:00;1,5;c;PAYMENT;SUCCESS;T\n")
    ingest.ingest_transactions(spark, str(land), table, ckpt, archive_dir=str(arch))
    assert spark.read.parquet(table).count() == 3
    # the first run's files are archived by the second run; the newest stay
    assert sorted(p.name for p in land.iterdir()) == ["transactions_03032021.txt"]
    assert sorted(p.name for p in arch.rglob("*.txt")) == ["transactions_01032021.txt",
                                                           "transactions_02032021.txt"]


def test_ingest_keeps_rejects_and_reads_by_name(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    names = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"
    (land / "transactions_01032021.txt").write_text(
        names + "\n1;2021-03-01 10:00:00;1,5;c;PAYMENT;SUCCESS;T\n"
        "2;2021-03-01 10:00:00;1,5;c;PAYMENT;SUCCESS;T;more\n")
    (land / "transactions_02032021.txt").write_text(  # other order, another column
        "terminal;note;amount;card_num;oper_type;oper_result;transaction_date;transaction_id\n"
        "T;n;2,5;c;PAYMENT;SUCCESS;2021-03-02 10:00:00;3\n")
    (land / "transactions_99999999.txt").write_text(
        names + "\n4;2021-03-01 10:00:00;1,5;c;PAYMENT;SUCCESS;T\n")
    table, ckpt = str(tmp_path / "facts"), str(tmp_path / "ckpt")
    for _ in range(2):  # a second run finds nothing new
        ingest.ingest_transactions(spark, str(land), table, ckpt, rejects=str(tmp_path / "rejects"))
        facts = ingest.read_ingested(spark, table)
        assert sorted((r.trans_id, r.amt, str(r.batch_date)) for r in facts.collect()) == [
            ("1", "1,5", "2021-03-01"), ("3", "2,5", "2021-03-02")]
        rejects = spark.read.parquet(str(tmp_path / "rejects"))
        assert sorted((r.transaction_id, r.reason) for r in rejects.collect()) == [
            ("2", "more fields than the header"), ("4", "no date in the file name")]
