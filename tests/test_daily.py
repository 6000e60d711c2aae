"""The daily job end to end on feeds built from the sf0.001 tables."""

from __future__ import annotations

import csv
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, D
from vigil.plans import bindings, daily
from xlsx_util import write_xlsx

DAYS = [D("2024-01-01"), D("2024-01-02"), D("2024-01-03")]
RUN_TIME = dt.datetime(2024, 1, 4, 6, 0, 0)


def load_time(d: dt.date) -> dt.datetime:
    return dt.datetime.combine(d, dt.time(23, 0))


def _landing(spark, folder, days, with_incomplete=False):
    os.makedirs(folder, exist_ok=True)
    staged = bindings.staged_transactions(spark, SF_SMALL).withColumn("d", F.to_date("transaction_date"))
    tx = {}
    for r in staged.collect():  # 1000 fixture rows, written as the upstream files would be
        tx.setdefault(r.d, []).append(r)
    bl = [(r.passport, r.date) for r in bindings.staged_blacklist(spark, SF_SMALL).collect()]
    term = {1: [list(r) for r in bindings.terminals_first(spark, SF_SMALL).collect()],
            2: [list(r) for r in bindings.terminals_second(spark, SF_SMALL).collect()]}
    extra = [days[-1] + dt.timedelta(days=1)] if with_incomplete else []
    for i, d in enumerate(days + extra):
        stamp = d.strftime("%d%m%Y")
        with open(os.path.join(folder, f"transactions_{stamp}.txt"), "w", newline="") as f:
            w = csv.writer(f, delimiter=";")
            w.writerow(["transaction_id", "transaction_date", "amount", "card_num", "oper_type",
                        "oper_result", "terminal"])
            for r in tx.get(d, []):
                w.writerow([r.transaction_id, r.transaction_date.isoformat(sep=" "), r.amount,
                            r.card_num, r.oper_type, r.oper_result, r.terminal])
        write_xlsx(os.path.join(folder, f"passport_blacklist_{stamp}.xlsx"), ["passport", "date"],
                   [list(x) for x in bl[: 2 + i]])
        if d in days:
            snap = term[1] if d == DAYS[0] else term[2]
            write_xlsx(os.path.join(folder, f"terminals_{stamp}.xlsx"),
                       ["terminal_id", "terminal_type", "terminal_city", "terminal_address"], snap)


def _seeds(spark):
    return (bindings.seed_clients(spark, SF_SMALL), bindings.seed_accounts(spark, SF_SMALL),
            bindings.seed_cards(spark, SF_SMALL))


def _rows(spark, table):
    df = table if not isinstance(table, str) else spark.read.parquet(table)
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def test_daily_once_equals_day_by_day(spark, tmp_path):
    land_all = str(tmp_path / "land_all")
    _landing(spark, land_all, DAYS, with_incomplete=True)
    wh_a = daily.Warehouse(str(tmp_path / "wh_a"))
    done = daily.run_daily(spark, land_all, wh_a, _seeds(spark), RUN_TIME, load_time)
    assert done == DAYS  # the incomplete fourth day waits

    wh_b = daily.Warehouse(str(tmp_path / "wh_b"))
    for i, d in enumerate(DAYS):
        land = str(tmp_path / f"land_{i}")
        _landing(spark, land, DAYS)
        for other in DAYS:
            if other != d:
                stamp = other.strftime("%d%m%Y")
                os.remove(os.path.join(land, f"terminals_{stamp}.xlsx"))
        assert daily.run_daily(spark, land, wh_b, _seeds(spark), RUN_TIME, load_time) == [d]

    # three pending days are one version; loaded one by one they are three, with the same rows
    assert daily.history_versions(spark, wh_a) == [1]
    assert daily.history_versions(spark, wh_b) == [1, 2, 3]
    both = [sorted(map(str, daily.read_history(spark, wh).collect())) for wh in (wh_a, wh_b)]
    assert both[0] == both[1]
    assert _rows(spark, daily.read_report(spark, wh_a)) == _rows(spark, daily.read_report(spark, wh_b))
    rep = daily.read_report(spark, wh_a)
    assert rep.count() > 0
    assert {r.event_type for r in rep.select("event_type").distinct().collect()} <= {
        "account cheat", "passport cheat", "city cheat", "selection of the amount"}
    # history after day 2 holds the changes of the second snapshot; day 3 repeats it
    hist = daily.read_history(spark, wh_a)
    assert hist.filter(F.col("deleted_flg") == 1).count() == 1

    # key violations of the run: the third day's blacklist repeats a passport;
    # most transaction terminals are unknown at this scale
    dq = spark.read.parquet(wh_a.quality)
    assert dq.filter("relation = 'fact_blacklist'").count() == 1
    assert dq.filter("relation = 'transactions.terminal'").count() > 0
    assert dq.filter("relation like 'dim_%'").count() == 0

    # SQL over the warehouse
    names = daily.register_views(spark, wh_a, RUN_TIME)
    assert "v_terminals" in names
    n_current = spark.sql("SELECT count(*) AS n FROM v_terminals").first()["n"]
    assert n_current == bindings.terminals_second(spark, SF_SMALL).count()
    by_type = spark.sql("SELECT event_type, count(*) AS n FROM rep_fraud GROUP BY event_type")
    assert by_type.count() >= 2

    # nothing pending: a second run adds nothing
    before = _rows(spark, daily.read_report(spark, wh_a))
    assert daily.run_daily(spark, land_all, wh_a, _seeds(spark), RUN_TIME, load_time) == []
    assert _rows(spark, daily.read_report(spark, wh_a)) == before


def test_command_line_run(spark, tmp_path, capsys):
    from vigil.__main__ import main
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS[:1])
    seeds = tmp_path / "seeds"
    for name, df in zip(("clients", "accounts", "cards"), _seeds(spark)):
        df.write.parquet(str(seeds / name))
    done = main(["--landing", land, "--warehouse", str(tmp_path / "wh"), "--seeds", str(seeds),
                 "--run-time", "2024-01-02T06:00:00", "--show", "5"], spark=spark)
    assert done == DAYS[:1]
    out = capsys.readouterr().out
    assert "processed batches: ['2024-01-01']" in out and "account cheat" in out


def test_bucketed_facts(spark, tmp_path):
    from vigil.operators import rules
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS)
    plain = daily.Warehouse(str(tmp_path / "wh_plain"))
    daily.run_daily(spark, land, plain, _seeds(spark), RUN_TIME, load_time)
    bucketed = daily.Warehouse(str(tmp_path / "wh_b"), fact_buckets=4, database="vigil_bucket_test")
    assert daily.run_daily(spark, land, bucketed, _seeds(spark), RUN_TIME, load_time) == DAYS
    assert _rows(spark, daily.read_report(spark, bucketed)) == _rows(spark, daily.read_report(spark, plain))
    # the card window reads co-located buckets: no exchange in the plan
    facts, hot = daily.read_facts(spark, bucketed, DAYS)
    assert hot is None
    plan = rules.amount_sequence(facts, max_group_rows=None)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    # persisted for the rule step, the bucketed scan keeps its partitioning
    day, hot = daily._persisted_day_facts(spark, bucketed, DAYS, rules.DEFAULT_GROUP_ROWS)
    try:
        cached_plan = rules.amount_sequence(day, hot=hot)._jdf.queryExecution() \
            .executedPlan().toString()
        assert "InMemoryTableScan" in cached_plan and "Exchange" not in cached_plan
    finally:
        day.unpersist()
    # every card forced hot: the plain read is sliced and the report is unchanged
    facts, hot = daily.read_facts(spark, bucketed, DAYS, max_group_rows=2)
    assert hot is not None
    again = daily.run_rules(spark, bucketed, DAYS, load_time, RUN_TIME, max_group_rows=2)
    base = daily.run_rules(spark, bucketed, DAYS, load_time, RUN_TIME)
    assert again.exceptAll(base).count() == 0 and base.exceptAll(again).count() == 0


def test_reads_only_pending_days(spark, tmp_path):
    from vigil.sources import delimited, workbook
    land = str(tmp_path / "land")
    _landing(spark, land, DAYS)
    want = [DAYS[1]]
    tx = delimited.read_transactions(spark, daily.day_files(land, "transactions", want))
    assert [os.path.basename(p) for p in tx.inputFiles()] == ["transactions_02012024.txt"]
    bl = workbook.read_blacklist(spark, daily.day_files(land, "passport_blacklist", want))
    assert {r.batch_date for r in bl.collect()} == {DAYS[1]}
