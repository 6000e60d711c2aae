"""The threshold join: no day in a holder's key, no more rows than the result needs."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from conftest import D, T, make_bank, make_facts
from vigil.operators import expiry, rules
from vigil.schemas import FACT_BLACKLIST

AS_OF = T("2021-12-31 06:00:00")
FIRST = D("2021-01-01")


def _days(n):
    return [FIRST + dt.timedelta(days=i) for i in range(n)]


def _inputs(spark, n_days, seed=1):
    rnd = random.Random(seed)
    days = _days(n_days)

    def some_day():
        return rnd.choice([None, D("2019-01-01"), rnd.choice(days), D("2030-01-01")])

    clients = [(str(i), "L", rnd.choice(["F", None]), "M", rnd.choice([f"P{i}", f"P{i}", None]),
                some_day(), f"+{i}") for i in range(12)]
    accounts = [(f"A{i}", some_day(), rnd.choice([str(rnd.randrange(14)), None]))
                for i in range(25)]
    cards = [(f"C{i}", f"A{rnd.randrange(27)}") for i in range(40)] + [(None, "A1")]
    facts = [(f"t{i}", T("2021-01-01 10:00:00"), "1",
              rnd.choice([f"C{rnd.randrange(45)}", "C1", None]), "PAYMENT", "SUCCESS", "T",
              rnd.choice(days)) for i in range(300)]
    listed = [(rnd.choice([f"P{rnd.randrange(14)}", None]), FIRST, rnd.choice(days))
              for _ in range(60)]
    return (make_bank(spark, clients, accounts, cards), make_facts(spark, facts),
            spark.createDataFrame(listed, FACT_BLACKLIST), days)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _day_by_day(rule, facts, days):
    out = []
    for d in days:
        out += rule(facts.filter(facts.batch_date == d), d).collect()
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("require_event", [False, True])
def test_many_days_equal_single_days(spark, require_event):
    bank, facts, blacklist, days = _inputs(spark, 5)
    options = {"require_event": require_event}
    own = days if not require_event else None
    by_account = _day_by_day(lambda f, d: rules.account_cheat(bank, f, d, AS_OF, **options),
                             facts, days)
    assert _sorted(rules.account_cheat(bank, facts, own, AS_OF, **options)) == by_account
    by_passport = _day_by_day(
        lambda f, d: rules.passport_cheat(bank, f, blacklist, d, AS_OF, **options), facts, days)
    table = spark.createDataFrame([(d, d) for d in days], "batch_date date, report_date date")
    assert _sorted(rules.passport_cheat(bank, facts, blacklist, table, AS_OF, **options)) == by_passport
    both = _sorted(rules.expiry_rules(bank, facts, blacklist, days, days, AS_OF, **options))
    assert both == sorted(by_account + by_passport, key=repr)


def test_report_dates_of_their_own(spark):
    bank, facts, blacklist, days = _inputs(spark, 4, seed=2)
    pairs = [(d, d - dt.timedelta(days=400 * (i % 2))) for i, d in enumerate(days)]
    single = []
    for p in pairs:
        single += rules.account_cheat(bank, facts, p, AS_OF).collect()
    got = _sorted(rules.account_cheat(bank, facts, pairs, AS_OF))
    assert got == sorted(map(tuple, single), key=repr)
    # rules with different batches are judged one after the other
    mixed = _sorted(rules.expiry_rules(bank, facts, blacklist, pairs, days, AS_OF))
    assert mixed == sorted(got + _sorted(rules.passport_cheat(bank, facts, blacklist, days, AS_OF)),
                           key=repr)


def _row_counts(df):
    """Rows put out by every operator of the plan that ran."""
    qe = df._jdf.queryExecution()
    n = qe.toRdd().count()
    counts = []

    def visit(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return visit(node.plan())
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            counts.append((metric.get().value(), node.nodeName()))
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(qe.executedPlan())
    return n, counts, qe.executedPlan().toString()


@pytest.mark.parametrize("n_days", [30, 300])
@pytest.mark.parametrize("require_event", [False, True])
def test_operators_make_no_more_rows_than_needed(spark, n_days, require_event):
    bank, facts, blacklist, days = _inputs(spark, n_days, seed=3)
    b = expiry.Batches.of(None, spark, facts)
    holders = (expiry.account_holders(bank, b, require_event).count()
               + expiry.passport_holders(bank, blacklist, b, require_event).count())
    n, counts, plan = _row_counts(rules.expiry_rules(bank, facts, blacklist, None, None, AS_OF,
                                                     require_event=require_event))
    bound = facts.count() + blacklist.count() + holders + n
    assert max(counts)[0] <= bound, (max(counts), bound)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_batches_prune_partitions(spark, tmp_path):
    bank, facts, _, days = _inputs(spark, 6)
    facts.write.partitionBy("batch_date").parquet(f"{tmp_path}/facts")
    stored = spark.read.schema(facts.schema).parquet(f"{tmp_path}/facts")
    table = spark.createDataFrame([(days[2], days[2])], "batch_date date, report_date date")
    for batches in (days[2], [days[2], days[3]], table):
        df = rules.account_cheat(bank, stored, batches, AS_OF, require_event=True)
        want = facts.filter(facts.batch_date.isin(days[2:3] if batches is not days else days))
        if isinstance(batches, list):
            want = facts.filter(facts.batch_date.isin(batches))
        assert _sorted(df) == _sorted(rules.account_cheat(bank, want, None, AS_OF, require_event=True))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(batch_date" in plan
