"""Plan facts: one fact shuffle per sequence rule, no Python in rules,
expiry filters pushed to the scan."""

from __future__ import annotations

import re

from conftest import SF_MID
from vigil.operators import rules
from vigil.plans import bindings as b


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_amount_rule_one_shuffle(spark):
    plan = _plan(rules.amount_hits(b.facts(spark, SF_MID)))
    assert _shuffles(plan) == 1 and plan.count("Window [") == 1
    assert "SortMergeJoin" not in plan


def test_city_rule_one_fact_shuffle(spark):
    plan = _plan(rules.city_hits(b.facts(spark, SF_MID), b.hist1(spark, SF_MID)))
    # the card window; the per-card min reuses its partitioning and the terminal
    # summary is a broadcast
    assert _shuffles(plan) == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_python_in_rules(spark):
    bank, facts = b.bank(spark, SF_MID), b.facts(spark, SF_MID)
    parts = rules.all_rules(bank, facts, b.blacklist(spark, SF_MID), b.hist1(spark, SF_MID),
                            b.BATCH_DATE, b.REPORT_AS_OF)
    for part in parts:
        plan = _plan(part)
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas", plan)


def test_expiry_filter_pushed_to_scan(spark):
    plan = _plan(rules.account_cheat(b.bank(spark, SF_MID), b.facts(spark, SF_MID),
                                     [(b.BATCH_DATE, b.ACCOUNT_RULE_DATE)], b.REPORT_AS_OF))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", plan)


def test_expiry_rule_reuses_holder_shuffles(spark):
    """With dimensions too large to broadcast, the inner and anti branches of
    the expiry rule share the holder side's shuffles (AQE stage reuse)."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = rules.account_cheat(b.bank(spark, SF_MID), b.facts(spark, SF_MID),
                                 [(b.BATCH_DATE, b.ACCOUNT_RULE_DATE)], b.REPORT_AS_OF)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
        assert "isFinalPlan=true" in final and "ReusedExchange" in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
