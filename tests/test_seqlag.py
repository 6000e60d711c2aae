"""Lag and fill over ranges equal the plain window; hot groups spread over tasks."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_MID
from vigil.operators import rules, seqlag
from vigil.operators.seqlag import fill_columns, hot_groups, lag_columns
from vigil.plans import bindings

BASE = dt.datetime(2021, 3, 1)
SCHEMA = "g string, t timestamp_ntz, i long, v int"


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_ranged_lag_equals_plain(spark):
    facts = bindings.facts(spark, SF_MID)
    plain = rules.amount_sequence(facts, max_group_rows=None)
    for rows_per_range in (3, 40):
        ranged = rules.amount_sequence(facts, max_group_rows=rows_per_range)
        assert ranged.exceptAll(plain).count() == 0
        assert plain.exceptAll(ranged).count() == 0


def test_hot_groups(spark):
    facts = bindings.facts(spark, SF_MID)
    assert hot_groups(facts, ["batch_date", "card_num"], 10_000_000) is None
    hot = hot_groups(facts, ["batch_date", "card_num"], 50)
    expected = facts.groupBy("batch_date", "card_num").agg(F.count(F.lit(1)).alias("n")) \
        .filter("n > 50")
    same(hot.select("batch_date", "card_num", "_n"), expected)
    assert expected.count() > 0


def test_ranged_lag_and_fill_property(spark):
    row = st.tuples(st.sampled_from(["a", "b", None]),                        # group (null too)
                    st.one_of(st.none(), st.integers(0, 20)),                  # minutes (ties, nulls)
                    st.integers(0, 10 ** 6),                                    # tie-breaker id
                    st.one_of(st.none(), st.integers(-5, 5)))                  # value

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=60, unique_by=lambda r: r[2]), st.integers(1, 6))
    def check(rows, limit):
        data = [(g, None if m is None else BASE + dt.timedelta(minutes=m), i, v)
                for g, m, i, v in rows]
        df = spark.createDataFrame(data, SCHEMA)
        lags = {"p1": ("v", 1), "p2": ("v", 2), "pt": ("t", 3)}
        hot = hot_groups(df, ["g"], limit)
        same(lag_columns(df, ["g"], ["t", "i"], lags),
             lag_columns(df, ["g"], ["t", "i"], lags, hot=hot))
        same(fill_columns(df, ["g"], ["t", "i"], {"f": "v", "ft": "t"}),
             fill_columns(df, ["g"], ["t", "i"], {"f": "v", "ft": "t"}, hot=hot))
    check()


def _one_instant(spark, n=900):
    rows = [("c", BASE, i, i) for i in range(n)] + [(None, BASE, i, i) for i in range(n)]
    rows += [("c", BASE, 5, 7)] * 300  # alike in every column
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_one_instant_and_the_null_group_spread_over_ranges(spark, monkeypatch):
    df = _one_instant(spark)
    hot = hot_groups(df, ["g"], 100)
    ranged = seqlag.in_ranges(seqlag.split_hot(df, ["g"], hot)[0], ["g"],
                              [F.col("t").asc_nulls_first(), F.col("i").asc_nulls_first()], hot)
    sizes = [r["n"] for r in ranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 2100 and len(sizes) >= 15 and max(sizes) < 400
    lags = {"p1": ("v", 1), "p3": ("v", 3)}
    same(lag_columns(df, ["g"], ["t", "i", "v"], lags),
         lag_columns(df, ["g"], ["t", "i", "v"], lags, hot=hot))


def test_values_are_carried_through_short_and_empty_ranges(spark):
    # one value at the start, then nulls over many ranges of few rows
    rows = [("c", BASE + dt.timedelta(minutes=i), i, 1 if i == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    hot = hot_groups(df, ["g"], 2)
    got = fill_columns(df, ["g"], ["t"], {"f": "v"}, hot=hot)
    assert {r.f for r in got.collect()} == {1}
    lags = {"p5": ("i", 5)}
    same(lag_columns(df, ["g"], ["t"], lags), lag_columns(df, ["g"], ["t"], lags, hot=hot))
