"""As-of joins by forward fill against the range join."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import D, T, make_facts, make_hist
from vigil.operators import rules
from vigil.operators.asof import as_of_join, tangled_keys
from vigil.schemas import OPEN_END

BASE = T("2021-03-01 00:00:00")


def _at(minutes):
    return None if minutes is None else BASE + dt.timedelta(minutes=minutes)


def _inputs(spark, tangled, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c", "d", None, "lost"]),
             _at(rnd.choice([None, *range(-3, 60)]))) for i in range(300)]
    versions = []
    for key in "abcd":
        start = rnd.randint(0, 5)
        for _ in range(8):
            end = start + rnd.randint(0, 9)
            for _ in range(rnd.choice([1, 1, 2])):
                versions.append((key, _at(start), _at(end), rnd.choice(["x", "y", None])))
            start = end + 1 + rnd.randint(0, 3)
    if tangled:
        versions += [("b", _at(2), _at(50), "over"), ("b", None, _at(9), "no start")]
    versions += [(None, _at(0), _at(99), "no key"), ("d", _at(1), None, "no end")]
    return (spark.createDataFrame(rows, "i long, k string, t timestamp_ntz"),
            spark.createDataFrame(versions, "k string, f timestamp_ntz, e timestamp_ntz, city string"))


def _by_range_join(rows, versions, known=None):
    v = versions.select(F.col("k").alias("vk"), "f", "e", "city")
    on = (F.col("k") == F.col("vk")) & F.col("t").between(F.col("f"), F.col("e"))
    if known is not None:
        on = on & (F.col("f") <= known)
    return rows.join(v, on, "left").select(*rows.columns, "city")


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("tangled", [False, True])
@pytest.mark.parametrize("max_rows", [None, 10])
def test_equal_to_the_range_join(spark, tangled, max_rows):
    rows, versions = _inputs(spark, tangled)
    found = tangled_keys(versions, key="k", start="f", end="e")
    assert {r.k for r in found.collect()} == ({"b"} if tangled else set())
    for known in (None, F.lit(_at(20)), F.when(F.col("i") % 3 > 0, F.lit(_at(20)))):
        got = as_of_join(rows, versions, key="k", time="t", start="f", end="e", values=["city"],
                         known=known, max_group_rows=max_rows)
        assert _sorted(got) == _sorted(_by_range_join(rows, versions, known))


def test_a_row_meets_one_version_of_ten_thousand(spark):
    """The fill's plan makes no more rows than rows and versions."""
    from test_expiry import _row_counts
    n = 10_000
    versions = spark.range(n).select(
        F.chr(97 + F.col("id") % 1).alias("k"), F.timestamp_add("MINUTE", F.col("id"), F.lit(BASE)).alias("f"),
        F.timestamp_add("SECOND", F.col("id") * 60 + 59, F.lit(BASE)).alias("e"),
        F.col("id").cast("string").alias("city"))
    rows = spark.range(3000).select(F.col("id").alias("i"), F.chr(97 + F.col("id") % 1).alias("k"),
                                    F.timestamp_add("SECOND", F.col("id") * 200, F.lit(BASE)).alias("t"))
    got = as_of_join(rows, versions, key="k", time="t", start="f", end="e", values=["city"],
                     max_group_rows=500)
    total, counts, plan = _row_counts(got)
    assert total == 3000 and max(counts)[0] <= n + 3000
    assert "NestedLoop" not in plan
    assert all(int(r.city) == r.i * 200 // 60 for r in got.collect())


def test_views_of_a_backfill_equal_single_days(spark):
    """Every day of a backfill sees the history as it was after its own load."""
    hist = make_hist(spark, [
        ("T1", "POS", "A", "a", 0, T("2021-03-01 01:00:00"), T("2021-03-02 00:59:59")),
        ("T1", "POS", "B", "a", 0, T("2021-03-02 01:00:00"), T("2021-03-03 00:59:59")),
        ("T1", "POS", "B", "a", 1, T("2021-03-03 01:00:00"), OPEN_END),
        ("T2", "POS", "A", "a", 0, T("2021-03-02 01:00:00"), OPEN_END),
        ("T3", "POS", "C", "a", 0, T("2021-03-03 01:00:00"), OPEN_END)])
    days = [D("2021-03-01"), D("2021-03-02"), D("2021-03-03"), D("2021-03-04")]
    known = {d: dt.datetime.combine(d, dt.time(1)) for d in days[:3]}  # the last has no load
    rnd = random.Random(2)
    facts = make_facts(spark, [
        (f"x{i}", dt.datetime.combine(d, dt.time(2)) + dt.timedelta(minutes=rnd.randrange(600)),
         "1", f"C{rnd.randrange(6)}", "PAYMENT", rnd.choice(["SUCCESS", "REJECT"]),
         rnd.choice(["T1", "T2", "T3", "T9", None]), d) for i in range(200) for d in days])
    for match in ("all_versions", "as_of"):
        whole = rules.city_hits(facts, hist, known_at=known, terminal_match=match)
        single = []
        for d in days:
            day = facts.filter(F.col("batch_date") == F.lit(d))
            seen = (hist.filter(F.col("effective_from") <= F.lit(known[d])) if d in known
                    else hist.limit(0))
            single += rules.city_hits(day, seen, terminal_match=match).collect()
        assert _sorted(whole) == sorted(map(tuple, single), key=repr)
