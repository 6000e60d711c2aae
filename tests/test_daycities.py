"""Distinct cities from mergeable day rows."""

from __future__ import annotations

import datetime as dt
import random

from conftest import D, T, make_facts, make_hist
from vigil.operators import daycities as dc
from vigil.schemas import OPEN_END

FIRST = D("2021-03-01")


def _hist(spark, cities, start=0):
    return make_hist(spark, [(f"T{(start + i) % 40}", "POS", c, "a", 0,
                              T("2020-01-01 00:00:00"), OPEN_END) for i, c in enumerate(cities)])


def test_numbers_are_unique_and_stay(spark, monkeypatch):
    monkeypatch.setattr(dc, "LANES", 2)  # 300 cities fill several words of each lane
    first = dc.city_numbers(_hist(spark, [f"c{i}" for i in range(100)] + ["c1", None]))
    one = {r.terminal_city: r.number for r in first.collect()}
    assert len(one) == 100 == len(set(one.values()))
    known = spark.createDataFrame(sorted(one.items()), "terminal_city string, number long")
    more = dc.city_numbers(_hist(spark, [f"c{i}" for i in range(50, 300)]), known)
    two = {r.terminal_city: r.number for r in more.collect()}
    assert len(two) == 300 == len(set(two.values()))
    assert all(two[c] == n for c, n in one.items())


def test_ranges_of_days_equal_sets(spark, monkeypatch):
    monkeypatch.setattr(dc, "LANES", 1)
    rnd = random.Random(1)
    versions = [(f"T{rnd.randrange(40)}", rnd.choice([None, *(f"c{i}" for i in range(150))]))
                for _ in range(200)]
    hist = make_hist(spark, [(t, "POS", c, "a", 0, T("2020-01-01 00:00:00"), OPEN_END)
                             for t, c in versions] + [(None, "POS", "c1", "a", 0, None, OPEN_END)])
    ops = [(FIRST + dt.timedelta(days=rnd.randrange(9)), rnd.choice(["C1", "C2", "C3", None]),
            rnd.choice([f"T{rnd.randrange(45)}", None])) for _ in range(80)]
    facts = make_facts(spark, [(f"x{i}", T("2021-03-01 10:00:00"), "1", c, "PAYMENT", "SUCCESS", t, d)
                               for i, (d, c, t) in enumerate(ops)])
    numbers = dc.city_numbers(hist)
    rows = dc.day_cities(facts, hist, numbers).cache()
    of = {}
    for t, c in versions:
        of.setdefault(t, set()).update({c} - {None})

    def count(card, low, high):
        return len(set().union(*(of.get(t, set()) for d, c, t in ops
                                 if c == card and low <= d <= high)))

    def found(df, *keys):
        return {tuple(r[k] for k in keys): r.cnt_city for r in df.collect()}

    pairs = {(d, c) for d, c, _ in ops}
    assert found(dc.cities_of_days(rows), "batch_date", "card_num") == {
        (d, c): count(c, d, d) for d, c in pairs}
    assert found(dc.cities_rolling(rows, 4), "batch_date", "card_num") == {
        (d, c): count(c, d - dt.timedelta(days=3), d) for d, c in pairs}
    low, high = FIRST + dt.timedelta(days=2), FIRST + dt.timedelta(days=6)
    assert found(dc.cities_between(rows, low, high), "card_num") == {
        (c,): count(c, low, high) for d, c in pairs if low <= d <= high}
    rows.unpersist()
