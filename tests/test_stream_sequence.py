"""The amount rule as a stateful stream gives the batch rule's rows."""

from __future__ import annotations

import datetime as dt
import random

from conftest import D, T
from vigil.operators import rules
from vigil.schemas import FACT_TRANSACTIONS
from vigil.streaming.sequence import amount_stream, read_sequence, write_sequence


def _facts(seed=1):
    """Three days of operations, most of them on few cards, with many hits among them."""
    rnd = random.Random(seed)
    rows = []
    for d in range(3):
        day = D("2021-03-01") + dt.timedelta(days=d)
        for card in ("C1", "C2", None):
            t = dt.datetime.combine(day, dt.time(8))
            amount = 900
            for i in range(40):
                t += dt.timedelta(seconds=rnd.choice([0, 30, 60, 300, 700]))
                amount = amount - 7 if rnd.random() < 0.85 else 900
                rows.append((f"{d}-{card}-{i:02}", t, rnd.choice([f"{amount},5"] * 9 + ["x"]), card,
                             rnd.choice(["PAYMENT", "WITHDRAW", "PAYMENT", "DEPOSIT"]),
                             "SUCCESS" if i % 5 == 4 else "REJECT", f"T{i % 3}", day))
    return rows


def _write(spark, rows, path):
    spark.createDataFrame(rows, FACT_TRANSACTIONS).coalesce(1).write.mode("append").parquet(path)


def _run(spark, folder, out):
    stream = (spark.readStream.schema(FACT_TRANSACTIONS).option("maxFilesPerTrigger", 1)
              .parquet(folder))
    write_sequence(amount_stream(stream, delay="1 day"), f"{out}/hits", f"{out}/side", f"{out}/ckpt")
    cols = ("batch_date", "card_num", "trans_id", "event_dt")
    return [sorted(map(tuple, read_sequence(spark, f"{out}/{x}").select(*c).collect()), key=repr)
            for x, c in (("hits", cols), ("side", ("kind", "trans_id")))]


def test_stream_equals_batch_rule(spark, tmp_path):
    rows = _facts()
    want = sorted(map(tuple, rules.amount_hits(spark.createDataFrame(rows, FACT_TRANSACTIONS))
                      .select("batch_date", "card_num", "trans_id", "event_dt").collect()), key=repr)
    assert len(want) > 5 and any(r[1] is None for r in want)
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    rnd = random.Random(3)
    by_day = [[r for r in rows if r[7] == D("2021-03-01") + dt.timedelta(days=d)] for d in range(3)]
    for own in by_day:
        rnd.shuffle(own)  # within a day the operations come in any order
        for i in range(0, len(own), 45):
            _write(spark, own[i:i + 45], land)
    undated = ("u1", None, "1", "C1", "PAYMENT", "SUCCESS", "T", D("2021-03-03"))
    later = ("z1", T("2021-03-08 00:00:00"), "1", "Z", "PAYMENT", "REJECT", "T", D("2021-03-08"))
    _write(spark, [undated, later], land)
    assert _run(spark, land, out) == [want, [("undated", "u1")]]
    # a restart from the checkpoint adds nothing; an operation of a judged day is late
    assert _run(spark, land, out)[0] == want
    _write(spark, [("l1", T("2021-03-02 09:00:00"), "1", "C1", "PAYMENT", "SUCCESS", "T",
                    D("2021-03-02"))], land)
    hits, side = _run(spark, land, out)
    assert hits == want and side == [("late", "l1"), ("undated", "u1")]


def test_hits_across_midnight(spark, tmp_path):
    """A slot of the state ends at midnight; rows of its last minutes count for the next one."""
    rows = []
    for card, day in (("C1", "2021-03-01"), ("C2", "2021-02-27"), (None, "2021-03-01")):
        start = dt.datetime.combine(D(day), dt.time(23, 40))
        for n, seconds in enumerate((0, 300, 900, 1199, 1200, 1260, 1500, 2400)):
            rows.append((f"{card}-{day}-{n}", start + dt.timedelta(seconds=seconds), f"{90 - n},5",
                         card, "PAYMENT", "SUCCESS" if n in (3, 7) else "REJECT", "T", D(day)))
        # three rejected ones before midnight, the success after it
        rows += [(f"m{i}-{card}", start + dt.timedelta(days=2, minutes=6 * i + 1), f"{50 - i}", card,
                  "PAYMENT", "SUCCESS" if i == 3 else "REJECT", "T", D(day)) for i in range(3)]
        rows.append((f"m3-{card}", start + dt.timedelta(days=2, minutes=20, seconds=59), "1", card,
                     "PAYMENT", "SUCCESS", "T", D(day)))
    want = sorted(map(tuple, rules.amount_hits(spark.createDataFrame(rows, FACT_TRANSACTIONS))
                      .select("batch_date", "card_num", "trans_id", "event_dt").collect()), key=repr)
    assert [r[2] for r in want if r[2].startswith("m")] == ["m3-C2", "m3-C1", "m3-None"]
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    _write(spark, [*rows, ("z1", T("2021-03-08 00:00:00"), "1", "Z", "PAYMENT", "REJECT", "T",
                           D("2021-03-08"))], land)
    assert _run(spark, land, out) == [want, []]


def test_state_does_not_grow_with_the_cards(spark, tmp_path):
    day = D("2021-03-01")
    rows = [(f"t{i}", T("2021-03-01 10:00:00"), "1", f"C{i}", "PAYMENT", "REJECT", "T", day)
            for i in range(6000)]
    _write(spark, rows, str(tmp_path / "land"))
    stream = spark.readStream.schema(FACT_TRANSACTIONS).parquet(str(tmp_path / "land"))
    query = write_sequence(amount_stream(stream), *(str(tmp_path / x) for x in ("h", "s", "c")))
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 0 < max(states) < 6000, states
