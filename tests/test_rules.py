"""Edge rows for the four fraud rules (hand-made inputs, expected rows by hand)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import D, T, make_bank, make_blacklist, make_facts, make_hist, rows_of
from vigil.operators import rules
from vigil.schemas import OPEN_END

DAY = D("2021-03-01")
AS_OF = T("2021-03-02 06:00:00")


def _tx(tid, ts, card, terminal="T0", result="SUCCESS", amt="1", kind="PAYMENT"):
    return (tid, T(ts), amt, card, kind, result, terminal)


# --- R-1 -------------------------------------------------------------------------

def test_account_rule_edges(spark):
    bank = make_bank(
        spark,
        clients=[("VIP-1", "Ivanov", "Ivan", "Ivanovich", "P1", None, "+7 1"),
                 ("2", "Petrov", None, "Petrovich", "P2", D("2030-01-01"), "+7 2")],
        accounts=[("A1", D("2021-02-28"), "VIP-1"),   # day before: hit
                  ("A2", DAY, "VIP-1"),               # the day itself: valid
                  ("A3", None, "2"),                  # no end: valid
                  ("A4", D("2021-01-01"), "2"),        # expired, no card
                  ("A5", D("2020-01-01"), "MISSING")],  # expired, client missing
        cards=[("C1", "A1"), ("C2", "A1"), ("C3", "A2"), ("C5", "A5")])
    facts = make_facts(spark, [
        _tx("t1", "2021-03-01 10:00:00", "C1"), _tx("t2", "2021-03-01 11:00:00", "C1"),
        _tx("t3", "2021-03-01 12:00:00", "C3"), _tx("t5", "2021-03-01 13:00:00", "C5")])
    out = rules.account_cheat(bank, facts, DAY, AS_OF)
    assert out.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt",
                           "batch_date"]
    got = rows_of(out, "event_dt", "passport", "fio", "phone")
    assert got == rows_of(spark.createDataFrame([
        (T("2021-03-01 10:00:00"), "P1", "Ivanov Ivan Ivanovich", "+7 1"),
        (T("2021-03-01 11:00:00"), "P1", "Ivanov Ivan Ivanovich", "+7 1"),
        (None, "P1", "Ivanov Ivan Ivanovich", "+7 1"),
        (None, "P2", None, "+7 2"),
        (T("2021-03-01 13:00:00"), None, None, None),
    ], "event_dt timestamp_ntz, passport string, fio string, phone string"),
        "event_dt", "passport", "fio", "phone")
    assert {r.event_type for r in out.collect()} == {"account cheat"}
    assert {r.report_dt for r in out.collect()} == {AS_OF}


# --- R-2 -------------------------------------------------------------------------

def test_passport_rule_edges(spark):
    bank = make_bank(
        spark,
        clients=[("1", "A", "B", "C", "P1", None, "+1"),              # never expires, not listed
                 ("2", "A", "B", "C", "P2", None, "+2"),              # never expires, listed
                 ("3", "A", "B", "C", "P3", DAY, "+3"),               # ends on the day: valid
                 ("4", "A", None, "C", "P4", D("2021-02-28"), "+4"),  # expired, null first name
                 ("5", "A", "B", "C", "P5", D("2030-01-01"), "+5")],  # listed twice
        accounts=[("A1", None, "1"), ("A2", None, "2"), ("A3", None, "3"), ("A4", None, "4"),
                  ("A5", None, "5")],
        cards=[("C1", "A1"), ("C2", "A2"), ("C3", "A3"), ("C4", "A4"), ("C5", "A5")])
    facts = make_facts(spark, [
        _tx("t1", "2021-03-01 09:00:00", "C1"), _tx("t2", "2021-03-01 10:00:00", "C2"),
        _tx("t3", "2021-03-01 10:30:00", "C3"),
        _tx("t5a", "2021-03-01 11:00:00", "C5"), _tx("t5b", "2021-03-01 12:00:00", "C5")])
    bl = make_blacklist(spark, [("P2", DAY), ("P5", DAY), ("P5", DAY), (None, DAY)])
    out = rules.passport_cheat(bank, facts, bl, DAY, AS_OF)
    got = rows_of(out, "event_dt", "passport", "fio")
    assert got == sorted([
        (T("2021-03-01 10:00:00"), "P2", "A B C"),
        (None, "P4", None),
        (T("2021-03-01 11:00:00"), "P5", "A B C"), (T("2021-03-01 11:00:00"), "P5", "A B C"),
        (T("2021-03-01 12:00:00"), "P5", "A B C"), (T("2021-03-01 12:00:00"), "P5", "A B C"),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))
    deduped = rules.passport_cheat(bank, facts, bl, DAY, AS_OF, dedupe_blacklist=True)
    assert deduped.count() == 4


def test_flagged_clients_each_once(spark):
    bank = make_bank(spark, clients=[("1", "A", "B", "C", "P1", D("2020-01-01"), "+1")],
                     accounts=[], cards=[])
    bl = make_blacklist(spark, [("P1", DAY)])
    flagged = rules.flagged_clients(bank, bl, DAY)
    assert [(r.client_id, r._listed) for r in flagged.collect()] == [("1", 1)]


# --- R-3 -------------------------------------------------------------------------

def _city_inputs(spark):
    hist = make_hist(spark, [
        ("TA", "POS", "A", "a", 0, T("2020-01-01 00:00:00"), OPEN_END),
        ("TB", "POS", "B", "b", 0, T("2020-01-01 00:00:00"), OPEN_END),
        ("TV", "POS", "A", "v", 0, T("2020-01-01 00:00:00"), T("2021-02-28 23:59:59")),
        ("TV", "POS", "B", "v", 0, T("2021-03-01 00:00:00"), OPEN_END),
        ("TD", "POS", "A", "d", 0, T("2020-01-01 00:00:00"), T("2021-01-31 23:59:59")),
        ("TD", "POS", "A", "d", 1, T("2021-02-01 00:00:00"), OPEN_END),
    ])
    rows = [
        # K1: REJECT before, gap 59:59 -> hit; a later second hit is not reported
        _tx("k1a", "2021-03-01 10:00:00", "K1", "TA", "REJECT"),
        _tx("k1b", "2021-03-01 10:59:59", "K1", "TB"),
        _tx("k1c", "2021-03-01 11:30:00", "K1", "TA"),
        # K2: exactly 60 minutes -> no
        _tx("k2a", "2021-03-01 10:00:00", "K2", "TA"), _tx("k2b", "2021-03-01 11:00:00", "K2", "TB"),
        # K3: same city -> no
        _tx("k3a", "2021-03-01 10:00:00", "K3", "TA"), _tx("k3b", "2021-03-01 10:10:00", "K3", "TA"),
        # K4: REJECT now -> no
        _tx("k4a", "2021-03-01 10:00:00", "K4", "TA"),
        _tx("k4b", "2021-03-01 10:10:00", "K4", "TB", "REJECT"),
        # K5: unknown terminal on either side -> no
        _tx("k5a", "2021-03-01 10:00:00", "K5", "T?"), _tx("k5b", "2021-03-01 10:10:00", "K5", "TB"),
        _tx("k5c", "2021-03-01 10:20:00", "K5", "T?"),
        # K6: terminal with two versions, all versions joined -> two cities at one instant
        _tx("k6a", "2021-03-01 10:00:00", "K6", "TV"),
        # K7: tombstoned terminal keeps its old city in all-versions mode
        _tx("k7a", "2021-03-01 10:00:00", "K7", "TD"), _tx("k7b", "2021-03-01 10:05:00", "K7", "TB"),
        # K8: two transactions at one instant
        _tx("k8a", "2021-03-01 10:00:00", "K8", "TA", "REJECT"),
        _tx("k8b", "2021-03-01 10:00:00", "K8", "TB"),
        # null card -> never a hit
        _tx("n1", "2021-03-01 10:00:00", None, "TA"), _tx("n2", "2021-03-01 10:01:00", None, "TB"),
    ]
    rows = rows[::-1]  # input order must not matter
    return make_facts(spark, rows).repartition(5), hist


def test_city_rule_all_versions(spark):
    facts, hist = _city_inputs(spark)
    hits = rules.city_hits(facts, hist)
    assert rows_of(hits, "card_num", "event_dt") == [
        ("K1", T("2021-03-01 10:59:59")), ("K6", T("2021-03-01 10:00:00")),
        ("K7", T("2021-03-01 10:05:00")), ("K8", T("2021-03-01 10:00:00"))]


def test_city_rule_as_of(spark):
    facts, hist = _city_inputs(spark)
    hits = rules.city_hits(facts, hist, terminal_match="as_of")
    assert rows_of(hits, "card_num", "event_dt") == [
        ("K1", T("2021-03-01 10:59:59")), ("K8", T("2021-03-01 10:00:00"))]


def test_city_rule_split_equals_plain(spark):
    facts, hist = _city_inputs(spark)
    plain = rows_of(rules.city_hits(facts, hist, max_group_rows=None), "card_num", "event_dt")
    split = rows_of(rules.city_hits(facts, hist, max_group_rows=1), "card_num", "event_dt")
    assert plain == split


def test_city_cheat_enriched(spark):
    facts, hist = _city_inputs(spark)
    bank = make_bank(spark, clients=[("c1", "L", "F", "M", "PK1", None, "+1")],
                     accounts=[("a1", None, "c1")], cards=[("K1", "a1")])
    out = rules.city_cheat(bank, facts, hist, AS_OF)
    got = {r.event_dt: (r.passport, r.fio) for r in out.collect()}
    assert got[T("2021-03-01 10:59:59")] == ("PK1", "L F M")
    assert out.count() == 4


# --- R-4 -------------------------------------------------------------------------

def _amount_rows():
    def seq(card, start, steps, kinds=None):
        out = []
        t0 = dt.datetime.fromisoformat(start)
        for i, (secs, result, amt) in enumerate(steps):
            kind = (kinds or {}).get(i, "WITHDRAW" if i % 2 else "PAYMENT")
            out.append((f"{card}-{i}", t0 + dt.timedelta(seconds=secs), amt, card, kind, result, "T1"))
        return out
    R, S = "REJECT", "SUCCESS"
    rows = []
    rows += seq("M1", "2021-03-01 10:00:00", [(0, R, "100"), (300, R, "99,5"), (600, R, "99,49"),
                                              (1199, S, "99")])                  # 19:59 -> hit
    rows += seq("M2", "2021-03-01 10:00:00", [(0, R, "100"), (300, R, "90"), (600, R, "80"),
                                              (1200, S, "70")])                  # 20:00 -> no
    rows += seq("M3", "2021-03-01 10:00:00", [(0, R, "100"), (60, R, "100"), (120, R, "90"),
                                              (180, S, "80")])                   # equal -> no
    rows += seq("M4", "2021-03-01 10:00:00", [(0, R, "100"), (60, R, "90"), (120, S, "80")])
    rows += seq("M5", "2021-03-01 10:00:00", [(0, R, "100"), (60, R, "90"), (120, S, "5"),
                                              (180, R, "80"), (240, S, "70")],
                kinds={2: "DEPOSIT"})                                            # deposit between
    rows += seq("M6", "2021-03-01 10:00:00", [(0, R, "100"), (60, R, "abc"), (120, R, "80"),
                                              (180, S, "70")])                   # unparsable
    rows += seq("M7", "2021-03-01 10:00:00", [(0, R, "300"), (60, R, "200"), (120, R, "100"),
                                              (180, S, "50"), (240, R, "40"), (300, R, "30"),
                                              (360, R, "20"), (420, S, "10")])   # two hits
    return rows


def test_amount_rule_edges(spark):
    facts = make_facts(spark, _amount_rows()[::-1]).repartition(3)
    hits = rules.amount_hits(facts)
    assert rows_of(hits, "card_num", "event_dt") == [
        ("M1", T("2021-03-01 10:19:59")), ("M5", T("2021-03-01 10:04:00")),
        ("M7", T("2021-03-01 10:03:00")), ("M7", T("2021-03-01 10:07:00"))]


def test_amount_rule_split_equals_plain(spark):
    facts = make_facts(spark, _amount_rows())
    plain = rows_of(rules.amount_sequence(facts, max_group_rows=None), "trans_id",
                    *rules.AMOUNT_LAGS.keys())
    for limit in (1, 2, 3):
        split = rows_of(rules.amount_sequence(facts, max_group_rows=limit), "trans_id",
                        *rules.AMOUNT_LAGS.keys())
        assert plain == split


def test_amount_null_card_kept(spark):
    rows = [(f"x{i}", T("2021-03-01 10:00:00") + dt.timedelta(minutes=i), a, None, "PAYMENT", r, "T")
            for i, (r, a) in enumerate([("REJECT", "3"), ("REJECT", "2"), ("REJECT", "1,5"),
                                        ("SUCCESS", "1")])]
    bank = make_bank(spark, clients=[], accounts=[], cards=[])
    out = rules.amount_cheat(bank, make_facts(spark, rows), AS_OF)
    assert [(r.event_dt, r.passport) for r in out.collect()] == [(T("2021-03-01 10:03:00"), None)]


# --- batches -----------------------------------------------------------------------

def test_batch_list_checks():
    assert rules.batch_list(DAY) == [(DAY, DAY)]
    assert rules.batch_list((DAY, D("2020-01-01"))) == [(DAY, D("2020-01-01"))]
    assert rules.batch_list([D("2021-03-02"), DAY]) == [(DAY, DAY), (D("2021-03-02"), D("2021-03-02"))]
    import pytest
    with pytest.raises(ValueError):
        rules.batch_list([])


def test_facts_pruned_to_batches(spark):
    facts = make_facts(spark, [_tx("t1", "2021-03-01 10:00:00", "C1")], batch_date=D("2021-03-05"))
    bank = make_bank(spark, clients=[("1", "A", "B", "C", "P", None, "+")],
                     accounts=[("A1", D("2000-01-01"), "1")], cards=[("C1", "A1")])
    out = rules.account_cheat(bank, facts, DAY, AS_OF)
    # the card's only transaction belongs to another batch: one null-event row
    assert [r.event_dt for r in out.collect()] == [None]
    assert out.filter(F.col("batch_date") != F.lit(DAY)).count() == 0


def test_amount_null_card_group_split(spark):
    rows = _amount_rows() + [
        (f"n{i}", T("2021-03-01 09:00:00") + dt.timedelta(minutes=i), a, None, "PAYMENT", r, "T")
        for i, (r, a) in enumerate([("REJECT", "5"), ("REJECT", "4"), ("REJECT", "3"),
                                    ("SUCCESS", "2"), ("REJECT", "9"), ("REJECT", "8"),
                                    ("REJECT", "7"), ("SUCCESS", "6")])]
    facts = make_facts(spark, rows)
    plain = rows_of(rules.amount_hits(facts, max_group_rows=None), "card_num", "event_dt")
    split = rows_of(rules.amount_hits(facts, max_group_rows=2), "card_num", "event_dt")
    assert plain == split
    assert (None, T("2021-03-01 09:03:00")) in plain and (None, T("2021-03-01 09:07:00")) in plain


def test_city_compact_equals_expanded(spark):
    facts, hist = _city_inputs(spark)
    compact = rows_of(rules.city_hits(facts, hist), "card_num", "event_dt")
    seq = rules.city_sequence(facts, hist)
    from vigil.functions import within_minutes
    expanded = (seq.filter(within_minutes("lag_time", "trans_date", 60)
                           & (F.col("terminal_city") != F.col("lag_city"))
                           & (F.col("oper_result") == "SUCCESS"))
                .groupBy("card_num").agg(F.min("trans_date").alias("event_dt")))
    assert compact == rows_of(expanded, "card_num", "event_dt")


def test_require_event_drops_null_event_rows(spark):
    bank = make_bank(spark, clients=[("1", "A", "B", "C", "P1", D("2020-01-01"), "+1")],
                     accounts=[("A1", D("2020-01-01"), "1"), ("A2", D("2020-01-01"), "1")],
                     cards=[("C1", "A1"), ("C2", "A1")])
    facts = make_facts(spark, [_tx("t1", "2021-03-01 10:00:00", "C1")])
    bl = make_blacklist(spark, [])
    full = rules.account_cheat(bank, facts, DAY, AS_OF)
    assert full.count() == 3  # t1, card C2 without operations, account A2 without cards
    only = rules.account_cheat(bank, facts, DAY, AS_OF, require_event=True)
    assert [r.event_dt for r in only.collect()] == [T("2021-03-01 10:00:00")]
    p_full = rules.passport_cheat(bank, facts, bl, DAY, AS_OF)
    p_only = rules.passport_cheat(bank, facts, bl, DAY, AS_OF, require_event=True)
    assert p_full.count() == 3 and p_only.count() == 1


def test_cross_batch_sequences(spark):
    # a run of three rejects on one day and the success on the next
    rows = [(f"x{i}", T("2021-03-01 23:57:00") + dt.timedelta(minutes=i), a, "M", "PAYMENT", r, "T",
             D("2021-03-01") if i < 3 else D("2021-03-02"))
            for i, (r, a) in enumerate([("REJECT", "3"), ("REJECT", "2"), ("REJECT", "1,5"),
                                        ("SUCCESS", "1")])]
    facts = make_facts(spark, rows)
    assert rules.amount_hits(facts).count() == 0
    crossed = rules.amount_hits(facts, cross_batch=True)
    assert [(r.card_num, r.event_dt) for r in crossed.collect()] == [("M", T("2021-03-02 00:00:00"))]


def test_rules_ignore_partitioning_and_unrelated_cards(spark):
    from conftest import SF_MID
    from vigil.plans import bindings
    facts = bindings.facts(spark, SF_MID)
    hist = bindings.hist1(spark, SF_MID)
    base_amount = rows_of(rules.amount_hits(facts, max_minutes=14400), "card_num", "event_dt")
    base_city = rows_of(rules.city_hits(facts, hist), "card_num", "event_dt")
    for parts in (1, 13):
        shuffled = facts.repartition(parts)
        assert rows_of(rules.amount_hits(shuffled, max_minutes=14400), "card_num",
                       "event_dt") == base_amount
        assert rows_of(rules.city_hits(shuffled, hist), "card_num", "event_dt") == base_city
    # a new card whose operations would hit on their own changes nothing for the others
    extra = make_facts(spark, [
        (f"z{i}", T("2024-01-05 10:00:00") + dt.timedelta(minutes=i), a, "ZZ", "PAYMENT", r, "1",
         D("2024-01-31"))
        for i, (r, a) in enumerate([("REJECT", "9"), ("REJECT", "8"), ("REJECT", "7"),
                                    ("SUCCESS", "6")])])
    more = rows_of(rules.amount_hits(facts.unionByName(extra), max_minutes=14400), "card_num",
                   "event_dt")
    assert [r for r in more if r[0] != "ZZ"] == base_amount and len(more) == len(base_amount) + 1


def test_city_cross_batch(spark):
    hist = make_hist(spark, [("TA", "POS", "A", "a", 0, T("2020-01-01 00:00:00"), OPEN_END),
                             ("TB", "POS", "B", "b", 0, T("2020-01-01 00:00:00"), OPEN_END)])
    rows = [("x1", T("2021-03-01 23:50:00"), "1", "K", "PAYMENT", "SUCCESS", "TA", D("2021-03-01")),
            ("x2", T("2021-03-02 00:10:00"), "1", "K", "PAYMENT", "SUCCESS", "TB", D("2021-03-02"))]
    facts = make_facts(spark, rows)
    assert rules.city_hits(facts, hist).count() == 0          # each day alone: no hit
    crossed = rules.city_hits(facts, hist, cross_batch=True).collect()
    assert [(r.card_num, r.event_dt, r.batch_date) for r in crossed] == [
        ("K", T("2021-03-02 00:10:00"), D("2021-03-02"))]


def test_expiry_rules_combined_equal_separate(spark):
    from conftest import SF_SMALL
    from vigil.plans import bindings as bd
    bank, facts, bl = bd.bank(spark, SF_SMALL), bd.facts(spark, SF_SMALL), bd.blacklist(spark, SF_SMALL)
    acc = [(bd.BATCH_DATE, bd.ACCOUNT_RULE_DATE)]
    pas = [(bd.BATCH_DATE, bd.PASSPORT_RULE_DATE)]
    for require_event in (False, True):
        combined = rules.expiry_rules(bank, facts, bl, acc, pas, AS_OF, require_event=require_event)
        separate = rules.account_cheat(bank, facts, acc, AS_OF, require_event=require_event) \
            .unionByName(rules.passport_cheat(bank, facts, bl, pas, AS_OF,
                                              require_event=require_event))
        assert combined.exceptAll(separate).count() == 0
        assert separate.exceptAll(combined).count() == 0
