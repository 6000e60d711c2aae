"""The four fraud rules.

Each rule returns report rows ``event_dt, passport, fio, phone, event_type,
report_dt, batch_date``. Facts carry ``batch_date``; a rule processes any
number of batches in one job, and by default never looks across batches
(``batch_date`` is part of every window partition and fact join key), which
equals running the rule once per day.

Batches are given as ``expiry.BatchSpec``: dates or ``(batch_date, report_date)``
pairs, a table of them, or None for every batch of the facts. The expiry rules
(``expiry``) compare against ``report_date``, the file date in the daily run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import parse_amount, ts_lit, within_minutes
from vigil.operators.asof import as_of_join, last_before
from vigil.operators.dims import Bank, with_holder
from vigil.operators.expiry import (
    Batches,
    BatchSpec,
    account_cheat,
    batch_list,
    expired_accounts,
    expiry_rules,
    flagged_clients,
    passport_cheat,
)
from vigil.operators.seqlag import DEFAULT_GROUP_ROWS, hot_groups, lag_columns
from vigil.schemas import (
    AMOUNT_MAX_MINUTES,
    AMOUNT_OPER_TYPES,
    CITY_MAX_MINUTES,
    EVENT_AMOUNT,
    EVENT_CITY,
    REPORT_COLUMNS,
    RESULT_REJECT,
    RESULT_SUCCESS,
)
from vigil.session import written


def _report(rows: DataFrame, event_type: str, as_of: dt.datetime) -> DataFrame:
    return rows.select(
        F.col("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone",
        F.lit(event_type).alias("event_type"), ts_lit(as_of).alias("report_dt"), "batch_date",
    ).select(*REPORT_COLUMNS)


# --- R-3: operations in different cities within an hour --------------------

CITY_ORDER = ("trans_date", "trans_id", "terminal", "oper_result", "effective_from",
              "deleted_flg", "terminal_city")
TX_ORDER = ("trans_date", "trans_id", "terminal", "oper_result")
VERSION_ORDER = ("effective_from", "deleted_flg", "terminal_city")
def _keys(cross_batch: bool) -> list[str]:
    return ["card_num"] if cross_batch else ["batch_date", "card_num"]



def _hot(df: DataFrame, keys: list[str], max_group_rows: int | None, hot) -> DataFrame | None:
    """Hot groups of ``df`` unless given: slicing any group is exact, so stats
    computed once over a superset of the rows (all facts of the batches) serve
    every sequence rule of a run."""
    if hot != "auto":
        return hot
    return hot_groups(df, keys, max_group_rows) if max_group_rows else None


def cards_city_count(tx: DataFrame, hist: DataFrame) -> DataFrame:
    """``batch_date, card_num, cnt_city``: distinct cities of each card's operations over
    all versions of their terminals."""
    h = hist.select("terminal_id", "terminal_city")
    return (tx.join(h, tx.terminal == h.terminal_id, "left")
            .groupBy("batch_date", "card_num")
            .agg(F.count_distinct("terminal_city").alias("cnt_city")))


def cards_multi_city(tx: DataFrame, hist: DataFrame) -> DataFrame:
    """Cards with operations in more than one city on a day."""
    return cards_city_count(tx, hist).filter(F.col("cnt_city") > 1)


KnownAt = dict[dt.date, dt.datetime]


def _known_at(facts: DataFrame, known_at: KnownAt | None) -> DataFrame:
    """The facts with the history load time of their batch (null without ``known_at``)."""
    if not known_at:
        return facts.withColumn("_known", F.lit(None).cast("timestamp_ntz"))
    loads = facts.sparkSession.createDataFrame(sorted(known_at.items()),
                                               "batch_date date, _known timestamp_ntz")
    # the caller's own dictionary: 16 bytes a day
    return facts.join(F.broadcast(loads), "batch_date", "left")


def city_sequence(facts: DataFrame, hist: DataFrame, *, terminal_match: str = "all_versions",
                  cross_batch: bool = False, max_group_rows: int | None = DEFAULT_GROUP_ROWS,
                  known_at: KnownAt | None = None, hot="auto") -> DataFrame:
    """Transactions of known cards joined to terminal history, with the previous
    row's city and time on the same card.

    ``terminal_match='all_versions'`` joins every version of the terminal (a
    terminal that changed city gives one row per city); ``'as_of'`` only the
    live version valid at the transaction time (none after a deletion), which a
    transaction finds by forward fill (``asof``).
    ``known_at`` maps a batch date to its history load time: a batch then only
    sees versions that existed after its own load, so a backfill over several
    days reads one history table and still gets each day's view."""
    tx = facts.filter(F.col("card_num").isNotNull()).select(
        "batch_date", "card_num", "trans_id", "trans_date", "oper_result", "terminal")
    h = hist.select("terminal_id", "terminal_city", "effective_from", "effective_to", "deleted_flg")
    dated = _known_at(tx, known_at)
    if terminal_match == "as_of":
        live = h.filter(F.col("deleted_flg") == 0).withColumnRenamed("terminal_id", "terminal")
        rows = as_of_join(
            dated, live.withColumn("_from", F.col("effective_from")), key="terminal",
            time="trans_date", start="effective_from", end="effective_to",
            values=["terminal_city", "_from", "deleted_flg"],
            known=F.col("_known") if known_at else None, max_group_rows=max_group_rows)
        rows = rows.withColumnRenamed("_from", "effective_from")
    elif terminal_match == "all_versions":
        cond = F.col("terminal") == F.col("terminal_id")
        if known_at:
            cond = cond & (F.col("effective_from") <= F.col("_known"))
        rows = dated.join(written(h), cond, "left").drop("terminal_id", "effective_to")
    else:
        raise ValueError(f"unknown terminal_match {terminal_match!r}")
    rows = rows.drop("_known")
    keys = _keys(cross_batch)
    hot = _hot(tx, keys, max_group_rows, hot)
    return lag_columns(rows, keys, CITY_ORDER,
                       {"lag_city": ("terminal_city", 1), "lag_time": ("trans_date", 1)}, hot=hot)


def terminal_views(hist: DataFrame) -> DataFrame:
    """``terminal_id, effective_from, first_city, last_city, moved``: the summary of a
    terminal's versions in version order, as it stands from every version's start on.
    ``moved``: two consecutive versions had different non-null cities. The window runs per
    terminal over its versions (at most one a load)."""
    h = hist.select("terminal_id", "terminal_city", "effective_from", "deleted_flg")
    w = Window.partitionBy("terminal_id").orderBy(*[F.col(c).asc_nulls_first()
                                                    for c in VERSION_ORDER])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.select("*", F.lag("terminal_city").over(w).alias("_prev"),
                 F.first("terminal_city").over(upto).alias("first_city"),
                 F.lead(F.struct("effective_from")).over(w).alias("_next"))
    step = F.coalesce(F.col("_prev") != F.col("terminal_city"), F.lit(False))
    h = h.withColumn("moved", F.max(step).over(upto))
    # the last of the versions with one start
    same = F.col("_next").isNotNull() & F.col("_next.effective_from").eqNullSafe(F.col("effective_from"))
    return h.filter(~same).select("terminal_id", "effective_from", "first_city",
                                  F.col("terminal_city").alias("last_city"), "moved")


def terminal_cities(hist: DataFrame) -> DataFrame:
    """One row per terminal: its last view (``first_city, last_city, moved``).

    This is all the city rule needs from the history in all-versions mode, so
    facts join an n:1 table instead of fanning out over versions. The table is
    written, so its size in bytes decides how it is joined."""
    views = terminal_views(hist)
    last = Window.partitionBy("terminal_id").orderBy(F.col("effective_from").desc_nulls_last())
    return written(views.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1")
                   .select("terminal_id", "first_city", "last_city", "moved"))


def terminal_cities_at(hist: DataFrame, facts: DataFrame, known_at: KnownAt,
                       max_group_rows: int | None = DEFAULT_GROUP_ROWS) -> DataFrame:
    """``batch_date, terminal_id`` of the facts with the view of the terminal at the batch's
    load time: every pair finds its view by forward fill, so neither versions nor terminals
    are multiplied by days."""
    pairs = _known_at(facts.select("batch_date", F.col("terminal").alias("terminal_id")).distinct(),
                      known_at)
    views = terminal_views(hist.filter(F.col("effective_from").isNotNull()))
    met = last_before(pairs, views, key="terminal_id", at=F.col("_known"), start="effective_from",
                      values=["first_city", "last_city", "moved"], max_group_rows=max_group_rows)
    return written(met.filter(F.col("_versions").isNotNull())
                   .select("batch_date", "terminal_id", F.inline("_versions")))


def _city_hits_by_summary(facts: DataFrame, hist: DataFrame, max_minutes: int,
                          cross_batch: bool, max_group_rows: int | None,
                          known_at: KnownAt | None, hot) -> DataFrame:
    """All-versions city rule on transactions joined to ``terminal_cities``.

    Over the rows of a transaction's versions, a row after the first is 0
    minutes after its predecessor (same transaction), so it is a hit when that
    version moved city; the first row follows the previous transaction's last
    version. Hence a SUCCESS transaction is a hit when its terminal ``moved``,
    or its ``first_city`` differs from the previous transaction's
    ``last_city`` less than ``max_minutes`` earlier -- the same hits as the
    window over all versions, with one row per transaction."""
    tx = facts.filter(F.col("card_num").isNotNull()).select(
        "batch_date", "card_num", "trans_id", "trans_date", "oper_result", "terminal")
    summary = (terminal_cities_at(hist, tx, known_at, max_group_rows) if known_at
               else terminal_cities(hist))
    on = ["terminal_id"] if not known_at else ["batch_date", "terminal_id"]
    rows = (tx.withColumnRenamed("terminal", "terminal_id")
            .join(summary, on, "left").withColumnRenamed("terminal_id", "terminal"))
    keys = _keys(cross_batch)
    hot = _hot(tx, keys, max_group_rows, hot)
    seq = lag_columns(rows, keys, TX_ORDER,
                      {"lag_last_city": ("last_city", 1), "lag_time": ("trans_date", 1)}, hot=hot)
    step = (within_minutes("lag_time", "trans_date", max_minutes)
            & (F.col("first_city") != F.col("lag_last_city")))
    # versions of one transaction are 0 minutes apart: a move counts when 0 < max_minutes
    moved = F.coalesce(F.col("moved"), F.lit(False)) & F.lit(max_minutes > 0)
    hit = (F.col("oper_result") == RESULT_SUCCESS) & (moved | F.coalesce(step, F.lit(False)))
    return seq.filter(hit)


def city_hits(facts: DataFrame, hist: DataFrame, *, max_minutes: int = CITY_MAX_MINUTES,
              terminal_match: str = "all_versions", cross_batch: bool = False,
              max_group_rows: int | None = DEFAULT_GROUP_ROWS,
              known_at: KnownAt | None = None, hot="auto") -> DataFrame:
    """Earliest SUCCESS transaction per card whose city differs from the previous
    row's city (any result, any type) less than ``max_minutes`` earlier.

    All-versions mode runs on one row per transaction (``terminal_cities``);
    as-of mode on the transactions joined to their live version."""
    if terminal_match == "all_versions":
        hits = _city_hits_by_summary(facts, hist, max_minutes, cross_batch, max_group_rows,
                                     known_at, hot)
    else:
        seq = city_sequence(facts, hist, terminal_match=terminal_match, cross_batch=cross_batch,
                            max_group_rows=max_group_rows, known_at=known_at, hot=hot)
        hit = (within_minutes("lag_time", "trans_date", max_minutes)
               & (F.col("terminal_city") != F.col("lag_city"))
               & (F.col("oper_result") == RESULT_SUCCESS))
        hits = seq.filter(hit)
    if cross_batch:
        return hits.groupBy("card_num").agg(
            F.min("trans_date").alias("event_dt"),
            F.min_by("batch_date", F.struct("trans_date", "batch_date")).alias("batch_date"))
    return hits.groupBy("batch_date", "card_num").agg(F.min("trans_date").alias("event_dt"))


def city_cheat(bank: Bank, facts: DataFrame, hist: DataFrame, as_of: dt.datetime, *,
               holders: DataFrame | None = None, **options) -> DataFrame:
    """City rule hits as report rows (``holders``: a stored card-holder table)."""
    hits = city_hits(facts, hist, **options)
    return _report(with_holder(hits, bank if holders is None else holders), EVENT_CITY, as_of)


# --- R-4: guessing the amount -----------------------------------------------

AMOUNT_ORDER = ("trans_date", "trans_id", "amt", "oper_result", "terminal")
AMOUNT_LAGS = {
    "lag_time": ("trans_date", 3),
    "lag_result_1": ("oper_result", 1),
    "lag_result_2": ("oper_result", 2),
    "lag_result_3": ("oper_result", 3),
    "lag_amt_1": ("amt_value", 1),
    "lag_amt_2": ("amt_value", 2),
    "lag_amt_3": ("amt_value", 3),
}


def amount_sequence(facts: DataFrame, *, cross_batch: bool = False,
                    max_group_rows: int | None = DEFAULT_GROUP_ROWS, hot="auto") -> DataFrame:
    """Withdrawals and payments with the three previous results and amounts and
    the time three rows back, per card. Other operation types are removed
    before the window, so they do not break a run."""
    ops = (facts.filter(F.col("oper_type").isin(*AMOUNT_OPER_TYPES))
           .select("batch_date", "card_num", "trans_id", "trans_date", "oper_result", "amt",
                   "terminal", parse_amount("amt").alias("amt_value")))
    keys = _keys(cross_batch)
    hot = _hot(ops, keys, max_group_rows, hot)
    return lag_columns(ops, keys, AMOUNT_ORDER, AMOUNT_LAGS, hot=hot)


def amount_hits(facts: DataFrame, *, max_minutes: int = AMOUNT_MAX_MINUTES,
                cross_batch: bool = False,
                max_group_rows: int | None = DEFAULT_GROUP_ROWS, hot="auto") -> DataFrame:
    """SUCCESS after three REJECTs in a row on a card, amounts strictly falling,
    first to last less than ``max_minutes``. Every hit is kept."""
    seq = amount_sequence(facts, cross_batch=cross_batch, max_group_rows=max_group_rows, hot=hot)
    hit = ((F.col("oper_result") == RESULT_SUCCESS)
           & (F.col("lag_result_1") == RESULT_REJECT)
           & (F.col("lag_result_2") == RESULT_REJECT)
           & (F.col("lag_result_3") == RESULT_REJECT)
           & (F.col("lag_amt_3") > F.col("lag_amt_2"))
           & (F.col("lag_amt_2") > F.col("lag_amt_1"))
           & (F.col("lag_amt_1") > F.col("amt_value"))
           & within_minutes("lag_time", "trans_date", max_minutes))
    return seq.filter(hit).select("batch_date", "card_num", "trans_id",
                                  F.col("trans_date").alias("event_dt"))


def amount_cheat(bank: Bank, facts: DataFrame, as_of: dt.datetime, *,
                 holders: DataFrame | None = None, **options) -> DataFrame:
    """Amount rule hits as report rows (``holders``: a stored card-holder table)."""
    hits = amount_hits(facts, **options)
    return _report(with_holder(hits, bank if holders is None else holders), EVENT_AMOUNT, as_of)


def all_rules(bank: Bank, facts: DataFrame, blacklist: DataFrame, hist: DataFrame,
              batches: BatchSpec, as_of: dt.datetime, *, holders: DataFrame | None = None,
              account_batches: BatchSpec | None = None,
              passport_batches: BatchSpec | None = None,
              max_group_rows: int | None = DEFAULT_GROUP_ROWS, hot="auto",
              city_options: dict | None = None, amount_options: dict | None = None,
              passport_options: dict | None = None,
              account_options: dict | None = None) -> Sequence[DataFrame]:
    """All four rules as report parts: the two expiry rules together (their
    card holders joined to the facts in one pass, unless their options differ),
    then the two sequence rules together.

    The sequence rules share one hot-group pass over the batches' facts, and
    their hits are enriched together, so the card-holder side is filtered and
    read once. ``account_batches`` / ``passport_batches`` give the expiry
    rules other report dates than ``batches``. ``hot`` passes hot-group stats
    computed by the caller (``None``: no hot group)."""
    b = Batches.of(batches, facts.sparkSession, facts)
    dated = b.only(facts)
    city_opts = dict(city_options or {})
    amount_opts = dict(amount_options or {})
    city_opts.setdefault("max_group_rows", max_group_rows)
    amount_opts.setdefault("max_group_rows", max_group_rows)
    cross = city_opts.get("cross_batch", False)
    if (cross == amount_opts.get("cross_batch", False) and "hot" not in city_opts
            and "hot" not in amount_opts and max_group_rows):
        shared = (hot_groups(dated, _keys(cross), max_group_rows)
                  if hot == "auto" else hot)
        city_opts["hot"] = amount_opts["hot"] = shared
    hits = (city_hits(dated, hist, **city_opts).select(
                "batch_date", "card_num", "event_dt", F.lit(EVENT_CITY).alias("event_type"))
            .unionByName(amount_hits(dated, **amount_opts).select(
                "batch_date", "card_num", "event_dt", F.lit(EVENT_AMOUNT).alias("event_type"))))
    enriched = with_holder(hits, bank if holders is None else holders)
    sequence = enriched.select(
        "event_dt", F.col("passport_num").alias("passport"), "fio", "phone", "event_type",
        ts_lit(as_of).alias("report_dt"), "batch_date").select(*REPORT_COLUMNS)
    account_opts, passport_opts = dict(account_options or {}), dict(passport_options or {})
    if account_opts.get("require_event", False) == passport_opts.get("require_event", False):
        expiry = (expiry_rules(bank, facts, blacklist, account_batches or b,
                               passport_batches or b, as_of,
                               require_event=account_opts.get("require_event", False),
                               dedupe_blacklist=passport_opts.get("dedupe_blacklist", False)),)
    else:
        expiry = (account_cheat(bank, facts, account_batches or b, as_of, **account_opts),
                  passport_cheat(bank, facts, blacklist, passport_batches or b, as_of,
                                 **passport_opts))
    return (*expiry, sequence)
