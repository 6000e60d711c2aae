"""The expiry rules (operations on expired accounts, on expired or listed passports).

A holder row is one card of an account or client that has ended before the last report
date, or whose passport is listed on any day; no day is part of its key. The operations are
joined to it on the card alone, with ``ends < report_date`` of the operation's own batch as
the rest of the join's condition, so an account that ended before a backfill of a year is
one row and not 365. The days on which a passport is listed are a map on the holder's row
(at most one entry a day).

Rows without an operation (wanted unless ``require_event``) come from the holder's days less
the days of the card's operations, which are one set per card (again at most one entry a
day); only the rows of the result are made.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import date_lit, full_name, ts_lit
from vigil.operators.dims import Bank
from vigil.schemas import BATCHES, EVENT_ACCOUNT, EVENT_PASSPORT, NO_EXPIRY, REPORT_COLUMNS

#: a date, a (batch, report) pair, a list of either, a table (batch_date, report_date), or
#: None: every batch of the facts, judged on its own date
BatchSpec = (dt.date | tuple[dt.date, dt.date] | Iterable[dt.date | tuple[dt.date, dt.date]]
             | DataFrame | None)


def batch_list(batches: dt.date | tuple | Iterable) -> list[tuple[dt.date, dt.date]]:
    """Normalise to a sorted list of ``(batch_date, report_date)``.

    A single date is one batch judged on its own date; a 2-tuple of dates is
    one ``(batch_date, report_date)`` pair; several batches are given as a
    list (of dates or pairs)."""
    if isinstance(batches, dt.date):
        batches = [batches]
    elif isinstance(batches, tuple) and len(batches) == 2 and all(
            isinstance(x, dt.date) for x in batches):
        batches = [batches]
    out = set()
    for b in batches:
        out.add((b, b) if isinstance(b, dt.date) else (b[0], b[1]))
    if not out:
        raise ValueError("no batch given")
    return sorted(out)


@dataclass(frozen=True, eq=False)
class Batches:
    """Batches and the dates they are judged on: ``pairs`` (batch_date, report_date) as a
    table; ``known`` the same as a list, when the caller gave one; ``own`` when every batch
    of the facts is judged on its own date."""

    pairs: DataFrame
    known: list[tuple[dt.date, dt.date]] | None = None
    own: bool = False

    @classmethod
    def of(cls, spec: BatchSpec, spark: SparkSession, facts: DataFrame | None = None) -> "Batches":
        if isinstance(spec, Batches):
            return spec
        if spec is None:
            if facts is None:
                raise ValueError("batches, or facts to take them from, must be given")
            days = facts.select("batch_date").filter(F.col("batch_date").isNotNull()).distinct()
            return cls(days.select("batch_date", F.col("batch_date").alias("report_date")), own=True)
        if isinstance(spec, DataFrame):
            return cls(spec.select("batch_date", "report_date").distinct())
        known = batch_list(spec)
        return cls(spark.createDataFrame(known, BATCHES), known)

    def _scalar(self, value: Column) -> Column:
        return self.pairs.agg(value).scalar()

    def latest(self) -> Column:
        """The last report date."""
        if self.known:
            return date_lit(max(r for _, r in self.known))
        return self._scalar(F.max("report_date"))

    def days(self) -> Column:
        """All pairs as one array; its length is the number of days."""
        if self.known and len(self.known) == 1:
            (b, r), = self.known
            return F.array(F.struct(date_lit(b).alias("batch_date"), date_lit(r).alias("report_date")))
        return self._scalar(F.array_sort(F.collect_list(F.struct("batch_date", "report_date"))))

    def spread(self, rows: DataFrame, applies: Callable[[Column], Column]) -> DataFrame:
        """Every row once for each batch to which it ``applies`` (a condition on the pair),
        with ``batch_date`` and ``report_date``."""
        return (rows.withColumn("_days", self.days())
                .select("*", F.explode(F.filter("_days", applies)).alias("_day")).drop("_days")
                .select("*", "_day.batch_date", "_day.report_date").drop("_day"))

    def _small(self, pairs: DataFrame) -> DataFrame:
        # a list given by the caller is broadcast (16 bytes a day); a table's size decides
        return F.broadcast(pairs) if self.known else pairs

    def _pruned(self, facts: DataFrame) -> DataFrame:
        """The facts cut to the batches' range, which prunes partitions."""
        day = F.col("batch_date")
        if self.own:
            return facts.filter(day.isNotNull())
        if self.known:
            low, high = date_lit(self.known[0][0]), date_lit(self.known[-1][0])
        else:
            low, high = self._scalar(F.min("batch_date")), self._scalar(F.max("batch_date"))
        return facts.filter((day >= low) & (day <= high))

    def only(self, facts: DataFrame) -> DataFrame:
        """The facts of these batches."""
        facts = self._pruned(facts)
        if self.own or (self.known and len({b for b, _ in self.known}) == 1):
            return facts
        return facts.join(self._small(self.pairs.select("batch_date").distinct()), "batch_date",
                          "left_semi")

    def dated(self, facts: DataFrame, name: str = "report_date") -> DataFrame:
        """The facts of these batches with the date they are judged on."""
        if self.own:
            return self._pruned(facts).withColumn(name, F.col("batch_date"))
        if self.known and len(self.known) == 1:
            return self._pruned(facts).withColumn(name, date_lit(self.known[0][1]))
        return self._pruned(facts).join(
            self._small(self.pairs.withColumnRenamed("report_date", name)), "batch_date")


# --- holders -----------------------------------------------------------------------------

_HOLDER = ("card_num", "passport_num", "phone", "fio", "ends", "listed")
_CLIENT = ("client_id", "last_name", "first_name", "patronymic", "passport_num", "phone")
_NO_LIST = "CAST(NULL AS MAP<DATE, BIGINT>)"


def _ended_accounts(bank: Bank, b: Batches) -> DataFrame:
    """Accounts that end before the last report date, with their client. The cut reaches
    the scan; a null end never expires."""
    accounts = (bank.accounts.filter(F.col("valid_to") < b.latest())
                .select("account_num", F.col("valid_to").alias("ends"),
                        F.col("client").alias("client_id")))
    return accounts.join(bank.clients.select(*_CLIENT), "client_id", "left")


def expired_accounts(bank: Bank, batches: BatchSpec, facts: DataFrame | None = None) -> DataFrame:
    """Accounts ending before the report date of each batch, with their client: one row
    per batch and account."""
    b = Batches.of(batches, bank.accounts.sparkSession, facts)
    rows = b.spread(_ended_accounts(bank, b), lambda d: F.col("ends") < d["report_date"])
    return rows.select("batch_date", "account_num", "last_name", "first_name", "patronymic",
                       "passport_num", "phone")


def account_holders(bank: Bank, b: Batches, require_event: bool) -> DataFrame:
    """Cards of ended accounts (a null card for an account without cards)."""
    cards = bank.cards.select("card_num", "account_num")
    return (_ended_accounts(bank, b)
            .join(cards, "account_num", "inner" if require_event else "left")
            .withColumn("fio", full_name("last_name", "first_name", "patronymic"))
            .withColumn("listed", F.expr(_NO_LIST)).select(*_HOLDER))


def listed_days(blacklist: DataFrame, b: Batches) -> DataFrame:
    """passport_num, listed (batch date -> number of entries) of the batches' blacklists."""
    by_day = (b.only(blacklist).filter(F.col("passport_num").isNotNull())
              .groupBy("passport_num", "batch_date").agg(F.count(F.lit(1)).alias("n")))
    return by_day.groupBy("passport_num").agg(
        F.map_from_entries(F.collect_list(F.struct("batch_date", "n"))).alias("listed"))


def _flagged(bank: Bank, blacklist: DataFrame, b: Batches) -> DataFrame:
    """Clients whose passport ends before the last report date (null = never) or is on a
    blacklist of the batches."""
    clients = bank.clients.select(
        *_CLIENT, F.coalesce("passport_valid_to", date_lit(NO_EXPIRY)).alias("ends"))
    return (clients.join(listed_days(blacklist, b), "passport_num", "left")
            .filter((F.col("ends") < b.latest()) | F.col("listed").isNotNull()))


def _is_listed(batch_date: Column) -> Column:
    return F.coalesce(F.map_contains_key("listed", batch_date), F.lit(False))


def flagged_clients(bank: Bank, blacklist: DataFrame, batches: BatchSpec,
                    facts: DataFrame | None = None) -> DataFrame:
    """Clients whose passport ended before the report date or is on the batch's blacklist;
    one row per client and batch, with the number of blacklist entries of the passport in
    ``_listed`` (null when not listed)."""
    b = Batches.of(batches, bank.clients.sparkSession, facts)
    rows = b.spread(_flagged(bank, blacklist, b),
                    lambda d: (F.col("ends") < d["report_date"]) | _is_listed(d["batch_date"]))
    return rows.select("batch_date", *_CLIENT,
                       F.try_element_at("listed", F.col("batch_date")).alias("_listed"))


def passport_holders(bank: Bank, blacklist: DataFrame, b: Batches,
                     require_event: bool) -> DataFrame:
    """Cards of flagged clients (a null card for a client without cards)."""
    accounts = bank.accounts.select("account_num", F.col("client").alias("client_id"))
    cards = bank.cards.select("card_num", "account_num")
    how = "inner" if require_event else "left"
    return (_flagged(bank, blacklist, b)
            .withColumn("fio", full_name("last_name", "first_name", "patronymic"))
            .join(accounts, "client_id", how).join(cards, "account_num", how).select(*_HOLDER))


# --- the threshold join ----------------------------------------------------------------------

_RESULT = ("event_dt", "passport_num", "phone", "fio", "listed", "batch_date")


def _operations(holders: DataFrame, tx: DataFrame, report_date: Column) -> DataFrame:
    """Every operation on a holder's card on which the holder is expired or listed. The
    join is on the card alone; the rest of the condition is judged in the join."""
    tx = tx.withColumnRenamed("card_num", "_card")
    judged = (F.col("ends") < report_date) | _is_listed(F.col("batch_date"))
    return holders.join(tx, (F.col("card_num") == F.col("_card")) & judged, "inner").drop("_card")


def _idle(holders: DataFrame, tx: DataFrame, b: Batches) -> DataFrame:
    """A row without an event for every batch on which a holder is expired or listed and
    its card has no operation."""
    seen = (tx.filter(F.col("card_num").isNotNull()).groupBy("card_num")
            .agg(F.collect_set("batch_date").alias("_seen")))
    here = holders.join(seen, "card_num", "left")
    rows = b.spread(here, lambda d: (
        ((F.col("ends") < d["report_date"]) | _is_listed(d["batch_date"]))
        & ~F.coalesce(F.array_contains("_seen", d["batch_date"]), F.lit(False))))
    return rows.withColumn("event_dt", F.lit(None).cast("timestamp_ntz"))


def _copies(rows: DataFrame) -> DataFrame:
    """A row once per blacklist entry of its passport on its day."""
    n = F.coalesce(F.try_element_at("listed", F.col("batch_date")), F.lit(1))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), n.cast("int")))).drop("_copy")


def _report(rows: DataFrame, as_of: dt.datetime, repeat_listed: bool) -> DataFrame:
    rows = _copies(rows) if repeat_listed else rows
    return rows.select(
        F.col("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone", "event_type",
        ts_lit(as_of).alias("report_dt"), "batch_date").select(*REPORT_COLUMNS)


def _one_rule(holders: DataFrame, facts: DataFrame, b: Batches, event_type: str,
              require_event: bool) -> DataFrame:
    tx = b.dated(facts).select("card_num", "batch_date", "report_date",
                               F.col("trans_date").alias("event_dt"))
    rows = _operations(holders, tx, F.col("report_date")).select(*_RESULT)
    if not require_event:
        rows = rows.unionByName(_idle(holders, b.only(facts), b).select(*_RESULT))
    return rows.withColumn("event_type", F.lit(event_type))


def account_cheat(bank: Bank, facts: DataFrame, batches: BatchSpec,
                  as_of: dt.datetime, *, require_event: bool = False) -> DataFrame:
    """One row per transaction of the batch on any card of an expired account;
    a row with null ``event_dt`` for each such card without one (and for an
    account without cards) unless ``require_event``."""
    b = Batches.of(batches, facts.sparkSession, facts)
    holders = account_holders(bank, b, require_event)
    return _report(_one_rule(holders, facts, b, EVENT_ACCOUNT, require_event), as_of, False)


def passport_cheat(bank: Bank, facts: DataFrame, blacklist: DataFrame, batches: BatchSpec,
                   as_of: dt.datetime, *, dedupe_blacklist: bool = False,
                   require_event: bool = False) -> DataFrame:
    """One row per transaction on any card of a flagged client, null-event rows
    as in ``account_cheat`` (none with ``require_event``); rows are repeated
    once per blacklist entry of the passport unless ``dedupe_blacklist``."""
    b = Batches.of(batches, facts.sparkSession, facts)
    holders = passport_holders(bank, blacklist, b, require_event)
    return _report(_one_rule(holders, facts, b, EVENT_PASSPORT, require_event), as_of,
                   not dedupe_blacklist)


def expiry_rules(bank: Bank, facts: DataFrame, blacklist: DataFrame,
                 account_batches: BatchSpec, passport_batches: BatchSpec,
                 as_of: dt.datetime, *, require_event: bool = False,
                 dedupe_blacklist: bool = False) -> DataFrame:
    """Account and passport rules together: their card holders are united and joined to
    the facts once (one fact shuffle for both rules). The rules must share their batches;
    their report dates may differ."""
    spark = facts.sparkSession
    ab, pb = (Batches.of(x, spark, facts) for x in (account_batches, passport_batches))
    alike = (ab.own and pb.own) or ab is pb or account_batches is passport_batches or (
        ab.known is not None and ab.known == pb.known)
    one_day = all(b.known and len(b.known) == 1 for b in (ab, pb)) and (
        ab.known[0][0] == pb.known[0][0])
    if not (alike or one_day):
        return account_cheat(bank, facts, ab, as_of, require_event=require_event).unionByName(
            passport_cheat(bank, facts, blacklist, pb, as_of, require_event=require_event,
                           dedupe_blacklist=dedupe_blacklist))
    tx = ab.dated(facts, "_account_date")
    is_account = F.col("event_type") == EVENT_ACCOUNT
    passport_date = F.col("_account_date") if alike else date_lit(pb.known[0][1])
    report_date = F.when(is_account, F.col("_account_date")).otherwise(passport_date)
    holders = [account_holders(bank, ab, require_event).withColumn("event_type", F.lit(EVENT_ACCOUNT)),
               passport_holders(bank, blacklist, pb, require_event)
               .withColumn("event_type", F.lit(EVENT_PASSPORT))]
    tx = tx.select("card_num", "batch_date", "_account_date", F.col("trans_date").alias("event_dt"))
    columns = (*_RESULT, "event_type")
    rows = _operations(holders[0].unionByName(holders[1]), tx, report_date).select(*columns)
    if not require_event:
        for own, b in zip(holders, (ab, pb)):
            rows = rows.unionByName(_idle(own, ab.only(facts), b).select(*columns))
    return _report(rows, as_of, not dedupe_blacklist)
