"""Query catalog: one DataFrame-returning callable per operator key.

Every entry reads the driver tables at ``sf_dir`` through the bindings and
runs the library operator over all of their rows. Keys and output columns
match ``vigil.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import minutes_between, parse_amount
from vigil.operators import backfill, daycities, dims, history, quality, report, rules
from vigil.operators.seqlag import lag_columns
from vigil.operators.committed import CommittedDays
from vigil.plans import bindings as b
from vigil.plans import daily
from vigil.schemas import FACT_TRANSACTIONS, REPORT
from vigil.session import scratch_dir, written
from vigil.sources import delimited, files
from vigil.streaming import ingest, sequence

Query = Callable[[SparkSession, str], DataFrame]


def _single(rule_date) -> list:
    return [(b.BATCH_DATE, rule_date)]


# --- dimensions and facts -----------------------------------------------------

def q_dim_clients(spark, d):
    return dims.dim_clients(b.seed_clients(spark, d))


def q_dim_accounts(spark, d):
    return dims.dim_accounts(b.seed_accounts(spark, d))


def q_dim_cards(spark, d):
    return dims.dim_cards(b.seed_cards(spark, d))


def q_fact_transactions(spark, d):
    return dims.fact_transactions(b.staged_transactions(spark, d), b.BATCH_DATE)


def q_fact_blacklist(spark, d):
    return dims.fact_blacklist(b.staged_blacklist(spark, d), b.BATCH_DATE)


def q_card_holders(spark, d):
    return dims.card_holders(b.bank(spark, d))


# --- scalar functions ------------------------------------------------------------

def q_parse_amount(spark, d):
    tx = b.facts(spark, d)
    amt = F.when(F.col("trans_id").cast("long") % 10 == 0, F.lit("abc")).otherwise(F.col("amt"))
    return tx.select("trans_id", amt.alias("amt")).select(
        "trans_id", "amt", parse_amount("amt").alias("amt_value"))


def q_minutes_between(spark, d):
    tx = b.facts(spark, d).select("batch_date", "card_num", "trans_id", "trans_date")
    lagged = lag_columns(tx, ["batch_date", "card_num"], ["trans_date", "trans_id"],
                         {"lag_time": ("trans_date", 1)})
    return lagged.select("batch_date", "card_num", "trans_id", "trans_date", "lag_time",
                         minutes_between("lag_time", "trans_date").alias("gap_minutes"))


# --- expiry rules ---------------------------------------------------------------

def q_accounts_expired(spark, d):
    return rules.expired_accounts(b.bank(spark, d), _single(b.ACCOUNT_RULE_DATE))


def q_clients_bad_passport(spark, d):
    flagged = rules.flagged_clients(b.bank(spark, d), b.blacklist(spark, d),
                                    _single(b.PASSPORT_RULE_DATE))
    return flagged.select("batch_date", "client_id", "last_name", "first_name", "patronymic",
                          "passport_num", "phone")


def q_rule_account(spark, d):
    return rules.account_cheat(b.bank(spark, d), b.facts(spark, d), _single(b.ACCOUNT_RULE_DATE),
                               b.REPORT_AS_OF)


def q_rule_account_daily(spark, d):
    """Every day of the facts is a batch judged on its own date, operations only."""
    facts = b.facts(spark, d, per_day=True)
    return rules.account_cheat(b.bank(spark, d), facts, None, b.REPORT_AS_OF, require_event=True)


def q_rule_passport_daily(spark, d):
    """Every day of the facts judged on its own date against the day's own blacklist, with
    a row for each flagged card that has no operation on a day."""
    return rules.passport_cheat(b.bank(spark, d), b.facts(spark, d, per_day=True),
                                b.blacklist_daily(spark, d), None, b.REPORT_AS_OF)


def q_report_daily(spark, d):
    """All four rules over every day of the facts as its own batch (report
    date = batch date, the day's own blacklist), operations only for the
    expiry rules -- the daily job's rule step for a month of batches."""
    facts = b.facts(spark, d, per_day=True)
    return report.fraud_report(rules.all_rules(
        b.bank(spark, d), facts, b.blacklist_daily(spark, d), b.hist1(spark, d),
        None, b.REPORT_AS_OF,
        account_options={"require_event": True}, passport_options={"require_event": True},
        city_options={"max_minutes": b.CITY_MINUTES},
        amount_options={"max_minutes": b.AMOUNT_MINUTES}))


def q_rule_passport(spark, d):
    return rules.passport_cheat(b.bank(spark, d), b.facts(spark, d), b.blacklist(spark, d),
                                _single(b.PASSPORT_RULE_DATE), b.REPORT_AS_OF)


# --- data quality ------------------------------------------------------------------

def q_dq_duplicate_keys(spark, d):
    bank = b.bank(spark, d)
    return quality.union_checks([
        quality.duplicate_keys(bank.clients, "client_id", "dim_clients"),
        quality.duplicate_keys(bank.accounts, "account_num", "dim_accounts"),
        quality.duplicate_keys(bank.cards, "card_num", "dim_cards"),
        quality.duplicate_keys(b.blacklist(spark, d), "passport_num", "fact_blacklist"),
    ])


def q_dq_orphans(spark, d):
    bank = b.bank(spark, d)
    tx = b.facts(spark, d)
    terminals = history.current_terminals(b.hist1(spark, d), b.HIST1_AS_OF)
    return quality.union_checks([
        quality.orphans(bank.cards, "account_num", bank.accounts, "account_num", "cards.account_num"),
        quality.orphans(bank.accounts, "client", bank.clients, "client_id", "accounts.client"),
        quality.orphans(tx, "card_num", bank.cards, "card_num", "transactions.card_num"),
        quality.orphans(tx, "terminal", terminals, "terminal_id", "transactions.terminal"),
    ])


# --- city rule -------------------------------------------------------------------

def q_cards_city_count(spark, d):
    return rules.cards_city_count(b.facts(spark, d), b.hist1(spark, d))


def q_cards_multi_city(spark, d):
    return rules.cards_multi_city(b.facts(spark, d, per_day=True), b.hist0(spark, d))


def q_cards_city_rolling(spark, d):
    """Distinct cities of each card over seven days, merged from rows of single days that
    were written and read back; the cities are numbered in two steps."""
    hist = b.hist1(spark, d)
    numbers = daycities.city_numbers(hist, written(daycities.city_numbers(b.hist0(spark, d))))
    rows = daycities.day_cities(b.facts(spark, d, per_day=True), hist, written(numbers))
    return daycities.cities_rolling(written(rows), days=7)


def q_lag_city(spark, d):
    seq = rules.city_sequence(b.facts(spark, d), b.hist0(spark, d))
    return seq.select("batch_date", "card_num", "trans_id", "trans_date", "oper_result",
                      "terminal_city", "lag_city", "lag_time")


def q_lag_amount(spark, d):
    seq = rules.amount_sequence(b.facts(spark, d))
    return seq.select("batch_date", "card_num", "trans_id", "trans_date", "oper_result",
                      "amt_value", *rules.AMOUNT_LAGS.keys())


def q_rule_city_hits(spark, d):
    return rules.city_hits(b.facts(spark, d), b.hist1(spark, d), max_minutes=b.CITY_MINUTES)


def q_rule_city(spark, d):
    return rules.city_cheat(b.bank(spark, d), b.facts(spark, d), b.hist1(spark, d),
                            b.REPORT_AS_OF, max_minutes=b.CITY_MINUTES)


def q_rule_city_asof(spark, d):
    return rules.city_cheat(b.bank(spark, d), b.facts(spark, d), b.hist1(spark, d),
                            b.REPORT_AS_OF, max_minutes=b.CITY_MINUTES, terminal_match="as_of")


def q_rule_city_daily(spark, d):
    return rules.city_cheat(b.bank(spark, d), b.facts(spark, d, per_day=True), b.hist0(spark, d),
                            b.REPORT_AS_OF, max_minutes=b.CITY_MINUTES)


# --- amount rule -----------------------------------------------------------------

def q_rule_amount(spark, d):
    return rules.amount_cheat(b.bank(spark, d), b.facts(spark, d), b.REPORT_AS_OF,
                              max_minutes=b.AMOUNT_MINUTES)


# --- report ------------------------------------------------------------------------

def q_report_all(spark, d):
    return report.fraud_report(rules.all_rules(
        b.bank(spark, d), b.facts(spark, d), b.blacklist(spark, d), b.hist1(spark, d),
        b.BATCH_DATE, b.REPORT_AS_OF,
        account_batches=_single(b.ACCOUNT_RULE_DATE),
        passport_batches=_single(b.PASSPORT_RULE_DATE),
        city_options={"max_minutes": b.CITY_MINUTES},
        amount_options={"max_minutes": b.AMOUNT_MINUTES}))


# --- terminal history ------------------------------------------------------------

def q_scd2_current(spark, d):
    return history.current_terminals(b.hist1(spark, d), b.HIST1_AS_OF)


def _current0(spark, d):
    return history.current_terminals(b.hist0(spark, d), b.HIST1_AS_OF)


def q_scd2_new(spark, d):
    return history.new_terminals(b.terminals_second(spark, d), _current0(spark, d))


def q_scd2_deleted(spark, d):
    return history.deleted_terminals(_current0(spark, d), b.terminals_second(spark, d))


def q_scd2_changed(spark, d):
    return history.changed_terminals(_current0(spark, d), b.terminals_second(spark, d))


def q_scd2_apply(spark, d):
    return b.hist1(spark, d).drop("id")


def q_scd2_apply_twice(spark, d):
    return b.hist2(spark, d).drop("id")


def q_scd2_backfill(spark, d):
    """Eight days of snapshots folded into the first load's history in one job."""
    return backfill.apply_snapshots(b.hist0(spark, d), b.terminal_snapshots(spark, d),
                                    b.BACKFILL_LOADS).drop("id", "_open")


# --- sources -----------------------------------------------------------------------

def q_ingest_delimited(spark, d):
    """Round trip: the transactions feed written as ``;`` text with a decimal
    comma into the shared scratch folder, read back and typed."""
    path = scratch_dir(spark, "ingest")
    written = delimited.write_transactions(b.staged_transactions(spark, d), path, b.BATCH_DATE)
    staged = delimited.read_transactions(spark, written)
    return dims.fact_transactions(staged)


def q_stream_ingest(spark, d):
    """The transactions feed written as a daily file, taken by a file stream
    (``availableNow``, checkpointed) into a partitioned fact table, read back."""
    landing, table = scratch_dir(spark, "landing"), scratch_dir(spark, "facts")
    feed = delimited.write_transactions(b.staged_transactions(spark, d), landing, b.BATCH_DATE)
    ingest.ingest_transactions(spark, feed, table, scratch_dir(spark, "stream-ckpt"),
                               name_glob=None)
    return ingest.read_ingested(spark, table)


def q_stream_rule_amount(spark, d):
    """The amount rule as a stateful stream over the days' facts, written as files and taken
    some at a time; a closing row far ahead of them lets the last day be judged."""
    landing, out = scratch_dir(spark, "fact-files"), scratch_dir(spark, "sequence")
    facts = b.facts(spark, d, per_day=True)
    facts.repartitionByRange("batch_date").write.parquet(landing)
    closing = spark.createDataFrame([("", b.STREAM_END, "", "", "PAYMENT", "", "",
                                      b.STREAM_END.date())], FACT_TRANSACTIONS)
    closing.write.mode("append").parquet(landing)
    stream = (spark.readStream.schema(FACT_TRANSACTIONS).option("maxFilesPerTrigger", 16)
              .parquet(landing))
    hits = sequence.amount_stream(stream, max_minutes=b.AMOUNT_MINUTES, delay="60 days")
    sequence.write_sequence(hits, f"{out}/hits", f"{out}/side", f"{out}/checkpoint")
    return sequence.read_sequence(spark, f"{out}/hits").drop("kind")


# --- sinks -------------------------------------------------------------------------

def q_warehouse_holders(spark, d):
    """The dimensions and the card holders as the daily job writes them, read back."""
    wh = daily.Warehouse(scratch_dir(spark, "warehouse"))
    daily.load_dims(b.seed_clients(spark, d), b.seed_accounts(spark, d), b.seed_cards(spark, d), wh)
    return spark.read.parquet(wh.card_holders)


def q_warehouse_facts(spark, d):
    """Facts partitioned by day; odd days are written twice, the first time with other
    amounts, and only the second write stays."""
    path = scratch_dir(spark, "fact-table")
    facts = b.facts(spark, d, per_day=True)
    report.write_report(facts.withColumn("amt", F.lit("0,0")), path)
    report.write_report(facts.filter(F.dayofmonth("batch_date") % 2 == 1), path)
    report.write_report(facts.filter(F.dayofmonth("batch_date") % 2 == 0), path)
    return spark.read.schema(FACT_TRANSACTIONS).parquet(path)


def q_warehouse_report(spark, d):
    """The report of every day as a committed table: a first run with the amount rule alone,
    then a run of all rules that replaces every day in one step."""
    table = CommittedDays(spark, scratch_dir(spark, "report"), REPORT)
    facts = b.facts(spark, d, per_day=True)
    days = [r.batch_date for r in facts.select("batch_date").distinct().collect()]
    table.write(rules.amount_cheat(b.bank(spark, d), facts, b.REPORT_AS_OF,
                                   max_minutes=b.AMOUNT_MINUTES), days)
    table.write(q_report_daily(spark, d), days)
    table.vacuum()
    return table.read()


def q_warehouse_history(spark, d):
    """Eight snapshot files loaded into a warehouse in two runs, five days and three."""
    wh, landing = daily.Warehouse(scratch_dir(spark, "warehouse")), scratch_dir(spark, "landing")
    at = {d: t for d, t in b.BACKFILL_LOADS}
    for day in at:
        (b.terminal_snapshots(spark, d).filter(F.col("batch_date") == F.lit(day)).drop("batch_date")
         .write.parquet(f"{landing}/terminals_{day.strftime('%d%m%Y')}.parquet"))
    days = sorted(at)
    for run in (days[:5], days[5:]):
        daily.load_history(spark, landing, wh, run, at.__getitem__)
    return daily.read_history(spark, wh).drop("id")


def q_batch_date(spark, d):
    return files.feed_files(b.feed_file_names(spark, d))


def q_complete_batches(spark, d):
    return files.complete_batches(files.feed_files(b.feed_file_names(spark, d)))


def q_next_batch(spark, d):
    return files.next_batch(files.complete_batches(files.feed_files(b.feed_file_names(spark, d))))


QUERIES: dict[str, Query] = {
    "dim_clients": q_dim_clients,
    "dim_accounts": q_dim_accounts,
    "dim_cards": q_dim_cards,
    "fact_transactions": q_fact_transactions,
    "fact_blacklist": q_fact_blacklist,
    "card_holders": q_card_holders,
    "parse_amount": q_parse_amount,
    "minutes_between": q_minutes_between,
    "accounts_expired": q_accounts_expired,
    "clients_bad_passport": q_clients_bad_passport,
    "rule_account": q_rule_account,
    "rule_passport": q_rule_passport,
    "rule_account_daily": q_rule_account_daily,
    "rule_passport_daily": q_rule_passport_daily,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_orphans": q_dq_orphans,
    "cards_city_count": q_cards_city_count,
    "cards_multi_city": q_cards_multi_city,
    "cards_city_rolling": q_cards_city_rolling,
    "lag_city": q_lag_city,
    "lag_amount": q_lag_amount,
    "rule_city_hits": q_rule_city_hits,
    "rule_city": q_rule_city,
    "rule_city_asof": q_rule_city_asof,
    "rule_city_daily": q_rule_city_daily,
    "rule_amount": q_rule_amount,
    "report_all": q_report_all,
    "report_daily": q_report_daily,
    "scd2_current": q_scd2_current,
    "scd2_new": q_scd2_new,
    "scd2_deleted": q_scd2_deleted,
    "scd2_changed": q_scd2_changed,
    "scd2_apply": q_scd2_apply,
    "scd2_apply_twice": q_scd2_apply_twice,
    "scd2_backfill": q_scd2_backfill,
    "ingest_delimited": q_ingest_delimited,
    "stream_ingest": q_stream_ingest,
    "stream_rule_amount": q_stream_rule_amount,
    "warehouse_holders": q_warehouse_holders,
    "warehouse_facts": q_warehouse_facts,
    "warehouse_report": q_warehouse_report,
    "warehouse_history": q_warehouse_history,
    "batch_date": q_batch_date,
    "complete_batches": q_complete_batches,
    "next_batch": q_next_batch,
}
