"""Driver tables -> bank-shaped inputs (test and benchmark support).

The driver ships TPC-H-like tables and an ``events`` table, not bank feeds.
These functions shape them into the seed dimensions and daily feeds the
operators read, with the same expressions as the SQL oracle
(``vigil.plans.oracle``). The modulo expressions below shape the data model
(which orders are accounts, which rows get a null, which customers are
listed); none of them subsets a table to make a check cheaper.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import date_lit
from vigil.operators.dims import Bank, build_bank, fact_blacklist, fact_transactions
from vigil.operators.history import apply_snapshot, history_from_snapshot

# Fixture parameters (fixed values shared with the SQL oracle)
BATCH_DATE = dt.date(2024, 1, 31)          # the single batch of single-batch keys
REPORT_AS_OF = dt.datetime(2024, 1, 31, 6, 0, 0)
ACCOUNT_RULE_DATE = dt.date(1996, 3, 1)
PASSPORT_RULE_DATE = dt.date(1998, 1, 10)
HIST0_AS_OF = dt.datetime(2024, 1, 1, 0, 0, 0)
HIST1_AS_OF = dt.datetime(2024, 1, 16, 0, 0, 0)
HIST2_AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
STREAM_END = dt.datetime(2030, 1, 1)       # the closing row of the stream key
CITY_MINUTES = 60
AMOUNT_MINUTES = 14400
SEED_CREATE_DT = dt.date(1900, 1, 1)
BIRTH_BASE = dt.date(1950, 1, 1)
PASSPORT_END_BASE = dt.date(1998, 1, 1)
BLACKLIST_DATE_BASE = dt.date(2023, 12, 1)


# Columns of the driver tables that the bindings read (explicit schemas: no
# inference pass over the files, and only these columns are read).
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The projections below are SQL expression strings (one gateway call per
# projection instead of one per column function); they read as the binding
# table of FIXTURES.md.

def seed_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").selectExpr(
        "CAST(c_custkey AS STRING) AS client_id",
        "c_name AS last_name",
        "CASE WHEN c_custkey % 97 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS first_name",
        "n_name AS patronymic",
        f"date_add(DATE'{BIRTH_BASE}', CAST(c_custkey % 15000 AS INT)) AS date_of_birth",
        "'P' || CAST(c_custkey AS STRING) AS passport_num",
        "CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS DATE) "
        f"ELSE date_add(DATE'{PASSPORT_END_BASE}', CAST(c_custkey % 120 AS INT)) END AS passport_valid_to",
        "'+7 ' || CAST(c_custkey AS STRING) AS phone",
        f"DATE'{SEED_CREATE_DT}' AS create_dt",
        "CAST(NULL AS DATE) AS update_dt")


def seed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").selectExpr(
        "CAST(o_orderkey AS STRING) AS account",
        "to_date(o_orderdate) AS valid_to",
        "CAST(o_custkey AS STRING) AS client",
        f"DATE'{SEED_CREATE_DT}' AS create_dt",
        "CAST(NULL AS DATE) AS update_dt")


def seed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS card_num",
        "CAST(o_orderkey - o_orderkey % 2 AS STRING) AS account",
        f"DATE'{SEED_CREATE_DT}' AS create_dt",
        "CAST(NULL AS DATE) AS update_dt")


def bank(spark: SparkSession, sf_dir: str) -> Bank:
    return build_bank(seed_clients(spark, sf_dir), seed_accounts(spark, sf_dir),
                      seed_cards(spark, sf_dir))


# --- daily feeds ---------------------------------------------------------------

def staged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions feed shape: text amount with a decimal comma."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS transaction_id",
        "ts AS transaction_date",
        "replace(CAST(CAST(value AS DECIMAL(12,2)) AS STRING), '.', ',') AS amount",
        "CAST(user_id AS STRING) AS card_num",
        "CASE WHEN event_type = 'click' THEN 'WITHDRAW' "
        "WHEN event_type IN ('purchase', 'view') THEN 'PAYMENT' ELSE 'DEPOSIT' END AS oper_type",
        "CASE WHEN event_id % 4 = 0 THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result",
        "CAST(event_id % 100 AS STRING) AS terminal")


def facts(spark: SparkSession, sf_dir: str, per_day: bool = False) -> DataFrame:
    """Fact transactions: one batch (``BATCH_DATE``), or one batch per day."""
    staged = staged_transactions(spark, sf_dir)
    batch = F.to_date("transaction_date") if per_day else date_lit(BATCH_DATE)
    return fact_transactions(staged, batch)


def staged_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")

    def listed(step: int) -> DataFrame:
        return c.where(f"c_custkey % {step} = 0").selectExpr(
            "'P' || CAST(c_custkey AS STRING) AS passport",
            f"date_add(DATE'{BLACKLIST_DATE_BASE}', CAST(c_custkey % 30 AS INT)) AS date")
    # customers divisible by 100 are listed twice on purpose
    return listed(50).unionByName(listed(100))


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_blacklist(staged_blacklist(spark, sf_dir), BATCH_DATE)


def terminals_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").selectExpr(
        "CAST(s_suppkey AS STRING) AS terminal_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type",
        "n_name AS terminal_city",
        "s_name AS terminal_address")


def terminals_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot: ids ending in 3 gone, ids ending in 5 moved to their
    region's name, a new terminal for every id ending in 7."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
              .join(r, n.n_regionkey == r.r_regionkey, "inner"))
    kept = joined.where("s_suppkey % 10 <> 3").selectExpr(
        "CAST(s_suppkey AS STRING) AS terminal_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type",
        "CASE WHEN s_suppkey % 10 = 5 THEN r_name ELSE n_name END AS terminal_city",
        "s_name AS terminal_address")
    added = s.where("s_suppkey % 10 = 7").selectExpr(
        "CAST(s_suppkey + 100000 AS STRING) AS terminal_id",
        "'POS' AS terminal_type",
        "'NEWCITY' AS terminal_city",
        "s_name AS terminal_address")
    return kept.unionByName(added)


#: the loads of the backfill key: eight days, one load each
BACKFILL_LOADS = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),
                   dt.datetime(2024, 1, 1, 5, 0, 0) + dt.timedelta(days=i)) for i in range(1, 9)]


def terminal_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily snapshots that differ from day to day: terminals leave and return, move between
    nation and region, lose and regain their address, and some ids come twice."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
              .join(r, n.n_regionkey == r.r_regionkey, "inner"))
    days = [joined.where(f"(s_suppkey + 3 * {i}) % 11 <> 0").selectExpr(
        f"DATE'{d}' AS batch_date", "s_suppkey",
        "CAST(s_suppkey AS STRING) AS terminal_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type",
        f"CASE WHEN (s_suppkey + {i}) % 5 < 2 THEN r_name ELSE n_name END AS terminal_city",
        f"CASE WHEN (s_suppkey + {i}) % 13 = 0 THEN CAST(NULL AS STRING) ELSE s_name END "
        "AS terminal_address") for i, (d, _) in enumerate(BACKFILL_LOADS, 1)]
    whole = days[0]
    for day in days[1:]:
        whole = whole.unionByName(day)
    twice = whole.where("s_suppkey % 10 = 7 AND dayofmonth(batch_date) % 3 = 0").withColumn(
        "terminal_city", F.lit("NEWCITY"))
    return whole.unionByName(twice).drop("s_suppkey")


def hist0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_from_snapshot(terminals_first(spark, sf_dir), HIST0_AS_OF)


def hist1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_snapshot(hist0(spark, sf_dir), terminals_second(spark, sf_dir), HIST1_AS_OF)


def feed_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of the daily feeds for every day in ``events``; the terminal
    snapshot is missing on days divisible by 5 (incomplete batches)."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    stamp = F.date_format("d", "ddMMyyyy")
    tx = days.select(F.concat(F.lit("transactions_"), stamp, F.lit(".txt")).alias("file_name"))
    bl = days.select(F.concat(F.lit("passport_blacklist_"), stamp, F.lit(".xlsx")).alias("file_name"))
    te = (days.filter(F.dayofmonth("d") % 5 != 0)
          .select(F.concat(F.lit("terminals_"), stamp, F.lit(".xlsx")).alias("file_name")))
    return tx.unionByName(bl).unionByName(te)


def hist2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third load: the first snapshot again (deleted terminals return, moved
    ones move back, the added ones disappear)."""
    return apply_snapshot(hist1(spark, sf_dir), terminals_first(spark, sf_dir), HIST2_AS_OF)


def blacklist_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blacklist entries delivered one day each: the batch is the entry date
    plus 31 days (a day of the events); repeated entries share their day."""
    staged = staged_blacklist(spark, sf_dir)
    return fact_blacklist(staged, F.date_add(F.col("date"), 31))
