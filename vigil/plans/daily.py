"""The daily fraud job.

One run handles every complete batch waiting in a landing folder:

1. dimensions are rebuilt from the seed tables (their own step), with the
   card-holder table (card -> account -> client) joined once per run;
2. transactions and blacklists of all pending days are read in one pass each
   and written partitioned by ``batch_date`` with dynamic partition overwrite,
   so a day that is loaded again replaces itself;
3. the terminal snapshots of all pending days are folded into the history in one
   job. Every result is a new version directory with the rows it closed and all
   open rows; a load never writes over the table it reads;
4. key violations (duplicate keys, orphans) are written to a table;
5. the four rules run over all pending days in one job, each day seeing only
   the history versions its own load had produced, and the report's days become
   visible together (``committed``).

All paths are in a shared warehouse folder; nothing depends on a local disk.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark import StorageLevel
from pyspark.sql import functions as F

from vigil.operators import backfill, dims, history, quality, report, rules
from vigil.operators.committed import CommittedDays
from vigil.operators.seqlag import hot_groups
from vigil.schemas import (
    DQ_VIOLATIONS,
    FACT_BLACKLIST,
    FACT_TRANSACTIONS,
    FEED_BLACKLIST,
    FEED_EXTENSIONS,
    FEED_TERMINALS,
    FEED_TRANSACTIONS,
    OPEN_END,
    REPORT,
    TABLE_EXTENSIONS,
    TERMINALS_HIST,
)
from vigil.sources import delimited, files, workbook

_VERSION_PREFIX = "v="
HISTORY_LOADS = "version int, batch_date date, load_time timestamp_ntz"


@dataclass(frozen=True)
class Warehouse:
    """Table locations under one shared root.

    ``fact_buckets``: when set, the transaction facts are a catalog table
    (``database.fact_transactions``) partitioned by ``batch_date`` and bucketed
    by ``card_num`` into that many buckets, so the sequence rules' window on
    ``(batch_date, card_num)`` reads co-located buckets without shuffling the
    largest table."""

    root: str
    fact_buckets: int | None = None
    database: str = "vigil"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def clients(self) -> str:
        return self.path("dim_clients")

    @property
    def accounts(self) -> str:
        return self.path("dim_accounts")

    @property
    def cards(self) -> str:
        return self.path("dim_cards")

    @property
    def transactions(self) -> str:
        return self.path("fact_transactions")

    @property
    def blacklist(self) -> str:
        return self.path("fact_blacklist")

    @property
    def history(self) -> str:
        return self.path("terminals_hist")

    @property
    def report(self) -> str:
        return self.path("rep_fraud")

    @property
    def fact_table(self) -> str:
        return f"{self.database}.fact_transactions"

    @property
    def card_holders(self) -> str:
        return self.path("card_holders")

    @property
    def quality(self) -> str:
        return self.path("dq_violations")

    @property
    def rejects(self) -> str:
        return self.path("ingest_rejects")

    @property
    def history_loads(self) -> str:
        return self.path("history_loads")

    @property
    def processed(self) -> str:
        return self.path("processed_batches")


# --- file-system helpers (listing only; data never passes through the driver) --

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def history_loads(spark: SparkSession, wh: Warehouse) -> list[tuple[int, dt.date, dt.datetime]]:
    """(version, batch date, load time) of every complete load, by version: the record
    that a load writes after its version. One row per day."""
    if not _exists(spark, wh.history_loads):
        return []
    rows = spark.read.schema(HISTORY_LOADS).parquet(wh.history_loads).collect()
    return sorted((r.version, r.batch_date, r.load_time) for r in rows)


def history_versions(spark: SparkSession, wh: Warehouse) -> list[int]:
    return sorted({v for v, _, _ in history_loads(spark, wh)})


def _version_path(wh: Warehouse, version: int) -> str:
    return wh.path("terminals_hist", f"{_VERSION_PREFIX}{version:06d}")


def _history_part(spark: SparkSession, wh: Warehouse, versions: list[int], state: str) -> DataFrame:
    paths = [f"{_version_path(wh, v)}/state={state}" for v in versions]
    paths = [p for p in paths if _exists(spark, p)]
    if not paths:
        return history.empty_history(spark)
    return spark.read.schema(TERMINALS_HIST).parquet(*paths)


def open_history(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The open rows of the latest complete version."""
    return _history_part(spark, wh, history_versions(spark, wh)[-1:], "open")


def read_history(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The latest complete history (empty before the first load): its open rows, and the rows
    that each recorded version closed. ``history_loads`` is the manifest: what is not recorded
    there is not read."""
    versions = history_versions(spark, wh)
    return _history_part(spark, wh, versions, "closed").unionByName(
        _history_part(spark, wh, versions[-1:], "open"))


# --- steps -------------------------------------------------------------------

def load_dims(seed_clients: DataFrame, seed_accounts: DataFrame, seed_cards: DataFrame,
              wh: Warehouse) -> None:
    bank = dims.build_bank(seed_clients, seed_accounts, seed_cards)
    bank.clients.write.mode("overwrite").parquet(wh.clients)
    bank.accounts.write.mode("overwrite").parquet(wh.accounts)
    bank.cards.write.mode("overwrite").parquet(wh.cards)
    # card -> account -> client once per run; rules filter it by their hit keys
    stored = read_bank(bank.clients.sparkSession, wh)
    dims.card_holders(stored).write.mode("overwrite").parquet(wh.card_holders)


def read_bank(spark: SparkSession, wh: Warehouse) -> dims.Bank:
    return dims.Bank(spark.read.parquet(wh.clients), spark.read.parquet(wh.accounts),
                     spark.read.parquet(wh.cards))


def read_report(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The report; the days of a run become visible together."""
    return CommittedDays(spark, wh.report, REPORT).read()


def processed_dates(spark: SparkSession, wh: Warehouse) -> set[dt.date]:
    if not _exists(spark, wh.processed):
        return set()
    rows = spark.read.schema("processed_at timestamp_ntz, batch_date date").parquet(wh.processed)
    return {r.batch_date for r in rows.collect()}


def pending_batches(spark: SparkSession, landing: str, wh: Warehouse) -> list[dt.date]:
    """Complete, not yet processed batch dates in the landing folder (sorted)."""
    complete = files.complete_batches(files.feed_files(files.list_files(spark, landing)))
    done = processed_dates(spark, wh)
    return sorted(r.batch_date for r in complete.collect() if r.batch_date not in done)


def day_files(landing: str | list[str], feed: str, dates: list[dt.date]) -> list[str]:
    """The files of ``feed`` on ``dates`` in the folder(s): a run reads only its own days,
    however many processed days stay in the landing folder."""
    spark = SparkSession.getActiveSession()
    extensions = (FEED_EXTENSIONS[feed], *TABLE_EXTENSIONS.get(feed, ()))
    found = []
    for folder in [landing] if isinstance(landing, str) else landing:
        for d in sorted(dates):
            for ext in extensions:
                fs, p = _fs(spark, f"{folder}/{feed}_{d.strftime('%d%m%Y')}*.{ext}")
                found += [st.getPath().toString() for st in fs.globStatus(p) or []]
    return found


def archive_processed(spark: SparkSession, landing: str, wh: Warehouse, archive: str) -> None:
    """Move the files of all three feeds of the processed days out of the landing folder.
    The landing folder is listed once; days archived before have no files there any more,
    however many they are."""
    fs, target = _fs(spark, archive)
    fs.mkdirs(target)
    listed = files.list_files(spark, landing)
    dated = files.feed_files(listed).join(listed, "file_name").filter(
        F.col("feed").isNotNull() & files.has_extension(F.col("file_name"), F.col("feed")))
    days = dated.select("batch_date").distinct().collect()
    done = processed_dates(spark, wh) & {r.batch_date for r in days}
    for r in _only(dated, sorted(done)).select("file_path").collect() if done else []:
        _, p = _fs(spark, r.file_path)
        fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, p.getName()))


def _only(df: DataFrame, dates: list[dt.date]) -> DataFrame:
    return df.filter(F.col("batch_date").isin([F.lit(d) for d in dates]))


def load_facts(spark: SparkSession, landing: str | list[str], wh: Warehouse,
               dates: list[dt.date], staged: DataFrame | None = None) -> None:
    """Transactions (``staged``, or read from the landing folder) and blacklists of
    ``dates`` into the partitioned fact tables. A day that has no rows now loses its old
    ones. Lines that do not load are kept in ``ingest_rejects``."""
    if staged is None:
        raw = _only(delimited.read_transactions_raw(
            spark, day_files(landing, FEED_TRANSACTIONS, dates)), dates)
        staged = delimited.accepted_lines(raw)
        report.write_report(delimited.rejected_lines(raw), wh.rejects, batch_dates=dates)
    staged = _only(staged, dates)
    facts = dims.fact_transactions(staged)
    if wh.fact_buckets:
        _ensure_fact_table(spark, wh)
        before = report.day_files(facts, wh.transactions, dates)
        # one file per bucket and day
        (facts.repartition(int(wh.fact_buckets), "card_num")
         .write.option("partitionOverwriteMode", "dynamic")
         .insertInto(wh.fact_table, overwrite=True))
        report.drop_unwritten(facts, wh.transactions, before)
    else:
        report.write_report(facts, wh.transactions, batch_dates=dates)
    bl = _only(workbook.read_blacklist(spark, day_files(landing, FEED_BLACKLIST, dates)), dates)
    report.write_report(dims.fact_blacklist(bl), wh.blacklist, batch_dates=dates)


def _ensure_fact_table(spark: SparkSession, wh: Warehouse) -> None:
    """Register the bucketed fact table over its folder (data written by an
    earlier session is picked up with its partitions)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {wh.database}")
    if spark.catalog.tableExists(wh.fact_table):
        return
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT_TRANSACTIONS.fields)
    spark.sql(f"""CREATE TABLE {wh.fact_table} ({cols}) USING parquet
                  PARTITIONED BY (batch_date)
                  CLUSTERED BY (card_num) SORTED BY (card_num, trans_date)
                  INTO {int(wh.fact_buckets)} BUCKETS
                  LOCATION '{wh.transactions}'""")
    if _exists(spark, wh.transactions):
        spark.sql(f"ALTER TABLE {wh.fact_table} RECOVER PARTITIONS")


def read_facts(spark: SparkSession, wh: Warehouse, dates: list[dt.date],
               max_group_rows: int | None = rules.DEFAULT_GROUP_ROWS):
    """Facts for the rules and their hot-group stats.

    Hot groups are measured on a plain read (files split evenly). Without a
    hot group the bucketed table is used (no shuffle for the card window);
    with one, the plain read is used and the hot cards are sliced, because a
    bucketed read keeps every bucket, the hot card's too, in one task."""
    plain = spark.read.schema(FACT_TRANSACTIONS).parquet(wh.transactions)
    hot = (hot_groups(_only(plain, dates), ["batch_date", "card_num"], max_group_rows)
           if max_group_rows else None)
    if wh.fact_buckets and hot is None:
        _ensure_fact_table(spark, wh)
        return spark.table(wh.fact_table), hot
    return plain, hot


def _persisted_day_facts(spark: SparkSession, wh: Warehouse, dates: list[dt.date],
                         max_group_rows: int | None):
    """The run's facts, persisted (memory and disk; a lost block is recomputed
    from its lineage) because five readers use them: the hot-group count, two
    expiry joins and two sequence rules -- one scan instead of five. With a
    bucketed table and no hot card the bucketed scan is persisted, which keeps
    its partitioning for the card window."""
    plain = _only(spark.read.schema(FACT_TRANSACTIONS).parquet(wh.transactions), dates)
    if not wh.fact_buckets:
        day = plain.persist(StorageLevel.MEMORY_AND_DISK)
        keys = ["batch_date", "card_num"]
        hot = hot_groups(day, keys, max_group_rows) if max_group_rows else None
        return day, hot
    _, hot = read_facts(spark, wh, dates, max_group_rows)
    if hot is None:
        _ensure_fact_table(spark, wh)
        return _only(spark.table(wh.fact_table), dates).persist(StorageLevel.MEMORY_AND_DISK), hot
    return plain.persist(StorageLevel.MEMORY_AND_DISK), hot


def load_history(spark: SparkSession, landing: str | list[str], wh: Warehouse,
                 dates: list[dt.date], load_time: Callable[[dt.date], dt.datetime],
                 **options) -> dict[dt.date, dt.datetime]:
    """Fold the days' snapshots into the history in one job and give the load time of each
    day. The days come out as if each had been loaded on its own, in date order.

    A version holds the rows the load closed and all open rows; rows closed before are neither
    read nor written. It counts once its days are recorded in ``history_loads``, all in one
    file: a run that stops before leaves the last version as it was, and its successor
    writes the unrecorded version again. A day recorded before (a retry, or a day loaded
    again for its other feeds) keeps its version and its load time. A load time that is not
    after the last one becomes one second later than it."""
    loads = history_loads(spark, wh)
    times = {d: at for _, d, at in loads if d in set(dates)}
    latest = max((at for _, _, at in loads), default=None)
    new = []
    for d in sorted(set(dates) - set(times)):
        at = load_time(d)
        if latest is not None and at <= latest:
            at = latest + dt.timedelta(seconds=1)
        new.append((d, at))
        times[d] = latest = at
    if new:
        version = max((v for v, _, _ in loads), default=0) + 1
        snaps = workbook.read_terminals(spark, day_files(landing, FEED_TERMINALS, [d for d, _ in new]))
        merged = backfill.apply_snapshots(open_history(spark, wh), snaps, new, **options)
        state = F.when(F.col("effective_to") == F.lit(OPEN_END), "open").otherwise("closed")
        (merged.drop("_open").withColumn("state", state).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("state")
         .parquet(_version_path(wh, version)))
        (spark.createDataFrame([(version, d, at) for d, at in new], HISTORY_LOADS).coalesce(1)
         .write.mode("append").parquet(wh.history_loads))
    return times


def check_quality(spark: SparkSession, landing: str | list[str], wh: Warehouse,
                  load_times: dict[dt.date, dt.datetime], run_time: dt.datetime) -> None:
    """Key violations of this run as a table instead of an aborted load:
    duplicate primary keys of the dimensions and of each day's blacklist,
    orphans (card -> account, account -> client, transaction -> card,
    transaction -> terminal current after the day's own load), and values of the
    days' files that did not parse. One partition per run."""
    dates = sorted(load_times)
    bank = read_bank(spark, wh)
    facts = _only(spark.read.schema(FACT_TRANSACTIONS).parquet(wh.transactions), dates)
    blacklist = _only(spark.read.schema(FACT_BLACKLIST).parquet(wh.blacklist), dates)
    loads = spark.createDataFrame(sorted(load_times.items()),
                                  "batch_date date, load_time timestamp_ntz")
    raw = delimited.read_transactions_raw(spark, day_files(landing, FEED_TRANSACTIONS, dates))
    checks = quality.union_checks([
        quality.duplicate_keys(bank.clients, "client_id", "dim_clients"),
        quality.duplicate_keys(bank.accounts, "account_num", "dim_accounts"),
        quality.duplicate_keys(bank.cards, "card_num", "dim_cards"),
        quality.duplicate_keys(
            blacklist.withColumn("_key", F.concat_ws("|", F.col("batch_date").cast("string"),
                                                     "passport_num")),
            "_key", "fact_blacklist"),
        quality.orphans(bank.cards, "account_num", bank.accounts, "account_num",
                        "cards.account_num"),
        quality.orphans(bank.accounts, "client", bank.clients, "client_id", "accounts.client"),
        quality.orphans(facts, "card_num", bank.cards, "card_num", "transactions.card_num"),
        quality.orphan_terminals(facts, read_history(spark, wh), loads, "transactions.terminal"),
        delimited.bad_values(_only(raw, dates)),
    ])
    (checks.withColumn("checked_at", F.lit(run_time).cast("timestamp_ntz"))
     .withColumn("run", F.concat_ws("_", F.date_format("checked_at", "yyyyMMddHHmmss"),
                                    F.lit(dates[0].isoformat())))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run")
     .parquet(wh.quality))


def run_rules(spark: SparkSession, wh: Warehouse, dates: list[dt.date],
              load_time: Callable[[dt.date], dt.datetime], report_time: dt.datetime,
              facts: tuple[DataFrame, DataFrame | None] | None = None,
              **options) -> DataFrame:
    """The report rows of the given days (lazy). ``facts`` may pass the
    result of ``read_facts`` (e.g. persisted by the caller)."""
    bank = read_bank(spark, wh)
    max_group_rows = options.get("max_group_rows", rules.DEFAULT_GROUP_ROWS)
    facts, hot = facts if facts is not None else read_facts(spark, wh, dates, max_group_rows)
    blacklist = spark.read.schema(FACT_BLACKLIST).parquet(wh.blacklist)
    hist = read_history(spark, wh)
    city = {"known_at": {d: load_time(d) for d in dates}, **options.get("city_options", {})}
    holders = spark.read.parquet(wh.card_holders)
    return report.fraud_report(rules.all_rules(
        bank, facts, blacklist, hist, dates, report_time, holders=holders,
        max_group_rows=max_group_rows, hot=hot, city_options=city,
        amount_options=options.get("amount_options"),
        passport_options=options.get("passport_options"),
        account_options=options.get("account_options")))


def process_batches(spark: SparkSession, landing: str | list[str], wh: Warehouse, dates: list[dt.date],
                    run_time: dt.datetime,
                    load_time: Callable[[dt.date], dt.datetime] | None = None,
                    staged_transactions: DataFrame | None = None, **options) -> list[dt.date]:
    """Steps 2-5 for the given complete batch dates."""
    dates = sorted(dates)
    if not dates:
        return []
    if load_time is None:
        # one distinct, increasing load time per day of this run
        def load_time(d: dt.date, _order={d: i for i, d in enumerate(dates)}) -> dt.datetime:
            return run_time + dt.timedelta(seconds=_order[d])
    load_facts(spark, landing, wh, dates, staged_transactions)
    times = load_history(spark, landing, wh, dates, load_time,
                         **options.get("history_options", {}))
    check_quality(spark, landing, wh, times, run_time)
    day_facts, hot = _persisted_day_facts(spark, wh, dates,
                                          options.get("max_group_rows",
                                                      rules.DEFAULT_GROUP_ROWS))
    # with facts bucketed by card, let the expiry rules' join on (card, day) use
    # the card bucketing instead of shuffling the facts (the holder side is
    # shuffled by card to match); restored after the write
    copartition = "spark.sql.requireAllClusterKeysForCoPartition"
    previous = spark.conf.get(copartition)
    if wh.fact_buckets and hot is None:
        spark.conf.set(copartition, "false")
    try:
        result = run_rules(spark, wh, dates, times.__getitem__, run_time, facts=(day_facts, hot),
                           **options)
        CommittedDays(spark, wh.report, REPORT).write(result, dates)
    finally:
        spark.conf.set(copartition, previous)
        day_facts.unpersist()
    done = spark.createDataFrame([(d, run_time) for d in dates],
                                 "batch_date date, processed_at timestamp_ntz")
    (done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_date").parquet(wh.processed))
    return dates


def register_views(spark: SparkSession, wh: Warehouse, as_of: dt.datetime) -> list[str]:
    """Temporary views over the warehouse for SQL users: the dimensions, the
    facts, the latest terminal history, the report, the key violations, and
    ``v_terminals`` -- the terminals current at ``as_of``."""
    bank = read_bank(spark, wh)
    hist = read_history(spark, wh)
    views = {
        "dwh_dim_clients": bank.clients,
        "dwh_dim_accounts": bank.accounts,
        "dwh_dim_cards": bank.cards,
        "dwh_fact_transactions": spark.read.schema(FACT_TRANSACTIONS).parquet(wh.transactions),
        "dwh_fact_passport_blacklist": spark.read.schema(FACT_BLACKLIST).parquet(wh.blacklist),
        "dwh_dim_terminals_hist": hist,
        "v_terminals": history.current_terminals(hist, F.lit(as_of).cast("timestamp_ntz")),
        "rep_fraud": read_report(spark, wh),
        "dq_violations": spark.read.schema(DQ_VIOLATIONS).parquet(wh.quality),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def run_daily(spark: SparkSession, landing: str, wh: Warehouse, seeds: tuple[DataFrame, ...],
              run_time: dt.datetime, load_time: Callable[[dt.date], dt.datetime] | None = None,
              **options) -> list[dt.date]:
    """Rebuild the dimensions, then process every pending complete batch;
    returns the processed dates."""
    load_dims(*seeds, wh)
    return process_batches(spark, landing, wh, pending_batches(spark, landing, wh), run_time,
                           load_time, **options)


__all__ = ["Warehouse", "check_quality", "history_versions", "read_facts", "register_views", "load_dims", "load_facts", "load_history",
           "archive_processed", "pending_batches", "process_batches", "processed_dates", "read_bank", "read_history", "read_report", "run_daily",
           "run_rules"]
