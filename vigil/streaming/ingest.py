"""Incremental ingest of the landing folder with Structured Streaming.

The source system polls a folder, takes one day's files, and renames them
into an archive after loading. The Spark form is a file stream:

* ``transactions_stream`` reads new ``transactions_*.txt`` files with the same
  explicit schema and typing as the batch reader; the checkpoint records which
  files were taken, so each file is read exactly once across runs.
  ``archive_dir`` moves processed files there (``cleanSource=archive``); Spark
  archives a micro-batch's files only in a later micro-batch or run, so the
  checkpoint, not the archive, says what is processed.
* ``ingest_transactions`` appends the typed rows to the partitioned fact table
  with ``trigger(availableNow=True)``: a scheduled run drains what is there
  and stops. Columns are read by name, and lines that do not load are kept.
* ``run_daily_stream`` drives the whole daily job: the file stream says which
  transaction files are new; the days are then loaded by the batch job from
  all their files. A day runs as soon as its three feeds are there, whichever
  run that is; a further file of a day that was already processed loads that
  day again, whole. Files are archived only once their day is processed.

``transactions_stream`` maps columns by position (a stream has one schema for all
files); the ingest and the daily job read them by name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigil.operators import dims
from vigil.plans import daily
from vigil.schemas import FACT_TRANSACTIONS, FEED_TRANSACTIONS, TRANSACTIONS_FILE_COLUMNS
from vigil.sources import delimited
from vigil.streaming.completeness import feed_file_stream


def transactions_stream(spark: SparkSession, landing: str, archive_dir: str | None = None,
                        max_files_per_trigger: int | None = None,
                        name_glob: str | None = f"{FEED_TRANSACTIONS}_*.txt") -> DataFrame:
    """Streaming transaction rows (staging shape + ``batch_date``). ``name_glob``
    picks the transaction files of a landing folder holding every feed; pass
    None when ``landing`` is one feed directory written by a Spark job."""
    reader = spark.readStream.schema(delimited._READ_SCHEMA).options(**delimited.FORMAT)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = delimited._typed(reader.csv(landing), F.col("_metadata.file_path"))
    return (raw.filter(delimited._accepted() & F.col("batch_date").isNotNull())
            .select(*TRANSACTIONS_FILE_COLUMNS, "batch_date"))


def _new_files(spark: SparkSession, landing: str, archive_dir: str | None,
               name_glob: str | None) -> DataFrame:
    """``path`` of new files (contents are not read)."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(landing).select("path")


def ingest_transactions(spark: SparkSession, landing: str, table: str, checkpoint: str,
                        archive_dir: str | None = None,
                        name_glob: str | None = f"{FEED_TRANSACTIONS}_*.txt",
                        rejects: str | None = None) -> StreamingQuery:
    """Append new transaction files to the fact table and stop when drained. The stream says
    which files are new; each micro-batch's files are read as the daily job reads them, by
    column name. Lines that do not load (more fields than the header, no date in the file's
    name) go to ``rejects`` (default: beside the table) with the reason. A micro-batch writes
    partitions of its own number, so repeating it after a failure replaces its rows."""
    rejects = rejects or f"{table.rstrip('/')}_rejects"

    def load(batch: DataFrame, epoch_id: int) -> None:
        paths = [r.path for r in batch.collect()]  # file names only
        if not paths:
            return
        raw = delimited.read_transactions_raw(spark, paths)
        accepted = delimited.accepted_lines(raw).filter(F.col("batch_date").isNotNull())
        for rows, target, by in ((dims.fact_transactions(accepted), table, ["batch_date", "epoch"]),
                                 (delimited.rejected_lines(raw), rejects, ["epoch"])):
            (rows.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target))

    query = (_new_files(spark, landing, archive_dir, name_glob).writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The facts of ``ingest_transactions``."""
    stored = T.StructType([*FACT_TRANSACTIONS.fields, T.StructField("epoch", T.LongType())])
    return spark.read.schema(stored).parquet(table).drop("epoch")


def run_daily_stream(spark: SparkSession, landing: str, wh: daily.Warehouse, checkpoint: str,
                     run_time: dt.datetime,
                     load_time: Callable[[dt.date], dt.datetime] | None = None,
                     archive_dir: str | None = None,
                     seeds: tuple[DataFrame, DataFrame, DataFrame] | None = None,
                     **options) -> StreamingQuery:
    """The daily job, started by new transaction files. ``seeds`` (clients, accounts,
    cards) rebuilds the dimensions first; without them the warehouse's current dimensions
    are used. ``archive_dir`` takes all files of the processed days."""
    if seeds is not None:
        daily.load_dims(*seeds, wh)
    folders = [landing, archive_dir] if archive_dir else [landing]

    def again(batch: DataFrame, epoch_id: int) -> None:
        """Days that were processed before and have got another file."""
        carried = {r.batch_date for r in batch.select("batch_date").distinct().collect()}
        dates = sorted(carried & daily.processed_dates(spark, wh))
        daily.process_batches(spark, folders, wh, dates, run_time, load_time, **options)

    # names only: the files' contents are not read
    names = feed_file_stream(spark, landing, FEED_TRANSACTIONS).select("batch_date")
    query = (names.writeStream.foreachBatch(again).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    # whatever is complete by now, also where the last feed came without a new
    # transaction file, or the transaction file has no rows
    daily.process_batches(spark, folders, wh, daily.pending_batches(spark, landing, wh), run_time,
                          load_time, **options)
    if archive_dir:
        daily.archive_processed(spark, landing, wh, archive_dir)
    return query
