"""Delimited transactions feed: ``;``-separated text with a header line.

Columns are taken by the names in each file's header, in any order; other named columns
are not read. The driver reads only the header line of every file; files with the same
header are read together. A file without a needed column fails the run. Every field is
read as text with an explicit schema (no inference, no sampling pass), so ids such as
``NA`` and amounts with a decimal comma survive unchanged; only ``transaction_date`` is
typed, with ``try_cast`` so a bad value becomes null instead of failing the job. A doubled
quote inside quotes is one quote; a line break ends the line even inside quotes, so that
files stay splittable. The read schema has one column more than the header (``_extra``): a
line with missing trailing fields gets nulls (as a pandas reader does), a line with more
fields than the header fills ``_extra`` and is rejected. The batch date comes from each
file's path (``_metadata.file_path``: the ``feed_DDMMYYYY`` part, a file or the directory a
writer produced), so one read covers any number of daily files, split across tasks by file
and byte range.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import batch_date_of, parse_amount
from vigil.schemas import TRANSACTIONS_FILE, TRANSACTIONS_FILE_COLUMNS
from vigil.sources import files

EXTRA = "_extra"
_READ_SCHEMA = T.StructType(TRANSACTIONS_FILE.fields + [T.StructField(EXTRA, T.StringType())])


#: options of the text format, for batch and stream readers
FORMAT = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
          "enforceSchema": "true", "nullValue": "", "emptyValue": ""}


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file (only its first line is read); none of an empty file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    if not line:
        return ()
    return tuple(name.strip().strip('"') for name in line.lstrip("\ufeff").split(FORMAT["sep"]))


def _by_name(spark: SparkSession, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """The lines of files with this header, as the feed's columns and ``_extra``."""
    missing = [c for c in TRANSACTIONS_FILE_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"{paths[0]}: the header has no column {missing}")
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))]
                          + [T.StructField(EXTRA, T.StringType())])
    raw = spark.read.schema(schema).options(**FORMAT).csv(paths)
    return raw.select(*[F.col(f"_c{header.index(c)}").alias(c) for c in TRANSACTIONS_FILE_COLUMNS],
                      EXTRA, F.col("_metadata.file_path").alias("file_path"))


def _typed(raw: DataFrame, file_path: Column) -> DataFrame:
    return raw.select(
        "transaction_id",
        F.col("transaction_date").try_cast("timestamp_ntz").alias("transaction_date"),
        "amount", "card_num", "oper_type", "oper_result", "terminal",
        batch_date_of(file_path, in_path=True).alias("batch_date"),
        file_path.alias("file_path"),
        EXTRA,
        F.col("transaction_date").alias("date_text"),
    )


def read_transactions_raw(spark: SparkSession, path: str | list[str],
                          name_glob: str | None = None) -> DataFrame:
    """All lines of the feed files, typed, with file path, the ``_extra`` field and the
    text of the date. ``name_glob`` keeps only matching file names (e.g.
    ``transactions_*.txt`` in a landing folder holding every feed)."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in files.leaf_files(spark, path, name_glob):
        by_header.setdefault(_header(spark, p), []).append(p)
    parts = [_by_name(spark, header, paths) for header, paths in by_header.items() if header]
    if not parts:
        parts = [spark.createDataFrame([], T.StructType(
            _READ_SCHEMA.fields + [T.StructField("file_path", T.StringType())]))]
    return _typed(reduce(DataFrame.unionByName, parts), F.col("file_path"))


def _accepted() -> Column:
    """A line is taken when it has no more fields than the header."""
    return F.col(EXTRA).isNull()


def accepted_lines(raw: DataFrame) -> DataFrame:
    """The rows of ``read_transactions_raw`` that load, in staging shape."""
    return raw.filter(_accepted()).select(*TRANSACTIONS_FILE_COLUMNS, "batch_date")


def rejected_lines(raw: DataFrame) -> DataFrame:
    """The rows of ``read_transactions_raw`` that do not load, with a ``reason``."""
    return (raw.filter(~_accepted() | F.col("batch_date").isNull())
            .withColumn("reason", F.when(~_accepted(), F.lit("more fields than the header"))
                        .otherwise(F.lit("no date in the file name"))))


def bad_values(raw: DataFrame) -> DataFrame:
    """``relation, key_value, n_rows``: loaded values that did not parse and became null."""
    taken = raw.filter(_accepted())
    parts = [
        taken.filter(F.col("date_text").isNotNull() & F.col("transaction_date").isNull())
        .select(F.lit("transactions.transaction_date unparsable").alias("relation"),
                F.col("date_text").alias("key_value")),
        taken.filter(F.col("amount").isNotNull() & parse_amount("amount").isNull())
        .select(F.lit("transactions.amount unparsable").alias("relation"),
                F.col("amount").alias("key_value")),
    ]
    return (parts[0].unionByName(parts[1]).groupBy("relation", "key_value")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def read_transactions(spark: SparkSession, path: str | list[str],
                      name_glob: str | None = None) -> DataFrame:
    """Transaction rows in staging shape plus ``batch_date``."""
    return accepted_lines(read_transactions_raw(spark, path, name_glob))


def rejected_transactions(spark: SparkSession, path: str | list[str],
                          name_glob: str | None = None) -> DataFrame:
    """Quarantine: malformed lines and rows of files without a date in the name."""
    return rejected_lines(read_transactions_raw(spark, path, name_glob))


def write_transactions(staged: DataFrame, path: str, batch_date: dt.date) -> str:
    """Write staged transactions as one feed directory in the source format
    (``;``, header, decimal comma, ``yyyy-MM-dd HH:mm:ss.SSSSSS`` times), into
    ``path/transactions_DDMMYYYY.txt/`` so the date is in every file's path."""
    stamp = batch_date.strftime("%d%m%Y")
    out = staged.select(
        "transaction_id",
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("transaction_date"),
        "amount", "card_num", "oper_type", "oper_result", "terminal")
    target = f"{path}/transactions_{stamp}.txt"
    out.write.mode("overwrite").option("sep", ";").option("header", True).csv(target)
    return target
