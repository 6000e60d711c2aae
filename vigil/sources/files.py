"""Feed files: batch dates from names, complete batches, the next batch.

The source system looks at one landing folder, takes the date of the first
file by name and fails unless all three feeds of that date are there. Here the
listing is a DataFrame (one row per file), so every pending date is handled
at once: names are parsed per row, dates missing a feed are held back, and
files without a date go to quarantine instead of stopping the run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import batch_date_of, feed_of
from vigil.schemas import FEED_EXTENSIONS, FEEDS, TABLE_EXTENSIONS


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file_name, file_path`` of every file in ``folder`` (contents not read)."""
    listing = spark.read.format("binaryFile").load(folder).select("path")
    return listing.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                          F.col("path").alias("file_path"))


def leaf_files(spark: SparkSession, path: str | list[str], name_glob: str | None = None) -> list[str]:
    """Paths of the files under ``path`` (one entry per file; contents not read)."""
    reader = spark.read.format("binaryFile")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return sorted(r.path for r in reader.load(path).select("path").collect())


def has_extension(file_name: Column, feed: Column) -> Column:
    """The name ends as the feed's files do (a partial upload such as ``.txt.part`` or a
    copy with another ending is not the feed)."""
    return reduce(lambda a, b: a | b, [
        (feed == name) & F.lower(file_name).endswith(f".{ext}")
        for name in FEEDS for ext in (FEED_EXTENSIONS[name], *TABLE_EXTENSIONS.get(name, ()))])


def feed_files(names: DataFrame, name_col: str = "file_name") -> DataFrame:
    """``file_name, feed, batch_date`` for every file name."""
    return names.select(F.col(name_col).alias("file_name"),
                        feed_of(name_col).alias("feed"),
                        batch_date_of(name_col).alias("batch_date"))


def quarantined_files(files: DataFrame) -> DataFrame:
    """Files that belong to no feed, carry no valid date or end otherwise than the feed's."""
    return files.filter(F.col("feed").isNull() | F.col("batch_date").isNull()
                        | ~has_extension(F.col("file_name"), F.col("feed")))


def complete_batches(files: DataFrame) -> DataFrame:
    """Batch dates for which every feed has a file with its extension:
    ``batch_date, n_feeds``."""
    return (files.filter(F.col("feed").isNotNull() & F.col("batch_date").isNotNull()
                         & has_extension(F.col("file_name"), F.col("feed")))
            .groupBy("batch_date").agg(F.count_distinct("feed").alias("n_feeds"))
            .filter(F.col("n_feeds") == len(FEEDS)))


def pending_batches(complete: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """Complete batches not processed yet (``processed`` has ``batch_date``)."""
    if processed is None:
        return complete
    return complete.join(processed.select("batch_date").distinct(), "batch_date", "left_anti")


def next_batch(complete: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """The earliest pending complete batch (by date, not by file-name order)."""
    return pending_batches(complete, processed).agg(F.min("batch_date").alias("batch_date"))
