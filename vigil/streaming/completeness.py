"""Complete days as a stream.

The three feeds are three file streams (names and times only, contents are not read), joined
on the day in the file's name. A day's state is the feeds that have come and when the first
did. The day is emitted when the third feed arrives, and its state is dropped; when the
watermark passes the first file's time by ``timeout`` and a feed is still missing, one
``incomplete`` row names what is missing, and the state waits on until ``keep`` has passed,
when an ``expired`` row ends it. Times are the files' modification times.

A further file of an emitted day opens a state of its own, which ends as ``incomplete`` and
``expired`` unless all three feeds come again; consumers look such days up among the
processed ones.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from vigil.functions import batch_date_of, feed_of
from vigil.schemas import FEEDS
from vigil.sources import files
from vigil.streaming.sequence import PROVIDER

_FILE = "path string, modificationTime timestamp, length long, content binary"
_OUT = "kind string, batch_date date, missing string, at timestamp_ntz"
_EPOCH = dt.datetime(1970, 1, 1)


def feed_file_stream(spark: SparkSession, landing: str, feed: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """``feed, batch_date, arrived, millis`` of the files of a feed that carry a date and end
    as the feed's files do."""
    reader = spark.readStream.format("binaryFile").schema(_FILE).option(
        "pathGlobFilter", f"{feed}_*")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    named = reader.load(landing).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                                        F.col("modificationTime").alias("arrived"))
    dated = named.select("file_name", "arrived", feed_of("file_name").alias("feed"),
                         batch_date_of("file_name").alias("batch_date"))
    return (dated.filter((F.col("feed") == feed) & F.col("batch_date").isNotNull()
                         & files.has_extension(F.col("file_name"), F.col("feed")))
            .select("feed", "batch_date", "arrived", F.unix_millis("arrived").alias("millis")))


class FeedDays(StatefulProcessor):
    """The feeds of a day that have come."""

    def __init__(self, timeout: dt.timedelta, keep: dt.timedelta):
        self.timeout, self.keep = (int(x.total_seconds() * 1000) for x in (timeout, keep))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "feed string", "millis long")

    def _feeds(self) -> dict[str, int]:
        if not self.seen.exists():
            return {}
        return {k[0]: int(v[0]) for k, v in self.seen.iterator()}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame],
                        timerValues: Any) -> Iterator[pd.DataFrame]:
        feeds = self._feeds()
        before = min(feeds.values(), default=None)
        for frame in rows:
            for feed, millis in frame[["feed", "millis"]].itertuples(index=False, name=None):
                feeds[feed] = min(int(millis), feeds.get(feed, int(millis)))
        first = min(feeds.values())
        if before is not None and before != first:
            self._forget(before)
        if len(feeds) == len(FEEDS):
            self._forget(first)
            self.seen.clear()
            yield _row(key, "complete", [], max(feeds.values()))
            return
        for feed, millis in feeds.items():
            self.seen.updateValue((feed,), (millis,))
        self.handle.registerTimer(first + self.timeout)
        self.handle.registerTimer(first + self.keep)

    def _forget(self, first: int) -> None:
        self.handle.deleteTimer(first + self.timeout)
        self.handle.deleteTimer(first + self.keep)

    def handleExpiredTimer(self, key: Any, timerValues: Any,
                           expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        feeds = self._feeds()
        if not feeds:
            return
        missing = [f for f in FEEDS if f not in feeds]
        if at == min(feeds.values()) + self.keep:
            self.seen.clear()
            yield _row(key, "expired", missing, at)
        else:
            yield _row(key, "incomplete", missing, at)

    def close(self) -> None:
        pass


def _row(key: Any, kind: str, missing: list[str], millis: int) -> pd.DataFrame:
    return pd.DataFrame({
        "kind": [kind], "batch_date": pd.Series([key[0]], dtype="object"),
        "missing": [",".join(missing)],
        "at": pd.Series([_EPOCH + dt.timedelta(milliseconds=millis)], dtype="datetime64[us]")})


def day_stream(feed_files: DataFrame, *, timeout: dt.timedelta = dt.timedelta(days=1),
               keep: dt.timedelta = dt.timedelta(days=30), delay: str = "1 hour") -> DataFrame:
    """``kind, batch_date, missing, at``: complete, incomplete and expired days of a stream of
    feed files (``feed, batch_date, arrived, millis``)."""
    if keep <= timeout:
        raise ValueError("a day must be kept longer than its timeout")
    feed_files.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    timed = feed_files.withWatermark("arrived", delay).drop("arrived")
    return timed.groupBy("batch_date").transformWithStateInPandas(
        statefulProcessor=FeedDays(timeout, keep), outputStructType=_OUT, outputMode="Append",
        timeMode="EventTime")


def landing_days(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                 **options) -> DataFrame:
    """The days of a landing folder holding all feeds."""
    streams = [feed_file_stream(spark, landing, f, max_files_per_trigger) for f in FEEDS]
    return day_stream(reduce(lambda a, b: a.unionByName(b), streams), **options)


def write_days(days: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write the days known by now, then stop. A micro-batch's rows replace themselves."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/epoch={epoch_id}")

    query = (days.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def read_days(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(f"{_OUT}, epoch int").parquet(table).drop("epoch")
