"""Distinct cities per card from day rows that merge.

Every city has a number; a card's cities of a day are bits in words of 64 numbers, so a day row
is ``batch_date, card_num, word, bits``. Rows of any days merge with a bitwise or, and the
number of distinct cities is the number of bits: exact for every range of days, from the
stored rows and without the facts. All steps are built-in aggregates combined map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: city numbers are dealt in this many independent rows, so that no task numbers them all
LANES = 256
_BITS = 64


def city_numbers(hist: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``terminal_city, number``: the ``known`` numbers, and new ones for the history's
    other cities. A number is never given twice and never changes.

    Cities are dealt to lanes by their hash and counted on in each lane: the i-th city of
    lane l has number (i // 64 x LANES + l) x 64 + i % 64, so lanes fill words of their own."""
    cities = hist.select("terminal_city").filter(F.col("terminal_city").isNotNull()).distinct()
    spark = hist.sparkSession
    if known is None:
        known = spark.createDataFrame([], "terminal_city string, number long")
    known = known.select("terminal_city", "number")
    word = F.floor(F.col("number") / _BITS)
    taken = known.groupBy((word % LANES).alias("lane")).agg(F.count(F.lit(1)).alias("taken"))
    fresh = (cities.join(known, "terminal_city", "left_anti")
             .withColumn("lane", F.pmod(F.xxhash64("terminal_city"), F.lit(LANES)))
             .join(taken, "lane", "left"))
    turn = (F.coalesce("taken", F.lit(0)) - 1
            + F.row_number().over(Window.partitionBy("lane").orderBy("terminal_city")))
    number = (F.floor(turn / _BITS) * LANES + F.col("lane")) * _BITS + turn % _BITS
    return known.unionByName(fresh.select("terminal_city", number.cast("long").alias("number")))


def _word() -> list:
    number = F.col("number")
    return [F.floor(number / _BITS).cast("long").alias("word"),
            F.expr("shiftleft(1L, CAST(number % 64 AS INT))").alias("bits")]


def day_cities(facts: DataFrame, hist: DataFrame, numbers: DataFrame) -> DataFrame:
    """``batch_date, card_num, word, bits``: the cities of each card's operations of a day over
    all versions of their terminals. A card without a known city has one row without a word.

    The terminals' versions are merged first: a fact meets one row per word, not per version."""
    terminals = (hist.join(numbers, "terminal_city").filter(F.col("terminal_id").isNotNull())
                 .select(F.col("terminal_id").alias("terminal"), *_word())
                 .groupBy("terminal", "word").agg(F.bit_or("bits").alias("bits")))
    seen = facts.select("batch_date", "card_num", "terminal").distinct()
    return (seen.join(terminals, "terminal", "left")
            .groupBy("batch_date", "card_num", "word")
            .agg(F.coalesce(F.bit_or("bits"), F.lit(0).cast("long")).alias("bits")))


def _counted(merged: DataFrame, *keys: str) -> DataFrame:
    return merged.groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("long")).alias("cnt_city"))


def cities_of_days(day_rows: DataFrame) -> DataFrame:
    """``batch_date, card_num, cnt_city``: distinct cities of every card and day."""
    return _counted(day_rows, "batch_date", "card_num")


def cities_between(day_rows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """``card_num, cnt_city``: distinct cities of every card over a range of days (both ends
    included)."""
    day = F.col("batch_date")
    merged = (day_rows.filter((day >= F.lit(first)) & (day <= F.lit(last)))
              .groupBy("card_num", "word").agg(F.bit_or("bits").alias("bits")))
    return _counted(merged, "card_num")


def cities_rolling(day_rows: DataFrame, days: int) -> DataFrame:
    """``batch_date, card_num, cnt_city``: for every day on which a card has an operation, its
    distinct cities of that day and the ``days`` - 1 before. A stored row goes to at most
    ``days`` windows."""
    active = day_rows.select("batch_date", "card_num").distinct()
    reach = F.sequence(F.col("batch_date"), F.date_add("batch_date", days - 1))
    spread = day_rows.select(F.explode(reach).alias("batch_date"), "card_num", "word", "bits")
    merged = spread.groupBy("batch_date", "card_num", "word").agg(F.bit_or("bits").alias("bits"))
    counted = _counted(merged, "batch_date", "card_num")
    on = (F.col("a.batch_date") == F.col("c.batch_date")) & F.col("a.card_num").eqNullSafe(
        F.col("c.card_num"))
    return counted.alias("c").join(active.alias("a"), on, "left_semi")
