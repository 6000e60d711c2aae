"""Data-quality checks standing in for key constraints.

The source store aborts a load on a duplicate primary key and declares (but
does not enforce) foreign keys. Here both are queries whose rows are the
violations, so a load can report them instead of failing half-way. Both are
plain aggregates/anti joins: partial aggregation happens map-side, so a key
repeated millions of times is still counted without gathering its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: str, relation: str) -> DataFrame:
    """``relation, key_value, n_rows`` for every key value held by more than one row."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1)
            .select(F.lit(relation).alias("relation"), F.col(key).cast("string").alias("key_value"),
                    "n_rows"))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
            relation: str) -> DataFrame:
    """``relation, key_value, n_rows`` for child key values without a parent row.

    The child is aggregated to distinct keys first (map-side combine), then
    anti-joined against the distinct parent keys."""
    keys = (child.filter(F.col(child_key).isNotNull()).groupBy(child_key)
            .agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(parent_key).alias(child_key))
    return (keys.join(parents, child_key, "left_anti")
            .select(F.lit(relation).alias("relation"),
                    F.col(child_key).cast("string").alias("key_value"), "n_rows"))


def orphan_terminals(facts: DataFrame, hist: DataFrame, loads: DataFrame,
                     relation: str) -> DataFrame:
    """``relation, key_value, n_rows`` for terminals of ``facts`` (``batch_date``,
    ``terminal``) that no version valid after the day's own load names. ``loads`` has one
    row per day: ``batch_date, load_time``."""
    keys = (facts.filter(F.col("terminal").isNotNull()).groupBy("batch_date", "terminal")
            .agg(F.count(F.lit(1)).alias("n_rows")).join(F.broadcast(loads), "batch_date"))
    live = hist.filter(F.col("deleted_flg") == 0).select(
        F.col("terminal_id").alias("terminal"), "effective_from", "effective_to")
    found = keys.join(live, (keys["terminal"] == live["terminal"]) & F.col("load_time").between(
        F.col("effective_from"), F.col("effective_to")), "left_anti")
    return (found.groupBy("terminal").agg(F.sum("n_rows").alias("n_rows"))
            .select(F.lit(relation).alias("relation"),
                    F.col("terminal").cast("string").alias("key_value"), "n_rows"))


def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
