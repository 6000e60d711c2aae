"""``lag`` and forward fill over ordered groups that stay balanced when one group is huge.

A window function runs each partition group in a single task. When one card (or the null
card) holds a large share of the rows, the plain window puts all of them on one executor.
``lag_columns`` and ``fill_columns`` keep the window's result exactly, but treat such hot
groups apart:

1. ``hot_groups`` counts rows per group (combined map-side, so a hot group never meets in
   one task) and keeps the groups above ``max_rows`` as a table. Normally there is none, and
   the plain window is all there is.
2. The rows of hot groups are sorted into ranges of the total order (keys, then the order
   columns, then a row number, so that rows alike in everything are split too). A range is a
   task's share whatever the keys and times in it: a card with all rows at one instant
   spreads over as many ranges as its rows need.
3. Within a range the window runs per group. Only what crosses a border is missing: the
   first and last ``depth`` rows of every group and range (for a fill, the last value of
   every group and range) form a small stream in which the window runs once more per
   group. A range with fewer than ``depth`` rows of a group is in that stream whole, so
   values are carried through it.

The border stream of one group holds at most 2 x depth rows per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vigil.session import written

# Groups with more rows than this are cut into ranges of about this size.
DEFAULT_GROUP_ROWS = 2_000_000

_SLICE_COLUMNS = ("_slice", "_tie", "_rn", "_cnt")


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame | None:
    """``keys, _n`` of the groups with more than ``max_rows`` rows, or None when there is
    none (the common case). The table has at most rows / max_rows rows; one of them reaches
    the driver, to see that there is any."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > F.lit(int(max_rows)))
    first = hot.limit(1).collect()
    return written(hot.withColumn("_max", F.lit(int(max_rows)))) if first else None


def _is_hot(keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, Column]:
    named = hot.select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(keys)])
    return named, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hk{i}"))
                                              for i, k in enumerate(keys)])


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of the hot groups, and the others (adaptive execution splits the hot keys'
    partitions of both joins, or broadcasts the table when it is small)."""
    named, on = _is_hot(keys, hot)
    return df.join(named, on, "left_semi"), df.join(named, on, "left_anti")


def in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[Column],
              hot: DataFrame) -> DataFrame:
    """The rows of hot groups with the range they fall in (``_slice``, growing along keys and
    order) and a row number that makes the order total (``_tie``). Both are written, so that
    a lost task finds the same numbers and ranges again."""
    spark = rows.sparkSession
    total, most = hot.agg(F.sum("_n"), F.max("_max")).first()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // most))
    numbered = written(rows.withColumn("_tie", F.monotonically_increasing_id()))
    by = [F.col(k).asc_nulls_first() for k in keys] + list(order) + [F.col("_tie").asc()]
    return written(numbered.repartitionByRange(n, *by)
                   .withColumn("_slice", F.spark_partition_id().cast("long")))


def _windows(keys: Sequence[str], order: list[Column]) -> tuple[WindowSpec, WindowSpec, WindowSpec]:
    """Within a group's range: in order, and whole; and over a group's border rows."""
    inside = Window.partitionBy(*keys, "_slice")
    total = [*order, F.col("_tie").asc()]
    return inside.orderBy(*total), inside, Window.partitionBy(*keys).orderBy(F.col("_slice"), *total)


def lag_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                lags: Mapping[str, tuple[str, int]], *, hot: DataFrame | None = None) -> DataFrame:
    """Add ``name = lag(src, n)`` for every ``name -> (src, n)`` in ``lags``, in the
    group's ``order`` (nulls first). Rows alike in all order columns may come in any order,
    so these should hold every column that is lagged."""
    order_cols = _order(order)

    def lagged(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.select("*", *[F.lag(src, n).over(w).alias(name)
                                  for name, (src, n) in lags.items()])

    if hot is None:
        return lagged(df, Window.partitionBy(*keys).orderBy(*order_cols))
    hot_rows, others = split_hot(df, keys, hot)
    plain = lagged(others, Window.partitionBy(*keys).orderBy(*order_cols))
    depth = max(n for _, n in lags.values())
    in_order, whole, borders = _windows(keys, order_cols)
    # explicit: input already clustered by ``keys`` (a table bucketed by the card) would
    # otherwise satisfy the window and keep a hot group in one task
    ranged = in_ranges(hot_rows, keys, order_cols, hot).repartition(*keys, "_slice")
    inside = lagged(ranged.select("*", F.row_number().over(in_order).alias("_rn"),
                                  F.count(F.lit(1)).over(whole).alias("_cnt")), in_order)
    settled = inside.filter(F.col("_rn") > depth)
    edges = inside.filter((F.col("_rn") <= depth) | (F.col("_cnt") - F.col("_rn") < depth))
    heads = lagged(edges.drop(*lags), borders).filter(F.col("_rn") <= depth)
    return plain.unionByName(settled.unionByName(heads).drop(*_SLICE_COLUMNS))


def fill_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 fills: Mapping[str, str], *, hot: DataFrame | None = None) -> DataFrame:
    """Add ``name = last non-null src`` up to and with the row itself, in the group's
    ``order`` (nulls first), for every ``name -> src`` in ``fills``."""
    order_cols = _order(order)

    def filled(rows: DataFrame, w: WindowSpec) -> DataFrame:
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.select("*", *[F.last(src, ignorenulls=True).over(upto).alias(name)
                                  for name, src in fills.items()])

    if hot is None:
        return filled(df, Window.partitionBy(*keys).orderBy(*order_cols))
    hot_rows, others = split_hot(df, keys, hot)
    plain = filled(others, Window.partitionBy(*keys).orderBy(*order_cols))
    in_order, whole, _ = _windows(keys, order_cols)
    ranged = in_ranges(hot_rows, keys, order_cols, hot).repartition(*keys, "_slice")
    inside = filled(ranged, in_order).select(
        "*", F.row_number().over(in_order).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_cnt"))
    # what every range hands on: the last row's values; the nearest one before a range counts
    ends = inside.filter(F.col("_rn") == F.col("_cnt")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_ks"),
        *[F.col(name).alias(f"_end_{name}") for name in fills])
    before = (Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_ks")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(*[f"_k{i}" for i in range(len(keys))], "_ks", *[
        F.last(f"_end_{name}", ignorenulls=True).over(before).alias(f"_carry_{name}")
        for name in fills])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}"))
                                     for i, k in enumerate(keys)], F.col("_slice") == F.col("_ks"))
    done = inside.join(carried, on, "left").select(
        *df.columns, *[F.coalesce(name, f"_carry_{name}").alias(name) for name in fills])
    return plain.unionByName(done)
