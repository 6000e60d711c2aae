"""As-of joins by forward fill.

Rows and versions are put into one sequence per key, ordered by time with versions before
rows of the same instant, and the last version is carried forward. A row meets one version
(the versions of one key and start together), however many the key has. Hot keys go through
the ranges of ``seqlag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.seqlag import DEFAULT_GROUP_ROWS, fill_columns, hot_groups


def last_before(rows: DataFrame, versions: DataFrame, *, key: str, at: Column, start: str,
                values: Sequence[str], max_group_rows: int | None = DEFAULT_GROUP_ROWS) -> DataFrame:
    """All columns of ``rows`` and ``_versions``: the ``values`` (structs) of the key's versions
    with the greatest ``start`` not after ``at``; null where there is none, or where the key or
    the time is null. ``versions`` has the same ``key`` column."""
    known = (versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
             .groupBy(key, F.col(start).alias("_at"))
             .agg(F.collect_list(F.struct(*values)).alias("_new")))
    kind = known.schema["_new"].dataType
    timed = rows.select(F.col(key).alias("_key"), at.alias("_at"), F.struct("*").alias("_row"))
    placed = timed.filter(F.col("_key").isNotNull() & F.col("_at").isNotNull())
    events = placed.select("_key", "_at", "_row", F.lit(None).cast(kind).alias("_new")).unionByName(
        known.select(F.col(key).alias("_key"), "_at",
                     F.lit(None).cast(placed.schema["_row"].dataType).alias("_row"), "_new"))
    hot = hot_groups(events, ["_key"], max_group_rows) if max_group_rows else None
    # false before true: a version counts for the rows of its own instant
    filled = fill_columns(events.withColumn("_is_row", F.col("_row").isNotNull()), ["_key"],
                          ["_at", "_is_row"], {"_versions": "_new"}, hot=hot)
    lost = (timed.filter(F.col("_key").isNull() | F.col("_at").isNull())
            .select("_row", F.lit(None).cast(kind).alias("_versions")))
    return (filled.filter("_is_row").select("_row", "_versions").unionByName(lost)
            .select("_row.*", "_versions"))


def tangled_keys(versions: DataFrame, *, key: str, start: str, end: str) -> DataFrame:
    """Keys with a version that starts before an earlier start's versions have ended."""
    spans = (versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
             .groupBy(key, start).agg(F.max(end).alias(end)))
    earlier = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    return (spans.withColumn("_before", F.max(end).over(earlier))
            .filter(F.col("_before") >= F.col(start)).select(key).distinct())


def as_of_join(rows: DataFrame, versions: DataFrame, *, key: str, time: str, start: str, end: str,
               values: Sequence[str], known: Column | None = None,
               max_group_rows: int | None = DEFAULT_GROUP_ROWS) -> DataFrame:
    """``rows`` left-joined to the versions of their ``key`` valid at ``time`` (both ends
    included): all columns of ``rows`` and the ``values``. With ``known`` (a time) only
    versions that started by then count. Versions alike in key and start give a row each.

    Where a key's validity spans overlap (in a history that was not built by the library's
    merge), the last version alone is not the whole answer: those keys take the plain
    range join."""
    spans = versions.select(key, start, end, *values)
    tangled = tangled_keys(spans, key=key, start=start, end=end)
    at = F.col(time)
    if known is not None:
        at = F.when(F.col(time).isNotNull() & known.isNotNull(), F.least(F.col(time), known))
    if tangled.isEmpty():
        return _filled(rows, spans, key, time, at, start, end, values, max_group_rows)
    plain = _filled(rows.join(tangled, key, "left_anti"), spans.join(tangled, key, "left_anti"),
                    key, time, at, start, end, values, max_group_rows)
    own = spans.join(tangled, key, "left_semi").select(
        F.col(key).alias("_vkey"), F.col(start).alias("_start"), F.col(end).alias("_end"), *values)
    on = (F.col(key) == F.col("_vkey")) & (F.col("_start") <= at) & (F.col(time) <= F.col("_end"))
    ranged = rows.join(tangled, key, "left_semi").join(own, on, "left").drop("_vkey", "_start", "_end")
    return plain.unionByName(ranged).select(*rows.columns, *values)


def _filled(rows: DataFrame, spans: DataFrame, key: str, time: str, at: Column, start: str,
            end: str, values: Sequence[str], max_group_rows: int | None) -> DataFrame:
    met = last_before(rows, spans, key=key, at=at, start=start, values=[end, *values],
                      max_group_rows=max_group_rows)
    valid = F.filter("_versions", lambda v: F.col(time) <= v[end])
    return (met.select(*rows.columns, F.explode_outer(valid).alias("_v"))
            .select(*rows.columns, *[F.col("_v")[c].alias(c) for c in values]))
