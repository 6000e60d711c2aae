"""Fraud report: union of the rules and an idempotent partitioned write."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from vigil.schemas import REPORT_COLUMNS


def fraud_report(parts: Sequence[DataFrame]) -> DataFrame:
    """All rule outputs, duplicates kept (append semantics of the source)."""
    parts = [p.select(*REPORT_COLUMNS) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), parts)


def day_files(report: DataFrame, path: str, days: Sequence[dt.date]) -> dict:
    """File names in each day's partition folder (listing only)."""
    sc = report.sparkSession.sparkContext
    jvm = sc._jvm
    out = {}
    for d in days:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_date={d.isoformat()}")
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.exists(folder):
            out[d] = (fs, folder, sorted(st.getPath().getName() for st in fs.listStatus(folder)))
    return out


def write_report(report: DataFrame, path: str,
                 batch_dates: Sequence[dt.date] | None = None) -> None:
    """Write partitioned by ``batch_date`` with dynamic partition overwrite:
    running a day again replaces all of that day's rows, of every rule,
    instead of appending them a second time (a rule that finds nothing on the
    rerun leaves no stale rows behind). Other days are untouched.

    With ``batch_dates`` (the days this run reports on), a listed day whose
    folder the write did not replace -- the day has no rows now -- loses its
    old rows too: its file set is compared before and after the write."""
    before = day_files(report, path, batch_dates or [])
    (report.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_date")
     .parquet(path))
    drop_unwritten(report, path, before)


def drop_unwritten(rows: DataFrame, path: str, before: dict) -> None:
    """Delete the day folders that a dynamic overwrite left as ``before`` (from
    ``day_files``): these days have no rows now."""
    after = day_files(rows, path, list(before))
    for d, (fs, folder, names) in before.items():
        if d in after and after[d][2] == names:
            fs.delete(folder, True)
