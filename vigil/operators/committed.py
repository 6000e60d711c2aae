"""Day-partitioned tables whose runs become visible in one step.

A run writes its days into a folder of its own and then appends one file to the manifest,
naming the folder for each of its days. Readers take, per day, the folder of the last run
recorded; until the manifest's file is there they see the days as they were, all of them.
A day that a run covers without rows is empty afterwards. Folders that no day names any more
(replaced days, runs that stopped half-way) are removed by ``vacuum``.

The manifest has one row per day and run; only it passes through the driver. There is one
writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "commit int, batch_date date"


class CommittedDays:
    """A table of ``schema`` (with ``batch_date``) at ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _folder(self, path: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def commits(self) -> list[tuple[int, dt.date]]:
        """(run, day) of every recorded run."""
        fs, folder = self._folder(f"{self.path}/manifest")
        if not fs.exists(folder):
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").collect()
        return sorted((r["commit"], r["batch_date"]) for r in rows)

    def live(self) -> dict[dt.date, int]:
        """The run that holds each day now."""
        return {d: n for n, d in self.commits()}

    def _days_there(self) -> dict[tuple[int, dt.date], str]:
        """The day folders that exist, of recorded runs and others (one listing)."""
        fs, pattern = self._folder(f"{self.path}/data/commit=*/batch_date=*")
        found = {}
        for status in fs.globStatus(pattern) or []:
            run, day = status.getPath().toString().split("/")[-2:]
            found[int(run.split("=")[1]), dt.date.fromisoformat(day.split("=")[1])] = (
                status.getPath().toString())
        return found

    def stage(self, df: DataFrame, days: Sequence[dt.date]) -> int:
        """Write the rows of ``days`` as the next run; not visible before ``commit``. A run of
        that number that was not recorded is replaced."""
        run = max((n for n, _ in self.commits()), default=0) + 1
        (df.select(*self.schema.fieldNames()).filter(F.col("batch_date").isin(list(days)))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("batch_date").parquet(f"{self.path}/data/commit={run}"))
        return run

    def commit(self, run: int, days: Sequence[dt.date]) -> None:
        """Make the run's days visible, in one file."""
        rows = [(run, d) for d in sorted(set(days))]
        (self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/manifest"))

    def write(self, df: DataFrame, days: Sequence[dt.date]) -> None:
        """Replace all rows of ``days`` (at least one day)."""
        if not days:
            raise ValueError("no day given")
        self.commit(self.stage(df, days), days)

    def read(self) -> DataFrame:
        there = self._days_there()
        paths = [there[n, d] for d, n in self.live().items() if (n, d) in there]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([f for f in self.schema.fields if f.name != "batch_date"]
                              + [T.StructField("commit", T.IntegerType()),
                                 T.StructField("batch_date", T.DateType())])
        return (self.spark.read.schema(stored).option("basePath", f"{self.path}/data")
                .parquet(*sorted(paths)).select(*self.schema.fieldNames()))

    def vacuum(self) -> int:
        """Delete the day folders that no day names; how many there were."""
        live = {(n, d) for d, n in self.live().items()}
        old = [p for key, p in self._days_there().items() if key not in live]
        for path in old:
            fs, folder = self._folder(path)
            fs.delete(folder, True)
        return len(old)
