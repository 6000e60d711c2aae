"""Workbooks as a Spark data source: ``spark.read.format("workbook")``, batch and stream.

Options: ``path`` (a folder, or files separated by commas, on a file system mounted at every
worker), ``columns`` (comma list: only these are decoded into rows) and ``glob`` (default
``*.xlsx``). Every workbook is a partition; its first sheet is read event by event in the
task. Rows have the named columns, as text, and ``file_path``. As a stream, a file counts once
by its name. ``workbook.read_workbooks`` reads the same rows from any file system Spark knows.
"""

from __future__ import annotations

import fnmatch
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from vigil.sources.workbook import iter_first_sheet, sheet_columns


class WorkbookFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class _Workbooks:
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = [f.name for f in schema.fields if f.name != "file_path"]
        self.path, self.glob = options["path"], options.get("glob", "*.xlsx")

    def files(self) -> list[str]:
        found = []
        for place in self.path.split(","):
            if os.path.isdir(place):
                found += [os.path.join(place, n) for n in os.listdir(place)
                          if fnmatch.fnmatch(n, self.glob)]
            else:
                found.append(place)
        return sorted(found)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path = partition.value
        for values in sheet_columns(path, iter_first_sheet(path), self.columns):
            n = len(values[0]) if values else 0
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v, pa.string()) for v in values), pa.array([path] * n, pa.string())],
                [*self.columns, "file_path"])


class _Reader(_Workbooks, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return [WorkbookFile(p) for p in self.files()]


class _StreamReader(_Workbooks, DataSourceStreamReader):
    """An offset is the list of the file names seen."""

    def initialOffset(self) -> dict:
        return {"files": "[]"}

    def latestOffset(self) -> dict:
        return {"files": json.dumps(self.files())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        seen = set(json.loads(start["files"]))
        return [WorkbookFile(p) for p in json.loads(end["files"]) if p not in seen]

    def commit(self, end: dict) -> None:
        pass


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> T.StructType:
        columns = [c.strip() for c in self.options["columns"].split(",")]
        return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "file_path"]])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
