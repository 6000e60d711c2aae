"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import reliable_checkpoint, scratch_dir

#: white space of the contracts: space and the code points 9 to 13
WHITE = " \t\n\x0b\x0c\r"

#: a key with more than 1/HEAVY_SHARE of all rows is heavy; there are fewer than
#: HEAVY_SHARE such keys whatever the input's size, so they may be broadcast. Keys of
#: fewer than LEAST_HEAVY rows weigh nothing in any task.
HEAVY_SHARE, LEAST_HEAVY = 1000, 200


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts (as many bytes as characters) take
    the fast built-in; others are translated letter by letter."""
    return (F.when(F.octet_length(col) == F.length(col), F.lower(col))
            .otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


#: rows in an Arrow batch to a Python worker, so that long texts stay within its memory
ARROW_ROWS = 512
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    """``mapInArrow`` in batches of at most ARROW_ROWS rows. Where the workers share the
    driver's file system they import the package from the driver's place; elsewhere it
    is shipped with ``--py-files``."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    workers = spark.sparkContext.environment
    path = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in path:
        workers["PYTHONPATH"] = os.pathsep.join([_ROOT, *path])
    return df.mapInArrow(fn, schema)


def fixed(df: DataFrame) -> DataFrame:
    """Materialised as a table in the session's shared folder: a lost executor does not
    bring its inputs back to work, and later plans start from the table's true size (sizes
    estimated through many joins of a checkpoint's lineage would grow without bound)."""
    spark = df.sparkSession
    path = scratch_dir(spark, "fixed")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop_fixed(*tables: DataFrame) -> None:
    """Delete tables of ``fixed`` that no later plan reads."""
    for table in tables:
        delete_scratch(table.sparkSession, table.scratch_path)


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch_dir`` whose tables are no longer read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def fixed_in_place(df: DataFrame) -> DataFrame:
    """Materialised partition by partition, in order, as a reliable checkpoint."""
    return reliable_checkpoint(df)


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count_col: str) -> DataFrame:
    """Inner join of many rows to one row per key, where a key may hold a large
    share of the rows. ``keyed`` has ``count_col`` = rows per key. The heavy keys
    (fewer than HEAVY_SHARE, see there) are broadcast, so their rows never move;
    all other keys are too small to be skewed and take a shuffle join."""
    total, most = keyed.agg(F.sum(count_col), F.max(count_col)).first()
    bound = max((total or 0) / HEAVY_SHARE, LEAST_HEAVY)
    if (most or 0) <= bound:
        return rows.join(keyed, key)
    is_heavy = F.col(count_col) > bound
    heavy = F.broadcast(keyed.filter(is_heavy))
    rest = rows.join(F.broadcast(keyed.filter(is_heavy).select(key)), key, "left_anti")
    return rows.join(heavy, key).unionByName(rest.join(keyed.filter(~is_heavy), key))


def wrapped(docs: DataFrame, *keys: Column) -> DataFrame:
    """The rows as one struct column besides the keys, so that no name can clash."""
    return docs.select(F.struct("*").alias("_whole"), *keys)


def unwrapped(rows: DataFrame) -> DataFrame:
    return rows.select("_whole.*")
