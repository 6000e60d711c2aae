"""Exact deduplication with a persistent digest index.

The index is a catalog table bucketed and sorted by the digest of the normalised
text. A batch of documents is reduced to one row per digest (partial aggregation,
so a digest held by a third of all rows is one row per task before the shuffle),
the digests already known are removed by a sort-merge anti join in which the
index needs no shuffle, and the rest is appended.

Defined results
* a null text counts as empty; texts are equal when identical after lower-casing A-Z
* of equal texts of one batch the row with the largest doc_id stays; a text that an
  earlier batch brought stays with that batch and all rows of the new batch go
* repeated rows (same doc_id, same text) are one document; a null doc_id is smaller
  than all others and stays only if every row of its text has one
* ``group_size`` counts the batch's documents of that text
* an empty table gives no rows; other columns are not read
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, fixed, join_counted, unwrapped, wrapped
from vigil.session import scratch_dir


def digest(text) -> F.Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def digest_rows(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest (binary)."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.unhex(digest(docs["text"])).alias("digest"))
            .groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n_rows")))


class DigestIndex:
    """The persistent index: ``digest, keep_id, group_size, batch``."""

    def __init__(self, spark: SparkSession, table: str, path: str | None = None,
                 buckets: int = 64):
        self.spark, self.table, self.buckets = spark, table, buckets
        self._path = path
        if not spark.catalog.tableExists(table):
            where = f"LOCATION '{path}'" if path else ""
            spark.sql(f"CREATE TABLE {table} (digest BINARY, keep_id BIGINT, group_size BIGINT, "
                      f"batch STRING) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                      f"INTO {buckets} BUCKETS {where}")

    @classmethod
    def scratch(cls, spark: SparkSession) -> "DigestIndex":
        """A new index in the session's shared folder, with as many buckets as shuffles
        have partitions."""
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark, f"digest_index_{uuid.uuid4().hex}", scratch_dir(spark, "digest-index"),
                   buckets)

    def frame(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, docs: DataFrame, batch: str) -> DataFrame:
        """Append the batch's new digests; one row per document comes back:
        doc_id, digest, n_rows, keep_id, group_size, kept. Repeating a batch (after
        a failure) appends only what is missing and gives the same rows."""
        rows = fixed(digest_rows(docs))
        # written before the joins: an anti-join pushed below the aggregation would bring
        # all rows of a hot digest into one task
        groups = fixed(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                                  F.count(F.lit(1)).alias("group_size")))
        fresh = (groups.join(self.frame().select("digest").hint("merge"), "digest", "left_anti")
                 .select("digest", "keep_id", "group_size", F.lit(batch).alias("batch")))
        (fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))
        known = self.frame().select("digest", "keep_id", "batch")
        state = groups.drop("keep_id").join(known.hint("merge"), "digest")
        out = join_counted(rows, fixed(state), "digest", "group_size")
        return out.select(
            "doc_id", "digest", "n_rows", "keep_id", "group_size",
            ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"))


def kept_documents(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """The documents (all columns) that stay."""
    judged = index.ingest(docs, batch).filter("kept")
    stay = judged.select(F.col("doc_id").alias("id"), F.col("digest").alias("kept_digest"), "n_rows")
    own = wrapped(docs, docs["doc_id"].cast("long").alias("own_id"),
                  F.unhex(digest(docs["text"])).alias("digest"))
    found = own.join(stay, F.col("own_id").eqNullSafe(F.col("id"))
                     & (F.col("digest") == F.col("kept_digest")))
    repeated = found.filter("n_rows > 1").dropDuplicates(["own_id", "digest"])
    return unwrapped(found.filter("n_rows = 1").unionByName(repeated))
