"""The corpus pipeline: toxic documents go, of equal texts one stays, of near duplicates
one stays, documents that hold benchmark items go, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``. ``run`` writes each stage's rows as Parquet
in the session's shared folder and reads them again for the next stage.

Defined results: null texts count as empty and are neither toxic nor contaminated; an empty
table gives an empty result; repeated rows fall to the exact deduplication; extra columns
pass through unread whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from vigil.llm.common import read_table
from vigil.session import scratch_dir

#: words in a shingle, least similarity in percent of the near-duplicate stage
SHINGLE, PERCENT = 5, 80
#: bytes of words whose ids a worker of the last stage holds, beside executors whose heap the
#: stages before have filled
CACHE_WORDS = 3_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.kept_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs, exact_dedup.DigestIndex.scratch(spark), "pipeline")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept_documents(docs, SHINGLE, PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.kept_documents(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and whether they decode to
    the text, as digests of both."""
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                     public_tokenizers.PATTERN, decode=True, cache_words=CACHE_WORDS)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: the trained stage and the hashed one cannot be written in SQL; tests hold the stages
#: against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
