"""One query per operator, over the whole of its table, with production parameters.
The queries derive the contracts' digest columns from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (
    bpe,
    centroids,
    chat_format,
    decontaminate,
    embedding_dedup,
    exact_dedup,
    line_dedup,
    lm_score,
    near_dedup,
    periodic,
    pii,
    toxicity,
    url_filter,
)
from vigil.llm.common import fold, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _sha(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def _spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string"))), ",")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda k: k == kind


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(read_table(spark, sf_dir, "documents"))
    spans = F.arrays_zip("kinds", "starts", "ends")
    base = F.filter(spans, lambda s: s["kinds"].isin(*pii.BASE_KINDS))
    counts = [F.size(F.array_remove(F.transform("kinds", _is(kind)), False)).cast("long")
              .alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, _sha(_spans(base)).alias("base_sha256"),
                        _spans(spans).alias("spans"),
                        F.array_join(F.transform("scores", lambda x: F.format_string("%.2f", x)),
                                     ",").alias("scores"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex.scratch(spark)
    rows = index.ingest(read_table(spark, sf_dir, "documents"), "documents")
    return rows.select("doc_id", "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair(read_table(spark, sf_dir, "conversations"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", _sha(F.col("text")).alias("kept_sha256"))


RULES = [
    url_filter.Rule(True, "com"),
    url_filter.Rule(False, "example.com", "/en/"),
    url_filter.Rule(True, "www.example.com", "/en/"),
    url_filter.Rule(False, "net", "/es/"),
    url_filter.Rule(False, "net", "/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), RULES)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"),
                                      read_table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == toxicity.HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "evidence", "n_passages")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm_score.score(docs, fold(docs["doc_id"]) == 1)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.NearDuplicates(read_table(spark, sf_dir, "documents"), k=3, percent=85)
    return found.documents().select("doc_id", "n_shingles", "component_id", "kept")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(read_table(spark, sf_dir, "documents"),
                     public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                     decode=True)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64,
                             scale=1024, seed=3)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(read_table(spark, sf_dir, "documents"), periodic.planted)
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        _sha(F.array_join(line, "")).alias("runs_sha256"),
                        _sha(F.col("collapsed")).alias("collapsed_sha256"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.NearVectors(read_table(spark, sf_dir, "embeddings"), cosine=0.98)
    return found.documents().select("vec_id", "n_links", "component_id", "kept")


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_line_dedup": op4_line_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_lm_score": op8_lm_score,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_bpe": op10_bpe,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}
