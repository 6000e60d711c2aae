"""The bounded labelled sample: the rows of smallest hash, found without sorting all."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.llm import toxicity


def test_sample_is_the_rows_of_smallest_hash(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_LABELLED", 50)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    for n in (2000, 80, 52, 40):  # the bound binds by far, hardly, and not at all
        own = labels.filter(F.col("doc_id") < n)
        got = {r.doc_id for r in toxicity._labelled(docs, own).collect()}
        learnt = own.filter(toxicity.fold(F.col("doc_id")) != toxicity.HELD_OUT)
        want = {r.doc_id for r in learnt.orderBy(F.xxhash64("doc_id")).limit(50).collect()}
        assert got == want
