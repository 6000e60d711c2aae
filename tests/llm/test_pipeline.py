"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_llm_small import VOCABULARY, WORDS, brute_components, brute_tiles, lower, pairs, words

import corpus_pipeline
from vigil.llm import bpe, decontaminate, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    items = [" ".join(words(rnd, 25)) for _ in range(4)]
    rows, labels = [], []
    for i in range(240):
        text = words(rnd, 40)
        if i % 6 == 0:
            for _ in range(4):
                text.insert(rnd.randrange(40), rnd.choice(["vile", "scorn"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[i][1].upper()) for i in range(1, 12)]  # exact copies
    for i in range(12, 24):  # near copies
        near = rows[i][1].split()
        near[3] = rnd.choice(WORDS) + "x"
        rows.append((2000 + i, " ".join(near)))
    rows += [(3000 + i, f"zz {t} yy") for i, t in enumerate(items)]
    rows += [(4000, None), (4001, ""), (4001, ""), (4002, "x " * 3000)]
    d = str(tmp_path_factory.mktemp("tables"))
    own = "doc_id long, text string"
    docs = spark.createDataFrame(rows, own).withColumn("lang", F.lit("en")).withColumn(
        "source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(
        f"{d}/benchmark.parquet")
    return d


def brute_stage(name, spark, docs, d):
    own = pairs(docs)
    if name == "toxicity":
        model = toxicity.fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
        bad = {i for i, t in own if toxicity._probability(
            toxicity.evidence(toxicity.tokens_of(t), model)[0], model.curve) >= 0.5}
        assert {i for i in range(0, 240, 6)} == {i for i in bad if i < 240}
        return [i for i, _ in own if i not in bad]
    if name == "exact_dedup":
        return list({lower(t): i for i, t in sorted(own)}.values())
    if name == "minhash_near_dedup":
        return [i for i, _, _, kept in brute_components(own, 5, 80) if kept]
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(
        f"{d}/benchmark.parquet").collect()]
    number = {w: n for n, w in enumerate(sorted({w for x in items for w in x}))}

    def clean(text):
        doc = [number.get(w, -1) for w in decontaminate.words_of(text)]
        return len(doc) > 2000 or all(
            2 * sum(t[2] for t in brute_tiles(doc, [number[w] for w in x], 5)) < len(x) for x in items)

    return [i for i, t in own if clean(t)]


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "minhash_near_dedup", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        want = brute_stage(name, spark, docs, folder)
        docs = spark.read.parquet(path)
        assert sorted(r.doc_id for r in docs.collect()) == sorted(want), name
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={t: i for i, t in enumerate(bpe.load_ranks(VOCABULARY))})
    want = {(i, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in pairs(docs)}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r.doc_id, bytes(r.ids)) for r in got} == want and len(got) == len(want)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


class _Shared:
    value = bpe.load_ranks(VOCABULARY)


def test_encoding_in_bounded_memory():
    """A worker holds one encoder and as many bytes of words as it was told, with the same ids."""
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choices("abcdefgh", k=9)) for _ in range(200)) for _ in range(60)]
    batches = [pa.record_batch([pa.array(range(i, i + 10)), pa.array(texts[i:i + 10])],
                               ["doc_id", "text"]) for i in range(0, 60, 10)]

    def ids(cache_words):
        run = bpe._run(_Shared(), public_tokenizers.PATTERN, False, cache_words)
        return [x for batch in run(iter(batches)) for x in batch.column(1).to_pylist()]

    want = ids(bpe.CACHE_WORDS)
    assert ids(5_000) == want
    assert bpe._encoder.cache_info().currsize == 1
    encoder = bpe.Encoder(_Shared.value, public_tokenizers.PATTERN, 5_000)
    for batch in batches:
        encoder.encode(batch.column(1).to_pylist())
    # what a learnt batch adds comes on top; all 60 texts have 120,000 bytes of words
    assert encoder.cached_words < 45_000
    assert corpus_pipeline.CACHE_WORDS < bpe.CACHE_WORDS
