"""Near copies that meet only in buckets of several hundred dissimilar classes."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from test_llm_small import WORDS, brute_components, words

import corpus_pipeline
from vigil.llm import near_dedup

BINS = near_dedup.BANDS * near_dedup.ROWS


def passage(rnd: random.Random, k: int) -> list[str]:
    """Words whose shingles hold a very small hash of every bin, so that all documents with
    them agree in all bands."""
    pool = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(400_000)]
    one = {w: xxhash.xxh3_64_intdigest(w.encode()) for w in set(pool)}
    h = np.array([one[w] for w in pool], np.uint64)
    total = np.zeros(len(pool) - k + 1, np.uint64)
    for i in range(k):
        total = near_dedup._mix(total + h[i:i + len(total)])
    order = np.argsort(total)
    bounds = near_dedup._tables(BINS)[0]
    starts = order[np.searchsorted(total[order], bounds)]
    return [w for s in starts for w in pool[s:s + k]]


def templated(k: int) -> list[tuple[int, str]]:
    rnd = random.Random(k)
    shared = passage(rnd, k)
    rows = [(i, shared + words(rnd, len(shared) * 3 // 4)) for i in range(300)]
    for i in range(40, 46):
        near = list(rows[i][1])
        near[-7] += "x"
        rows.append((1000 + i, near))
    return [(i, " ".join(t)) for i, t in rows]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)])
def test_pairs_in_one_large_bucket(spark, monkeypatch, k, percent):
    monkeypatch.setattr(near_dedup, "STARS", 1)
    rows = templated(k)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, k, percent)
    assert sum(not r[3] for r in want) == 6
    got = near_dedup.NearDuplicates(table, k, percent)
    sizes = [r["n"] for r in got._members().groupBy("bucket").count().withColumnRenamed(
        "count", "n").collect()]
    assert sum(n > near_dedup.SMALL_BUCKET for n in sizes) == near_dedup.BANDS
    got = got.documents().select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == Counter(want)
    if k == corpus_pipeline.SHINGLE:
        kept = corpus_pipeline.drop_near_copies(spark, table, "")
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in want if r[3])


def test_exact_join_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "STARS", 1)
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rnd = random.Random(4)
    pool = [" ".join(words(rnd, 12)) for _ in range(9)]
    rows = [(i, " ".join(rnd.sample(pool, 7))) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " tail") for i in range(0, 120, 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.NearDuplicates(table, 3, 85).documents()
    got = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == Counter(brute_components(rows, 3, 85))
