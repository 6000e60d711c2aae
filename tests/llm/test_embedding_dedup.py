"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from vigil.llm.embedding_dedup import NearVectors, buckets, unit
from vigil.llm.queries import op13_embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, bucket int"


def linkable(v):
    return v is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, cosine=0.98):
    """n_links and component_id per row from all pairs."""
    vecs = [(np.array(r[1], np.float32).astype(float) if linkable(r[1]) and r[2] is not None
             else None) for r in rows]
    near = [[] for _ in rows]
    for i, a in enumerate(vecs):
        for j in range(i):
            b = vecs[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2]:
                continue
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i, r in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            front = [k for j in front for k in near[j] if k not in seen and not seen.add(k)]
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        low = min(ids, default=None)
        out.append((r[0], len(near[i]), low, r[0] == low))
    return sorted(out, key=str)


def around(rng, centre, n, spread):
    return [centre + spread * rng.standard_normal(len(centre)) / math.sqrt(len(centre))
            for _ in range(n)]


def awkward(rng):
    rows = []
    for label in (0, 1, None):
        for _ in range(25):
            rows.append([len(rows) * 3, unit(rng.standard_normal((1, 64)))[0].tolist(), label])
    hot = unit(rng.standard_normal((1, 64)))[0]
    for v in around(rng, hot, 60, 0.1):
        rows.append([len(rows) * 3, v.tolist(), 0])
    chain = hot
    for _ in range(20):
        chain = unit((chain + 0.17 * unit(rng.standard_normal((1, 64)))[0])[None, :])[0]
        rows.append([len(rows) * 3, (chain * 40).tolist(), 1])
    same = hot.tolist()
    rows += [[1000 + i, same, i % 2] for i in range(40)] + [[7, same, 0]] * 3
    rows += [[None, same, 1], [None, rows[0][1], 0], [None, None, 1]]
    rows += [[2000, None, 0], [2001, [], 0], [2002, [0.0] * 64, 0], [2003, [0.0] * 64, 0],
             [2004, [None] + same[1:], 0], [2005, [float("nan")] + same[1:], 0],
             [2006, [float("inf")] + same[1:], 0], [2007, same[:32], 0], [2008, same[:32], 0],
             [2009, [1e30] * 8, 0], [2010, [1e-30] * 8, 0], [2011, [-0.0, 1.0], 3],
             [2012, [0.0, 1.0], 3]]
    return [(*r, "x", i) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 7])
def test_links_and_components(spark, block):
    rows = awkward(np.random.default_rng(5))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = NearVectors(df, block=block).documents().select(
        "vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_query_reads_the_table(spark, tmp_path):
    rows = awkward(np.random.default_rng(6))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_embedding_near_dedup(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op13_embedding_near_dedup(spark, str(tmp_path)).collect() == []


def test_pairs_at_the_threshold_are_found():
    """Recall over pairs of cosine 0.98 exactly, where it is least."""
    rng = np.random.default_rng(0)
    a = unit(rng.standard_normal((4000, 64)))
    side = rng.standard_normal((4000, 64))
    side = unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * side
    assert (buckets(a) == buckets(b)).any(axis=1).mean() > 0.99
    assert (buckets(a) == buckets(side)).mean() < 1e-4
