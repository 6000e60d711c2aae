"""Centroid clustering against exact arithmetic over all vectors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from vigil.llm import centroids as C
from vigil.llm.queries import op11_centroid_clustering

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance long, rid int"


def brute(rows, dims=64, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == dims
            and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), q)
                   for i, q in kept)[:k]
    z = [q for _, q in first]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), i) for i, c in enumerate(z))

    for _ in range(rounds):
        own = [nearest(q)[1] for _, q in kept]
        for c in range(len(z)):
            rows_of = [q for (_, q), o in zip(kept, own) if o == c]
            if rows_of:
                z[c] = [sum(col) // len(rows_of) for col in zip(*rows_of)]
    last = [nearest(q) for _, q in kept]
    total = sum(d for d, _ in last)
    by = {c: sum(d for d, o in last if o == c) for c in range(len(z))}
    return sorted(((i, c, d, by[c], total,
                    hashlib.sha256(",".join(map(str, z[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, last)), key=str)


def awkward(seed, n=150, dims=64):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, dims)) / 8
    rows = [[i * 3, (centres[i % 5] + rng.standard_normal(dims) * 0.02).tolist()] for i in range(n)]
    rows += [[2000 + i, rows[4][1]] for i in range(30)] + [rows[7]] * 4
    rows += [[3000, [0.0] * dims], [3001, [-0.5] * dims], [None, rows[9][1]], [None, None],
             [3002, [900.25] + [0.0] * (dims - 1)],
             [3003, None], [3004, []], [3005, rows[0][1][:-1]], [3006, rows[0][1] + [0.0]],
             [3007, [None] + rows[0][1][1:]], [3008, [float("nan")] + rows[0][1][1:]],
             [3009, [float("-inf")] + rows[0][1][1:]]]
    return [(*r, "x", 1, 2) for r in rows]


def test_query_on_awkward_rows(spark, tmp_path):
    rows = awkward(1)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op11_centroid_clustering(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("va_file_")]


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_cells_change_no_result(spark, bits):
    rows = awkward(2, n=60, dims=5)
    got = C.cluster(spark.createDataFrame(rows, SCHEMA), dims=5, k=4, rounds=6, bits=bits)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, dims=5, k=4, rounds=6)


def test_ties_and_fewer_vectors_than_centroids(spark, tmp_path):
    rows = [(i, [float(i % 3)] + [0.0] * 63, "x", 1, 2) for i in range(5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, op11_centroid_clustering(spark, str(tmp_path)).collect()),
                  key=str) == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op11_centroid_clustering(spark, str(tmp_path))
    assert got.collect() == [] and got.columns[0] == "vec_id"


def test_too_large_components_are_refused(spark):
    rows = [(1, [1e6] * 64, "x", 1, 2)]
    with pytest.raises(ValueError, match="exceeds"):
        C.cluster(spark.createDataFrame(rows, SCHEMA))


def test_intervals_hold_the_distance_and_mostly_decide():
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (8, 64))
    rows = centres[rng.integers(0, 8, 500)] + rng.integers(-40, 40, (500, 64))
    borders = np.quantile(rows, [i / 64 for i in range(1, 64)], axis=0).astype(np.int64).T
    cells = C.Cells(borders, rows.min(0), rows.max(0), 6)
    own = cells.encode(rows)
    assert (cells.unpack(cells.pack(own)) == own).all()
    exact = C.distances(rows, centres)
    least, most = (t[np.arange(64), own].sum(axis=1) for t in cells.tables(centres))
    exact = exact - ((rows - centres.sum(0) // 8) ** 2).sum(1)[:, None]
    assert (least <= exact).all() and (exact <= most).all()
    decided = C.decide(own, cells.tables(centres))
    assert (decided >= 0).mean() > 0.9
    assert (decided[decided >= 0] == exact.argmin(1)[decided >= 0]).all()
