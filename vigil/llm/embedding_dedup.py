"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors of one label are compared. Each is scaled to length one; a hash is the number of
the cell of width WIDTH in which its projection on a random Gaussian direction, moved by a
random offset, falls. HASHES such cells, with the label, make a bucket; every vector is in
one bucket of each of TABLES tables. Equal vectors of one label are one class, and all
further work is on classes.

Two vectors of cosine 0.98 are at most 0.2 apart and share one cell with probability
1 - 2 Phi(-8) - 2 / (8 sqrt(2 pi)) (1 - exp(-32)) = 0.900, a bucket with 0.900^14 = 0.23, and
miss all tables with 0.77^24 = 0.002; closer pairs miss less. Unrelated vectors (1.41 apart)
share a bucket with 0.41^14 = 4e-6. With far more than a million vectors a label, HASHES and
TABLES should grow with the logarithm of their number and the inverse of that probability.

Members of a bucket are compared in blocks: a bucket of s classes has ceil(s / BLOCK) parts
and every pair of parts is a block, one matrix product in one task. A block returns one row
per member with links: how many vectors it is linked with, and the smallest member of
its part of the block's link graph, so no pairs are written. A pair that shares buckets of
several tables is counted in the first. The work in a bucket grows with the square of its
size, as the exact number of links in a large group of near copies does.

Defined results
* vectors that are null, empty, zero or hold null or non-finite components, and those with
  a null label, link with nothing; vectors of different lengths are not linked
* n_links counts the other rows linked directly: equal vectors of the same label count, and
  so do repeated rows
* component_id is the smallest vec_id reachable by links; kept marks the rows with that id;
  a null vec_id is ignored in the minimum; if all of a component are null, component_id is
  null and the rows are kept
* an empty table gives no rows; other columns are not read
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import fixed, join_counted, map_arrow
from vigil.llm.components import components

#: cells of a bucket, tables, and the width of a cell
HASHES, TABLES, WIDTH = 14, 24, 1.6
#: classes in one part of a bucket
BLOCK = 512
#: stands for a null id in joins
NO_ID = -(2**63)

_KEYED = "vec_id long, rid long, cls binary, buckets array<long>"
_FOUND = "cid long, root long, n_links long"


@lru_cache(maxsize=8)
def _projections(dims: int, hashes: int, tables: int) -> tuple[np.ndarray, ...]:
    """Directions, offsets (in cells) and odd multipliers, the same in every task."""
    rng = np.random.default_rng([dims, hashes, tables])
    directions = rng.standard_normal((dims, tables * hashes))
    offsets = rng.random(tables * hashes)
    odd = rng.integers(0, 2**63, (tables, hashes), np.uint64) * np.uint64(2) + np.uint64(1)
    return directions, offsets, odd


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one, scaled first so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def buckets(rows: np.ndarray, hashes: int = HASHES, tables: int = TABLES,
            width: float = WIDTH) -> np.ndarray:
    """The bucket of every row of unit length in every table, as hashes of its cells."""
    directions, offsets, odd = _projections(rows.shape[1], hashes, tables)
    cells = np.floor(rows @ directions / width + offsets).astype(np.int64).view(np.uint64)
    mixed = (cells.reshape(len(rows), tables, hashes) * odd).sum(axis=2)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0x9E3779B97F4A7C15)


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """The column's vectors; None for those that cannot be linked."""
    found = []
    for x in column:
        v = x.values
        if v is None or not len(v) or v.null_count:
            found.append(None)
            continue
        v = v.to_numpy(zero_copy_only=False) + 0.0  # minus zero becomes zero
        found.append(v if np.isfinite(v).all() and v.any() else None)
    return found


def _key(label: str, vector: np.ndarray) -> bytes:
    return hashlib.blake2b(vector.tobytes(), key=hashlib.blake2b(
        label.encode(), digest_size=16).digest(), digest_size=16).digest()


def _linkable(batch: pa.RecordBatch) -> tuple[list[str | None], list[np.ndarray | None]]:
    labels = batch.column(2).to_pylist()
    vectors = [v if label is not None else None
               for label, v in zip(labels, _vectors(batch.column(3)))]
    return labels, vectors


def _keyed(hashes: int, tables: int, width: float):
    """vec_id, rid, label, embedding -> vec_id, rid, cls, buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = _linkable(batch)
            keys = [None if v is None else _key(x, v) for x, v in zip(labels, vectors)]
            found: list = [None] * len(keys)
            for dims in {len(v) for v in vectors if v is not None}:
                at = [i for i, v in enumerate(vectors) if v is not None and len(v) == dims]
                own = np.array([int.from_bytes(hashlib.blake2b(
                    f"{dims}:{labels[i]}".encode(), digest_size=8).digest()) for i in at], np.uint64)
                marks = buckets(unit(np.stack([vectors[i] for i in at])), hashes, tables, width)
                marks += own[:, None] + np.arange(tables, dtype=np.uint64) * np.uint64(2**61 - 1)
                for i, row in zip(at, marks.view(np.int64)):
                    found[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
                 pa.array(found, pa.list_(pa.int64()))], ["vec_id", "rid", "cls", "buckets"])
    return run


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, rid, label, embedding -> rid, cls, unit (doubles)."""
    for batch in batches:
        labels, vectors = _linkable(batch)
        at = [i for i, v in enumerate(vectors) if v is not None]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1).take(pa.array(at, pa.int64())),
             pa.array([_key(labels[i], vectors[i]) for i in at], pa.binary()),
             pa.array([unit(vectors[i][None, :])[0].tobytes() for i in at], pa.binary())],
            ["rid", "cls", "unit"])


def _groups(linked: np.ndarray) -> np.ndarray:
    """The component of every row of a symmetric link matrix, named by its first row."""
    name = np.full(len(linked), -1)
    for first in range(len(linked)):
        if name[first] >= 0:
            continue
        name[first] = first
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & (name < 0))
            name[front] = first
    return name


def _block(rows: list[tuple], table: int, cosine: float) -> Iterator[tuple[int, int, int]]:
    """cid, root, n_links of a block's members that have links. A row is (cid, part, n_docs,
    unit, buckets); only pairs of different parts count where there are two parts."""
    rows.sort()
    points = np.frombuffer(b"".join(r[3] for r in rows)).reshape(len(rows), -1)
    linked = points @ points.T >= cosine
    np.fill_diagonal(linked, False)
    if not linked.any():
        return
    part = np.array([r[1] for r in rows])
    if part.min() != part.max():
        linked &= part[:, None] != part
    if table:
        marks = np.array([r[4] for r in rows])[:, :table]
        a, b = np.nonzero(np.triu(linked))
        before = np.zeros(len(a), bool)
        for t in range(table):
            before |= marks[a, t] == marks[b, t]
        linked[a[before], b[before]] = linked[b[before], a[before]] = False
    weight = linked @ np.array([r[2] for r in rows], np.int64)
    name = _groups(linked)
    for i in np.flatnonzero(weight):
        yield rows[i][0], rows[name[i]][0], int(weight[i])


def _compare(cosine: float):
    """bucket, i, j, t, cid, part, n_docs, unit, buckets, sorted by the first three columns
    -> cid, root, n_links of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, rows = None, []
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for *key, t, cid, part, n_docs, point, marks in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if [*key, t] != open_key:
                    if len(rows) > 1:
                        out += _block(rows, open_key[3], cosine)
                    open_key, rows = [*key, t], []
                rows.append((cid, part, n_docs, point, marks))
            yield _rows_out(out)
        if len(rows) > 1:
            yield _rows_out(list(_block(rows, open_key[3], cosine)))
    return run


def _rows_out(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      ["cid", "root", "n_links"])


class NearVectors:
    """Classes and links of a table of vectors (vec_id, embedding, label)."""

    def __init__(self, vectors: DataFrame, cosine: float = 0.98, hashes: int = HASHES,
                 tables: int = TABLES, width: float = WIDTH, block: int = BLOCK):
        vec_id = vectors["vec_id"].cast("long")
        self._source = vectors.select(
            vec_id.alias("vec_id"), F.coalesce(vec_id, F.lit(NO_ID)).alias("rid"),
            vectors["label"].cast("string").alias("label"),
            vectors["embedding"].cast("array<double>").alias("embedding"))
        keyed = map_arrow(self._source, _keyed(hashes, tables, width), _KEYED)
        self.rows = keyed.select("vec_id", "cls")
        self.classes = fixed(
            keyed.filter(F.col("cls").isNotNull()).groupBy("cls")
            .agg(F.min("vec_id").alias("min_id"), F.min("rid").alias("rid"),
                 F.count(F.lit(1)).alias("n_docs"), F.any_value("buckets").alias("buckets"))
            .withColumn("cid", F.monotonically_increasing_id()))
        self.found = fixed(map_arrow(self._blocks(self._members(), block), _compare(cosine), _FOUND)
                           .groupBy("cid", "root").agg(F.sum("n_links").alias("n_links")))
        self.labels = components(self.found.select(F.col("cid").alias("a"),
                                                   F.col("root").alias("b")))

    def _members(self) -> DataFrame:
        """bucket, t, cid, size of the classes that share a bucket with another one."""
        members = self.classes.select(F.posexplode("buckets").alias("t", "bucket"), "cid")
        sizes = fixed(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
                      .filter("size > 1"))
        return fixed(join_counted(members, sizes, "bucket", "size"))

    def _blocks(self, members: DataFrame, block: int) -> DataFrame:
        """The members with their vectors, once for every block, block by block."""
        wanted = (self.classes.join(members.select("cid").distinct(), "cid", "left_semi")
                  .select("cid", "cls", "rid", "n_docs", "buckets"))
        units = map_arrow(self._source, _units, "rid long, cls binary, unit binary")
        known = fixed(wanted.join(units, ["cls", "rid"]).drop("cls", "rid")
                      .dropDuplicates(["cid"]))
        parts = F.ceil(F.col("size") / block)
        part = F.pmod(F.xxhash64("cid", "bucket"), parts)
        placed = (members.select("bucket", "t", "cid", part.alias("part"), F.explode(
                      F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
                  .join(known, "cid"))
        return (placed.select("bucket", F.least("part", "other").alias("i"),
                              F.greatest("part", "other").alias("j"), "t", "cid", "part",
                              "n_docs", "unit", "buckets")
                .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "t"))

    def documents(self) -> DataFrame:
        """vec_id, n_links, component_id, kept per row."""
        n_links = self.found.groupBy("cid").agg(F.sum("n_links").alias("others"))
        named = fixed(
            self.classes.drop("buckets", "rid").join(n_links, "cid", "left")
            .join(self.labels.withColumnRenamed("node", "cid"), "cid", "left")
            .select("cls", "min_id", "n_docs",
                    (F.coalesce("others", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
                    F.coalesce("root", "cid").alias("root")))
        ids = fixed(named.groupBy("root").agg(F.min("min_id").alias("component_id"),
                                              F.count(F.lit(1)).alias("n_classes")))
        classes = fixed(join_counted(named, ids, "root", "n_classes")
                        .select("cls", "component_id", "n_links", "n_docs"))
        columns: list[str | Column] = ["vec_id", "n_links", "component_id"]
        linked = join_counted(self.rows.filter(F.col("cls").isNotNull()), classes, "cls", "n_docs")
        alone = self.rows.filter(F.col("cls").isNull()).select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return (linked.select(*columns).unionByName(alone)
                .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
