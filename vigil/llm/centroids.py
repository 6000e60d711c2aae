"""Centroid clustering of vectors with a VA-file.

Vectors are turned into integers once and written twice: whole (bucketed by row number) and
as approximations, a cell number of BITS bits per component. A component's cells end at the
quantiles of its values, so outliers do not widen the cells of the rest. For every centroid
a lookup table gives the least and greatest squared difference between its component and
the values of a cell; their sums over the components are an interval that holds the squared
distance. A vector whose intervals leave one centroid is assigned by its approximation; only
where intervals overlap is the whole vector fetched and compared exactly.

A round reads the approximations and needs the whole vectors only of rows that are open
under the last or the present centroids, or that move: the clusters' sums are kept and
changed by the moved vectors. A cluster's number under the last centroids is computed again
from the same approximations, so no assignments are written between rounds. Row numbers
of the open rows are shuffled into the buckets of the whole vectors, which never move. The
first sums and the final distances take one pass over the whole vectors each. The driver
holds the cells' borders, the centroids and the sums, whose sizes do not depend on the number
of vectors. All arithmetic is on integers, hence exact and independent of partitions.

Defined results
* vectors that are null, of another length, or hold null or non-finite components are not
  kept and give no rows
* the first centroids are the ``k`` kept vectors with the smallest hashes of their ids (a null
  id counts as empty text), ties by components; with fewer vectors there are fewer centroids
* equal distances go to the smaller cluster number; an empty cluster keeps its centroid; when
  no centroid changes, the remaining rounds would change nothing and are left out
* components of more than 2^27 units raise an error, as their distances might not fit a long
* repeated rows are vectors of their own; an empty table gives no rows; other columns are not
  read
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import delete_scratch, fixed, map_arrow
from vigil.session import scratch_dir

#: bits of a cell number
BITS = 8
#: relative rank error of the cells' borders is 1 / ACCURACY
ACCURACY = 1000
#: largest absolute component
LIMIT = 2**27

_SUMS = "cluster int, n long, sums array<long>"
RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")


def integers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id, q (floor(scale x component)) of the vectors that are kept."""
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(vectors["vec_id"].cast("long").alias("vec_id"),
                           vectors["embedding"].cast("array<double>").alias("e"))
            .filter((F.size("e") == dims) & ~bad)
            .select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("int")).alias("q")))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims).astype(np.int64)


class Cells:
    """Borders of every component's cells: cell c holds borders[c - 1] <= x < borders[c]."""

    def __init__(self, borders: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int):
        self.borders, self.bits = borders, bits
        self.low = np.concatenate([low[:, None], borders], axis=1)
        self.high = np.concatenate([borders - 1, high[:, None]], axis=1)

    @classmethod
    def of(cls, vectors: DataFrame, dims: int, bits: int) -> "Cells":
        marks = [i / 2**bits for i in range(1, 2**bits)]
        found = vectors.agg(*[f for i in range(dims) for f in (
            F.percentile_approx(F.col("q")[i], marks, ACCURACY).alias(f"b{i}"),
            F.min(F.col("q")[i]).alias(f"l{i}"), F.max(F.col("q")[i]).alias(f"h{i}"))]).first()
        low, high = (np.array([found[f"{c}{i}"] for i in range(dims)], np.int64) for c in "lh")
        if max(-low.min(), high.max()) > LIMIT:
            raise ValueError(f"a component exceeds {LIMIT} units")
        return cls(np.array([found[f"b{i}"] for i in range(dims)], np.int64), low, high, bits)

    def encode(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, rows[:, i], "right")
                         for i, b in enumerate(self.borders)], axis=1).astype(np.uint8)

    def pack(self, cells: np.ndarray) -> list[bytes]:
        bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits:]
        return [row.tobytes() for row in np.packbits(bits.reshape(len(cells), -1), axis=1)]

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        n = len(self.borders)
        bits = np.unpackbits(raw, axis=1)[:, :n * self.bits].reshape(len(packed), n, self.bits)
        return bits @ (1 << np.arange(self.bits - 1, -1, -1))

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference by component, cell and centroid, less that
        to the centroids' mean m: (x - z)^2 - (x - m)^2 is linear in x, so a cell's ends give
        its extremes."""
        z = centroids.T[:, None, :]
        mean = centroids.sum(axis=0)[:, None, None] // len(centroids)
        ends = [(mean - z) * (2 * x[:, :, None] - z - mean) for x in (self.low, self.high)]
        return np.minimum(*ends), np.maximum(*ends)


def decide(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The cluster of every vector whose distance intervals leave one, -1 for the others."""
    at = np.arange(cells.shape[1])
    least, most = (t[at, cells].sum(axis=1) for t in tables)
    near = least <= most.min(axis=1, keepdims=True)
    return np.where(near.sum(axis=1) == 1, near.argmax(axis=1), -1)


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([((rows - z) ** 2).sum(axis=1) for z in centroids], axis=1)


def assign(rows: np.ndarray, cells: np.ndarray, centroids: np.ndarray,
           tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The nearest centroid of every row, by its approximation where that decides."""
    cluster = decide(cells, tables)
    open_ = np.flatnonzero(cluster < 0)
    cluster[open_] = distances(rows[open_], centroids).argmin(axis=1)
    return cluster


def _approximate(cells: Cells, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = cells.pack(cells.encode(_rows(batch.column(1), dims)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())],
                                             ["rid", "cells"])
    return run


def _open_rows(cells: Cells, old: np.ndarray, new: np.ndarray):
    """rid, cells -> rid of the rows that move or that the approximation leaves open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(old), cells.tables(new)
        for batch in batches:
            own = cells.unpack(batch.column(1).to_pylist())
            before, now = (decide(own, t) for t in tables)
            settled = (before == now) & (now >= 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(~settled))], ["rid"])
    return run


def _summed(cells: Cells, old: np.ndarray | None, new: np.ndarray):
    """q -> what the rows add to every cluster's number and sums when the centroids ``old``
    (none at first) give way to ``new``."""
    k, dims = new.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(new)
        before = None if old is None else cells.tables(old)
        sums, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            rows = _rows(batch.column(0), dims)
            own = cells.encode(rows)
            moves = [(assign(rows, own, new, tables), 1)]
            if before is not None:
                moves.append((assign(rows, own, old, before), -1))
            for cluster, sign in moves:
                for c in range(k):
                    sums[c] += sign * rows[cluster == c].sum(axis=0)
                count += sign * np.bincount(cluster, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(count, pa.int64()),
             pa.array(list(sums), pa.list_(pa.int64()))], ["cluster", "n", "sums"])
    return run


def _final(cells: Cells, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(centroids)
        for batch in batches:
            rows = _rows(batch.column(1), centroids.shape[1])
            cluster = assign(rows, cells.encode(rows), centroids, tables)
            distance = ((rows - centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"])
    return run


class VaFile:
    """Whole vectors and their approximations in the session's shared folder."""

    def __init__(self, vectors: DataFrame, dims: int, scale: int):
        spark = self.spark = vectors.sparkSession
        self.dims, self.path = dims, scratch_dir(spark, "va-file")
        self.table = f"va_file_{uuid.uuid4().hex}"
        n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        numbered = integers(vectors, dims, scale).select(
            F.monotonically_increasing_id().alias("rid"), "vec_id", "q")
        (numbered.repartition(n_buckets, "rid").sortWithinPartitions("rid").write
         .format("parquet").option("path", f"{self.path}/whole")
         .bucketBy(n_buckets, "rid").sortBy("rid").saveAsTable(self.table))
        self.whole = spark.table(self.table)

    def approximate(self, bits: int) -> None:
        self.cells = Cells.of(self.whole, self.dims, bits)
        place = f"{self.path}/approximations"
        map_arrow(self.whole.select("rid", "q"), _approximate(self.cells, self.dims),
                  "rid long, cells binary").write.parquet(place)
        self.approximations = self.spark.read.schema("rid long, cells binary").parquet(place)

    def first_centroids(self, k: int, seed: int) -> np.ndarray:
        name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
        first = (self.whole.select(F.sha2(name.cast("binary"), 256).alias("h"), "q")
                 .orderBy("h", "q").limit(k).collect())
        return np.array([r["q"] for r in first], np.int64).reshape(len(first), self.dims)

    def _total(self, parts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums and number of every cluster: k x dims values."""
        found = (parts.select("cluster", "n", F.posexplode("sums").alias("i", "x"))
                 .groupBy("cluster", "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
                 .collect())
        sums, count = np.zeros((k, self.dims), np.int64), np.zeros(k, np.int64)
        for r in found:
            sums[r["cluster"], r["i"]], count[r["cluster"]] = r["x"], r["n"]
        return sums, count

    def sums(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every cluster's sums and number, from all whole vectors."""
        return self._total(map_arrow(self.whole.select("q"),
                                     _summed(self.cells, None, centroids), _SUMS),
                           len(centroids))

    def open_rows(self, old: np.ndarray, new: np.ndarray) -> DataFrame:
        return map_arrow(self.approximations, _open_rows(self.cells, old, new), "rid long")

    def changes(self, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the vectors that move add to the sums and numbers."""
        fetched = self.whole.select("rid", "q").join(self.open_rows(old, new), "rid").select("q")
        return self._total(map_arrow(fetched, _summed(self.cells, old, new), _SUMS), len(new))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.table}")
        delete_scratch(self.spark, self.path)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64,
            scale: int = 1024, seed: int = 3, bits: int = BITS) -> DataFrame:
    """vec_id, cluster, distance (squared, in units of 1 / scale), cluster_inertia, inertia and
    the centroid's digest per kept vector."""
    spark = vectors.sparkSession
    file = VaFile(vectors, dims, scale)
    centroids = file.first_centroids(k, seed)
    if not len(centroids):
        file.drop()
        return spark.createDataFrame([], RESULT)
    file.approximate(bits)
    old, sums, count = None, None, None
    for _ in range(rounds):
        if old is None:
            sums, count = file.sums(centroids)
        elif (old == centroids).all():
            break
        else:
            more_sums, more = file.changes(old, centroids)
            sums, count = sums + more_sums, count + more
        old = centroids
        centroids = np.where(count[:, None] > 0, sums // np.maximum(count, 1)[:, None], old)
    found = fixed(map_arrow(file.whole.select("vec_id", "q"), _final(file.cells, centroids),
                            "vec_id long, cluster int, distance long"))
    file.drop()
    return _with_inertia(found, centroids)


def _with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The clusters' sums and digests, one literal row per centroid, joined to the vectors."""
    by_cluster = {r["cluster"]: r["s"] for r in
                  found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(by_cluster.values())
    rows = [(c, s, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode())
             .hexdigest()) for c, s in by_cluster.items()]
    clusters = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
