"""Benchmark decontamination by greedy string tiling.

The benchmark's items, the stated query set, are taken in blocks of bounded size; each
block is broadcast and joined with every document by shared seeds (hashes of
``min_match`` words running over the text). An item whose words covered by seeds do not
reach the threshold cannot pass; for the others the longest common passage of unmarked
words is found by running Karp-Rabin hashes, marked in both texts, and so on until none
of ``min_match`` words is left. Tiles may stand in any order, so reordered passages are
caught. Documents are independent of each other: no shuffle, no text moves.

Defined results
* words are runs of letters, digits and underscores, lower-cased
* coverage is the share of an item's words in tiles; a document with an item of at least
  ``threshold`` coverage is contaminated
* among equally long passages the first in the item, then the first in the document is
  taken
* items of fewer than ``min_match`` words, null or empty items match nothing; repeated
  items are judged each; null or empty texts are clean; an empty table or benchmark gives
  no hits; repeated rows give repeated hits; other columns are not read
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import map_arrow, unwrapped, wrapped

#: characters of benchmark text in one broadcast block at most (an item longer than
#: this is a block of its own)
BLOCK_CHARS = 4_000_000
HITS = "doc_id long, item_id long, coverage double, n_tiles int, longest_tile int"
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _scatter(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def running_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash (modulo 2^64) of every window of ``length`` ids, by doubling:
    the hash of 2n words is that of the first n times base^n plus that of the next n."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done = np.zeros(n, np.uint64), 0
    power, size, weight = _scatter(ids), 1, _BASE
    with np.errstate(over="ignore"):
        rest = length
        while rest:
            if rest & 1:
                total = total * weight + power[done:done + n]
                done += size
            rest >>= 1
            if rest:
                power = power[:-size] * weight + power[size:]
                size, weight = size * 2, weight * weight
    return total


def _common(doc: np.ndarray, item: np.ndarray, length: int) -> tuple[int, int] | None:
    """First place in the item, then in the document, of a common unmarked window.
    Marked words are negative and differ between the texts, so they match nothing."""
    h_item, h_doc = running_hashes(item, length), running_hashes(doc, length)
    for i in np.flatnonzero(np.isin(h_item, h_doc)):
        for d in np.flatnonzero(h_doc == h_item[i]):
            if np.array_equal(doc[d:d + length], item[i:i + length]):
                return int(d), int(i)
    return None


def tile(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, length), longest first."""
    doc, item, tiles = doc.astype(np.int64), item.astype(np.int64), []
    most = min(len(doc), len(item))
    while most >= min_match:
        low, high, best = min_match - 1, most, None
        while low < high:  # a common window of n words holds common windows of fewer
            middle = (low + high + 1) // 2
            found = _common(doc, item, middle)
            if found:
                low, best = middle, found
            else:
                high = middle - 1
        if best is None:
            break
        d, i = best
        tiles.append((d, i, low))
        doc[d:d + low], item[i:i + low] = -2, -3
        most = low
    return tiles


class _Block:
    """Items of one block: word numbers, and the seeds with the items that have them."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.min_match = min_match
        self.number: dict[str, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        hashes, owners = [], []
        for item_id, text in items:
            words = words_of(text)
            if len(words) < min_match:
                continue
            ids = np.array([self.number.setdefault(w, len(self.number)) for w in words])
            h = np.unique(running_hashes(ids, min_match))
            hashes.append(h)
            owners.append(np.full(len(h), len(self.items)))
            self.items.append((item_id, ids))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.seeds = h[order]
        self.owners = np.concatenate(owners)[order] if hashes else np.zeros(0, np.int64)

    def hits(self, text: str | None, threshold: float) -> list[tuple]:
        """(item_id, coverage, tiles, longest tile) of the items that the text holds."""
        get, k = self.number.get, self.min_match
        words = words_of(text)
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        if len(ids) < k or not len(self.seeds):
            return []
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        places = np.flatnonzero(known[k:] - known[:-k] == k)
        if not len(places):
            return []
        h = running_hashes(ids, k)[places]
        lo = np.searchsorted(self.seeds, h, "left")
        hi = np.searchsorted(self.seeds, h, "right")
        places, lo, hi = places[hi > lo], lo[hi > lo], hi[hi > lo]
        if not len(places):
            return []
        # only words in some seed can be in a tile; the others are cut out and leave a mark
        inside = np.zeros(len(ids) + 1, np.int64)
        np.add.at(inside, places, 1)
        np.add.at(inside, places + k, -1)
        inside = np.cumsum(inside)[:-1] > 0
        edge = inside & ~np.concatenate([[False], inside[:-1]])
        seeded = np.insert(ids[inside], np.flatnonzero(edge[inside]), -1)
        shared = np.unique(running_hashes(seeded, k))
        out = []
        for n in np.unique(np.concatenate([self.owners[a:b] for a, b in set(zip(lo, hi))])):
            item_id, item = self.items[n]
            at = np.flatnonzero(np.isin(running_hashes(item, k), shared))
            reach = np.zeros(len(item) + 1, np.int64)
            np.add.at(reach, at, 1)
            np.add.at(reach, at + k, -1)
            if np.count_nonzero(np.cumsum(reach)[:-1]) < threshold * len(item):
                continue  # tiles cover no more than the seeds do
            tiles = tile(seeded, item, k)
            coverage = sum(t[2] for t in tiles) / len(item)
            if tiles and coverage >= threshold:
                out.append((item_id, coverage, len(tiles), tiles[0][2]))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of at most BLOCK_CHARS, one partition at the driver at a time."""
    block, chars = [], 0
    for row in (benchmark.select(F.col("item_id").cast("long"), "text")
                .filter(F.col("text").isNotNull()).toLocalIterator()):
        if block and chars + len(row[1]) > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((row[0], row[1]))
        chars += len(row[1])
    if block:
        yield block


@lru_cache(maxsize=2)
def _block(shared) -> _Block:
    return _Block(*shared.value)


def _search(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _block(shared)
        for batch in batches:
            rows = [(doc_id, *hit) for doc_id, text in
                    zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for hit in block.hits(text, threshold)]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()))],
                ["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 5,
                 threshold: float = 0.5) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest_tile of every document and item whose
    coverage reaches the threshold."""
    spark = docs.sparkSession
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    parts = [map_arrow(texts, _search(spark.sparkContext.broadcast((b, min_match)), threshold),
                       HITS) for b in _blocks(benchmark)]
    if not parts:
        return spark.createDataFrame([], HITS)
    return reduce(DataFrame.unionByName, parts)


def _clean(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _block(shared)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            keep = pa.array([not block.hits(t, threshold) for t in texts], pa.bool_())
            yield batch.filter(keep)
    return run


def kept_documents(docs: DataFrame, benchmark: DataFrame, min_match: int = 5,
                   threshold: float = 0.5) -> DataFrame:
    """The documents (all columns) that hold no item: each block's pass filters the rows
    that the one before left, in place."""
    spark = docs.sparkSession
    rows = wrapped(docs, docs["text"].alias("_text"))
    for b in _blocks(benchmark):
        shared = spark.sparkContext.broadcast((b, min_match))
        rows = map_arrow(rows, _clean(shared, threshold), rows.schema)
    return unwrapped(rows)
