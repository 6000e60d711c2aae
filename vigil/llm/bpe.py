"""Byte-level BPE encoding and decoding by replaying the merges over a corpus of words.

A task gathers the distinct chunks (white space run plus following word) of a batch of
texts that it has not met before, splits them by the tokenizer's pattern, and encodes
all their distinct words at once: an inverted index from token pair to word positions
is worked off in rank order, and each merge updates only the two touched neighbours.
Texts are then encoded by looking up their chunks. Rows are independent: no shuffle.

The vocabulary (a bounded file, see ``MAX_VOCABULARY``) is read by the driver from the
path given and broadcast.

Defined results
* a null text counts as empty; an empty text has no ids
* ids are what greedy lowest-rank-first, leftmost merging of each pattern match gives,
  special tokens apart; decoding gives the text's UTF-8 bytes back
* words of any length cost time in proportion to length x log(length)
* every row gives a row, repeated rows too; a null doc_id stays null; an empty table
  gives no rows; other columns are not read
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import map_arrow

#: tokens in a vocabulary file at most: ids must fit pair keys of 2 x 32 bits, and the
#: file is broadcast
MAX_VOCABULARY = 2_000_000
#: characters of cached chunks and bytes of cached words per worker; beyond the first only
#: the chunks of the texts at hand stay, beyond the second the older half of the words goes
CACHE_CHARS, CACHE_WORDS = 2_000_000, 12_000_000
#: texts are encoded in slices of about so many characters
SLICE_CHARS = 4_000_000

ENCODED = "doc_id long, ids binary"
ROUND_TRIP = "doc_id long, ids binary, decoded binary"


def load_ranks(path: str) -> list[bytes]:
    """The tokens by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    if len(pairs) > MAX_VOCABULARY:
        raise ValueError(f"{path}: more than {MAX_VOCABULARY} tokens")
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class MergeTable:
    """Ranks of tokens, and of every pair of tokens whose concatenation is one."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = rank = {t: i for i, t in enumerate(tokens)}
        self.pairs: dict[int, int] = {}
        for r, t in enumerate(tokens):
            for cut in range(1, len(t)):
                a, b = rank.get(t[:cut]), rank.get(t[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = r
        self.bytes_ = [rank[bytes([b])] for b in range(256)]

    def alone(self, ids: list[int]) -> list[int]:
        """Merge one word's ids, lowest rank first, leftmost first."""
        while len(ids) > 1:
            best = min((r, i) for i, r in enumerate(
                self.pairs.get(a << 32 | b, MAX_VOCABULARY) for a, b in zip(ids, ids[1:])))
            if best[0] == MAX_VOCABULARY:
                break
            ids[best[1]:best[1] + 2] = [best[0]]
        return ids

    def replay(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of all words, every merge applied in rank order over all of them."""
        words = list(words)
        out: dict[bytes, list[int]] = {}
        tok: list[int] = []
        nxt: list[int] = []
        prv: list[int] = []
        begins: list[tuple[int, bytes]] = []
        index: dict[int, list[int]] = {}
        pairs, bytes_, rank = self.pairs, self.bytes_, self.rank
        for w in words:
            whole = rank.get(w)
            if whole is not None:
                out[w] = [whole]
                continue
            if not w:
                out[w] = []
                continue
            at = len(tok)
            begins.append((at, w))
            ids = [bytes_[b] for b in w]
            tok += ids
            nxt += range(at + 1, at + len(ids))
            nxt.append(-1)
            prv.append(-1)
            prv += range(at, at + len(ids) - 1)
            a = ids[0]
            for i, b in enumerate(ids[1:], at):
                r = pairs.get(a << 32 | b)
                if r is not None:
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                a = b
        heap = list(index)
        heapq.heapify(heap)
        finished: dict[int, list[int]] = {}
        while heap:
            r = heapq.heappop(heap)
            for i in sorted(index.pop(r)):
                a, j = tok[i], nxt[i]
                if a < 0 or j < 0 or pairs.get(a << 32 | tok[j]) != r:
                    continue  # a neighbour was merged away meanwhile
                k, p = nxt[j], prv[i]
                tok[i], tok[j], nxt[i] = r, -1, k
                early = False
                if k >= 0:
                    prv[k] = i
                    s = pairs.get(r << 32 | tok[k])
                    if s is not None:
                        early = s < r
                        if s not in index:
                            index[s] = []
                            heapq.heappush(heap, s)
                        index[s].append(i)
                if p >= 0:
                    s = pairs.get(tok[p] << 32 | r)
                    if s is not None:
                        early = early or s < r
                        if s not in index:
                            index[s] = []
                            heapq.heappush(heap, s)
                        index[s].append(p)
                if early:  # a lower rank arose: it comes before this word's other merges
                    start, places = i, []
                    while prv[start] >= 0:
                        start = prv[start]
                    q = start
                    while q >= 0:
                        places.append(q)
                        q = nxt[q]
                    finished[start] = self.alone([tok[q] for q in places])
                    for q in places:
                        tok[q] = -1
        for at, w in begins:
            ids = finished.get(at)
            if ids is None:
                ids, q = [], at
                while q >= 0:
                    ids.append(tok[q])
                    q = nxt[q]
            out[w] = ids
        return out


class Encoder:
    """Encodes texts, keeping the ids of the chunks it has met."""

    def __init__(self, tokens: list[bytes], pattern: str, cache_words: int = CACHE_WORDS):
        self.most_words = cache_words
        self.table = MergeTable(tokens)
        self.pattern = regex.compile(pattern)
        self.chunk = regex.compile(r"\s*\S+|\s+")
        self.cache: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.cached_chars = self.cached_words = 0

    def _learn(self, new: set[str]) -> None:
        if self.cached_words > self.most_words:
            self.words = dict(islice(self.words.items(), len(self.words) // 2, None))
            self.cached_words = sum(map(len, self.words))
        split = {c: [w.encode() for w in self.pattern.findall(c)] for c in new}
        words = {w for ws in split.values() for w in ws}.difference(self.words)
        for w, ids in self.table.replay(words).items():
            self.words[w] = pack(f"<{len(ids)}I", *ids)
        get = self.words.__getitem__
        for c, ws in split.items():
            self.cache[c] = b"".join([get(w) for w in ws])
        self.cached_words += sum(map(len, words))
        self.cached_chars += sum(map(len, new))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        chunks = [self.chunk.findall(t) for t in texts]
        here = set().union(*chunks)
        if self.cached_chars > CACHE_CHARS:
            self.cache = {c: self.cache[c] for c in here if c in self.cache}
            self.cached_chars = sum(map(len, self.cache))
        new = here.difference(self.cache)
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        return [b"".join(map(get, x)) for x in chunks]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


# one only: a worker that goes on to the next encoding drops the words of the last one
@lru_cache(maxsize=1)
def _encoder(shared: Broadcast, pattern: str, cache_words: int) -> Encoder:
    return Encoder(shared.value, pattern, cache_words)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _run(shared: Broadcast, pattern: str, decode: bool, cache_words: int = CACHE_WORDS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern, cache_words)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                ids = encoder.encode(texts[a:b])
                columns = [batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())]
                names = ["doc_id", "ids"]
                if decode:
                    columns.append(pa.array([encoder.decode(x) for x in ids], pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _vocabulary(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(load_ranks(path))


def encode(docs: DataFrame, path: str, pattern: str, decode: bool = False,
           cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) per row of ``docs``; with
    ``decode`` also the bytes that the ids give back. A worker holds the ids of about
    ``cache_words`` bytes of words: fewer take less memory and more time."""
    shared = _vocabulary(docs.sparkSession, path)
    return map_arrow(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]),
                     _run(shared, pattern, decode, cache_words), ROUND_TRIP if decode else ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids)."""
    shared = _vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.decode("utf-8", "replace") for t in texts])],
                ["doc_id", "text"])
    return map_arrow(encoded.select(encoded["doc_id"].cast("long").alias("doc_id"),
                                    encoded["ids"]), run, "doc_id long, text string")
