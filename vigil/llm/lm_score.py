"""Language-model scores of texts by online logistic context mixing.

Texts are coded bit by bit: Huffman codes of the training bytes (and of an end mark), one
for each byte before, turn each byte into the fewest binary decisions. Each decision is
predicted by several contexts (the last one, three and five bytes) whose counts, hashed into tables of
fixed size, are gathered from all training documents. The predictions are mixed in the
logistic domain by weights that a gate selects (whether the longest context is sure), learnt
online from the text's bits just coded (after every STEP bits), and refined by an adaptive
map from the mixed to the observed probability, learnt after every bit; weights and map run
through the whole text. The sum of the bits' log-probabilities is the
text's; it is a proper distribution over texts, since every factor depends on earlier
bits and on training counts only.

Beside it stands the unigram base score over words. The counts of words that make up
more than 1/FREQUENT of all tokens (fewer than FREQUENT words, whatever the input) are
broadcast; for all others the (document, word) pairs are joined with the counts.

Scale: training counts are added up per task, then in two rounds of shuffles over table
pieces; tables are of fixed size. Texts never move; each task sorts its own by length, so
that the texts coded side by side end at about the same step.

Defined results
* a null text counts as empty: only the end mark and the end token are scored
* texts are lower-cased (A-Z) first; words are runs outside white space (code points
  9-13 and 32); n_tokens counts the end token; V and N count it as any other
* without training rows all counts are 0 and predictions start at one half
* every row gives a row, repeated rows too (a repeated training row counts each time); a
  null doc_id stays null; an empty table gives no rows; other columns are not read
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ARROW_ROWS, fixed, map_arrow
from vigil.session import scratch_dir

#: words with more than 1/FREQUENT of all tokens are broadcast
FREQUENT = 1_000_000
#: slots of a context's table (as a power of two), slots of a piece in the shuffle
TABLE_BITS, PIECE_BITS = 21, 15
#: bytes before the current one that the hashed contexts see
ORDERS = (3, 5)
#: bits between two updates of the weights
STEP = 8
#: texts coded side by side, bytes of text gathered for them, most steps of a stretch
LANES, GATHER_BYTES, STRETCH = 2048, 8_000_000, 64
#: bytes laid out at once (whose arrays stay in a core's cache); bytes counted at once, and
#: their distinct places laid out at once
CHUNK_BYTES, COUNT_BYTES, COUNT_KEYS = 100_000, 2_000_000, 100_000
#: first round of adding up table pieces: so many parts of the tasks
ROUNDS = 16
#: predictions are kept as whole 16ths of their logit, at most 127
SCALE = 16.0
RATE, GATE_AT, MOST_LOGIT = 0.001, 24, 7.99
MAP_CELLS, MAP_RATE, MAP_SHARE = 16, 0.02, 0.25
#: weights at the start of a text, by context; sum above 1 since contexts agree often
FIRST_WEIGHTS = (0.05, 0.4, 0.6)

#: the symbol after the last byte; the token after the last word
END, _END_TOKEN = 256, b""
SYMBOLS, PAIR_BITS = 257, 17
_GOLD, _MURMUR = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def normal(text: str | None) -> bytes:
    return (text or "").encode().lower()


@dataclass
class Tokens:
    """Distinct tokens of each text, one text after the other."""

    text: np.ndarray
    token: np.ndarray  # place in ``names``
    times: np.ndarray
    names: pa.Array


def tokens_of(texts: pa.Array) -> Tokens:
    """Words of the lower-cased texts, and one end token for each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, parents = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    names = pa.concat_arrays([coded.dictionary.cast(pa.binary()),
                              pa.array([_END_TOKEN], pa.binary())])
    key = np.concatenate([
        parents.filter(real).to_numpy().astype(np.int64) * len(names) + coded.indices.to_numpy(),
        np.arange(1, len(texts) + 1) * len(names) - 1])
    key, times = np.unique(key, return_counts=True)
    return Tokens(key // len(names), key % len(names), times, names)


# --- code --------------------------------------------------------------------------

@dataclass
class Code:
    """Binary codes: per symbol before and symbol where its decisions stand, and per
    decision the tree node (of all trees) at which it is taken and the bit."""

    start: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    n_nodes: int


def _paths(counts: np.ndarray) -> list[tuple[tuple[int, int], ...]]:
    """(node, bit) steps to each symbol in the Huffman tree of the counts; each symbol
    counts once more, so that all have a code."""
    heap = [(int(c) + 1, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    at = len(counts)
    while len(heap) > 1:
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        children[at] = (left, right)
        heapq.heappush(heap, (a + b, at))
        at += 1
    paths: list[tuple[tuple[int, int], ...]] = [()] * len(counts)
    todo: list[tuple[int, tuple[tuple[int, int], ...]]] = [(at - 1, ())]
    while todo:
        n, path = todo.pop()
        if n in children:
            here = n - len(counts)
            todo += [(child, (*path, (here, bit))) for bit, child in enumerate(children[n])]
        else:
            paths[n] = path
    return paths


def huffman(counts: np.ndarray) -> Code:
    """Of the counts of the 257 symbols after each of them."""
    each = len(counts[0]) - 1  # nodes of a tree
    paths = [[(n + i * each, bit) for n, bit in path]
             for i, row in enumerate(counts) for path in _paths(row)]
    length = np.array([len(p) for p in paths], np.int32)
    start = (np.cumsum(length) - length).astype(np.int32)
    return Code(start, length, np.array([n for p in paths for n, _ in p], np.uint32),
                np.array([b for p in paths for _, b in p], np.uint8), each * len(counts))


@dataclass
class Places:
    """The bytes and end marks of some texts, one text after the other."""

    pair: np.ndarray  # symbol before and symbol
    hashes: list[np.ndarray]  # of what each hashed context sees
    sizes: np.ndarray  # places of each text


def places(texts: list[bytes]) -> Places:
    most = max(ORDERS)
    gap, end = np.full(most, END, np.uint16), np.full(1, END, np.uint16)
    row = np.concatenate([part for t in texts for part in (gap, np.frombuffer(t, np.uint8), end)])
    row = row.astype(np.uint32)
    sizes = np.array([len(t) + 1 for t in texts])
    target = np.ones(len(row), bool)
    begins = np.cumsum(sizes + most) - sizes - most
    for i in range(most):
        target[begins + i] = False
    target = target[most:]

    def back(n):
        return row[most - n:len(row) - n]

    hashes = []
    for n in ORDERS:
        h = np.full(len(target), n, np.uint32)
        for i in range(1, n + 1):
            h ^= back(i)
            h *= _GOLD
            h ^= h >> np.uint32(15)
        hashes.append(h[target])
    return Places((back(1) * np.uint32(SYMBOLS) + back(0))[target], hashes, sizes)


def _steps(pair: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Decisions of each place, and where they stand in the code."""
    length = code.length.take(pair)
    total = np.cumsum(length, dtype=np.int64)
    at = np.repeat(code.start.take(pair) - (total - length), length)
    at += np.arange(len(at))
    return length, at


def _slots(h: np.ndarray, length: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Slots in a hashed context's table; ``mixed`` has the hashes of the nodes."""
    s = np.repeat(h, length)
    s += mixed
    s *= _MURMUR
    s ^= s >> np.uint32(13)
    s *= _GOLD
    s >>= np.uint32(32 - TABLE_BITS)
    return s


@dataclass
class Decisions:
    """The binary decisions of some texts, one text after the other."""

    slots: list[np.ndarray]  # of every context's table
    bit: np.ndarray
    bits_of: np.ndarray  # decisions of each text


def decisions(texts: list[bytes], code: Code) -> Decisions:
    own = places(texts)
    length, at = _steps(own.pair, code)
    node = code.node.take(at)
    mixed = node * _GOLD
    slots = [node, *(_slots(h, length, mixed) for h in own.hashes)]
    return Decisions(slots, code.bit.take(at),
                     np.add.reduceat(length, np.cumsum(own.sizes) - own.sizes, dtype=np.int64))


def _pairs(texts: list[bytes]) -> np.ndarray:
    """Symbol before and symbol of the bytes and end marks of some texts, in one number."""
    end = np.full(1, END, np.uint16)
    row = np.concatenate([end, *(p for t in texts for p in (np.frombuffer(t, np.uint8), end))])
    row = row.astype(np.uint32)
    return row[:-1] * np.uint32(SYMBOLS) + row[1:]


def _chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


# --- training ------------------------------------------------------------------------

def _gathered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[pa.Array]]:
    """Columns of batches in groups of about GATHER_BYTES of text."""
    held: list[pa.RecordBatch] = []
    size = 0

    def whole():
        return [pa.concat_arrays(columns) for columns in zip(*(b.columns for b in held))]

    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= GATHER_BYTES:
            yield whole()
            held, size = [], 0
    if held:
        yield whole()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (is_byte, token, n): words and the end token, and pairs of symbols."""
    symbols = np.zeros(SYMBOLS * SYMBOLS, np.int64)

    def out(names, n, is_byte):
        return pa.RecordBatch.from_arrays(
            [pa.array([is_byte] * len(names), pa.bool_()), names, pa.array(n, pa.int64())],
            ["is_byte", "token", "n"])

    for (text,) in _gathered(batches, 0):
        own = tokens_of(text)
        n = np.zeros(len(own.names), np.int64)
        np.add.at(n, own.token, own.times)
        yield out(own.names, n, False)
        for at in range(0, len(text), ARROW_ROWS):
            some = [normal(t) for t in text[at:at + ARROW_ROWS].to_pylist()]
            symbols += np.bincount(_pairs(some), minlength=len(symbols))
    seen = np.flatnonzero(symbols)
    yield out(pa.array([s.to_bytes(4, "big") for s in seen.tolist()], pa.binary()),
              symbols[seen], True)


def _sizes(code: Code) -> list[int]:
    """Slots of every context's table: one per tree node, or hashed."""
    return [code.n_nodes, *[1 << TABLE_BITS] * len(ORDERS)]


def _counted(h: np.ndarray, pair: np.ndarray, code: Code, table: np.ndarray) -> None:
    """Add the decisions of a hashed context's places to its table. Places that see the same
    and have the same symbol take the same decisions, which are laid out once."""
    key = h.astype(np.uint64) << np.uint64(PAIR_BITS)
    key |= pair
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(first, append=len(key))
    key = key[first]
    pair = (key & np.uint64((1 << PAIR_BITS) - 1)).astype(np.int64)
    key >>= np.uint64(PAIR_BITS)
    for a in range(0, len(key), COUNT_KEYS):
        length, at = _steps(pair[a:a + COUNT_KEYS], code)
        slots = _slots(key[a:a + COUNT_KEYS].astype(np.uint32), length,
                       code.node.take(at) * _GOLD).astype(np.int64)
        slots <<= 1
        slots |= code.bit.take(at)
        np.add.at(table, slots, np.repeat(times[a:a + COUNT_KEYS], length))


def _count_bits(shared):
    """Rows (context, piece, part, counts): counts of both bits of a hashed context's slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        tables = [np.zeros(2 << TABLE_BITS, np.int64) for _ in ORDERS]
        held: list[bytes] = []
        part = size = 0

        def add():
            for a, b in _chunks([len(t) for t in held], COUNT_BYTES):
                own = places(held[a:b])
                for table, h in zip(tables, own.hashes):
                    _counted(h, own.pair, code, table)
            held.clear()

        for batch in batches:
            for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(normal(text))
                size += len(held[-1])
                if size >= COUNT_BYTES:
                    add()
                    size = 0
        add()
        rows = [(c, p, part, _pressed(table[i:i + (2 << PIECE_BITS)]))
                for c, table in enumerate(tables, 1) if table.any()
                for p, i in enumerate(range(0, len(table), 2 << PIECE_BITS))]
        yield _piece_rows(rows)
    return run


def _pressed(counts: np.ndarray) -> bytes:
    """In the fewest bytes a count that hold the largest one; the first byte says how many."""
    width = np.min_scalar_type(int(counts.max()))
    return bytes([width.itemsize]) + zlib.compress(counts.astype(width).tobytes(), 1)


def _unpressed(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(counts)[1:]),
                         f"u{counts[0]}").astype(np.int64)


PIECES = "context int, piece int, part int, counts binary"


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
        ["context", "piece", "part", "counts"])


def _add_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the counts per piece of this task, one array per piece in memory."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for c, p, _, counts in zip(*(x.to_pylist() for x in batch.columns)):
            own = _unpressed(counts)
            if (c, p) in sums:
                sums[c, p] += own
            else:
                sums[c, p] = own
    yield _piece_rows([(c, p, 0, _pressed(s)) for (c, p), s in sums.items()])


def _node_counts(pairs: np.ndarray, code: Code) -> np.ndarray:
    """Counts of both bits of every tree node, from those of the pairs of symbols."""
    return np.bincount(code.node.astype(np.int64) * 2 + code.bit,
                       np.repeat(pairs, code.length), 2 * code.n_nodes)


def _logits(counts: np.ndarray) -> np.ndarray:
    both = counts.reshape(-1, 2) + 0.4
    return np.clip(np.rint(np.log(both[:, 1] / both[:, 0]) * SCALE), -127, 127).astype(np.int8)


def _context_tables(texts: DataFrame, pairs: np.ndarray, code: Code) -> list[np.ndarray]:
    """Predictions (scaled logits) of every context's slots."""
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = texts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(ROUNDS)))
    counted = map_arrow(parts, _count_bits(spark.sparkContext.broadcast(code)), PIECES)
    some = map_arrow(counted.repartition(n, "context", "piece", "part"), _add_pieces, PIECES)
    whole = map_arrow(some.repartition(n, "context", "piece"), _add_pieces, PIECES)
    logits = [_logits(_node_counts(pairs, code)),
              *(np.zeros(1 << TABLE_BITS, np.int8) for _ in ORDERS)]
    for row in whole.toLocalIterator():
        x = _logits(_unpressed(row.counts))
        at = row.piece << PIECE_BITS
        logits[row.context][at:at + len(x)] = x
    return logits


# --- scoring -------------------------------------------------------------------------

def _packed(d: Decisions, logits: list[np.ndarray]) -> np.ndarray:
    """Predictions and bits of every step, by step, context (the bits last) and turn. Each
    text begins with a new step; its last one is filled up with zeros."""
    flat = np.empty((len(logits) + 1, len(d.bit)), np.int8)
    for own, table, slots in zip(flat, logits, d.slots):
        table.take(slots, out=own, mode="clip")
    flat[-1] = d.bit
    steps = steps_of(d.bits_of)
    packed = np.zeros((len(flat), STEP * int(steps.sum())), np.int8)
    at = to = 0
    for n, own in zip(d.bits_of.tolist(), steps.tolist()):
        packed[:, to:to + n] = flat[:, at:at + n]
        at += n
        to += own * STEP
    by_step = np.ascontiguousarray(packed.view(np.dtype((np.void, STEP))).T)
    return by_step.view(np.int8).reshape(-1, len(flat), STEP)


def steps_of(bits_of: np.ndarray) -> np.ndarray:
    return -(-bits_of // STEP)


@dataclass
class Lanes:
    """Which lane codes which text from which step on. Lanes are numbered by the step at
    which they are done, the last one first, so those at work are always the first ones."""

    n: int
    begins: dict[int, list[tuple[int, int]]]  # step -> (lane, text)
    ends: dict[int, list[tuple[int, int]]]  # last step of a text -> (lane, text)
    at_work: np.ndarray  # lanes at work in each step


def lanes_of(bits_of: np.ndarray, most: int) -> Lanes:
    """Long texts first, each to the lane that is free first."""
    n = min(most, int((bits_of > 0).sum()))
    free = [(0, lane) for lane in range(n)]
    own: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    steps = steps_of(bits_of).tolist()
    for text in np.argsort(-bits_of, kind="stable").tolist():
        if not steps[text]:
            break
        start, lane = heapq.heappop(free)
        end = start + steps[text]
        own[lane].append((start, end, text))
        heapq.heappush(free, (end, lane))
    own.sort(key=lambda texts: -texts[-1][1])
    begins: dict[int, list[tuple[int, int]]] = {}
    ends: dict[int, list[tuple[int, int]]] = {}
    done = np.zeros(own[0][-1][1] if n else 0, np.int64)
    for lane, texts in enumerate(own):
        for start, end, text in texts:
            begins.setdefault(start, []).append((lane, text))
            ends.setdefault(end - 1, []).append((lane, text))
        done[:texts[-1][1]] += 1
    return Lanes(n, begins, ends, done)


def mixed_log10(d: Decisions, logits: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text's decisions."""
    return packed_log10(_packed(d, logits), d.bits_of)


def _stretches(lanes: Lanes) -> Iterator[tuple[int, int, int]]:
    """(first step, steps, lanes at work) of stretches in which no lane takes or ends a text;
    of many steps where few lanes are left."""
    bounds = sorted({*lanes.begins, *(step + 1 for step in lanes.ends)})
    for start, stop in zip(bounds, bounds[1:]):
        m = int(lanes.at_work[start])
        most = max(1, min(STRETCH, LANES // m))
        for at in range(start, stop, most):
            yield at, min(most, stop - at), m


def packed_log10(whole: np.ndarray, bits_of: np.ndarray) -> np.ndarray:
    """log10 probability of the texts whose steps ``_packed`` gives, one text after the
    other. LANES texts advance together, STEP bits at a time; each has its own weights and
    map, and a lane whose text ends takes the next one with fresh weights and map. What a
    text's last step holds past its end counts for nothing and changes only what is
    set anew. Only the weights go step by step; all else is done for a stretch of steps."""
    lanes = lanes_of(bits_of, LANES)
    steps = steps_of(bits_of)
    first, n, k = np.cumsum(steps) - steps, lanes.n, whole.shape[1] - 1
    rows = whole.reshape(len(whole), -1)
    fresh = np.array(FIRST_WEIGHTS, np.float32)[:, None, None] / SCALE
    shared = np.zeros((k, 1, n), np.float32)
    sure = np.zeros((k, 1, n), np.float32)  # added where the longest context is sure
    centres = 1 / (1 + np.exp(-(np.arange(MAP_CELLS) - MAP_CELLS / 2 + 0.5)))
    centres = centres.astype(np.float32)[:, None]
    cells = np.zeros(MAP_CELLS * n, np.float32)
    column = np.arange(n, dtype=np.int64) + n * (MAP_CELLS // 2)
    place, total = np.zeros(n, np.int64), np.zeros(n, np.float64)
    out = np.zeros(len(bits_of))
    rate, one = np.float32(-RATE / SCALE), np.float32(1)
    share, pace = np.float32(MAP_SHARE), np.float32(MAP_RATE)
    least, most = np.float32(-MOST_LOGIT), np.float32(MOST_LOGIT)
    ahead = np.arange(STRETCH)[:, None]
    for step, size, m in _stretches(lanes):
        if step in lanes.begins:
            own, texts = map(list, zip(*lanes.begins[step]))
            shared[:, :, own], sure[:, :, own], total[own] = fresh, 0, 0
            cells.reshape(MAP_CELLS, n)[:, own] = centres
            place[own] = first[texts]
        now = rows.take((place[:m] + ahead[:size]).ravel(), axis=0).reshape(size, m, k + 1, STEP)
        place += size
        now = now.transpose(2, 0, 3, 1).astype(np.float32, order="C")
        bits = now[k]
        gates = (np.abs(now[k - 1]) >= GATE_AT).astype(np.float32)
        mixes, guesses = np.empty_like(bits), np.empty_like(bits)
        w, v = shared[:, :, :m], sure[:, :, :m]
        for i in range(size):
            x, gate, z, p = now[:k, i], gates[i], mixes[i], guesses[i]
            mixed = gate * v
            mixed += w
            mixed *= x
            np.add(mixed[0], mixed[1], out=z)
            for part in mixed[2:]:
                z += part
            z.clip(least, most, out=z)
            np.negative(z, out=p)
            np.exp(p, out=p)
            p += one
            np.divide(one, p, out=p)
            pull = p - bits[i]
            pull *= rate
            x *= pull
            w += np.add.reduce(x, axis=1, keepdims=True)
            x *= gate
            v += np.add.reduce(x, axis=1, keepdims=True)
        np.floor(mixes, out=mixes)
        cell = mixes.astype(np.int64)
        cell *= n
        cell += column[:m]
        seen = mixes
        for own, at, bit in zip(*(a.reshape(-1, m) for a in (seen, cell, bits))):
            cells.take(at, out=own, mode="clip")
            new = bit - own
            new *= pace
            new += own
            cells[at] = new
        seen -= guesses
        seen *= share
        seen += guesses
        np.subtract(one, bits, out=bits)
        bits -= seen
        np.abs(bits, out=bits)
        final = np.log(bits, out=bits)
        ending = lanes.ends.get(step + size - 1, ())
        for lane, text in ending:
            final[-1, (int(bits_of[text]) - 1) % STEP + 1:, lane] = 0
        for part in final.sum(axis=1):
            total[:m] += part
        for lane, text in ending:
            out[text] = total[lane]
    return out / math.log(10)


@dataclass
class Model:
    code: Code
    logits: list[np.ndarray]
    frequent: dict[bytes, int]
    n_tokens: int
    n_words: int

    @property
    def scale(self) -> float:
        return max(self.n_tokens + 0.5 * (self.n_words + 1), 0.5)


ROWS = ("doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "tokens array<binary>, times array<long>")


def _bits_of(texts: list[bytes], code: Code) -> np.ndarray:
    """Decisions of each text."""
    sizes = np.array([len(t) + 1 for t in texts])
    return np.add.reduceat(code.length.take(_pairs(texts)), np.cumsum(sizes) - sizes,
                           dtype=np.int64)


def _score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    """The decisions are laid out chunk by chunk (four bytes each stay), then coded together."""
    chunks = list(_chunks([len(t) for t in texts], CHUNK_BYTES))
    if not chunks:
        return np.zeros(0)
    bits_of = np.concatenate([_bits_of(texts[a:b], model.code) for a, b in chunks])
    whole = np.empty((int(steps_of(bits_of).sum()), len(model.logits) + 1, STEP), np.int8)
    to = 0
    for a, b in chunks:
        part = _packed(decisions(texts[a:b], model.code), model.logits)
        whole[to:to + len(part)] = part
        to += len(part)
    return packed_log10(whole, bits_of)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for doc_id, held_out, text in _gathered(batches, 2):
            scores = _score_texts([normal(t) for t in text.to_pylist()], model)
            n, own = len(text), tokens_of(text)
            get = model.frequent.get
            count = np.array([get(w, 0) for w in own.names.to_numpy(zero_copy_only=False)],
                             np.int64)[own.token]
            rare = count == 0
            known = np.where(rare, 0, own.times)
            base = known * np.log10((count + 0.5) / model.scale)
            ends = np.cumsum(np.bincount(own.text[rare], minlength=n))
            at = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [doc_id, held_out,
                 *(pa.array(np.bincount(own.text, x, n).astype(np.int64))
                   for x in (own.times, known)),
                 pa.array(np.bincount(own.text, base, n)), pa.array(scores, pa.float64()),
                 pa.ListArray.from_arrays(at, own.names.take(pa.array(own.token[rare]))),
                 pa.ListArray.from_arrays(at, pa.array(own.times[rare], pa.int64()))],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tokens",
                 "times"])
    return run


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of
    ``docs``, learning from the rows where ``held_out`` is false."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       held_out.alias("held_out"), docs["text"])
    training = rows.filter(~F.col("held_out")).select("text")
    counts = fixed(map_arrow(training, _count_words, "is_byte boolean, token binary, n long")
                   .groupBy("is_byte", "token").agg(F.sum("n").alias("n")))
    words = counts.filter("NOT is_byte").select("token", "n")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    symbols = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for r in counts.filter("is_byte").select("token", "n").collect():
        symbols[int.from_bytes(r.token, "big")] = r.n
    frequent = {bytes(r.token): r.n
                for r in words.filter(F.col("n") > n / FREQUENT).orderBy("token").collect()}
    code = huffman(symbols.reshape(SYMBOLS, SYMBOLS))
    model = Model(code, _context_tables(training, symbols, code), frequent, n, v)
    shared = spark.sparkContext.broadcast(model)
    path = scratch_dir(spark, "lm-rows")
    # texts of like length side by side keep all lanes at work
    by_length = rows.sortWithinPartitions(F.octet_length("text").desc())
    (map_arrow(by_length, _score(shared), ROWS)
     .withColumn("row", F.monotonically_increasing_id()).write.parquet(path))
    scored = spark.read.parquet(path)
    rare = (scored.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t"))
            .select("row", "t.tokens", "t.times"))
    log = F.log10((F.col("n") + 0.5) / F.lit(model.scale))
    known = (rare.join(words, rare["tokens"] == words["token"])
             .groupBy("row").agg(F.sum("times").alias("more"),
                                 F.sum(F.col("times") * log).alias("more_base")))
    both = scored.drop("tokens", "times").join(known, "row", "left").fillna(
        0, ["more", "more_base"])
    n_known = F.col("n_known") + F.col("more")
    unknown = F.lit(math.log10(0.5 / model.scale))
    return both.select(
        "doc_id", "held_out", "n_tokens", n_known.alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more_base") + (F.col("n_tokens") - n_known) * unknown)
        .alias("base_score"), "score")
