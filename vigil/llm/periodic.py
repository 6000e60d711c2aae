"""Runs of periodically repeated words, found by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least max(6, 4 q) words long, that no neighbouring word extends.

All texts of a batch are laid out as one sequence of word numbers, every text behind a
word of its own, so that no run crosses texts. At scale B = 1, 2, 4, ... runs with periods
from B to 2B - 1 are sought. Such a run holds a whole block of B words that starts at a
multiple of B and occurs again q words later. The squared differences between a block and
its following window, for all shifts at once, are block^2 + window^2 - 2 x their
correlation; the correlation is computed by a number-theoretic transform in exact integer
arithmetic (directly at small scales, where a transform saves nothing). Shifts without a
mismatch are the candidate periods; each is extended word by word to both sides, which
also confirms it. A block with a word that does not come again within 2B - 1 words cannot
match at any shift and is passed over.

Shifts inside a known run that are multiples of its period give the same run and are
dropped before the extension. A stretch of at least 4 d words with period d that is in no
such run has no smaller period (two periods would make their common divisor one), so the
order of the scales finds smallest periods.

Defined results
* words are runs outside white space (code points 9-13 and 32), case kept; a null or empty
  text or one without words has no words and no runs
* the strongest run is the one of greatest length / period; ties go to the smallest start,
  then the smallest period; without runs its four columns are null
* a null doc_id counts as empty text where its number is taken (``planted``)
* every row of the table gives one row, repeated ones too; an empty table gives none; other
  columns are not read
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import map_arrow

#: a run has at least LEAST words and EXPONENT periods
LEAST, EXPONENT = 6, 4
#: blocks below this length are compared shift by shift, longer ones by transforms
DIRECT = 32
#: numbers held by one transform
CELLS = 1 << 20
#: modulus of the transforms, 119 x 2^23 + 1, and a generator of its units
PRIME, GENERATOR = 998244353, 3

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, "
          "exponent_milli long, runs array<struct<start:long,length:long,period:long>>, "
          "collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FIELDS = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
                     ("length", pa.int64()), ("period", pa.int64()),
                     ("exponent_milli", pa.int64()), ("runs", pa.list_(_RUN)),
                     ("collapsed", pa.string())])

Run = tuple[int, int, int]
Order = Callable[[int | None, int], np.ndarray]


# --- exact transforms -----------------------------------------------------------------

def _roots(half: int, inverse: bool) -> np.ndarray:
    """Powers of the (2 x half)-th root of one."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(half, np.int64)
    done = 1
    while done < half:
        more = min(done, half - done)
        out[done:done + more] = out[:more] * pow(root, done, PRIME) % PRIME
        done += more
    return out


def ntt(rows: np.ndarray) -> np.ndarray:
    """Transform of every row (a power of two long); entries in bit-reversed order."""
    n_rows, n = rows.shape
    half = n // 2
    x = rows
    while half:
        x = x.reshape(n_rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1]
        x = np.stack([(u + v) % PRIME, (u - v) % PRIME * _roots(half, False) % PRIME], axis=2)
        half //= 2
    return x.reshape(n_rows, n)


def inverse_ntt(rows: np.ndarray) -> np.ndarray:
    """The rows whose transforms (in bit-reversed order) are given."""
    n_rows, n = rows.shape
    half, x = 1, rows
    while half < n:
        x = x.reshape(n_rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1] * _roots(half, True) % PRIME
        x = np.stack([(u + v) % PRIME, (u - v) % PRIME], axis=2)
        half *= 2
    return x.reshape(n_rows, n) * pow(n, PRIME - 2, PRIME) % PRIME


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo PRIME, between every block (rows of B words) and
    its window (rows of 2B words) at the shifts 0 ... B - 1."""
    n_rows, size = blocks.shape
    if size < DIRECT:
        out = np.empty((n_rows, size), np.int64)
        for shift in range(size):
            out[:, shift] = ((blocks - windows[:, shift:shift + size]) ** 2 % PRIME).sum(1)
        return out % PRIME
    mirrored = np.zeros((n_rows, 2 * size), np.int64)
    mirrored[:, 0] = blocks[:, 0]
    mirrored[:, size + 1:] = blocks[:, :0:-1]
    common = inverse_ntt(ntt(mirrored) * ntt(windows) % PRIME)[:, :size]
    squares = np.zeros((n_rows, 2 * size + 1), np.int64)
    np.cumsum(windows * windows % PRIME, axis=1, out=squares[:, 1:])
    of_window = squares[:, size:2 * size] - squares[:, :size]
    of_block = (blocks * blocks % PRIME).sum(1, keepdims=True)
    return (of_block + of_window - 2 * common) % PRIME


# --- runs -----------------------------------------------------------------------------

def _next_same(words: np.ndarray) -> np.ndarray:
    """Distance from every place to the next place of the same word (the sequence's length
    where there is none)."""
    order = np.argsort(words, kind="stable")
    gap = np.full(len(words), len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """Number of leading places where the sequences agree."""
    done, step, n = 0, 32, len(a)
    while done < n:
        differ = a[done:done + step] != b[done:done + step]
        if differ.any():
            return done + int(differ.argmax())
        done += step
        step *= 4
    return n


def _extended(words: np.ndarray, at: int, size: int, period: int) -> tuple[int, int]:
    """The longest stretch around words[at : at + size + period] with that period; empty
    when the block does not occur there."""
    if (words[at:at + size] != words[at + period:at + period + size]).any():
        return at, at
    left = _alike(words[at - 1::-1] if at else words[:0],
                  words[at + period - 1:period - 1:-1] if at else words[:0])
    right = _alike(words[at + size:len(words) - period], words[at + size + period:])
    return at - left, at + size + period + right


def _seeds(words: np.ndarray, gap: np.ndarray, ends: np.ndarray,
           size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and shifts (size ... 2 size - 1) at which a block occurs again. ``ends`` holds
    for each place the end of its text."""
    n_blocks = len(words) // size
    widest = gap[:n_blocks * size].reshape(n_blocks, size).max(1)
    at = np.flatnonzero(widest < 2 * size) * size
    at = at[at + 2 * size <= ends[at]]
    places, shifts = [], []
    step = max(1, CELLS // (2 * size))
    for i in range(0, len(at), step):
        part = at[i:i + step, None]
        blocks = words[part + np.arange(size)]
        windows = words[np.minimum(part + size + np.arange(2 * size), len(words) - 1)]
        row, shift = np.nonzero(mismatches(blocks, windows) == 0)
        places.append(part[row, 0])
        shifts.append(shift + size)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(shifts)


def _known(runs: list[Run], places: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """Seeds that lie in a run whose period divides the shift. Two runs share fewer words
    than their periods' sum, which is less than a seed is long, so a seed lies in at most
    one run: the one that reaches furthest among those starting at or before it."""
    if not runs:
        return np.zeros(len(places), bool)
    table = np.array(sorted(runs), np.int64)
    ends = table[:, 0] + table[:, 1]
    furthest = np.maximum.accumulate(ends)
    best = np.maximum.accumulate(np.where(ends == furthest, np.arange(len(ends)), 0))
    at = np.searchsorted(table[:, 0], places, "right") - 1
    run = best[np.maximum(at, 0)]
    return (at >= 0) & (ends[run] >= places + shifts + size) & (shifts % table[run, 2] == 0)


def find_runs(words: np.ndarray, ends: np.ndarray, longest: int) -> list[Run]:
    """All runs (start, length, period) of a sequence in which every text ends with a word of
    its own; ``ends`` holds each place's end of text, ``longest`` the longest text's words."""
    runs: list[Run] = []
    if not len(words):
        return runs
    gap = _next_same(words)
    size = 1
    while EXPONENT * size <= max(longest, LEAST):
        places, shifts = _seeds(words, gap, ends, size)
        new = ~_known(runs, places, shifts, size)
        places, shifts = places[new], shifts[new]
        order = np.lexsort((places, shifts))
        found, period, reach = [], 0, 0
        for place, shift in zip(places[order].tolist(), shifts[order].tolist()):
            if shift == period and place + size + shift <= reach:
                continue
            start, end = _extended(words, place, size, shift)
            period, reach = shift, end
            if end - start >= max(LEAST, EXPONENT * shift):
                found.append((start, end - start, shift))
        runs += found
        size *= 2
    return sorted(runs)


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2] or (
                run[1] * best[2] == best[1] * run[2] and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The text with every run's words after its first period left out."""
    if not runs:
        return b" ".join(words).decode()
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)]).decode()


# --- tables ---------------------------------------------------------------------------

def planted(doc_id: int | None, n: int) -> np.ndarray:
    """The order of the words of a text of n words in the fixture of planted repetitions:
    one id in ten has its tail, from a place on, made of one repeated passage."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    order = np.arange(n)
    if h % 10 == 0 and n:
        first = g % n
        period = 1 + (n - first) // (3 + g % 8)
        order[first:] = first + (order[first:] - first) % period
    return order


def _batch(ids: list[int | None], texts: list[str | None], order: Order | None) -> list[tuple]:
    split, numbers, sequence, starts = [], {}, [], []
    for doc_id, text in zip(ids, texts):
        words = (text or "").encode().split()
        if order is not None and words:
            words = [words[i] for i in order(doc_id, len(words)).tolist()]
        split.append(words)
        starts.append(len(sequence))
        sequence += [numbers.setdefault(w, len(numbers)) for w in words]
        sequence.append(-1)
    words = np.array(sequence, np.int64)
    apart = np.flatnonzero(words < 0)
    words[apart] = len(numbers) + np.arange(len(apart))
    sizes = np.array([len(w) for w in split])
    ends = np.repeat(apart, sizes + 1)
    per_text: list[list[Run]] = [[] for _ in split]
    for start, length, period in find_runs(words, ends, int(sizes.max(initial=0))):
        i = int(np.searchsorted(apart, start, "right"))
        per_text[i].append((start - starts[i], length, period))
    out = []
    for doc_id, own, runs in zip(ids, split, per_text):
        best = strongest(runs) or (None, None, None)
        milli = None if best[2] is None else 1000 * best[1] // best[2]
        out.append((doc_id, len(runs), *best, milli,
                    [{"start": s, "length": n, "period": q} for s, n, q in runs],
                    collapsed(own, runs)))
    return out


#: characters laid out together; a longer text is a batch of its own
BATCH_CHARS = 4_000_000


def _detect(order: Order | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first, chars = 0, 0
            for i, text in enumerate([*texts, None]):
                chars += len(text or "")
                if i == len(texts) or (chars > BATCH_CHARS and i > first):
                    rows = _batch(ids[first:i], texts[first:i], order)
                    first, chars = i, len(text or "")
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)],
                            schema=_FIELDS)
    return run


def periodic_runs(docs: DataFrame, order: Order | None = None) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli (of the strongest run), runs (all,
    by start, then period) and collapsed (the text without repetitions) per document.
    ``order`` gives, for a document's id and number of words, the order in which its words
    are taken."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"]),
                     _detect(order), SCHEMA)

