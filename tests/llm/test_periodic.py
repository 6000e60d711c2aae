"""Periodic runs against a quadratic search."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import periodic
from vigil.llm.queries import op12_periodic_runs

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACES:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_runs(w):
    """Every stretch of every period, compared word by word."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, length = i, j + q - i
            if length >= max(6, 4 * q) and not any(
                    q % p == 0 and s0 <= s and s0 + l0 >= s + length for s0, l0, p in out):
                out.append((s, length, q))
            i = j
    return sorted(out)


def brute_row(doc_id, text, change):
    w = words_of(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    if change and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    milli = best and 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), milli,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def repeated(rnd):
    out = []
    for _ in range(rnd.randint(0, 6)):
        letters = rnd.choice(["ab", "abc", "abcdefgh"])
        part = [rnd.choice(letters) for _ in range(rnd.randint(1, rnd.choice([3, 10, 60])))]
        out += (part * 9)[:rnd.randint(0, len(part) * 9)]
    return out


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_two_letter_texts(texts):
    rows = periodic._batch(list(range(len(texts))), [" ".join(t) for t in texts], None)
    for row, text in zip(rows, texts):
        assert [tuple(r.values()) for r in row[6]] == brute_runs(text)


def test_long_periods_go_through_transforms():
    rnd = random.Random(3)
    texts = [repeated(rnd) for _ in range(120)]
    for period in (31, 32, 33, 63, 64, 65, 130, 257):
        part = [str(rnd.random()) for _ in range(period)]
        texts.append(["x"] * rnd.randint(0, 90) + part * 4 + part[:rnd.randint(0, period - 1)])
    rows = periodic._batch(list(range(len(texts))), [" ".join(t) for t in texts], None)
    for row, text in zip(rows, texts):
        assert [tuple(r.values()) for r in row[6]] == brute_runs(text)


def test_transforms_equal_direct_sums():
    rng = np.random.default_rng(1)
    for size in (32, 128):
        a, b = rng.integers(0, 10**6, (3, size)), rng.integers(0, 10**6, (3, 2 * size))
        direct = np.array([[((a[r] - b[r, s:s + size]) ** 2).sum() % periodic.PRIME
                            for s in range(size)] for r in range(3)])
        assert (periodic.mismatches(a, b) == direct).all()


def test_batches_cut_by_size_change_nothing(monkeypatch):
    rnd = random.Random(9)
    texts = [" ".join(repeated(rnd)) for _ in range(40)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], ["doc_id", "text"])
    whole = [r for b in periodic._detect(None)([batch]) for r in b.to_pylist()]
    monkeypatch.setattr(periodic, "BATCH_CHARS", 50)
    assert [r for b in periodic._detect(None)([batch]) for r in b.to_pylist()] == whole


def test_query_on_awkward_rows(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, " ".join(repeated(rnd)), "x", 0) for i in range(150)]
    rows += [(None, "a b c " * 8, None, 1), (None, None, None, 1), (500, None, "", 2),
             (501, "", "", 2), (502, SPACES, "", 2), (503, "é É é É é É é É", "x", 3),
             (504, "a " * 6, "x", 3), (505, "A a " * 3, "x", 3), (506, "long word " * 30000, "x", 3)]
    rows += [rows[3]] * 2 + [(3, "same id, other text", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_runs int")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = [brute_row(r[0], r[1], True) for r in rows if r[0] != 506]
    assert sorted((g for g in got if g[0] != 506), key=str) == sorted(want, key=str)
    long = next(g for g in got if g[0] == 506)
    assert long[1:5] == (1, 0, 60000, 2) and long[5] == 30000000


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    assert op12_periodic_runs(spark, str(tmp_path)).collect() == []
