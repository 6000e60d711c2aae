"""Work of the language-model scores: a long text, equal places, words of odd texts."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from test_llm_small import words

from vigil.llm import lm_score


def model():
    code = lm_score.huffman(np.random.default_rng(0).integers(0, 50, (257, 257)))
    tables = [np.random.default_rng(1).integers(-60, 60, n).astype(np.int8)
              for n in lm_score._sizes(code)]
    return code, tables


def test_a_long_text_takes_few_stretches_with_the_same_score(monkeypatch):
    rnd = random.Random(5)
    texts = [" ".join(words(rnd, n)).encode() for n in (30, 2000, 3, 40, 25, 60, 33, 0, 50)]
    code, tables = model()
    d = lm_score.decisions(texts, code)
    got = lm_score.mixed_log10(d, tables)
    lanes = lm_score.lanes_of(d.bits_of, lm_score.LANES)
    stretches = list(lm_score._stretches(lanes))
    longest = int(lm_score.steps_of(d.bits_of).max())
    assert len(stretches) < longest / 20 and sum(size for _, size, _ in stretches) == longest
    for most, side_by_side in ((1, 512), (64, 3), (64, 1)):
        monkeypatch.setattr(lm_score, "STRETCH", most)
        monkeypatch.setattr(lm_score, "LANES", side_by_side)
        assert np.allclose(got, lm_score.mixed_log10(d, tables), rtol=1e-6)


def test_equal_places_are_laid_out_once_and_counted_each(monkeypatch):
    rnd = random.Random(6)
    texts = [" ".join(words(rnd, 300)).encode()] * 5 + [b"", b"ab", b"\xc3\xa9 x"]
    code, _ = model()
    d, own = lm_score.decisions(texts, code), lm_score.places(texts)
    want = [np.bincount(s.astype(np.int64) * 2 + d.bit, minlength=2 * n)
            for s, n in zip(d.slots, lm_score._sizes(code))]
    steps, laid = lm_score._steps, []
    monkeypatch.setattr(lm_score, "COUNT_KEYS", 100)
    monkeypatch.setattr(lm_score, "_steps",
                        lambda pair, c: laid.append(len(pair)) or steps(pair, c))
    for h, counts in zip(own.hashes, want[1:]):
        laid.clear()
        table = np.zeros(len(counts), np.int64)
        lm_score._counted(h, own.pair, code, table)
        assert np.array_equal(table, counts)
        assert max(laid) <= 100 and sum(laid) < len(own.pair) / 4
        assert np.array_equal(lm_score._unpressed(lm_score._pressed(table)), table)
    pairs = np.bincount(own.pair, minlength=lm_score.SYMBOLS ** 2)
    assert np.array_equal(lm_score._node_counts(pairs, code), want[0])


def test_tokens_of_odd_texts():
    texts = [None, "", " \x1c a\x0bB b   x\x85y\x1fz É é\t\n", " lead", "trail \r\n", "a A a"]
    own = lm_score.tokens_of(pa.array(texts))
    names = own.names.to_pylist()
    got = [Counter() for _ in texts]
    for text, token, times in zip(own.text, own.token, own.times):
        got[text][names[token]] += int(times)
    assert got == [Counter(lm_score.normal(t).split() + [b""]) for t in texts]
    assert len(lm_score.tokens_of(pa.array([], pa.string())).text) == 0


def test_groups_hold_every_row_whatever_their_size(monkeypatch):
    texts = pa.array(["one two", None, "", "two two"] * 5)
    batches = [pa.RecordBatch.from_arrays([texts[i:i + 3]], ["text"]) for i in range(0, 20, 3)]
    found = []
    for size in (1, 40, 10_000):
        monkeypatch.setattr(lm_score, "GATHER_BYTES", size)
        counts: Counter = Counter()
        for out in lm_score._count_words(iter(batches)):
            for r in out.to_pylist():
                counts[r["is_byte"], r["token"]] += r["n"]
        found.append(counts)
    assert found[0] == found[1] == found[2]
    assert found[0][False, b"two"] == 15 and found[0][False, b""] == 20
