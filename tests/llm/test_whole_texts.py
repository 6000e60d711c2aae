"""Online mixing through whole texts, against the method written down bit by bit."""

from __future__ import annotations

import math
import random

import numpy as np
from test_llm_small import words

from vigil.llm import lm_score


def plain_log10(text: bytes, code, tables) -> float:
    d = lm_score.decisions([text], code)
    n = len(tables)
    w = [[x / lm_score.SCALE for x in lm_score.FIRST_WEIGHTS], [0.0] * n]
    half = lm_score.MAP_CELLS // 2
    cells = [1 / (1 + math.exp(-(i - half + 0.5))) for i in range(lm_score.MAP_CELLS)]
    total, add = 0.0, [[0.0] * n, [0.0] * n]
    for i, y in enumerate(int(b) for b in d.bit):
        x = [float(t[s[i]]) for t, s in zip(tables, d.slots)]
        sure = abs(x[-1]) >= lm_score.GATE_AT
        z = sum((a + sure * b) * c for a, b, c in zip(*w, x))
        z = min(max(z, -lm_score.MOST_LOGIT), lm_score.MOST_LOGIT)
        p, at = 1 / (1 + math.exp(-z)), math.floor(z) + half
        final = p + lm_score.MAP_SHARE * (cells[at] - p)
        total += math.log10(final if y else 1 - final)
        cells[at] += lm_score.MAP_RATE * (y - cells[at])
        for j in range(n):
            g = lm_score.RATE / lm_score.SCALE * (y - p) * x[j]
            add[0][j] += g
            add[1][j] += sure * g
        if i % lm_score.STEP == lm_score.STEP - 1:
            w = [[a + b for a, b in zip(*both)] for both in zip(w, add)]
            add = [[0.0] * n, [0.0] * n]
    return total


def test_weights_and_map_run_through_the_whole_text():
    rnd = random.Random(3)
    texts = [" ".join(words(rnd, n)).encode() for n in (400, 2, 1500, 0)]
    code = lm_score.huffman(np.random.default_rng(0).integers(0, 50, (257, 257)))
    tables = [np.random.default_rng(1).integers(-60, 60, n).astype(np.int8)
              for n in lm_score._sizes(code)]
    got = lm_score.mixed_log10(lm_score.decisions(texts, code), tables)
    want = [plain_log10(t, code, tables) for t in texts]
    assert max(lm_score.decisions(texts, code).bits_of) > 20_000
    assert np.allclose(got, want, rtol=1e-4)
