"""Toxicity by maximum-scoring segments.

Token weights are log-odds between toxic and clean labelled documents with an informative
Dirichlet prior (the pooled frequencies). A linear-time scan finds all maximal-scoring
segments of a document; extreme-value statistics of such segments (lambda from the
background distribution of weights, K by maximum likelihood on clean documents) turn
segment scores into p-values that allow for the document's length. A document's evidence
is the sum of -log10 p over its significant segments (of the best one if none is); a
logistic curve on it gives the probability.

The model is fitted on a bounded sample of labelled rows (``MAX_LABELLED``, those with the
smallest hash of the id); a token it holds has some ten documents of the sample, so the
model is bounded as the sample is, and is broadcast. Scoring covers every whole text, without a shuffle.

Defined results
* tokens are runs of letters, digits and underscores, lower-cased; a token counts once
  per labelled document
* labels of one id that disagree count as toxic; null labels or ids are not learnt from
* a null or empty text, or one without a token of positive weight, has no evidence and
  gets the calibrated probability of that case; without labels of both classes every
  score is the share of toxic labels (0 without labels)
* every row gives a row, repeated rows too; a null doc_id stays null and is held out; an
  empty table gives no rows; other columns are not read
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import fixed, fold, map_arrow, unwrapped, wrapped

#: labelled rows that the model is fitted on at most
MAX_LABELLED = 20_000
#: folds (crc32 of the id modulo 5) whose labels are never learnt; that calibrate
HELD_OUT, CALIBRATION = 0, 4
#: strength of the Dirichlet prior in tokens; evidence that a token needs (root of the
#: likelihood ratio statistic: 4.5 leaves about one chance finding in 150,000 tokens)
PRIOR_TOKENS, LEAST_Z = 500.0, 4.5
#: every token costs so much, so that segments without evidence lose
DRIFT = 0.25
WEIGHT_RANGE = (-3.0, 6.0)
#: a segment is significant below this p-value
SIGNIFICANT = 0.01
#: beyond so much evidence the probability stays the same
MOST_EVIDENCE = 50.0
_WORD = re.compile(r"\w+")

SCORED = ("doc_id long, score double, evidence double, n_passages int, "
          "starts array<int>, ends array<int>")


@dataclass
class Model:
    weights: dict[str, float]
    lam: float
    k: float
    #: intercept and slope of the logistic curve on the evidence
    curve: tuple[float, float]


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def maximal_segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) in linear time: a candidate
    absorbs the nearest earlier one that begins lower if that one ends lower too."""
    total = np.concatenate([[0.0], np.cumsum(weights)])
    low: list[float] = []
    high: list[float] = []
    first: list[int] = []
    end: list[int] = []
    link: list[int] = []  # nearest earlier candidate that begins lower
    for i in np.flatnonzero(weights > 0):
        a, b, begin = total[i], total[i + 1], int(i)
        j = len(low) - 1
        while True:
            while j >= 0 and low[j] >= a:
                j = link[j]
            if j < 0 or high[j] >= b:
                break
            a, begin = low[j], first[j]
            del low[j:], high[j:], first[j:], end[j:], link[j + 1:]
            j = link.pop()
        low.append(a)
        high.append(b)
        first.append(begin)
        end.append(int(i) + 1)
        link.append(j)
    return [(f, e, h - x) for f, e, h, x in zip(first, end, high, low)]


def p_value(score: float, n: int, lam: float, k: float) -> float:
    """Of a maximal segment score among ``n`` tokens, by the extreme-value law."""
    return max(-np.expm1(-k * n * np.exp(-lam * score)), 1e-60)


def evidence(tokens: list[str], model: Model) -> tuple[float, list[tuple[int, int]]]:
    """Of a document, and its significant segments (in tokens)."""
    get = model.weights.get
    weights = np.fromiter((get(t, -DRIFT) for t in tokens), float, len(tokens))
    if not (weights > 0).any():
        return 0.0, []
    found = [(a, b, float(-np.log10(p_value(s, len(tokens), model.lam, model.k))))
             for a, b, s in maximal_segments(weights)]
    sure = [x for x in found if x[2] >= -np.log10(SIGNIFICANT)]
    total = sum(e for _, _, e in sure) if sure else max(e for _, _, e in found)
    return min(total, MOST_EVIDENCE), [(a, b) for a, b, _ in sure]


def _probability(x: float, curve: tuple[float, float]) -> float:
    return float(1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * x, -30, 30))))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic, fold of the bounded sample of labelled rows."""
    ids = fixed(labels.select(labels["doc_id"].cast("long").alias("doc_id"),
                              labels["toxic"].cast("int").alias("toxic"))
                .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
                .withColumn("fold", fold(F.col("doc_id"))).filter(F.col("fold") != HELD_OUT)
                .groupBy("doc_id", "fold").agg(F.max("toxic").alias("toxic"))
                .withColumn("turn", F.xxhash64("doc_id")))
    n = ids.count()
    if n > MAX_LABELLED:
        # slightly more than are wanted, by their hashes; only these are sorted in one task
        share = (MAX_LABELLED + 8 * MAX_LABELLED**0.5) / n
        some = ids.filter(F.col("turn") <= min(int(share * 2**64), 2**64 - 1) - 2**63)
        ids = some if some.count() >= MAX_LABELLED else ids
        ids = ids.orderBy("turn", "doc_id").limit(MAX_LABELLED)
    ids = ids.drop("turn")
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return own.join(F.broadcast(ids), "doc_id")


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic > 0].update(set(tokens_of(text)))
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[t] for t in names], pa.int64())
                                             for c in counts)], ["token", "clean", "toxic"])


def _log_odds(sample: DataFrame) -> tuple[dict[str, float], np.ndarray, np.ndarray]:
    """Weights of the tokens with enough evidence, and the background distribution:
    weights and their probabilities in clean documents."""
    counts = fixed(map_arrow(sample.select("text", "toxic"), _count_tokens,
                             "token string, clean long, toxic long")
                   .groupBy("token").agg(F.sum("clean").alias("clean"),
                                         F.sum("toxic").alias("toxic")))
    n0, n1 = counts.agg(F.sum("clean"), F.sum("toxic")).first()
    if not n0 or not n1:
        return {}, np.zeros(0), np.zeros(0)

    def logit(y: Column, n: int, prior: Column) -> Column:
        return F.log((y + prior) / (n + PRIOR_TOKENS - y - prior))

    prior = PRIOR_TOKENS * (F.col("clean") + F.col("toxic")) / (n0 + n1)
    delta = logit(F.col("toxic"), n1, prior) - logit(F.col("clean"), n0, prior)
    both = F.col("clean") + F.col("toxic")

    def part(y: Column, n: int) -> Column:
        return F.when(y > 0, y * F.log(y * (n0 + n1) / (both * n))).otherwise(0.0)

    ratio = 2 * (part(F.col("clean"), n0) + part(F.col("toxic"), n1))
    best = (counts.select("token", ((F.col("clean") + prior) / (n0 + PRIOR_TOKENS)).alias("p"),
                          delta.alias("delta"),
                          F.sqrt(F.greatest(ratio, F.lit(0.0))).alias("z"))
            # a token needs some ten documents of the bounded sample to get there
            .filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "token").collect())
    weights = {r.token: float(np.clip(r.delta, *WEIGHT_RANGE)) - DRIFT for r in best}
    values = np.array([weights[r.token] for r in best] + [-DRIFT])
    shares = np.array([r.p for r in best])
    return weights, values, np.append(shares, max(1 - shares.sum(), 0.0))


def _lambda(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(p exp(lambda s)) = 1; 1 where there is none."""
    if not len(values) or values.max() <= 0 or values @ shares >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while shares @ np.exp(high * values) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if shares @ np.exp(middle * values) < 1 else (low, middle)
    return (low + high) / 2


def _observe(model: Model):
    """Per document: toxic, number of tokens, best segment score, evidence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = tokens_of(text)
                get = model.weights.get
                weights = np.array([get(t, -DRIFT) for t in tokens])
                best = max((s for _, _, s in maximal_segments(weights)), default=0.0)
                rows.append((toxic, len(tokens), float(best), evidence(tokens, model)[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int32(), pa.int64(), pa.float64(), pa.float64()))],
                ["toxic", "n", "best", "evidence"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge logistic regression on one feature by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(2), np.diag([1e-3, 1.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fitted on at most MAX_LABELLED labelled rows outside the held-out fold; one fold
    of them calibrates, the others give the weights."""
    sample = fixed(_labelled(docs, labels))
    n, toxic = sample.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    share = min(max((toxic or 0) / max(n, 1), 1e-9), 1 - 1e-9)
    flat = Model({}, 1.0, 1.0, (float(np.log(share / (1 - share))), 0.0))
    weights, values, shares = _log_odds(sample.filter(F.col("fold") != CALIBRATION))
    if not weights:
        return flat
    model = Model(weights, _lambda(values, shares), 1.0, flat.curve)
    rest = sample.filter(F.col("fold") == CALIBRATION).select("text", "toxic")
    columns = "toxic int, n long, best double, evidence double"
    seen = map_arrow(rest, _observe(model), columns).collect()
    clean = [(r.n, r.best) for r in seen if not r.toxic and r.n]
    if not clean or len(clean) == len(seen):
        return flat
    model.k = len(clean) / max(sum(n * np.exp(-model.lam * s) for n, s in clean), 1e-12)
    seen = map_arrow(rest, _observe(model), columns).collect()
    model.curve = _logistic(np.array([r.evidence for r in seen]),
                            np.array([r.toxic for r in seen], float))
    return model


def _places(text: str, segments: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Segments of tokens as code point offsets of the lower-cased text."""
    spans = [m.span() for m in _WORD.finditer(text.lower())]
    return [(spans[a][0], spans[b - 1][1]) for a, b in segments]


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found, segments = evidence(tokens_of(text), model)
                places = _places(text, segments) if segments else []
                rows.append((_probability(found, model.curve), found, len(places),
                             [a for a, _ in places], [b for _, b in places]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.int32()),
                     pa.list_(pa.int32()))))],
                ["doc_id", "score", "evidence", "n_passages", "starts", "ends"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, evidence, and the significant passages
    (number, starts, ends) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]),
                     _score(shared), SCORED)


def _clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            keep = [_probability(evidence(tokens_of(t), model)[0], model.curve) < 0.5
                    for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def kept_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents (all columns) with a score under one half, in place."""
    rows = wrapped(docs, docs["text"].alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return unwrapped(map_arrow(rows, _clean(shared), rows.schema))
