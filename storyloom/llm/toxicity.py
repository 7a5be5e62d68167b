"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import pieces

SAMPLE_DOCS = 12_000  # labelled documents that the fit takes, about: its bound
BUCKETS = 1 << 26  # of hashed terms
MIN_DOCS = 5  # documents of the sample that a term must be in
STEMS = (4, 5, 6, 7)  # letters of a word's start that count as a term
FACTORS = 4
STEPS, BATCH, RATE = 240, 1024, 0.2
Z = 5.0  # standard errors by which a term's mean gradient has to differ from 0: its L1 penalty
L2 = 1e-4
BLOCK = 1024  # terms, and documents, that are met at once in the search for pairs
_TERM = re.compile(r"\w+")


def terms(text: str | None) -> list[str]:
    """Distinct terms of a whole text in lower case: words, and starts of longer words, which stand for their stems."""
    words = set(_TERM.findall((text or "").lower()))
    stems = {w[:n] + "-" for n in STEMS for w in words if len(w) >= n}
    return [*words, *stems]


def hashed(found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the terms of several texts, one after the other, and where each text starts and ends."""
    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
    flat = np.array([t for f in found for t in f], dtype=object)
    return (pd.util.hash_array(flat, categorize=False) % BUCKETS).astype(np.int64) if len(flat) else np.zeros(0, np.int64), ends


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, values, n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Machine:
    """Bias, weight and factors of the kept buckets: bias + sum w + pairs <v_i, v_j> over the terms of a text."""

    def __init__(self, bias: float, buckets: np.ndarray, w: np.ndarray, v: np.ndarray):
        self.bias, self.buckets, self.w, self.v = bias, buckets, w, v

    def scores(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(ends) - 1
        if not len(self.buckets):
            return np.full(n, sigmoid(np.array(self.bias)))
        rows = np.repeat(np.arange(n), np.diff(ends))
        at = np.minimum(np.searchsorted(self.buckets, flat), len(self.buckets) - 1)
        hit = self.buckets[at] == flat
        rows, at = rows[hit], at[hit]
        x = self.bias + _sums(self.w[at], rows, n)
        for f in range(self.v.shape[1]):
            v = self.v[at, f]
            x += 0.5 * (_sums(v, rows, n) ** 2 - _sums(v * v, rows, n))
        return sigmoid(x)


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """A machine from hashed texts and 0/1 labels.

    First a linear part over all terms, with an L1 penalty of ``Z`` standard errors of each term's own
    gradient, so that rare terms are held to the same rule as frequent ones. A term is dropped only if neither
    it nor any pair that it is in says something beyond that part; weights and factors of the others are
    trained together. AdaGrad in a fixed order of the rows.
    """
    if not len(texts):
        return Machine(0.0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    y = labels.astype(float)
    buckets, counts = np.unique(np.concatenate(texts), return_counts=True)
    buckets = buckets[counts >= MIN_DOCS]
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    none = Machine(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    if not len(buckets):
        return none
    rng = np.random.default_rng(seed)
    places = [np.minimum(np.searchsorted(buckets, t), len(buckets) - 1) for t in texts]
    kept = [p[buckets[p] == t] for p, t in zip(places, texts)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    l1 = Z * np.sqrt(np.bincount(np.concatenate(kept), minlength=len(buckets)) * share * (1 - share)) / len(y)
    bias, w, _ = _train(kept, y, bias, np.zeros(len(buckets)), None, l1, rng)
    expected = sigmoid(bias + np.array([w[k].sum() for k in kept]))
    chosen = np.union1d(np.flatnonzero(w), _paired(kept, y, expected, len(buckets)))
    if not len(chosen):
        return none
    place = np.full(len(buckets), -1)
    place[chosen] = np.arange(len(chosen))
    kept = [p[p >= 0] for p in (place[k] for k in kept)]
    v = rng.normal(0, 0.1, (len(chosen), FACTORS))
    bias, w, v = _train(kept, y, bias, w[chosen], v, l1[chosen] / 20, rng)
    return Machine(float(bias), buckets[chosen], w, v)


def _paired(rows: list[np.ndarray], y: np.ndarray, expected: np.ndarray, n_terms: int) -> np.ndarray:
    """Terms of all pairs found in more toxic texts than the ``expected`` chances of the pair's texts explain.

    Every pair that MIN_DOCS toxic texts share is tried; the Poisson excess has to pass the log of the number of
    pairs. Two bounds save work without losing a pair: its excess is at most the sum of p - 1 - log p over
    the toxic texts of either term, and toxic texts alone give a lower bound of the expectation.
    """
    toxic = np.flatnonzero(y > 0)
    if not len(toxic):
        return np.zeros(0, np.int64)
    flat, p = np.concatenate([rows[i] for i in toxic]), np.maximum(expected[toxic], 1e-12)
    often = np.bincount(flat, minlength=n_terms) >= MIN_DOCS
    needed = 2 * math.log(max(often.sum(), 1)) + 2
    terms_ = np.flatnonzero(often & (np.bincount(flat, np.repeat(p - 1 - np.log(p), [len(rows[i]) for i in toxic]), n_terms) > needed))
    if len(terms_) < 2:
        return np.zeros(0, np.int64)
    place = np.full(n_terms, -1)
    place[terms_] = np.arange(len(terms_))
    x = np.zeros((len(rows), len(terms_)), np.uint8)
    for i, r in enumerate(rows):
        x[i, place[r][place[r] >= 0]] = 1
    chance = expected.astype(np.float32)[:, None]

    def together(docs: np.ndarray, one: np.ndarray, two: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
        out = np.zeros((len(one), len(two)), np.float32)
        for a in range(0, len(docs), BLOCK):
            part = docs[a : a + BLOCK]
            left = x[np.ix_(part, one)].astype(np.float32)
            out += (left if weight is None else left * weight[part]).T @ x[np.ix_(part, two)].astype(np.float32)
        return out

    def excess(seen: np.ndarray, mean: np.ndarray) -> np.ndarray:
        mean = np.maximum(mean, 1e-3)
        return np.where(seen > mean, seen * np.log(np.maximum(seen, 1) / mean) - (seen - mean), 0)

    every, found = np.arange(len(rows)), np.zeros(len(terms_), bool)
    for a in range(0, len(terms_), BLOCK):
        one, two = np.arange(a, min(a + BLOCK, len(terms_))), np.arange(a, len(terms_))
        seen = together(toxic, one, two, None)
        open_ = (seen >= MIN_DOCS) & (excess(seen, together(toxic, one, two, chance)) > needed)
        open_ &= two[None] > one[:, None]
        i, j = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
        if not len(i):
            continue
        sure = open_[np.ix_(i, j)] & (excess(seen[np.ix_(i, j)], together(every, one[i], two[j], chance)) > needed)
        found[one[i[sure.any(1)]]] = True
        found[two[j[sure.any(0)]]] = True
    return terms_[found]


def _train(rows: list[np.ndarray], y: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray | None, l1: np.ndarray, rng) -> tuple:
    w, n_terms = w.copy(), len(w)
    gw, gb = np.full(n_terms, 1e-4), 1e-4
    gv = None if v is None else np.full(v.shape, 1e-4)
    for _ in range(math.ceil(STEPS / math.ceil(len(rows) / BATCH))):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            part = order[a : a + BATCH]
            at = np.concatenate([rows[i] for i in part])
            of = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            x = bias + _sums(w[at], of, len(part))
            if v is not None:
                s = np.stack([_sums(v[at, f], of, len(part)) for f in range(FACTORS)], 1)
                x += 0.5 * ((s * s).sum(1) - np.stack([_sums(v[at, f] ** 2, of, len(part)) for f in range(FACTORS)], 1).sum(1))
            g = (sigmoid(x) - y[part]) / len(part)
            gb += g.sum() ** 2
            bias -= RATE * g.sum() / np.sqrt(gb)
            d = np.bincount(at, g[of], n_terms)
            gw += d * d
            step = RATE / np.sqrt(gw)
            w -= step * d
            w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
            if v is not None:
                for f in range(FACTORS):
                    d = np.bincount(at, g[of] * (s[of, f] - v[at, f]), n_terms) + L2 * v[:, f]
                    gv[:, f] += d * d
                    v[:, f] -= RATE / np.sqrt(gv[:, f]) * d
    return bias, w, v


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Machine:
    """A machine from about ``sample_docs`` labelled documents, chosen by a hash of their ids.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; several labels of a document count as their
    largest, null ones not at all. The sample's hashed terms, bounded by the parameter, are
    what the driver gets.
    """
    marked = labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    share = min(1.0, sample_docs / n) if n else 1.0
    sample = F.broadcast(marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)))  # about sample_docs rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = hashed([terms(t) for t in batch.column(1).to_pylist()])
            rows = [np.sort(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64())), batch.column(2)], names=["doc_id", "terms", "toxic"])

    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.mapInArrow(run, "doc_id long, terms array<long>, toxic int").toArrow()
    rows = sorted(zip(rows.column(0).to_pylist(), rows.column(1), rows.column(2).to_pylist()), key=lambda r: r[0])
    return fit([np.asarray(r[1].values, dtype=np.int64) for r in rows], np.array([r[2] for r in rows]))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score and predicted label of each whole text; one row out per row in, no shuffle.

    Null and empty texts get the score of the bias alone.
    """
    narrow = docs.select("doc_id", "text")
    kind = narrow.schema[0].dataType.simpleString()
    held = (machine.bias, machine.buckets, machine.w, machine.v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*held)
        for batch in pieces(batches, 1000):
            got = m.scores(*hashed([terms(t) for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got), pa.array((got >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return narrow.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
