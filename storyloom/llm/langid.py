"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import per_worker, pieces
from storyloom.llm.lattice import SPACE_PIECE, VOCABULARY, Lattice, expected, forward, forward_plain, log_table

SAMPLE_DOCS = 1500  # training documents per language, about: the bound of the fit
SHARED = 200.0  # weight of the piece shares of all languages together, in pieces
REMEMBERED = 400_000  # words whose scores a worker keeps
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    words = _LETTERS.findall((text or "").lower())
    if "".join(words).isalpha():
        return words
    return "".join(c if c.isalpha() else " " for c in " ".join(words)).split()  # raised digits and the like count as word characters


class Model:
    """Log probabilities of the pieces per language, languages in order."""

    def __init__(self, languages: list[str], logs: list[list[float]]):
        self.languages, self.logs = languages, logs
        self.shares = [[exp(x) for x in row] for row in logs]

    def word(self, word: str, lattice: Lattice) -> list[float]:
        """Log probability of a word in each language."""
        w = SPACE_PIECE + word
        arcs = lattice.arcs(w)
        if len(w) <= 24:
            sums = [forward_plain(len(w), arcs, shares) for shares in self.shares]
            if min(sums) > 1e-290:
                return [log(x) for x in sums]
        return [forward(len(w), arcs, logs)[-1] for logs in self.logs]

    def predict(self, text: str | None, lattice: Lattice, known: list[dict]) -> tuple[str, float]:
        """Most likely language and its share of the likelihood, equal priors; ties to the first by name."""
        said = letter_words(text)
        if not said or not self.languages:
            return UNKNOWN, 0.0
        first = known[0]
        new = {*said}.difference(first)
        if len(known[0]) + len(new) > REMEMBERED:
            new = {*said}
            for scores in known:
                scores.clear()
        for word in new:
            for scores, x in zip(known, self.word(word, lattice)):
                scores[word] = x
        sums = [sum(map(scores.__getitem__, said)) for scores in known]  # words in the text's order
        best = max(range(len(sums)), key=lambda k: (sums[k], -k))
        return self.languages[best], 1.0 / sum(exp(max(s - sums[best], -700.0)) for s in sums)


def fit(labelled: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Piece probabilities per language from about ``sample_docs`` documents of each (chosen by hash).

    Expected uses of pieces under the vocabulary's own scores, over all segmentations of the
    sample's words, smoothed by the shares of all languages. The driver gets one
    number per language and one per language and piece.
    """
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), "text").filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [])
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n))))
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            per: dict[str, Counter] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                per.setdefault(lang, Counter()).update(letter_words(text))
            for lang, c in per.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = per_worker(Lattice, path)
        logs = log_table(lattice.prior())
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                w = SPACE_PIECE + word
                expected(len(w), lattice.arcs(w), logs, n, sums.setdefault(lang, np.zeros(lattice.size)))
        for lang, s in sums.items():
            used = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(s[used])], names=["lang", "piece", "uses"])

    counted = sample.mapInArrow(words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    summed = counted.mapInArrow(uses, "lang string, piece long, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect()
    lattice = per_worker(Lattice, path)
    languages = sorted(sizes)
    weight = np.zeros((len(languages), lattice.size))
    for r in summed:
        weight[languages.index(r["lang"]), r["piece"]] = r["uses"]
    pooled = weight.sum(axis=0) + lattice.prior() * SHARED
    weight += SHARED * pooled / pooled.sum()
    weight /= weight.sum(axis=1, keepdims=True)
    return Model(languages, [np.round(log_table(p), 9).tolist() for p in weight])


def predict(docs: DataFrame, model: Model, path: str, id_column: str = "doc_id") -> DataFrame:
    """Language and score of each whole text: id column, lang_pred, score.

    One row out per row in, no shuffle. A null text or one without a letter is ``und`` with score 0, as
    is every text if nothing was learned.
    """
    narrow = docs.select(id_column, "text")
    field = narrow.schema[0]
    share = narrow.sparkSession.sparkContext.broadcast((model.languages, model.logs))  # languages x vocabulary numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, m, known = per_worker(Lattice, path), Model(*share.value), [{} for _ in share.value[0]]
        for batch in pieces(batches, 500):
            got = [m.predict(t, lattice, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[field.name, "lang_pred", "score"])

    return narrow.mapInArrow(run, f"`{field.name}` {field.dataType.simpleString()}, lang_pred string, score double")
