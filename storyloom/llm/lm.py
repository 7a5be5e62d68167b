"""Language-model scores: the probability of a text, summed over all subword segmentations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import per_worker, stage, words_of
from storyloom.llm.lattice import SPACE_PIECE, VOCABULARY, Lattice, expected, expected_plain, forward, log_table

BLOCK_BITS = 12  # 4096 documents share one table of word scores
PRIOR_WORDS = 1000.0  # weight of the vocabulary's own scores, in pieces


def score_texts(docs: DataFrame, train: str, path: str | None = None) -> DataFrame:
    """Word-count base score and subword lattice score of each whole text.

    ``docs`` has doc_id, text and the boolean column ``train``. Tokens are the words of the text, A-Z
    in lower case, then one end. The base score adds up smoothed word frequencies of the
    training texts. The model's pieces start from the vocabulary's own scores and take over
    their expected uses in all training words (one EM step); a text's probability is the product
    over its words of the sum over their segmentations, times the end. Null and empty texts have
    the end token alone; without training texts the vocabulary's scores stand. Returns
    doc_id, train, n_tokens, n_known, train_tokens, base_score, score (log10).

    Documents are cut into blocks; a block asks once for each of its words, so a word in every text
    moves as many rows as there are blocks. Word counts and scores are tables that grow
    with the input; only two sums and one number per vocabulary piece reach the driver.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
    rows = stage(rows.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)))
    asked = rows.select("block", "text", "train").mapInArrow(_block_words, "block long, word binary, n long")
    counts = stage(asked.groupBy("word").agg(F.sum("n").alias("c")))
    seen, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = rows.filter("train").count()
    total, distinct = seen + ends, kinds + (ends > 0)
    logs = _fit(counts, ends, path)
    known = counts.mapInArrow(_word_scores(logs, path), "word binary, c long, lp float")
    back = asked.select("block", "word").join(known, "word")
    table = back.select("block", F.lit(0).alias("kind"), "word", "c", "lp", *(F.lit(None).cast(t).alias(n) for n, t in (("doc_id", rows.schema["doc_id"].dataType), ("text", "string"), ("train", "boolean"))))
    texts = rows.select("block", F.lit(1).alias("kind"), *(F.lit(None).cast(t).alias(n) for n, t in (("word", "binary"), ("c", "long"), ("lp", "float"))), "doc_id", "text", "train")
    met = table.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(
        _score(total, distinct, ends, logs[-1]),
        f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each block with their number in training texts."""
    for batch in batches:
        blocks: dict[int, tuple[Counter, set]] = {}
        for block, text, train in zip(*(c.to_pylist() for c in batch.columns)):
            learned, others = blocks.setdefault(block, (Counter(), set()))
            (learned if train else others).update(words_of(text))
        for block, (learned, others) in blocks.items():
            words = [*learned, *(others - learned.keys())]
            n = [*learned.values(), *[0] * (len(words) - len(learned))]
            for a in range(0, len(words), 50_000):
                part = words[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array(part, pa.binary()), pa.array(n[a : a + 50_000], pa.int64())], names=["block", "word", "n"])


def _as_word(word: bytes) -> str:
    return SPACE_PIECE + word.decode("utf-8", "surrogatepass")


def _fit(counts: DataFrame, ends: int, path: str) -> list[float]:
    """Log probabilities of all pieces after one EM step; the last entry is the end's."""

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = per_worker(Lattice, path)
        prior = lattice.prior()
        logs, shares = log_table(prior), prior.tolist()
        sums, long_sums = [0.0] * lattice.size, np.zeros(lattice.size)
        for batch in batches:
            for word, c in zip(*(x.to_pylist() for x in batch.columns)):
                w = _as_word(word)
                arcs = lattice.arcs(w)
                if len(w) > 32 or not expected_plain(len(w), arcs, shares, c, sums):
                    expected(len(w), arcs, logs, c, long_sums)
        sums = np.array(sums) + long_sums
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used])], names=["piece", "uses"])

    lattice = per_worker(Lattice, path)
    weight = lattice.prior() * PRIOR_WORDS
    for r in counts.filter("c > 0").select("word", "c").mapInArrow(uses, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
        weight[r["piece"]] += r["uses"]
    weight[lattice.end] = ends + 0.5
    p = weight / weight.sum()
    return [*np.round(log_table(p), 9).tolist(), float(log(p[lattice.end]))]


def _word_scores(logs: list[float], path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = per_worker(Lattice, path)
        for batch in batches:
            words = (_as_word(w) for w in batch.column(0).to_pylist())
            lp = [forward(len(w), lattice.arcs(w), logs)[-1] for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(lp, np.float32))], names=["word", "c", "lp"])

    return run


def _score(total: int, distinct: int, ends: int, end_log: float):
    names = ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    scale = total + 0.5 * (distinct + 1)

    def base(c: int) -> float:
        return log10((c + 0.5) / scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, bases, logs, new = None, {}, {}, set()
        for batch in batches:
            out = []
            blocks, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words, cs, lps = (batch.column(i).to_pylist() for i in (2, 3, 4))
            ids, texts, trains = (batch.column(i).to_pylist() for i in (5, 6, 7))
            for i, block in enumerate(blocks):
                if block != here:
                    here, bases, logs, new = block, {}, {}, set()
                if kinds[i] == 0:
                    bases[words[i]], logs[words[i]] = base(cs[i]), lps[i]
                    if not cs[i]:
                        new.add(words[i])
                    continue
                said = words_of(texts[i])
                n_known = len(said) - (sum(map(new.__contains__, said)) if new else 0) + (ends > 0)
                b = sum(map(bases.__getitem__, said)) + base(ends)
                s = (sum(map(logs.__getitem__, said)) + end_log) / log(10)
                out.append((ids[i], trains[i], len(said) + 1, n_known, total, b, s))
            if out:
                cols = list(zip(*out))
                kinds_out = (batch.schema.field(5).type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds_out)], names=names)

    return run
