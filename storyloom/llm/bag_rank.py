"""Ranked lexical search over bags: documents alike in the items' terms are scored once, as one class."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.llm.common import pieces, stage

TOP = 10
PASS_TERMS = 200_000  # terms of all items of one pass, about; bounds what travels to every task
_LAST = (1 << 63) - 1  # a null id sorts after all others
# Letters, digits and all beyond ASCII belong to terms; A-Z become lower case.
_FOLD = bytes(b | 0x20 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number per row), item_id, and its distinct terms; staged. Texts without terms have none."""
    narrow = items.select("item_id", F.col("text").cast("string"))
    kind = narrow.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1000):
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    return stage(narrow.mapInArrow(run, f"item_id {kind}, terms array<binary>").withColumn("item", F.monotonically_increasing_id()))


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the text), bag: (term, tf) as 4-byte numbers by term, of the vocabulary only; staged."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1000):
            sizes, found = [], []
            for text in batch.column(1).to_pylist():
                terms = terms_of(text)
                counts = Counter(terms)
                held = sorted((vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys())
                sizes.append(len(terms))
                found.append(np.array(held, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n", "bag"])

    return stage(narrow.mapInArrow(run, "doc_id long, n long, bag binary"))


def holding(bagged: DataFrame, size: int) -> np.ndarray:
    """Per term of the vocabulary, how many documents hold it; each task sends one count a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")[::2]
            total += np.bincount(ids, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    counts = bagged.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for row in counts.toLocalIterator():
        out[row.term] = row.df
    return out


def _best(columns: list[np.ndarray], top: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Of (item, score, least, class) the first ``top`` of each item, and each one's place in its item."""
    order = np.lexsort((columns[3], columns[2], -columns[1], columns[0]))
    columns = [c[order] for c in columns]
    new = np.flatnonzero(np.concatenate([[True], columns[0][1:] != columns[0][:-1]])) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return [c[place < top] for c in columns], place[place < top]


def best_classes(classes: DataFrame, start: np.ndarray, item: np.ndarray, weights: np.ndarray, items: int, top: int) -> DataFrame:
    """place (of the item), score, class: every task's ``top`` classes of each item.

    ``start`` cuts ``item`` and ``weights`` into one run per term. At most ``top`` classes can
    hold the first ``top`` documents: a class's least id stands before its others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64) for _ in range(4)]
        floor = np.ones(items, np.int64)
        for batch in pieces(batches, max(1, min(1000, 1_000_000 // items))):
            found = batch.column(1).to_pylist()
            pairs = np.frombuffer(b"".join(found), "<u4").reshape(-1, 2).astype(np.int64)
            row = np.repeat(np.arange(len(found)), [len(b) // 8 for b in found])
            m = batch.column(2).to_numpy()[row]
            part = 1_000_000_000 * pairs[:, 1] // (1000 * pairs[:, 1] + 8 * m)
            length = start[pairs[:, 0] + 1] - start[pairs[:, 0]]
            at = np.arange(length.sum()) + np.repeat(start[pairs[:, 0]] - (np.cumsum(length) - length), length)
            scores = np.zeros(len(found) * items, np.int64)
            np.add.at(scores, np.repeat(row * items, length) + item[at], weights[at] * np.repeat(part, length))
            r, i = np.nonzero(scores.reshape(-1, items) >= floor)
            new = [i, scores[r * items + i], batch.column(3).to_numpy()[r], batch.column(0).to_numpy()[r]]
            kept, place = _best([np.concatenate(x) for x in zip(kept, new)], top)
            full = place == top - 1
            floor[kept[0][full]] = kept[1][full]
        arrays = [pa.array(kept[k], pa.int64()) for k in (0, 1, 2, 3)]
        yield pa.RecordBatch.from_arrays(arrays, names=["place", "score", "least", "class"])

    found = classes.select("class", "bag", "m", "least").mapInArrow(run, "place long, score long, least long, class long")
    first = Window.partitionBy("place").orderBy(F.desc("score"), "least", "class")
    return found.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= top).select("place", "score", "class")


def _one_pass(asked: DataFrame, docs: DataFrame, top: int) -> DataFrame | None:
    rows = asked.select("item", "terms").toPandas()
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for terms in rows["terms"] for t in terms}))}
    if not vocabulary:
        return None
    bagged = bags(docs, vocabulary)
    total = bagged.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    if not total.documents:
        return None
    held = holding(bagged, len(vocabulary))
    of_term = np.array([vocabulary[bytes(t)] for terms in rows["terms"] for t in terms])
    item = np.repeat(np.arange(len(rows)), rows["terms"].map(len))
    order = np.argsort(of_term, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(of_term, minlength=len(vocabulary)))])
    weights = np.array([weight(total.documents, int(df)) for df in held], np.int64)[of_term[order]]
    sized = bagged.filter(F.length("bag") > 0).withColumn("m", F.expr(f"10 + (90L * n * {total.documents}L) div {total.terms}L"))
    classes = sized.groupBy("m", "bag").agg(F.coalesce(F.min("doc_id"), F.lit(_LAST)).alias("least"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()))
    best = stage(best_classes(classes, start, item[order], weights, len(rows), top))
    chosen = stage(classes.join(best.select("class").distinct(), "class", "left_semi").select("class", "m", "bag"))
    by_id = Window.partitionBy("class").orderBy(F.asc_nulls_last("doc_id"))
    members = sized.join(chosen, ["m", "bag"]).select("class", "doc_id").withColumn("_at", F.row_number().over(by_id)).filter(F.col("_at") <= top).drop("_at")
    numbers = asked.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(rows["item"])], "place long, item long")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    shown = best.join(members, "class").join(numbers, "place").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return shown.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def rank(items: DataFrame, docs: DataFrame, top: int = TOP, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0, best first.

    Documents (doc_id, text) become bags of the terms that any item of the pass holds. Those with
    one bag and one length norm m are a class: Spark groups them by hash and compares the bags in
    full. A class is scored once, against all items of the pass; the classes found are expanded by
    ascending doc_id. Items go in passes of about ``pass_terms`` terms, chosen by hash; no more than
    those (or one longer item) travels to the tasks.

    Null texts have no terms. Documents that share no term of weight above 0 with an item are not
    listed for it. Equal scores go by doc_id, null last; ids are whole numbers. Repeated
    documents are listed each, items that repeat are answered each. Empty tables give no rows.
    """
    asked = item_terms(items)
    passes = max(1, math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / pass_terms))
    parts = (_one_pass(asked.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == i) if passes > 1 else asked, docs, top) for i in range(passes))
    parts = [p for p in parts if p is not None]
    kind = asked.schema["item_id"].dataType.simpleString()
    return reduce(DataFrame.unionByName, parts) if parts else asked.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
