"""Articles to sentences, tokens and sentence vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions import text as tx
from storyloom.functions.words import STOP_WORDS
from storyloom.schemas import REQUIRED_ARTICLE_COLUMNS, require_columns

EMBED_BATCH = 100  # texts per call of the embedding function
TASK_TEXT_BYTES = 2 << 20  # of text whose terms one task holds at once


def clean_articles(articles: DataFrame) -> DataFrame:
    """NULL titles and texts become empty strings."""
    require_columns(articles, REQUIRED_ARTICLE_COLUMNS)
    return articles.withColumns(
        {"title": F.coalesce("title", F.lit("")), "text": F.coalesce("text", F.lit(""))}
    )


def null_counts(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.count("*").alias("articles"),
        F.count_if(F.col("title").isNull()).alias("null_titles"),
        F.count_if(F.col("text").isNull()).alias("null_texts"),
    )


def by_article(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Hash rows on the article id.

    Done on the articles, before text is cut up, it moves the least data, spreads the
    text work, and every later grouping or join on (id, ...) needs no shuffle. Terms take
    far more room than their text, so large tables need ``tasks`` (see ``text_tasks``).
    """
    return rows.repartition(tasks, "id") if tasks else rows.repartition("id")


def text_tasks(texts: DataFrame, task_bytes: int = TASK_TEXT_BYTES) -> int:
    """Number of tasks that get about ``task_bytes`` of column ``text`` each; not under the session's own number."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / task_bytes))


def split_into_sentences(articles: DataFrame, keep: Iterable[str] = ("date",)) -> DataFrame:
    """Long table of sentences; index 0 is the title."""
    all_sentences = tx.with_title(F.col("title"), tx.split_sentences(F.col("text")))
    return clean_articles(articles).select(
        "id", *keep, F.posexplode(all_sentences).alias("sent_idx", "sentence")
    )


def tokenize(sentences: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    return sentences.withColumn("tokens", tx.tokens(F.col("sentence"), stop_words))


def embed_sentences(
    sentences: DataFrame,
    embed: Callable[[list[str]], np.ndarray],
    batch_size: int = EMBED_BATCH,
    mark_errors: bool = False,
) -> DataFrame:
    """Add ``embedding`` by calling a user function on batches of texts.

    With ``mark_errors`` a failing text gets a NULL vector and a message in
    ``error`` instead of failing the job.
    """
    schema = f"{_ddl(sentences)}, embedding array<double>, error string"

    def call(texts: list[str]) -> tuple[list, list]:
        try:
            return [np.asarray(v, dtype=float) for v in embed(texts)], [None] * len(texts)
        except Exception as problem:
            if not mark_errors:
                raise
            if len(texts) == 1:
                return [None], [f"{type(problem).__name__}: {problem}"]
            # find the texts that fail; the others keep their vectors
            parts = [call([t]) for t in texts]
            return [p[0][0] for p in parts], [p[1][0] for p in parts]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors, errors = [], []
            texts = frame["sentence"].tolist()
            for start in range(0, len(texts), batch_size):
                got, failed = call(texts[start : start + batch_size])
                vectors += got
                errors += failed
            yield frame.assign(embedding=vectors, error=errors)

    result = sentences.mapInPandas(run, schema)
    return result if mark_errors else result.drop("error")


def lookup_vectors(sentences: DataFrame, vectors: DataFrame, on: str | list[str]) -> DataFrame:
    """Default provider: vectors from a table; sentences without one are dropped."""
    return sentences.join(vectors, on, "inner")


def nest_articles(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """One row per article with its sentences, tokens and vectors in order."""
    parts = ["sent_idx", "sentence", "tokens"] + (["embedding"] if "embedding" in sentences.columns else [])
    nested = sentences.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("s"))
    columns = {
        "sentences": F.col("s.sentence"),
        "sentence_counts": F.size("s").cast("int"),
        "sentence_tokens": F.col("s.tokens"),
    }
    if "embedding" in parts:
        columns["sentence_embds"] = F.col("s.embedding")
    return articles.join(nested, "id").withColumns(columns).drop("s")


def preprocess_articles(
    articles: DataFrame,
    embed: Callable[[list[str]], np.ndarray],
    stop_words: Iterable[str] = STOP_WORDS,
    batch_size: int = EMBED_BATCH,
) -> DataFrame:
    """The whole step: clean, split, tokenise, embed, nest."""
    cleaned = clean_articles(articles)
    sentences = tokenize(split_into_sentences(cleaned), stop_words)
    return nest_articles(cleaned, embed_sentences(sentences, embed, batch_size))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
