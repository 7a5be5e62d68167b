"""Reads of raw and processed articles."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.dates import timestamp_ntz
from storyloom.functions.text import tokens
from storyloom.functions.vectors import vector_mean
from storyloom.functions.words import STOP_WORDS
from storyloom.operators.preprocess import by_article
from storyloom.operators.terms import article_terms, sentence_terms
from storyloom.schemas import REQUIRED_ARTICLE_COLUMNS, require_columns

RENAMES = {"published": "date", "content": "text"}


def as_articles(raw: DataFrame) -> DataFrame:
    """Raw columns under their working names; fails when one is missing."""
    renamed = require_columns(raw.withColumnsRenamed(RENAMES), REQUIRED_ARTICLE_COLUMNS)
    extra = ["created_at"] if "created_at" in renamed.columns else []
    return renamed.select(*REQUIRED_ARTICLE_COLUMNS, *extra)


def read_all_articles(raw: DataFrame) -> DataFrame:
    return as_articles(raw)


def _instant(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def read_articles_from_days(raw: DataFrame, days: int, now) -> DataFrame:
    """Articles created in the last days, from the midnight before up to now."""
    start = F.date_trunc("day", _instant(now) - F.make_dt_interval(days=F.lit(days)))
    return as_articles(raw.filter((F.col("created_at") >= start) & (F.col("created_at") <= _instant(now))))


def read_todays_articles(raw: DataFrame, now) -> DataFrame:
    start = F.date_trunc("day", _instant(now))
    end = start + F.make_dt_interval(days=F.lit(1))
    return as_articles(raw.filter((F.col("created_at") >= start) & (F.col("created_at") < end)))


def read_unprocessed_articles(raw: DataFrame, processed: DataFrame, days: int, now) -> DataFrame:
    """Recent articles that are not stored yet, newest first."""
    seen = processed.select(F.col("source_article_id").alias("id"))
    return read_articles_from_days(raw, days, now).join(seen, "id", "left_anti").orderBy(F.desc("date"), "id")


def processed_since(articles: DataFrame, since, limit: int | None = None) -> DataFrame:
    return _newest(articles.filter(F.col("date") >= timestamp_ntz(since)), limit)


def processed_on(articles: DataFrame, day, limit: int | None = None) -> DataFrame:
    start = F.date_trunc("day", timestamp_ntz(day)).cast("timestamp_ntz")
    end = start + F.make_dt_interval(days=F.lit(1))
    return _newest(articles.filter((F.col("date") >= start) & (F.col("date") < end)), limit)


def in_date_range(articles: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Both days inclusive, the last one up to 23:59:59."""
    return articles.filter(
        (F.col("date") >= timestamp_ntz(f"{start_date} 00:00:00"))
        & (F.col("date") <= timestamp_ntz(f"{end_date} 23:59:59"))
    )


def _newest(articles: DataFrame, limit: int | None) -> DataFrame:
    newest = articles.orderBy(F.desc("date"), "source_article_id")
    return newest.limit(limit) if limit else newest


# --- chunks, vectors, assembly ----------------------------------------------


def chunks_of(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    return chunks.join(articles.select("source_article_id"), "source_article_id", "left_semi")


def chunks_by_article(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks of each asked article as an ordered list."""
    ordered = F.array_sort(F.collect_list(F.struct("sent_idx", "chunk_id", "text")))
    return chunks_of(articles, chunks).groupBy("source_article_id").agg(ordered.alias("chunks"))


def vectors_of(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Chunks with their vectors; a chunk without vector is dropped.

    Vectors that carry their article's id are joined on it too: chunks hashed on it stay where they are,
    and so does what is grouped by article afterwards.
    """
    keys = [c for c in ("source_article_id", "chunk_id") if c in vectors.columns]
    return chunks.join(vectors.select(*keys, "embedding"), keys)


def assemble_sentences(
    articles: DataFrame, chunk_vectors: DataFrame, stop_words: Iterable[str] = STOP_WORDS, dedupe_title: bool = False
) -> DataFrame:
    """Sentences of stored articles with tokens and vectors.

    The title is put in front as sentence -1 with the mean of the chunk vectors.
    Ingestion stores the title as a chunk as well, so by default it counts twice;
    ``dedupe_title`` leaves the extra one out. Articles without any chunk vector
    do not appear.
    """
    keyed = articles.select(F.col("source_article_id").alias("id"), "date", "title")
    stored = chunk_vectors.select(F.col("source_article_id").alias("id"), "sent_idx", F.col("text").alias("sentence"), "embedding")
    body = stored.join(keyed.select("id", "date"), "id")
    if dedupe_title:
        both = body
    else:
        means = stored.groupBy("id").agg(vector_mean(F.col("embedding")).alias("embedding"))
        titles = (
            keyed.filter(F.col("title").isNotNull())
            .join(means, "id")
            .select("id", F.lit(-1).alias("sent_idx"), F.col("title").alias("sentence"), "embedding", "date")
        )
        both = body.unionByName(titles)
    return both.select(
        "id", "date", "sent_idx", "sentence", tokens(F.col("sentence"), stop_words).alias("tokens"), "embedding"
    )


def assemble_processed_articles(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """One nested row per article, as the reading API returns it."""
    parts = F.struct("sent_idx", "sentence", "tokens", "embedding")
    nested = sentences.groupBy("id").agg(F.array_sort(F.collect_list(parts)).alias("s"))
    return (
        articles.withColumn("id", F.col("source_article_id"))
        .join(nested, "id")
        .select(
            "id",
            "source_article_id",
            F.coalesce(F.col("date"), F.col("created_at").cast("timestamp_ntz")).alias("date"),
            "created_at",
            "title",
            "text",
            F.col("s.sentence").alias("sentences"),
            F.size("s").alias("sentence_counts"),
            F.col("s.tokens").alias("sentence_tokens"),
            F.col("s.embedding").alias("sentence_embds"),
        )
    )


class Corpus(NamedTuple):
    """Clustering data set in long form."""

    articles: DataFrame  # id, date, created_at
    sentences: DataFrame  # id, date, sent_idx, sentence, tokens, embedding
    sentence_tf: DataFrame  # id, sent_idx, term, tf
    article_tf: DataFrame  # id, term, tf


def fetch_sentences(
    articles: DataFrame, chunks: DataFrame, vectors: DataFrame,
    stop_words: Iterable[str] = STOP_WORDS, dedupe_title: bool = False,
) -> DataFrame:
    """Articles to sentences with vectors as one lazy join tree."""
    found = vectors_of(chunks_of(articles, chunks), vectors)
    return assemble_sentences(articles, found, stop_words, dedupe_title)


def fetch_processed(articles: DataFrame, chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    return assemble_processed_articles(articles, fetch_sentences(articles, chunks, vectors))


def read_dataset(
    articles: DataFrame, chunks: DataFrame, vectors: DataFrame, start_date: str, end_date: str,
    stop_words: Iterable[str] = STOP_WORDS, dedupe_title: bool = False,
) -> Corpus:
    """Stored articles of a date range with their term counts."""
    inside = in_date_range(articles, start_date, end_date)
    sentences = fetch_sentences(inside, chunks, vectors, stop_words, dedupe_title)
    sentence_tf = sentence_terms(by_article(sentences))
    present = inside.withColumn("id", F.col("source_article_id")).join(sentences.select("id"), "id", "left_semi")
    return Corpus(present.select("id", "date", "created_at"), sentences, sentence_tf, article_terms(sentence_tf))
