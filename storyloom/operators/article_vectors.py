"""Article vectors: theme-weighted or plain means of sentence vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions import text as tx
from storyloom.functions.scoring import WEIGHT_FLOOR
from storyloom.functions.vectors import scale, vector_mean, vector_sum


def sentence_weights(sentence_tf: DataFrame, keywords: DataFrame, sentences: DataFrame) -> DataFrame:
    """Weight of each sentence from the article's keywords; they sum to 1.

    Keyword scores can be negative. Should the raw weights sum to exactly zero the
    sentences get equal weights.
    """
    raw = (
        sentence_tf.join(keywords.select("id", "term", "score"), ["id", "term"])
        .groupBy("id", "sent_idx")
        .agg(F.sum(F.col("tf") * F.col("score")).alias("raw"))
    )
    return _shares(raw, sentences)


def token_weights(sentences: DataFrame, keywords: DataFrame) -> DataFrame:
    """``sentence_weights`` from the tokens (id, sent_idx, tokens): no table of sentence counts is written.

    An article's keywords are few; its sentences meet them as one list, inside the row.
    """
    found = F.collect_list(F.struct("term", "score"))
    own = keywords.groupBy("id", "term").agg(F.sum("score").alias("score")).groupBy("id").agg(F.map_from_entries(found).alias("scores"))
    scores = F.transform(tx.unigrams_and_bigrams(F.col("tokens")), lambda t: F.coalesce(F.element_at(F.col("scores"), t), F.lit(0.0)))
    part = F.aggregate(scores, F.lit(0.0), lambda total, score: total + score)
    raw = sentences.join(own, "id").select("id", "sent_idx", part.alias("raw")).groupBy("id", "sent_idx").agg(F.sum("raw").alias("raw"))
    return _shares(raw, sentences)


def _shares(raw: DataFrame, sentences: DataFrame) -> DataFrame:
    everything = Window.partitionBy("id")
    return (
        sentences.select("id", "sent_idx")
        .join(raw, ["id", "sent_idx"], "left")
        .withColumn("raw", F.coalesce("raw", F.lit(0.0)) + F.lit(WEIGHT_FLOOR))
        .withColumn("total", F.sum("raw").over(everything))
        .withColumn("n", F.count("*").over(everything))
        .select(
            "id",
            "sent_idx",
            F.when(F.col("total") == 0, F.lit(1.0) / F.col("n"))
            .otherwise(F.col("raw") / F.col("total"))
            .alias("weight"),
        )
    )


def weighted_article_vectors(weights: DataFrame, sentence_vectors: DataFrame) -> DataFrame:
    return weighted_sums(weights.join(sentence_vectors.select("id", "sent_idx", "embedding"), ["id", "sent_idx"]))


def weighted_sums(rows: DataFrame) -> DataFrame:
    """Sum of weight x vector per article, over rows that carry both."""
    return rows.groupBy("id").agg(vector_sum(scale(F.col("embedding"), F.col("weight"))).alias("embedding"))


def mean_article_vectors(sentence_vectors: DataFrame) -> DataFrame:
    return sentence_vectors.groupBy("id").agg(vector_mean(F.col("embedding")).alias("embedding"))
