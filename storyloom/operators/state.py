"""Cluster state: vector and term sums per cluster and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions.dates import state_age, timestamp_ntz
from storyloom.functions.vectors import vector_sum


def embedding_delta(members: DataFrame) -> DataFrame:
    """Sums over newly assigned articles (cluster, date, embedding as it was before)."""
    return (
        members.filter(F.col("cluster") >= 0)
        .groupBy(F.col("cluster").alias("cluster_id"), "date")
        .agg(vector_sum(F.col("embedding")).alias("emb_sum"), F.count("*").alias("n"))
    )


def term_delta(members: DataFrame, article_tf: DataFrame) -> DataFrame:
    return (
        members.filter(F.col("cluster") >= 0)
        .select("id", F.col("cluster").alias("cluster_id"), "date")
        .join(article_tf.select("id", "term", "tf"), "id")
        .groupBy("cluster_id", "date", "term")
        .agg(F.sum("tf").cast("double").alias("tf"))
    )


def _inside(state: DataFrame, to_date, window_size: int | None) -> DataFrame:
    """Entries older than the window are never read again and can go."""
    if to_date is None:
        return state
    return state.filter(state_age(timestamp_ntz(to_date), F.col("date")) < window_size)


def merge_embedding_state(old: DataFrame | None, delta: DataFrame, to_date=None, window_size=None) -> DataFrame:
    if old is None:
        return _inside(delta, to_date, window_size)
    return (
        _inside(old.unionByName(delta), to_date, window_size)
        .groupBy("cluster_id", "date")
        .agg(vector_sum(F.col("emb_sum")).alias("emb_sum"), F.sum("n").alias("n"))
    )


def merge_term_state(old: DataFrame | None, delta: DataFrame, to_date=None, window_size=None) -> DataFrame:
    if old is None:
        return _inside(delta, to_date, window_size)
    return (
        _inside(old.unionByName(delta), to_date, window_size)
        .groupBy("cluster_id", "date", "term")
        .agg(F.sum("tf").alias("tf"))
    )


def rebuild_state(
    assignments: DataFrame, context: DataFrame, article_tf: DataFrame, today, window_size: int
) -> tuple[DataFrame, DataFrame]:
    """State from stored assignments: sums per calendar date younger than the window."""
    day = F.date_trunc("day", F.col("date")).cast("timestamp_ntz")
    members = (
        context.select("id", day.alias("date"), "embedding")
        .join(
            assignments.filter(F.col("cluster_id").isNotNull()).select(
                F.col("source_article_id").alias("id"), F.col("cluster_id").alias("cluster")
            ),
            "id",
        )
        .filter(F.date_diff(timestamp_ntz(today).cast("date"), F.col("date").cast("date")) < window_size)
    )
    return embedding_delta(members), term_delta(members, article_tf)
