"""Cluster themes and the keyword history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions import scoring
from storyloom.functions.dates import state_age, timestamp_ntz
from storyloom.functions.skew import HOT_ROWS, join_frequent
from storyloom.operators.terms import top_terms
from storyloom.sources.tables import stage


def decayed_cluster_terms(tf_state: DataFrame, live: DataFrame, to_date, window_size: int) -> DataFrame:
    """Term sums of live clusters, older dates decayed."""
    age = state_age(timestamp_ntz(to_date), F.col("date"))
    return (
        tf_state.join(live.select("cluster_id"), "cluster_id", "left_semi")
        .withColumn("age", age)
        .filter(F.col("age") < window_size)
        .groupBy("cluster_id", "term")
        .agg(F.sum(F.exp(-F.col("age") / F.lit(float(window_size))) * F.col("tf")).alias("tf"))
    )


def plain_cluster_terms(members: DataFrame, article_tf: DataFrame) -> DataFrame:
    """Term sums over the members that are in the window."""
    return (
        members.filter(F.col("cluster") >= 0)
        .select("id", F.col("cluster").alias("cluster_id"))
        .join(article_tf.select("id", "term", "tf"), "id")
        .groupBy("cluster_id", "term")
        .agg(F.sum("tf").cast("double").alias("tf"))
    )


def cluster_theme(cluster_tf: DataFrame, n: int, method: str = "tfidf", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Best n terms per cluster with score and share among them.

    ``cluster_tf`` is read several times and should be a written table.
    """
    clusters, total = cluster_tf.agg(F.count_distinct("cluster_id"), F.sum("tf")).first()
    frequency = stage(cluster_tf.groupBy("term").agg(F.count("*").alias("df")))
    idf = frequency.withColumn("idf", scoring.smoothed_idf(F.lit(clusters), F.col("df")))
    rows = cluster_tf
    if method == "bm25":
        lengths = cluster_tf.groupBy("cluster_id").agg(F.sum("tf").alias("length"))
        rows = rows.join(lengths, "cluster_id")
    scored = join_frequent(rows, idf, ["term"], "df", "cluster_id", hot_rows)
    mean_length = F.lit((total or 0.0) / max(clusters, 1))
    length = F.col("length") if method == "bm25" else F.lit(None)
    score = scoring.keyword_score(method, F.col("tf"), F.col("idf"), length, mean_length)
    best = top_terms(scored.withColumn("score", score), n, by="cluster_id")
    share = F.col("tf") / F.sum("tf").over(Window.partitionBy("cluster_id"))
    return best.select(
        "cluster_id", "rank", "term", "score", F.bround(share, scoring.PROB_DIGITS).alias("prob")
    )


def keyword_history(theme: DataFrame, window_id: int) -> DataFrame:
    """Keywords of each cluster in one window, best first (at most n per cluster)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return (
        theme.groupBy("cluster_id")
        .agg(ordered.alias("k"))
        .select(F.lit(window_id).cast("int").alias("window_id"), "cluster_id", F.col("k.term").alias("keywords"))
    )
