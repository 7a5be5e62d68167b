"""Keyword scores, gate rule and tie-safe ordering keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
BM25_K1 = 1.2
BM25_B = 0.75
BM25_SHIFT = 1.0
WEIGHT_FLOOR = 1e-5
PROB_DIGITS = 5


def smoothed_idf(n: Column, df: Column) -> Column:
    return F.log((n + F.lit(1.0)) / (df + F.lit(1.0))) + F.lit(1.0)


def keyword_score(method: str, tf: Column, idf: Column, length: Column, mean_length: Column) -> Column:
    if method == "tfidf":
        return tf * idf
    if method == "bm25":
        x = tf / (F.lit(1 - BM25_B) + F.lit(BM25_B) * length / mean_length)
        return (F.lit(BM25_K1 + 1) * x / (F.lit(BM25_K1) + x) + F.lit(BM25_SHIFT)) * idf
    raise ValueError(f"unknown keyword score: {method}")


def rank_key(score: Column, digits: int = 9) -> Column:
    """Score as an integer, so that equal scores summed in another order stay equal."""
    return F.floor(score * F.lit(float(10**digits)) + F.lit(0.5))


def outlier_threshold(k: Column, temperature: float) -> Column:
    return F.pow(F.lit(1.0) - F.lit(1.0) / (k + F.lit(1.0)), F.lit(float(temperature)))


def is_outlier(conf: Column, k: Column, temperature: float) -> Column:
    """Too little confidence; the difference is rounded so that equality is stable."""
    return F.round((F.lit(1.0) - conf) - outlier_threshold(k, temperature), 12) > 0


def divergence_part(p: Column, q: Column) -> Column:
    """p ln(2p/(p+q)) + q ln(2q/(p+q)), with 0 ln 0 = 0."""
    def side(x):
        return F.when(x > 0, x * F.log(F.lit(2.0) * x / (p + q))).otherwise(F.lit(0.0))

    return side(p) + side(q)
