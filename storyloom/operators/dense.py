"""Every article against every centre, as a blocked matrix product.

A softmax over clusters needs all similarities of an article, but never as rows:
articles are cut into slices and centres into blocks, each (block, slice) tile is
one Spark group holding a bounded number of both, and a tile only returns the
partial sums and the best centre of each of its articles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.arrow import instants, matrix
from storyloom.functions.dates import MICROS_PER_DAY, micros

TILE_BYTES = 32 << 20  # vectors one tile may hold of either side
ROWS_AT_ONCE = 512  # articles multiplied in one step inside a tile

PARTIAL = "id string, k bigint, sum_exp double, sum_cos double, best_sim double, best_cluster bigint"


def slots(rows: int, dim: int, tile_bytes: int) -> int:
    return max(1, math.ceil(rows * dim * 8 / tile_bytes))


def score_against_centers(
    articles: DataFrame,
    entries: DataFrame,
    temperature: float = 1.0,
    window_size: int | None = None,
    euclidean: bool = False,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """Per article: number of centres, sum of exp(T*cos), sum of cos, best centre.

    ``entries`` has ``cluster_id``, ``vector`` and, when ``window_size`` is given, a
    ``date``: a cluster's centre is then the sum of its entries weighted by
    exp(-|days|/window_size) between article and entry. An entry without date has
    weight 1. With ``euclidean`` the best centre is the one at the smallest distance
    and ``best_sim`` is 2xc - cc. Ties go to the lowest cluster id.
    """
    spark = articles.sparkSession
    dated = window_size is not None
    n, dim = articles.agg(F.count("*"), F.max(F.size("embedding"))).first()
    m = entries.count()
    if not n or not m:
        return spark.createDataFrame([], PARTIAL)
    blocks = slots(m, dim, tile_bytes)
    slices = max(slots(n, dim, tile_bytes), min(spark.sparkContext.defaultParallelism, math.ceil(n / 64)))

    def at(col: Column) -> Column:
        return (micros(col) if dated else F.lit(None).cast("bigint")).alias("at")

    left = articles.select(
        "id",
        F.col("embedding").alias("vector"),
        at(F.col("date")) if dated else at(None),
        F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    right = entries.select(
        "cluster_id",
        "vector",
        at(F.col("date")) if dated else at(None),
        F.pmod(F.xxhash64("cluster_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
    )
    tiles = (
        left.groupBy("block", "slice")
        .cogroup(right.groupBy("block", "slice"))
        .applyInArrow(_tile_function(float(temperature), window_size, euclidean), PARTIAL)
    )
    if blocks == 1:
        return tiles
    best = F.max(F.struct(_key(F.col("best_sim")), -F.col("best_cluster"), F.col("best_sim")))
    return (
        tiles.groupBy("id")
        .agg(
            F.sum("k").alias("k"),
            F.sum("sum_exp").alias("sum_exp"),
            F.sum("sum_cos").alias("sum_cos"),
            best.alias("best"),
        )
        .select(
            "id", "k", "sum_exp", "sum_cos",
            F.col("best.best_sim").alias("best_sim"),
            (-F.col("best.col2")).alias("best_cluster"),
        )
    )


def _key(sim: Column) -> Column:
    return F.floor(sim * 1e12 + 0.5)


def decay(at: np.ndarray, entry_at: np.ndarray, undated: np.ndarray, window_size: int) -> np.ndarray:
    """Weight of state entries for an article instant, by whole days rounded down."""
    days = np.floor_divide(at - entry_at, MICROS_PER_DAY)
    return np.where(undated, 1.0, np.exp(-np.abs(days) / window_size))


def _tile_function(temperature: float, window_size: int | None, euclidean: bool):
    def cosines(vectors, centers):
        length = np.linalg.norm(vectors, axis=1)[:, None] * np.linalg.norm(centers, axis=1)[None, :]
        product = vectors @ centers.T
        return np.divide(product, length, out=np.zeros_like(product), where=length > 0)

    def closeness(vectors, centers):
        return 2 * (vectors @ centers.T) - (centers**2).sum(axis=1)[None, :]

    def tile(articles: pa.Table, entries: pa.Table) -> pa.Table:
        names = ["id", "k", "sum_exp", "sum_cos", "best_sim", "best_cluster"]
        types = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
        if articles.num_rows == 0 or entries.num_rows == 0:
            return pa.table([pa.array([], t) for t in types], names)
        owner = entries["cluster_id"].to_numpy()
        order = np.argsort(owner, kind="stable")
        owner, sums = owner[order], matrix(entries["vector"])[order]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        clusters = owner[starts]
        vectors = matrix(articles["vector"])

        if window_size is None:
            centers = np.add.reduceat(sums, starts)
            groups = [(np.arange(s, min(s + ROWS_AT_ONCE, len(vectors))), centers)
                      for s in range(0, len(vectors), ROWS_AT_ONCE)]
        else:
            entry_at, undated = (a[order] for a in instants(entries["at"]))
            article_at = articles["at"].to_numpy()

            def per_date():
                for day in np.unique(article_at):
                    weight = decay(day, entry_at, undated, window_size)
                    centers = np.add.reduceat(weight[:, None] * sums, starts)
                    rows = np.flatnonzero(article_at == day)
                    for s in range(0, len(rows), ROWS_AT_ONCE):
                        yield rows[s : s + ROWS_AT_ONCE], centers

            groups = per_date()

        n = len(vectors)
        sum_exp, sum_cos, best = np.empty(n), np.empty(n), np.empty(n)
        best_cluster = np.empty(n, dtype=np.int64)
        for rows, centers in groups:
            sims = (closeness if euclidean else cosines)(vectors[rows], centers)
            winner = np.argmax(np.floor(sims * 1e12 + 0.5), axis=1)
            best[rows] = sims[np.arange(len(rows)), winner]
            best_cluster[rows] = clusters[winner]
            sum_exp[rows] = 0.0 if euclidean else np.exp(temperature * sims).sum(axis=1)
            sum_cos[rows] = sims.sum(axis=1)
        columns = [articles["id"], np.full(n, len(clusters)), sum_exp, sum_cos, best, best_cluster]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for c, t in zip(columns, types)], names)

    return tile


def nearest_center(articles: DataFrame, centers: DataFrame) -> DataFrame:
    """Most similar centre of each article by cosine; ties go to the lowest id."""
    scored = score_against_centers(articles, centers.select("cluster_id", F.col("center").alias("vector")))
    return scored.select("id", F.col("best_cluster").alias("cluster_id"), F.col("best_sim").alias("cos"))
