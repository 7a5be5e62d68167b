"""Joins on a key of which few values are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of one key value that a single task may get


def join_frequent(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    frequency: str,
    spread: str,
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Join many rows per key with one row per key, splitting frequent keys.

    ``per_key[frequency]`` tells how many rows of ``rows`` carry the key. A key with
    more than ``hot_rows`` of them is cut into parts by a hash of ``spread``, and its
    single row is repeated once per part, so no task gets more than about
    ``hot_rows`` rows of it. Every such key is split; their list is as long as the rows
    over ``hot_rows``, and Spark broadcasts it only under its own size limit. The result is the plain join, and without any hot key
    so is the plan; ``per_key`` should be a written table, as it is looked at first.
    """
    hot = (
        per_key.filter(F.col(frequency) > hot_rows)
        .select(*keys, F.ceil(F.col(frequency) / hot_rows).cast("int").alias("_parts"))
    )
    if hot.isEmpty():
        return rows.join(per_key, keys, how)
    left = rows.join(hot, keys, "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64(F.col(spread)), F.col("_parts")), F.lit(0)).cast("int")
    )
    right = per_key.join(hot, keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    )
    return left.drop("_parts").join(right.drop("_parts"), [*keys, "_part"], how).drop("_part")
