"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.sources.tables import stage

#: What separates words in every contract here: the blank and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that other columns of any name do no harm."""
    return df.select(*(F.col(f"`{c}`") for c in columns or ("doc_id", "text")))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(divisor))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z in lower case; bytes.split() cuts exactly at blank and 9 to 13."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def pieces(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches in slices of at most ``rows`` rows, so that long texts do not pile up."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def per_worker(make: Callable, *args):
    """``make(*args)`` once per worker process, kept over its tasks.

    Task functions travel by value, so a module-level cache would start empty in every task.
    """
    kept = vars(sys).setdefault("_storyloom_kept", {})
    key = (make.__module__, make.__qualname__, *args)
    if key not in kept:
        kept[key] = make(*args)
    return kept[key]


__all__ = ["SPACE", "WORD", "documents", "per_worker", "pieces", "remainder", "stage", "table", "words_of"]
