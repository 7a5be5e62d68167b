"""Expressions and aggregates on ARRAY<DOUBLE> vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 when a vector has no length."""
    return safe_ratio(dot(a, b), norm(a) * norm(b))


def safe_ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def scale(a: Column, factor: Column) -> Column:
    return F.transform(a, lambda v: v * factor)


def unit(a: Column) -> Column:
    """The vector scaled to length 1; a zero vector stays zero."""
    length = norm(a)
    return F.when(length > 0, scale(a, F.lit(1.0) / length)).otherwise(a)


def vector_sum(a: Column) -> Column:
    """Sum of vectors, with partial sums before the shuffle."""
    return vector_to_array(Summarizer.sum(array_to_vector(a)))


def vector_mean(a: Column) -> Column:
    return vector_to_array(Summarizer.mean(array_to_vector(a)))


def parse_vector(text: Column) -> Column:
    """Vector kept as JSON text."""
    return F.from_json(text, "array<double>")
