"""From raw documents to token ids: quality rules, near copies, personal data, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.bpe import encode
from storyloom.llm.common import stage, table
from storyloom.llm.dedup import grouped
from storyloom.llm.mixing import fair_mix, text_size
from storyloom.llm.pii import fit as fit_personal
from storyloom.llm.pii import mask
from storyloom.llm.quality import quality

#: A stage with Python cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def _whole(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that an operator needs, and each row whole, so that no other column's name can clash."""
    return docs.select(*needed, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and look like a language; null and empty texts go."""
    return quality(_whole(docs, "doc_id", "text"), keep=("_row",)).filter("kept").select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: of the rows with its smallest id, one text.

    Groups are made of texts, so different texts with one id both stay unless they are near copies; of
    repeated rows one stays. Documents without an id cannot be grouped and stay. Null and empty texts are copies of nothing.
    """
    rows = _whole(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64(F.col("text").cast("string"))).drop("text")
    first = grouped(docs.select("doc_id", "text")).filter("first")
    kept = first.groupBy("doc_id", "set", F.when(F.col("set").isNull(), F.col("text_hash"))).agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    one = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("_row"))
    stay = rows.join(kept, ["doc_id", "text_hash"], "left_semi").withColumn("_at", F.row_number().over(one)).filter("_at = 1")
    return stay.select("_row.*").unionByName(rows.filter(F.col("doc_id").isNull()).select("_row.*"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind in brackets; n_chars follows the text."""
    out = mask(docs, fit_personal(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those that it doesn't take go.

    The mix knows doc_id, source and size alone, so only these and two hashes of the row move through it;
    rows meet their number of times by the hashes. Equal rows have one number together: one of them is
    repeated so often.
    """
    rows = _whole(docs, "doc_id", "text", "source")
    hashes = {"_a": F.xxhash64("_row"), "_b": F.xxhash64(F.lit(1), "_row")}
    sizes = stage(rows.select("doc_id", "source", text_size(F.col("text")).alias("size"), *(h.alias(n) for n, h in hashes.items())))
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    mixed = fair_mix(sizes, keep=("_a", "_b")).groupBy("_a", "_b").agg(F.sum(times).cast("int").alias("times"), F.count(F.lit(1)).alias("equal"))
    met = rows.select("_row").withColumns(hashes).join(stage(mixed.filter("times > 0")), ["_a", "_b"])
    alone = met.filter("equal = 1").select("_row", "times")
    equal = met.filter("equal > 1").groupBy("_a", "_b").agg(F.first("_row").alias("_row"), F.first("times").alias("times")).select("_row", "times")
    return alone.unionByName(equal).select(F.explode(F.array_repeat("_row", F.col("times"))).alias("_row")).select("_row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each document, as often as it comes."""
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
