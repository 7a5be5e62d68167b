"""One query per operator of this subpackage, with its production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.ann import search
from storyloom.llm.bag_rank import rank
from storyloom.llm.bpe import encode, with_ids_digest
from storyloom.llm.chat import digests, format_chats
from storyloom.llm.common import documents, remainder, table
from storyloom.llm.dedup import near_copies
from storyloom.llm.edit_print import compare_edits
from storyloom.llm.langid import fit as fit_languages
from storyloom.llm.langid import predict as predict_language
from storyloom.llm.lattice import VOCABULARY as PIECES
from storyloom.llm.lm import score_texts
from storyloom.llm.mixing import fair_mix
from storyloom.llm.pii import find as find_personal
from storyloom.llm.pii import fit as fit_personal
from storyloom.llm.quality import quality
from storyloom.llm.repair import damaged, repair
from storyloom.llm.toxicity import learn as learn_toxicity
from storyloom.llm.toxicity import score as score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


#: Two rows that every run formats besides the table: a user and an assistant saying control strings.
CONTROL_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def masked_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = documents(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_CHAT, "conv_id long, turn long, role string, text string")
    shown = digests(format_chats(chats.unionByName(more)))
    return shown.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def hyperminhash_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(documents(table(spark, sf_dir, "documents")))


def factored_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")
    machine = learn_toxicity(docs, labels.filter(remainder("doc_id", 5) != 0))
    return score_toxicity(docs, machine).withColumn("held_out", remainder("doc_id", 5) == 0)


def fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return fair_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def multiprobe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def distribution_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(table(spark, sf_dir, "documents"))
    return find_personal(docs, fit_personal(docs))


def lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(table(spark, sf_dir, "documents")).withColumn("train", remainder("doc_id", 5) != 1)
    return score_texts(docs, "train").withColumn("held_out", ~F.col("train")).drop("train")


def marginal_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(PIECES)
    docs = documents(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    model = fit_languages(docs.filter(remainder("doc_id", 4) != 2), path)
    return predict_language(docs, model, path).withColumn("held_out", remainder("doc_id", 4) == 2)


def prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = with_ids_digest(encode(documents(table(spark, sf_dir, "documents"))))
    return done.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(documents(table(spark, sf_dir, "documents")))


def bag_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(documents(table(spark, sf_dir, "benchmark"), "item_id", "text"), documents(table(spark, sf_dir, "documents")))


def repaired_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = documents(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    said = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return repair(damaged(chats), "present").withColumn("repaired_sha256", F.sha2(said, 256)).drop("repaired")


QUERIES: dict[str, Query] = {
    "op1_masked_chats": masked_chats,
    "op2_hyperminhash_copies": hyperminhash_copies,
    "op3_factored_toxicity": factored_toxicity,
    "op4_fair_mixing": fair_mixing,
    "op5_multiprobe_search": multiprobe_search,
    "op6_distribution_quality": distribution_quality,
    "op7_personal_spans": personal_spans,
    "op8_lattice_likelihood": lattice_likelihood,
    "op9_marginal_language_id": marginal_language_id,
    "op10_prefix_bpe": prefix_bpe,
    "op11_edit_prints": edit_prints,
    "op12_bag_ranking": bag_ranking,
    "op13_branch_and_bound_repair": repaired_chats,
}
