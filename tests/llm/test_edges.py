"""Nulls, empty and very long texts, repeated rows, empty tables, clashing names: every operator and stage."""

import hashlib
import zlib
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from storyloom.llm import ann, bpe, chat, dedup, langid, lm, mixing, pii, quality, toxicity
from storyloom.llm.common import documents
from storyloom.llm.lattice import VOCABULARY

SENTENCE = "the cat and the dog sat on the mat of a house that was in the town by the river with a bridge and it is old "
ROWS = [
    (1, None, "en", "a", 0, "x"), (2, "", "en", "a", 0, "x"), (3, " \n\t ", None, None, 3, "x"),
    (4, SENTENCE, "en", "a", 10, "x"), (4, SENTENCE, "en", "a", 10, "x"), (5, SENTENCE + "indeed", "en", "b", 10, "x"),
    (6, "w" * 50_000, "de", "b", 50_000, "x"), (7, " ".join(f"word{i}" for i in range(20_000)), "de", "b", 1, "x"),
    (8, "mail me at jo@ex.org or +1 (212) 555-0100 you and the others in the house", "en", None, 1, None), (None, "no id here", None, "c", None, "x"),
    (9, "one two", "fr", "c", 7, "x"), (10, "ONE two", "fr", "c", 7, "x"), (11, "### $$$ %%% !!!", None, "a", 1, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(docs, none):
    got = by_id(quality.quality(documents(docs)))
    assert got[1].n_words == got[3].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[4].kept and got[6].word_chars == 50_000 and got[7].n_words == 20_000 and got[7].n_repeat_words == 0
    assert got[11].n_symbols == 9
    assert quality.quality(documents(none)).count() == 0


def test_mixing(docs, none):
    rows = mixing.fair_mix(documents(docs, "doc_id", "text", "source")).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sum(r.taken for r in rows) <= sum(r.size for r in rows)
    assert mixing.fair_mix(documents(none, "doc_id", "text", "source")).count() == 0


def test_copies(docs, none):
    rows = dedup.near_copies(documents(docs)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS)
    assert got[5].component_id == got[4].component_id == 4 and got[10].component_id == 9
    assert got[1].component_id == 1 and got[2].component_id == 2 and got[1].n_shingles == 0 and got[9].n_shingles == 1
    assert got[None].component_id is None and not got[None].kept
    assert dedup.near_copies(documents(none)).count() == 0


def test_bpe(docs, none):
    got = by_id(bpe.with_ids_digest(bpe.encode(documents(docs))))
    assert got[1].n_tokens == got[3].n_tokens == 0 and got[1].ids_sha256 == hashlib.sha256(b"").hexdigest() and got[1].decoded == ""
    assert bpe.with_ids_digest(bpe.encode(documents(none))).count() == 0


def test_personal_data(docs, none):
    field = pii.fit(documents(docs))
    got = by_id(pii.find(documents(docs), field))
    assert got[8].n_email == got[8].n_phone == 1 and got[1].spans == ""
    assert pii.fit(documents(none)).weights == {} and pii.find(documents(none), field).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (9, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(documents(docs), toxicity.learn(documents(docs), labels)).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(documents(none), toxicity.learn(documents(none), labels.limit(0))).count() == 0


def test_language(docs, none):
    path = public_tokenizers.path(VOCABULARY)
    model = langid.fit(documents(docs, "doc_id", "text", "lang"), path)
    got = by_id(langid.predict(documents(docs), model, path))
    assert got[1].lang_pred == got[11].lang_pred == "und" and got[4].lang_pred == "en"
    empty = langid.fit(documents(none, "doc_id", "text", "lang"), path)
    assert {r.lang_pred for r in langid.predict(documents(docs), empty, path).collect()} == {"und"}


def test_language_model_base_score(docs, none):
    from math import log10

    from pyspark.sql import functions as F

    marked = documents(docs).withColumn("train", F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)))
    rows = lm.score_texts(marked, "train").collect()
    learned = [r for r in ROWS if r[0] is not None and r[0] % 2 == 0]
    said = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(w for r in learned for w in said(r[1]))
    total, kinds = sum(c.values()), len(c)
    texts = {r[0]: r[1] for r in ROWS}
    assert len(rows) == len(ROWS)
    for r in rows:
        words = said(texts[r.doc_id])
        assert r.n_tokens == len(words) and r.train_tokens == total and r.n_known == sum(c[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(log10((c[w] + .5) / (total + .5 * (kinds + 1))) for w in words))
        assert r.score < 0
    assert lm.score_texts(documents(none).withColumn("train", F.lit(True)), "train").count() == 0


def test_search(spark):
    vectors = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
               (7, [1.0, None]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 1.0, 1.0]), *[(i, [1.0, 0.0]) for i in range(20, 120)]]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = ann.search(df, df.filter("vec_id in (0, 2, 5, 9)")).collect()
    first = [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0]
    assert first == [(1, 1.0), (8, 1.0), (20, 1.0), (21, 1.0), (22, 1.0)]
    assert {r.query_id for r in got} == {0, 2}
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_search_finds_all_that_there_is(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    few = rng.standard_normal((6, 64))
    near = rng.standard_normal(48) + rng.standard_normal((300, 48)) / 10
    rows = [(i, v.tolist()) for i, v in enumerate(few)] + [(100 + i, v.tolist()) for i, v in enumerate(near)] + [(99, (-near.mean(axis=0)).tolist())]
    scaled = [(1000 + (7 * i) % 60, [2.0**i, 3 * 2.0**i, 2.0**i]) for i in range(-30, 30)]  # equal directions, no equal vectors
    df = spark.createDataFrame(rows + scaled, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(ann.search(df, df.filter("vec_id < 100 or vec_id in (1000, 1059)")).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.vec_id)
    for i in range(6):
        cos = few @ few[i] / np.linalg.norm(few, axis=1)
        assert got[i] == [j for j in np.argsort(-cos) if j != i]
    away = near @ near.mean(axis=0) / np.linalg.norm(near, axis=1)
    assert got[99] == [100 + j for j in np.argsort(away)[:5]]
    assert got[1000] == [1001, 1002, 1003, 1004, 1005] and got[1059] == [1000, 1001, 1002, 1003, 1004]


def test_chats(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "hi"), (1, 1, "assistant", None), (None, None, "user", "x"), (2, 0, "assistant", "y" * 100_000)]
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0 and got[2].loss_chars == 100_000 and got[None].n_turns == 1
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_stages(spark, docs, none):
    for start in (docs, none):
        now = start
        for name, apply in corpus_pipeline.STAGES:
            now = apply(spark, now, "")
            if name != "token_ids":
                assert now.columns == docs.columns, name
            now = spark.createDataFrame(now.collect(), now.schema)
    for (name, apply), n in zip(corpus_pipeline.STAGES[:3], (1, None, len(ROWS))):
        got = apply(spark, docs, "").collect()
        if name == "near_dedup":
            assert sorted(r.doc_id for r in got if r.doc_id) == [1, 2, 3, 4, 6, 7, 8, 9, 11] and sum(r.doc_id is None for r in got) == 1
        elif name == "personal_data":
            assert len(got) == n and "[EMAIL]" in next(r.text for r in got if r.doc_id == 8)


def test_remainder_is_crc32(spark):
    from storyloom.llm.common import remainder

    for r in spark.range(20).withColumn("m", remainder("id", 5)).collect():
        assert r.m == zlib.crc32(str(r.id).encode()) % 5
