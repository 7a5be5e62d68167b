"""Near copies where ids repeat, are strings, or columns have clashing names."""

import pytest

import corpus_pipeline
from storyloom.llm.dedup import near_copies

S = "the cat and the dog sat on the mat of a house that was in the town by the river"
S2 = "one day a tall man from far away came to us and asked for bread and some cold water"
ROWS = [(1, S), (1, S2), (2, S + " indeed"), (3, S2 + " today"), (3, S2 + " today"), (4, None), (5, S.upper())]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_links_of_all_texts_of_an_id(docs):
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_copies(docs).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (3, 1, False), (4, 4, True), (5, 1, False)]


def test_string_ids(docs):
    named = docs.selectExpr("concat('d', doc_id) as doc_id", "text")
    got = {(r.doc_id, r.component_id) for r in near_copies(named).collect()}
    assert got == {("d1", "d1"), ("d2", "d1"), ("d3", "d1"), ("d4", "d4"), ("d5", "d1")}


def test_stage_keeps_one_text_of_each_group(spark, docs):
    clash = docs.selectExpr("*", "7 as _at", "'x' as `a.b`", "1 as first", "true as kept")
    out = corpus_pipeline.near_dedup(spark, clash, "")
    assert out.columns == clash.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.text) == [(1, S2), (1, S)]
    both = spark.createDataFrame([(1, S), (1, S + " indeed"), (None, S), (1, S)], "doc_id long, text string")
    rows = corpus_pipeline.near_dedup(spark, both, "").collect()
    assert len(rows) == 2 and {r.doc_id for r in rows} == {1, None}
