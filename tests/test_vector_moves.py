"""Sentence vectors are added up before they move, and meet their chunks where the article is."""

import re

import pytest
from pyspark.sql import functions as F

from storyloom.operators.article_vectors import mean_article_vectors, weighted_article_vectors
from storyloom.plans import testbed as tb
from storyloom.sources import articles as reads


def moved(df) -> list[str]:
    """Columns of each exchange of the plan before it runs."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)


@pytest.fixture
def large(spark, monkeypatch):
    """Vectors too many to be sent around."""
    monkeypatch.setattr(tb, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def values(df):
    rows = df.select("id", F.posexplode("embedding").alias("at", "v")).select("id", "at", F.round("v", 6).alias("v"))
    return sorted(map(tuple, rows.collect()))


def test_sums_of_a_large_table_move_once_per_article(spark, tiny, large, monkeypatch):
    means, weighted = mean_article_vectors(tb.sentence_vectors(spark, tiny)), tb.embedded_articles(spark, tiny)
    for df in (means, weighted):
        assert not [c for c in moved(df) if "embedding" in c and "sent_idx" in c]
        # the one other move of vectors is that of the table itself
        assert not [c for c in moved(df) if "embedding" in c and re.search(r"\bid#", c)]
    got = values(means), values(weighted)
    monkeypatch.setattr(tb, "BROADCAST_BYTES", 64 << 20)
    joined = weighted_article_vectors(tb.article_weights(spark, tiny), tb.sentence_vectors(spark, tiny))
    assert got == (values(mean_article_vectors(tb.sentence_vectors(spark, tiny))), values(joined))


def test_vectors_that_are_sent_around_leave_sentences_by_article(spark, tiny):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reads.vectors_of(tb.stored_chunks(spark, tiny), tb.stored_vectors(spark, tiny))
        rows = reads.assemble_sentences(tb.stored_articles(spark, tiny), found)
        assert not [c for c in moved(rows) if "embedding" in c or "sent_idx" in c]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_do_not_move_to_the_blocks_of_vectors(spark, tiny, large, monkeypatch):
    rows = tb.with_vectors(spark, tiny, tb.sentences(spark, tiny))
    assert not [c for c in moved(rows) if "_block" in c and ("tokens" in c or "sentence#" in c)]
    assert not [c for c in moved(rows) if "embedding" in c and "tokens" in c]
    got = rows.select("id", "sent_idx", "sentence", "tokens", F.round(F.col("embedding")[1], 6)).collect()
    monkeypatch.setattr(tb, "BROADCAST_BYTES", 64 << 20)
    sent = tb.with_vectors(spark, tiny, tb.sentences(spark, tiny))
    want = sent.select("id", "sent_idx", "sentence", "tokens", F.round(F.col("embedding")[1], 6)).collect()
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got)


def test_stored_vectors_stay_floats(spark, tiny, monkeypatch):
    from storyloom.plans import queries

    written, plain = [], queries.store.write_changes
    monkeypatch.setattr(queries.store, "write_changes", lambda df, path: written.append(dict(df.dtypes)) or plain(df, path))
    got = queries.reingested_vectors(spark, tiny)
    assert [w["embedding"] for w in written] == ["array<float>"] * 2
    assert dict(got.dtypes)["first_value"] == "double" and not got.isEmpty()
