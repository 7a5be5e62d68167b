"""Term tables: few moves, tasks of bounded text, and the same scores for frequent and seldom terms."""

import re

import pytest
from pyspark.sql import functions as F

from storyloom.operators import terms
from storyloom.operators.article_vectors import sentence_weights, token_weights
from storyloom.operators.preprocess import by_article, text_tasks


@pytest.fixture
def counts(spark):
    """200 articles of one frequent term, one of every second article and one of its own."""
    rows = []
    for i in range(200):
        rows += [(f"a{i}", i % 5, "often", 1 + i % 3), (f"a{i}", i % 5, f"own{i}", 2)]
        rows += [(f"a{i}", i % 5, "half", 1)] if i % 2 else []
    rows += [("a7", None, "often", 4), (None, 1, "half", 1)]
    return spark.createDataFrame(rows, "id string, slide_id int, term string, tf bigint")


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return len(re.findall(r"\) Exchange\n", plan))


def rounded(df):
    return sorted(df.select("id", "slide_id", "term", "tf", F.round("score", 9)).collect(), key=repr)


@pytest.mark.parametrize("method", ["tfidf", "bm25"])
@pytest.mark.parametrize("time_aware", [True, False])
def test_frequent_and_seldom_terms_get_the_scores_of_the_plain_joins(spark, counts, monkeypatch, method, time_aware):
    articles = counts.select("id", "slide_id").distinct()
    stats = terms.window_stats(terms.slide_stats(articles, counts), 3)
    df = terms.window_document_frequency(terms.slide_document_frequency(counts), 3, time_aware)
    plain = rounded(terms.keyword_scores(counts, terms.inverse_document_frequency(df, stats), method))
    assert rounded(terms.score_terms(articles, counts, 3, time_aware, method)) == plain
    monkeypatch.setattr(terms, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(terms, "FREQUENT_TERMS", 10)
    assert {r.term for r in terms.frequent_terms(counts).collect()} == {"often", "half"}
    assert rounded(terms.score_terms(articles, counts, 3, time_aware, method, hot_rows=30)) == plain


def test_scores_of_seldom_terms_move_the_counts_once(spark, counts, monkeypatch):
    monkeypatch.setattr(terms, "SAMPLE_ROWS", 1000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = terms.score_terms(counts.select("id", "slide_id").distinct(), counts, 2)
        assert exchanges(scores) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tasks_follow_the_text(spark):
    texts = spark.createDataFrame([(str(i), "x" * 1000) for i in range(50)] + [("n", None)], "id string, text string")
    tasks = text_tasks(texts, 5000)
    assert tasks == 10 and by_article(texts, tasks).rdd.getNumPartitions() == 10
    assert text_tasks(texts) == text_tasks(texts.filter("false")) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_weights_of_tokens_are_those_of_sentence_counts(spark):
    # one id twice, a sentence without tokens, a keyword twice, an article without keywords
    rows = [("a", 0, ["x", "y", "x"]), ("a", 1, []), ("a", 0, ["x", "z"]), ("b", 0, ["x"]), ("b", 1, ["q"]), (None, 0, ["x"])]
    sentences = spark.createDataFrame(rows, "id string, sent_idx int, tokens array<string>")
    keywords = spark.createDataFrame([("a", "x", 0.5), ("a", "x", 0.25), ("a", "x y", -0.3), ("c", "x", 1.0)], "id string, term string, score double")
    got, want = (
        sorted(w.select("id", "sent_idx", F.round("weight", 9)).collect(), key=repr)
        for w in (token_weights(sentences, keywords), sentence_weights(terms.sentence_terms(sentences), keywords, sentences))
    )
    assert got == want
    assert terms.terms_of_sentences(sentences).exceptAll(terms.article_terms(terms.sentence_terms(sentences))).isEmpty()


def test_only_the_asked_terms_are_counted(spark):
    sentences = spark.createDataFrame([("a", 0, ["x", "y", "x"]), ("b", 0, ["q"])], "id string, sent_idx int, tokens array<string>")
    only = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x y")], "cluster_id bigint, term string")
    got = terms.sentence_terms(sentences, only=only).collect()
    assert {(r.id, r.term, r.tf) for r in got} == {("a", "x", 2), ("a", "x y", 1)} and len(got) == 2


@pytest.fixture
def mixed_counts(spark):
    """120 articles over 6 slides: repeated seldom and shared terms, a frequent one, one article in two slides, null keys."""
    rows = []
    for i in range(120):
        s = i % 6
        rows += [(f"a{i}", s, "often", 1 + i % 7)] + [(f"a{i}", s, f"own{i}-{j}", 1) for j in range(30)]
        rows += [(f"a{i}", s, f"shared{(i + j) % 25}", 1 + (i * j) % 4) for j in range(5)]
        rows += [(f"a{i}", s, f"burst{i % 3}", 9)] if s == 2 else []
    rows += [("a7", 3, "own7-0", 5), ("a9", None, "often", 4), (None, 1, "shared1", 1), (None, 1, "often", 2), ("b", 5, "shared2", 1)]
    return spark.createDataFrame(rows, "id string, slide_id int, term string, tf bigint")


@pytest.mark.parametrize("method,time_aware,first,frequent", [("tfidf", True, 6, 4), ("tfidf", False, 1, 100), ("bm25", True, 2, 4)])
def test_best_terms_are_the_top_of_all_scores(spark, mixed_counts, monkeypatch, method, time_aware, first, frequent):
    articles = mixed_counts.select("id", "slide_id").distinct()
    monkeypatch.setattr(terms, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(terms, "FREQUENT_TERMS", frequent)
    monkeypatch.setattr(terms, "BEST_ROWS", first)
    want = terms.top_terms(terms.score_terms(articles, mixed_counts, 3, time_aware, method), 3)
    got = terms.best_terms(articles, mixed_counts, 3, 3, time_aware, method)
    def shown(df):
        return sorted(df.select("id", "slide_id", "rank", "term", "tf", F.round("score", 9)).collect(), key=repr)
    assert shown(got) == shown(want)


def test_terms_that_cannot_be_among_the_best_are_not_moved(spark, mixed_counts, monkeypatch):
    scored, plain = [], terms._score_some
    monkeypatch.setattr(terms, "_score_some", lambda some, *given: scored.append(some.count()) or plain(some, *given))
    terms.best_terms(mixed_counts.select("id", "slide_id").distinct(), mixed_counts, 3, 3)
    assert 0 < sum(scored) < mixed_counts.count() / 3


def test_the_filter_keeps_every_row_of_the_terms(spark, mixed_counts):
    wanted = mixed_counts.filter("term like 'own1%'").select("term")
    got = terms.among_terms(mixed_counts, wanted)
    assert got.columns == mixed_counts.columns and got.count() < mixed_counts.count() / 2
    assert got.join(wanted.distinct(), "term", "left_semi").count() == mixed_counts.join(wanted.distinct(), "term", "left_semi").count()
