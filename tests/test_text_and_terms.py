import math
from datetime import datetime

from pyspark.sql import functions as F

from storyloom.functions.dates import floor_days, parse_iso
from storyloom.functions.ids import dense_ids
from storyloom.functions.skew import join_frequent
from storyloom.operators import terms
from storyloom.operators.article_vectors import sentence_weights, weighted_article_vectors
from storyloom.operators.preprocess import clean_articles, embed_sentences, split_into_sentences, tokenize
from storyloom.schemas import RAW_ARTICLES, conform

ARTICLES = "id string, date timestamp_ntz, title string, text string"
DAY = datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_sentences_and_titles(spark):
    df = spark.createDataFrame(
        [("a", DAY, "T", "One two. X! Hi.\n Last one"), ("b", DAY, None, None)], ARTICLES
    )
    got = rows(split_into_sentences(df), "id", "sent_idx", "sentence")
    # a bare "X!" has two tokens and stays, the title stays even when empty
    assert got == [("a", 0, "T"), ("a", 1, "One two."), ("a", 2, "X!"), ("a", 3, "Hi."), ("a", 4, "Last one"), ("b", 0, "")]


def test_single_token_pieces_are_dropped(spark):
    df = spark.createDataFrame([("a", DAY, "t", "Go on. word")], ARTICLES)
    assert [r.sentence for r in split_into_sentences(df).orderBy("sent_idx").collect()] == ["t", "Go on."]


def test_tokens_and_bigrams_stay_inside_a_sentence(spark):
    df = spark.createDataFrame([("a", DAY, "The Fox", "the fox2 3 Red fox's den. Blue sky")], ARTICLES)
    sents = tokenize(split_into_sentences(df))
    assert [r.tokens for r in sents.orderBy("sent_idx").collect()] == [["fox"], ["red", "fox", "den"], ["blue", "sky"]]
    tf = {(r.sent_idx, r.term): r.tf for r in terms.sentence_terms(sents).collect()}
    assert tf[(1, "red fox")] == 1 and tf[(1, "fox den")] == 1 and (1, "den blue") not in tf
    assert {t for s, t in tf if s == 0} == {"fox"}
    article = {r.term: r.tf for r in terms.article_terms(terms.sentence_terms(sents)).collect()}
    assert article["fox"] == 2 and article["blue sky"] == 1


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-02T00:00:00Z",), ("2024-01-01T12:00:00",), ("x",)], "s string")
    got = [r[0] for r in df.select(parse_iso(F.col("s"))).collect()]
    assert got == [datetime(2024, 1, 2), datetime(2024, 1, 1, 12), None]
    pair = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 1, 12))], "a timestamp_ntz, b timestamp_ntz")
    # half a day before is day -1, half a day after is day 0
    assert pair.select(floor_days(F.col("a"), F.col("b")), floor_days(F.col("b"), F.col("a"))).first()[:] == (-1, 0)


def test_contract_check(spark):
    df = spark.createDataFrame([("a",)], "id string")
    for check in (lambda: conform(df, RAW_ARTICLES), lambda: clean_articles(df)):
        try:
            check()
        except ValueError as problem:
            assert "missing columns" in str(problem)
        else:
            raise AssertionError("missing columns were accepted")


def test_idf_counts_the_window_before_the_slide_and_may_be_negative(spark):
    arts = spark.createDataFrame(
        [("old", 0)] + [(f"n{i}", 1) for i in range(100)], "id string, slide_id int"
    ).withColumn("date", F.lit(None).cast("timestamp_ntz"))
    tf = arts.select("id", "slide_id", F.lit("x").alias("term"), F.lit(2).cast("bigint").alias("tf"))
    scores = terms.score_terms(arts, tf, live_slides=2, time_aware=False)
    got = {r.id: r.score for r in scores.collect()}
    assert math.isclose(got["old"], 2 * (math.log(2 / 2) + 1))
    assert math.isclose(got["n5"], 2 * (math.log(2 / 102) + 1)) and got["n5"] < 0
    decayed = {r.id: r.score for r in terms.score_terms(arts, tf, 2, True).collect()}
    assert math.isclose(decayed["n5"], 2 * (math.log(2 / (100 + math.exp(-0.5) + 1)) + 1))


def test_window_after_an_empty_slide_is_the_slide_itself(spark):
    stats = spark.createDataFrame([(0, 4, 8), (3, 2, 10)], "slide_id int, n_articles bigint, n_tf bigint")
    got = {r.slide_id: (r.n, r.mean_length) for r in terms.window_stats(stats, 2).collect()}
    assert got == {0: (4, 2.0), 3: (2, 5.0)}


def test_equal_scores_go_by_term(spark):
    df = spark.createDataFrame([("a", "z", 0.3), ("a", "b", 0.1 + 0.2), ("a", "c", 0.1)], "id string, term string, score double")
    assert rows(terms.top_terms(df, 2), "rank", "term") == [(1, "b"), (2, "z")]


def test_frequent_keys_are_split_without_changing_the_join(spark):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term"))
    right = left.groupBy("term").agg(F.count("*").alias("n"))
    plain = rows(left.join(right, "term"), "id", "term", "n")
    assert rows(join_frequent(left, right, ["term"], "n", "id", hot_rows=100), "id", "term", "n") == plain
    assert len(plain) == 3000


def test_dense_ids(spark):
    df = spark.createDataFrame([(k,) for k in (5, 70_000, 200_000, 7, 65_536)], "k bigint")
    got = rows(dense_ids(df, "k", F.lit(10), "n"), "k", "n")
    assert got == [(5, 10), (7, 11), (65_536, 12), (70_000, 13), (200_000, 14)]


def test_sentence_weights(spark):
    sent = spark.createDataFrame([("a", 0), ("a", 1), ("w", 0), ("w", 1)], "id string, sent_idx int")
    tf = spark.createDataFrame([("a", 1, "x", 3)], "id string, sent_idx int, term string, tf bigint")
    kw = spark.createDataFrame([("a", "x", 2.0)], "id string, term string, score double")
    got = {(r.id, r.sent_idx): r.weight for r in sentence_weights(tf, kw, sent).collect()}
    assert math.isclose(got["a", 1], (6 + 1e-5) / (6 + 2e-5)) and math.isclose(sum(v for k, v in got.items() if k[0] == "a"), 1)
    # only stop words: equal weights
    assert got["w", 0] == got["w", 1] == 0.5
    # weights that sum to zero fall back to equal ones; negative scores are allowed otherwise
    zero = spark.createDataFrame([("a", "x", -2e-5 / 3)], "id string, term string, score double")
    fallback = {r.sent_idx: r.weight for r in sentence_weights(tf, zero, sent.filter("id = 'a'")).collect()}
    assert math.isclose(sum(fallback.values()), 1.0)


def test_weighted_vectors_accept_negative_weights(spark):
    w = spark.createDataFrame([("a", 0, -1.0), ("a", 1, 2.0)], "id string, sent_idx int, weight double")
    v = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("a", 1, [0.0, 1.0])], "id string, sent_idx int, embedding array<double>")
    assert weighted_article_vectors(w, v).first().embedding == [-1.0, 2.0]


def test_embedding_function_in_batches_with_marked_errors(spark):
    def embed(texts):
        assert len(texts) <= 3
        if "bad" in texts:
            raise RuntimeError("no vector")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(str(i), 0, "bad" if i == 4 else "x" * i) for i in range(10)], "id string, sent_idx int, sentence string")
    got = {r.id: r for r in embed_sentences(df.coalesce(1), embed, batch_size=3, mark_errors=True).collect()}
    assert got["4"].embedding is None and "no vector" in got["4"].error
    assert got["5"].embedding == [5.0, 1.0] and got["5"].error is None and len(got) == 10
