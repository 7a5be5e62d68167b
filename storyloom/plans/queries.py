"""Every operator as a query over the given tables.

Vectors are returned as one row per dimension and doubles are rounded to 6 places,
so that results can be compared with another engine.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom import schemas
from storyloom.functions import dates, scoring, vectors
from storyloom.functions.text import is_content_word
from storyloom.operators import evaluate, reports, terms
from storyloom.operators.article_vectors import mean_article_vectors
from storyloom.operators.assign import assign_to_clusters, theme_hits, theme_scores, theme_similarity, theme_vectors, time_weighted_centers
from storyloom.operators.dense import nearest_center, score_against_centers
from storyloom.operators.kmeans import cluster_outliers, spherical_kmeans
from storyloom.operators.preprocess import clean_articles, null_counts, split_into_sentences, text_tasks
from storyloom.operators.state import embedding_delta, merge_embedding_state, merge_term_state, rebuild_state, term_delta
from storyloom.operators.sweeps import grid, mean_cosine_by_temperature, sweep
from storyloom.operators.theme import cluster_theme, decayed_cluster_terms, keyword_history, plain_cluster_terms
from storyloom.plans import daily as daily_plan
from storyloom.plans import testbed as tb
from storyloom.plans.ingest import read_store
from storyloom.plans.simulate import simulate, window_membership
from storyloom.session import new_workspace
from storyloom.sources import articles as reads
from storyloom.sources import clusters as cs
from storyloom.sources import store
from storyloom.sources.tables import first_rows, read_json_articles, stage, write_csv
from storyloom.streaming.term_df import windowed_document_frequency

DIGITS = 6
TOP_LIMIT = 100
QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, DIGITS)


def by_dim(df: DataFrame, column: str, *keys) -> DataFrame:
    return df.select(*keys, F.posexplode(column).alias("dim", "value")).withColumn("value", r("value"))


def ntz(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


# --- sources and sinks -------------------------------------------------------


@query
def all_raw_articles(spark: SparkSession, sf: str) -> DataFrame:
    return reads.read_all_articles(tb.raw_articles(spark, sf)).select("id", "date", "title", "text")


@query
def articles_of_last_days(spark, sf):
    return reads.read_articles_from_days(tb.raw_articles(spark, sf), 10, tb.NOW).select("id", "date", "title", "text")


@query
def articles_of_today(spark, sf):
    now = tb.NOW - timedelta(days=2)
    return reads.read_todays_articles(tb.raw_articles(spark, sf), now).select("id", "date", "title")


@query
def unprocessed_articles(spark, sf):
    stored = tb.stored_articles(spark, sf).filter(F.col("lang") != "en")
    found = reads.read_unprocessed_articles(tb.raw_articles(spark, sf), stored, 30, tb.NOW)
    return found.select("id", "date", "title")


@query
def processed_articles_since(spark, sf):
    found = reads.processed_since(tb.stored_articles(spark, sf), "2024-01-20 00:00:00")
    return found.select("source_article_id", "date", "title", ntz("created_at"))


@query
def processed_articles_on_day(spark, sf):
    found = reads.processed_on(tb.stored_articles(spark, sf), "2024-01-20 00:00:00")
    return found.select("source_article_id", "date", "title")


@query
def chunks_grouped_by_article(spark, sf):
    wanted = reads.processed_since(tb.stored_articles(spark, sf), "2024-01-20 00:00:00")
    grouped = reads.chunks_by_article(wanted, tb.stored_chunks(spark, sf))
    return grouped.select("source_article_id", F.posexplode("chunks").alias("place", "chunk")).select(
        "source_article_id", "place", "chunk.chunk_id", "chunk.text"
    )


@query
def chunk_vectors(spark, sf):
    found = reads.vectors_of(tb.stored_chunks(spark, sf), tb.stored_vectors(spark, sf))
    return found.select("chunk_id", "source_article_id", r(vectors.norm(F.col("embedding"))).alias("length"),
                        r(F.col("embedding")[0]).alias("first_value"))


@query
def assembled_sentences(spark, sf):
    found = reads.vectors_of(tb.stored_chunks(spark, sf), tb.stored_vectors(spark, sf))
    rows = reads.assemble_sentences(tb.stored_articles(spark, sf), found)
    return rows.select(
        "id", "date", "sent_idx", "sentence", F.concat_ws(" ", "tokens").alias("tokens"),
        r(vectors.norm(F.col("embedding"))).alias("length"), r(F.col("embedding")[0]).alias("first_value"),
    )


@query
def json_dataset(spark, sf):
    folder = new_workspace(spark, "json")
    rows = tb.sentences(spark, sf).groupBy("id", F.col("date").cast("string").alias("date")).agg(
        F.sort_array(F.collect_list(F.struct("sent_idx", "sentence", "tokens"))).alias("s")
    )
    rows.select("id", "date", F.col("s.sentence").alias("sentences"), F.col("s.tokens").alias("sentence_tokens")).write.json(folder)
    back = read_json_articles(spark, folder, schemas.NESTED_ARTICLES)
    nested = F.posexplode(F.arrays_zip("sentences", "sentence_tokens")).alias("sent_idx", "s")
    return back.select("id", dates.parse_iso(F.col("date")).alias("date"), nested).select(
        "id", "date", "sent_idx", F.col("s.sentences").alias("sentence"), F.size("s.sentence_tokens").alias("n_tokens")
    )


def _changed_articles(spark, sf):
    return tb.stored_articles(spark, sf).filter(F.col("lang") == "en").withColumn("title", F.upper("title"))


@query
def upserted_articles(spark, sf):
    stored = tb.stored_articles(spark, sf).filter(F.col("date") < F.lit("2024-01-20").cast("timestamp_ntz"))
    both = store.upsert_articles(stored, _changed_articles(spark, sf))
    return both.select("source_article_id", "date", "title", "lang")


@query
def replaced_chunks(spark, sf):
    changed = split_into_sentences(_changed_articles(spark, sf).withColumnRenamed("source_article_id", "id"))
    number = F.col("id").cast("bigint") * tb.IDS_PER_ARTICLE + 500_000 + F.col("sent_idx")
    new = changed.filter(F.col("sent_idx") > 0).select(
        number.alias("chunk_id"), F.col("id").alias("source_article_id"), "sent_idx", F.col("sentence").alias("text")
    )
    return store.replace_chunks(tb.stored_chunks(spark, sf), new)


@query
def vector_metadata(spark, sf):
    rows = tb.with_vectors(spark, sf, split_into_sentences(tb.articles(spark, sf)))
    return store.vector_rows(rows).select(
        F.col("source_article_id"), F.length("text").alias("chars"), "text", r(F.col("embedding")[0]).alias("first_value")
    )


@query
def reingested_vectors(spark, sf):
    """All vectors stored, then the articles of the last days again with other vectors and without their title.

    The given vectors are 4-byte floats and so are the stored ones: no value changes, and they take half the room.
    """
    path = new_workspace(spark, "store") + "/vectors"
    floats = F.col("embedding").cast("array<float>").alias("embedding")
    rows = split_into_sentences(tb.articles(spark, sf)).drop("sentence")
    rows = tb.with_vectors(spark, sf, rows).select(F.col("id").alias("source_article_id"), "date", "sent_idx", floats)
    store.write_changes(rows, path)
    late = rows.filter((F.col("date") >= F.lit("2024-02-02").cast("timestamp_ntz")) & (F.col("sent_idx") > 0))
    doubled = vectors.scale(F.col("embedding"), F.lit(2.0)).cast("array<float>")
    stored = store.write_changes(late.withColumn("embedding", doubled), path)
    return stored.select("source_article_id", "sent_idx", r(F.col("embedding")[0].cast("double")).alias("first_value"))


@query
def chunk_id_uniqueness(spark, sf):
    chunks = store.chunk_rows(split_into_sentences(tb.articles(spark, sf)))
    clashes = store.id_collisions(chunks).agg(F.count("*").alias("collisions"))
    return chunks.agg(F.count("*").alias("chunks"), F.count_distinct("source_article_id").alias("articles")).withColumn(
        "one", F.lit(1)).join(clashes.withColumn("one", F.lit(1)), "one").drop("one")


def _clusters(spark, sf) -> DataFrame:
    """A cluster store: one cluster per source, a third of them retired."""
    rows = tb.articles(spark, sf).withColumn("cluster_id", tb.cluster_of_source())
    grouped = rows.groupBy("cluster_id").agg(
        F.count("*").alias("cluster_size"),
        F.min("date").alias("date_range_start"),
        F.max("date").alias("date_range_end"),
        F.array_sort(F.collect_set("lang")).alias("keywords"),
    )
    return grouped.join(tb.given_centers(spark, sf), "cluster_id").select(
        "cluster_id", F.col("center").alias("cluster_center"), "cluster_size", "keywords", "date_range_start",
        "date_range_end", F.when(F.col("cluster_id") % 3 == 0, "retired").otherwise("active").alias("status"),
        F.lit(0.7).alias("similarity_threshold"), F.lit(None).cast("timestamp").alias("last_updated"),
    )


def _assignments(spark, sf) -> DataFrame:
    rows = tb.articles(spark, sf).filter(F.col("date") < F.lit(tb.MEMBERS_UNTIL).cast("timestamp_ntz"))
    return rows.select(
        F.col("id").alias("source_article_id"), tb.cluster_of_source().alias("cluster_id"),
        F.lit(0.5).alias("similarity_score"), F.lit("initial").alias("assignment_type"),
    )


def _show_clusters(df: DataFrame) -> DataFrame:
    return df.select(
        "cluster_id", r(F.col("cluster_center")[0]).alias("first_value"), "cluster_size",
        F.concat_ws(",", "keywords").alias("keywords"), "date_range_start", "date_range_end", "status",
    )


@query
def active_clusters(spark, sf):
    as_text = _clusters(spark, sf).withColumn("cluster_center", F.to_json("cluster_center"))
    return _show_clusters(cs.load_active_clusters(as_text))


@query
def appended_assignments(spark, sf):
    later = tb.articles(spark, sf).filter(F.col("date") >= F.lit("2024-01-10").cast("timestamp_ntz")).select(
        F.col("id").alias("source_article_id"), tb.cluster_of_source().alias("cluster_id"), (F.length("text") / 1e6).alias("sim")
    )
    rows = cs.assign_articles(_assignments(spark, sf), later)
    return rows.withColumn("similarity_score", r("similarity_score"))


@query
def updated_centers(spark, sf):
    changes = _clusters(spark, sf).select(
        "cluster_id", vectors.scale(F.col("cluster_center"), F.lit(2.0)).alias("cluster_center"),
        F.when(F.col("cluster_id") % 2 == 0, F.array(F.lit("new"))).alias("keywords"),
    ).filter(F.col("cluster_id") < 10)
    return _show_clusters(cs.update_centers(_clusters(spark, sf), changes, tb.NOW))


@query
def assignment_lookups(spark, sf):
    rows = _assignments(spark, sf)
    one = cs.assignments_of_article(rows, "7").select("source_article_id", "cluster_id")
    return cs.articles_of_cluster(rows, 5).withColumn("cluster_id", F.lit(5).cast("bigint")).unionByName(one)


@query
def cluster_date_ranges(spark, sf):
    return _show_clusters(
        cs.update_date_ranges(_clusters(spark, sf), _assignments(spark, sf), tb.articles(spark, sf).select("id", "date"), tb.NOW)
    )


@query
def cluster_sizes(spark, sf):
    return _show_clusters(cs.update_sizes(_clusters(spark, sf), _assignments(spark, sf), tb.NOW))


def _finished_window(spark, sf):
    return tb.clustered(spark, sf).withColumn("cluster", F.when(F.col("cluster") >= 0, F.col("cluster") * 2).otherwise(-1))


def _finished_keywords(spark, sf):
    return tb.keyword_table(spark, sf).withColumn("cluster_id", F.col("cluster_id") * 2)


@query
def saved_run_clusters(spark, sf):
    clusters, _ = cs.save_run(
        _clusters(spark, sf), _assignments(spark, sf), _finished_window(spark, sf), _finished_keywords(spark, sf), tb.NOW
    )
    return _show_clusters(clusters)


@query
def saved_run_assignments(spark, sf):
    _, rows = cs.save_run(
        _clusters(spark, sf), _assignments(spark, sf), _finished_window(spark, sf), _finished_keywords(spark, sf), tb.NOW
    )
    return rows.withColumn("similarity_score", r("similarity_score"))


def _daily_window(spark, sf):
    """Articles of the last slide: some to stored clusters, some to two new ones, some to none."""
    rows = tb.clustered(spark, sf).filter(F.col("date") >= F.lit("2024-01-29").cast("timestamp_ntz"))
    return rows.withColumn("cluster", F.when(F.length("text") % 5 == 0, 100 + F.length("text") % 2).otherwise(F.col("cluster")).cast("bigint"))


def _daily_saved(spark, sf):
    new_centers = tb.given_centers(spark, sf).filter(F.col("cluster_id") < 2).withColumn("cluster_id", F.col("cluster_id") + 100)
    return cs.save_daily(
        _clusters(spark, sf), _assignments(spark, sf), _daily_window(spark, sf), new_centers,
        tb.articles(spark, sf).select("id", "date"), tb.NOW,
    )


@query
def saved_daily_clusters(spark, sf):
    return _show_clusters(_daily_saved(spark, sf)[0])


@query
def saved_daily_assignments(spark, sf):
    return _daily_saved(spark, sf)[1].withColumn("similarity_score", r("similarity_score"))


@query
def csv_results(spark, sf):
    folder = new_workspace(spark, "csv")
    write_csv(reports.cluster_summary(tb.clustered(spark, sf)), folder)
    back = spark.read.csv(folder, header=True, schema="cluster bigint, size bigint, avg_sim double, earliest timestamp_ntz, latest timestamp_ntz")
    return back.withColumn("avg_sim", r("avg_sim"))


@query
def limited_load(spark, sf):
    return first_rows(reads.read_all_articles(tb.raw_articles(spark, sf)), TOP_LIMIT).select("id", "date", "title")


@query
def fetched_articles(spark, sf):
    wanted = reads.processed_since(tb.stored_articles(spark, sf), "2024-01-20 00:00:00")
    rows = reads.fetch_processed(wanted, tb.stored_chunks(spark, sf), tb.stored_vectors(spark, sf))
    return rows.select(
        "id", "source_article_id", "date", ntz("created_at"), "title", "sentence_counts",
        F.size(F.flatten("sentence_tokens")).alias("n_tokens"), F.size("sentence_embds").alias("n_vectors"),
        F.element_at("sentences", -1).alias("last_sentence"),
    )


# --- projections, filters, scalars ----------------------------------------------


@query
def concatenated_slides(spark, sf):
    rows = tb.slided_articles(spark, sf)
    early = rows.filter("slide_id < 2")
    late = rows.filter("slide_id >= 2")
    return early.unionByName(late).groupBy("slide_id").agg(F.count("*").alias("n"), F.min("date").alias("first_date"))


def _with_nulls(spark, sf):
    rows = tb.articles(spark, sf)
    return rows.withColumns(
        {"title": F.when(F.col("lang") != "fr", F.col("title")), "text": F.when(F.col("lang") != "de", F.col("text"))}
    )


@query
def null_text_counts(spark, sf):
    return null_counts(_with_nulls(spark, sf))


@query
def null_text_cleaned(spark, sf):
    return clean_articles(_with_nulls(spark, sf)).select("id", "title", F.length("text").alias("chars"))


@query
def articles_in_date_range(spark, sf):
    return reads.in_date_range(tb.articles(spark, sf), "2024-01-05", "2024-01-25").select("id", "date")


@query
def slide_numbers(spark, sf):
    return tb.slided_articles(spark, sf)


@query
def parsed_dates(spark, sf):
    text = F.when(F.col("lang") == "fr", F.lit("no date")).when(
        F.col("lang") == "de", F.concat(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    ).otherwise(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss"))
    parsed = tb.articles(spark, sf).select("id", dates.parse_iso(text).alias("date"))
    return parsed.filter(F.col("date").isNotNull())


@query
def membership_split(spark, sf):
    side = F.when(F.col("cluster") >= 0, "live").otherwise("outlier").alias("side")
    return tb.clustered(spark, sf).groupBy(side).agg(F.count("*").alias("n"), F.count_distinct("cluster").alias("clusters"))


@query
def assignment_rows(spark, sf):
    rows = tb.clustered(spark, sf)
    odd = F.col("id").cast("bigint") % 2 == 1
    window = rows.select(
        F.when(~odd, F.col("id")).alias("id"),
        F.when(odd & (F.length("id") > 1), F.col("id")).alias("source_article_id"),
        F.lit(None).cast("string").alias("article_id"),
        "cluster",
        F.when(F.length("text") % 7 == 0, F.lit(float("nan"))).when(F.length("text") % 7 != 1, F.col("sim")).alias("sim"),
    )
    return cs.article_assignments(window).withColumn("similarity_score", r("similarity_score"))


@query
def json_vectors(spark, sf):
    text = F.to_json(F.col("embedding").cast("array<double>"))
    rows = tb.read(spark, sf, "embeddings").select("vec_id", vectors.parse_vector(text).alias("v"))
    return by_dim(rows, "v", "vec_id")


@query
def decay_and_rounding(spark, sf):
    age = dates.floor_days(F.lit(tb.TO_DATE).cast("timestamp_ntz"), F.col("date"))
    weight = F.exp(-age / F.lit(14.0))
    return tb.articles(spark, sf).select(
        "id", age.alias("age"), r(weight).alias("weight"), r(F.log(F.length("text") + F.lit(1.0))).alias("log_chars"),
        F.bround(weight, scoring.PROB_DIGITS).alias("rounded"),
    )


@query
def clean_token_counts(spark, sf):
    words = tb.articles(spark, sf).select("id", F.explode(F.split("text", r"[ \t\n\r\f]+")).alias("w"))
    kept = words.filter(is_content_word(F.col("w")))
    return kept.groupBy(F.lower(F.trim("w")).alias("token")).agg(F.count("*").alias("n"))


# --- text and terms --------------------------------------------------------------


@query
def sentence_split(spark, sf):
    return split_into_sentences(tb.articles(spark, sf))


@query
def sentence_counts(spark, sf):
    rows = split_into_sentences(tb.articles(spark, sf))
    return rows.groupBy("id").agg(
        F.count("*").alias("sentence_counts"), F.max(F.when(F.col("sent_idx") == 0, F.col("sentence"))).alias("title_sentence")
    )


@query
def sentence_tokens(spark, sf):
    return tb.sentences(spark, sf).select("id", "sent_idx", F.posexplode("tokens").alias("place", "token"))


@query
def sentence_term_counts(spark, sf):
    return terms.sentence_terms(tb.sentences(spark, sf))


@query
def article_term_counts(spark, sf):
    return terms.terms_of_sentences(tb.sentences(spark, sf))


@query
def vocabulary_by_length(spark, sf):
    words = terms.vocabulary(terms.terms_of_sentences(tb.sentences(spark, sf)))
    return words.groupBy(F.size(F.split("term", " ")).alias("words")).agg(
        F.count("*").alias("terms"), F.min("term").alias("first_term"), F.max("term").alias("last_term")
    )


@query
def sentence_vector_lookup(spark, sf):
    rows = tb.sentence_vectors(spark, sf)
    return rows.select("id", "sent_idx", r(vectors.norm(F.col("embedding"))).alias("length"), r(F.col("embedding")[1]).alias("second_value"))


@query
def preprocessed_articles(spark, sf):
    from storyloom.operators.preprocess import nest_articles

    rows = tb.with_vectors(spark, sf, tb.sentences(spark, sf))
    nested = nest_articles(clean_articles(tb.articles(spark, sf)), rows)
    return nested.select(
        "id", "date", "sentence_counts", F.size(F.flatten("sentence_tokens")).alias("n_tokens"),
        F.size("sentence_embds").alias("n_vectors"), r(F.element_at("sentence_embds", -1)[0]).alias("last_first_value"),
        F.element_at("sentences", -1).alias("last_sentence"),
    )


@query
def clustering_dataset(spark, sf):
    corpus = reads.read_dataset(
        tb.stored_articles(spark, sf), tb.stored_chunks(spark, sf), tb.stored_vectors(spark, sf), "2024-01-03", "2024-02-02"
    )
    counts = corpus.article_tf.groupBy("id").agg(F.count("*").alias("terms"), F.sum("tf").alias("total_tf"))
    sents = corpus.sentences.groupBy("id").agg(F.count("*").alias("sentences"))
    return corpus.articles.select("id", "date").join(sents, "id").join(counts, "id", "left").fillna(0, ["terms", "total_tf"])


# --- term statistics and article vectors ---------------------------------------------


@query
def slide_term_frequency(spark, sf):
    return terms.slide_document_frequency(tb.counts_by_term(spark, sf))


def _window_df(spark, sf, time_aware=True):
    slide_df = terms.slide_document_frequency(tb.counts_by_term(spark, sf))
    return terms.window_document_frequency(slide_df, tb.PARAMS.live_slides, time_aware)


@query
def decayed_window_frequency(spark, sf):
    return _window_df(spark, sf).select("slide_id", "term", r("df").alias("df"))


@query
def plain_window_frequency(spark, sf):
    return _window_df(spark, sf, False).select("slide_id", "term", r("df").alias("df"))


@query
def inverse_frequency(spark, sf):
    tf = tb.slided_terms(spark, sf)
    stats = terms.window_stats(terms.slide_stats(tb.slided_articles(spark, sf), tf), tb.PARAMS.live_slides)
    df = _window_df(spark, sf)
    return terms.inverse_document_frequency(df, stats).select("slide_id", "term", "n", r("idf").alias("idf"))


@query
def tfidf_scores(spark, sf):
    return tb.keyword_scores(spark, sf).select("id", "term", r("score").alias("score"))


@query
def bm25_scores(spark, sf):
    return tb.keyword_scores(spark, sf, "bm25").select("id", "term", r("score").alias("score"))


@query
def article_keywords(spark, sf):
    best = tb.best_keywords(spark, sf)
    return best.select("id", "rank", "term", r("score").alias("score"))


@query
def sentence_theme_weights(spark, sf):
    return tb.article_weights(spark, sf).select("id", "sent_idx", r("weight").alias("weight"))


@query
def theme_weighted_article_vectors(spark, sf):
    return by_dim(tb.embedded_articles(spark, sf), "embedding", "id")


@query
def mean_vectors_of_articles(spark, sf):
    return by_dim(mean_article_vectors(tb.sentence_vectors(spark, sf)), "embedding", "id")


# --- clustering ----------------------------------------------------------------------


def _vector_groups(spark, sf):
    points = tb.read(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return spherical_kmeans(points, points.count() // 50)


@query
def spherical_kmeans_labels(spark, sf):
    labels, centers = _vector_groups(spark, sf)
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    return centers.join(sizes, "label").select("label", "size", r(vectors.norm(F.col("center"))).alias("center_length"))


@query
def spherical_kmeans_members(spark, sf):
    return _vector_groups(spark, sf)[0]


@query
def spherical_kmeans_centers(spark, sf):
    return by_dim(_vector_groups(spark, sf)[1], "center", "label")


@query
def initial_clusters(spark, sf):
    """k-means over the first window, then the confidence gate."""
    first = tb.slided_articles(spark, sf).filter("slide_id = 0").select("id")
    window = stage(tb.embedded_articles(spark, sf).join(first, "id", "left_semi").select("id", "date", "embedding"))
    k = window.count() // tb.PARAMS.min_articles
    _, found = spherical_kmeans(window, k)
    centers = stage(found.select(F.col("label").alias("cluster_id"), "center"))
    assigned = assign_to_clusters(window, centers, temperature=4, initial=True, window_size=14)
    return assigned.groupBy("cluster").agg(F.count("*").alias("size"), r(F.avg("sim")).alias("avg_sim"))


def _assigned(spark, sf, time_aware, theme_aware, method="tfidf"):
    if theme_aware:
        s = tb.scoring_inputs(spark, sf, method)
        extra = dict(theme=s.theme, sentence_tf=s.sentence_tf, sentence_vectors=s.vectors, emb_state=s.emb_state)
        out, centers = s.out, s.centers
    else:
        embedded, centers = tb.dense_inputs(spark, sf)
        out = tb.to_assign(embedded)
        extra = dict(emb_state=stage(embedding_delta(tb.members(embedded))) if time_aware else None)
    return assign_to_clusters(
        out, centers, temperature=2, initial=False, window_size=tb.SCORING_WINDOW, to_date=tb.TO_DATE,
        time_aware=time_aware, theme_aware=theme_aware, **extra,
    )


def _show_assigned(df):
    return df.select("id", "cluster", r("sim").alias("sim"), r("conf").alias("conf"))


@query
def assign_theme_time(spark, sf):
    return _show_assigned(_assigned(spark, sf, True, True))


@query
def assign_theme_only(spark, sf):
    return _show_assigned(_assigned(spark, sf, False, True))


@query
def assign_time_only(spark, sf):
    return _show_assigned(_assigned(spark, sf, True, False))


@query
def assign_plain(spark, sf):
    return _show_assigned(_assigned(spark, sf, False, False))


@query
def cosine_to_all_centers(spark, sf):
    embedded, centers = tb.dense_inputs(spark, sf)
    scored = score_against_centers(embedded, centers.select("cluster_id", F.col("center").alias("vector")), temperature=2)
    return scored.select("id", "k", r("sum_exp").alias("sum_exp"), r("sum_cos").alias("sum_cos"), r("best_sim").alias("best_sim"))


@query
def centers_at_article_dates(spark, sf):
    embedded, centers = tb.dense_inputs(spark, sf)
    state = stage(embedding_delta(tb.members(embedded)))
    out = tb.to_assign(embedded)
    # the clusters an article is asked about: all with members of the same hour of day
    asked = out.select("date", F.hour("date").alias("h")).distinct().join(
        tb.members(embedded).select(F.hour("date").alias("h"), F.col("cluster").alias("cluster_id")).distinct(), "h"
    )
    found = time_weighted_centers(asked, state, centers, tb.TO_DATE, tb.SCORING_WINDOW)
    return by_dim(found, "center", "date", "cluster_id")


@query
def cluster_specific_vectors(spark, sf):
    s = tb.scoring_inputs(spark, sf)
    seen = theme_vectors(theme_hits(s.out, s.sentence_tf, s.theme), s.vectors)
    return seen.select(
        "id", "cluster_id", r(vectors.norm(F.col("theme_embedding"))).alias("length"),
        r(F.col("theme_embedding")[0]).alias("first_value"),
    )


@query
def jensen_shannon_similarity(spark, sf):
    s = tb.scoring_inputs(spark, sf)
    return theme_similarity(theme_hits(s.out, s.sentence_tf, s.theme)).select("id", "cluster_id", r("js_sim").alias("js_sim"))


@query
def combined_similarity(spark, sf):
    s = tb.scoring_inputs(spark, sf)
    pairs = theme_scores(s.out, s.sentence_tf, s.vectors, s.theme, s.centers, s.emb_state, tb.TO_DATE, tb.SCORING_WINDOW, True)
    return pairs.select("id", "cluster_id", r("cos").alias("cos"), r("sim").alias("sim"))


@query
def replaced_embeddings(spark, sf):
    return by_dim(_assigned(spark, sf, True, True), "new_embedding", "id")


@query
def merged_vector_state(spark, sf):
    embedded, _ = tb.dense_inputs(spark, sf)
    rows = embedded.withColumn("cluster", tb.cluster_of_source())
    half = F.hour("date") < 12
    state = merge_embedding_state(
        embedding_delta(rows.filter(half)), embedding_delta(rows.filter(~half)), tb.TO_DATE, tb.SCORING_WINDOW
    )
    return state.select("cluster_id", "date", "n", r(vectors.norm(F.col("emb_sum"))).alias("length"))


@query
def merged_term_state(spark, sf):
    rows = tb.articles(spark, sf).withColumn("cluster", tb.cluster_of_source())
    tf = tb.slided_terms(spark, sf)
    french = F.col("lang") == "fr"
    return merge_term_state(
        term_delta(rows.filter(french), tf), term_delta(rows.filter(~french), tf), tb.TO_DATE, tb.SCORING_WINDOW
    ).withColumn("tf", F.col("tf").cast("bigint"))


@query
def outlier_groups(spark, sf):
    points = stage(tb.embedded_articles(spark, sf).select("id", "embedding"))
    found = cluster_outliers(points, points.count(), 20, tb.PARAMS.min_articles)
    return found[0].groupBy("cluster").agg(F.count("*").alias("size"))


def _cluster_terms(spark, sf):
    a_tf = tb.slided_terms(spark, sf)
    rows = tb.articles(spark, sf).filter(F.col("date") < F.lit(tb.MEMBERS_UNTIL).cast("timestamp_ntz"))
    return rows.withColumn("cluster", tb.cluster_of_source()), a_tf


def _show_theme(df):
    return df.select("cluster_id", "rank", "term", r("score").alias("score"), "prob")


@query
def decayed_themes_tfidf(spark, sf):
    members, tf = _cluster_terms(spark, sf)
    return _show_theme(tb.given_theme(stage(term_delta(members, tf)), tb.given_centers(spark, sf)))


@query
def plain_themes_bm25(spark, sf):
    members, tf = _cluster_terms(spark, sf)
    return _show_theme(cluster_theme(stage(plain_cluster_terms(members, tf)), tb.PARAMS.n_keywords, "bm25"))


@query
def keyword_history_rows(spark, sf):
    members, tf = _cluster_terms(spark, sf)
    theme = tb.given_theme(stage(term_delta(members, tf)), tb.given_centers(spark, sf))
    return keyword_history(theme, 3).withColumn("keywords", F.concat_ws(",", "keywords"))


@query
def nearest_centers(spark, sf):
    embedded, centers = tb.dense_inputs(spark, sf)
    return nearest_center(embedded, centers).withColumn("cos", r("cos"))


@query
def rebuilt_state(spark, sf):
    embedded, _ = tb.dense_inputs(spark, sf)
    tf = tb.slided_terms(spark, sf)
    emb, terms_ = rebuild_state(_assignments(spark, sf), embedded, tf, tb.TO_DATE, tb.SCORING_WINDOW)
    totals = terms_.groupBy("cluster_id", "date").agg(F.sum("tf").cast("bigint").alias("total_tf"), F.count("*").alias("terms"))
    return emb.join(totals, ["cluster_id", "date"]).select(
        "cluster_id", "date", "n", r(vectors.norm(F.col("emb_sum"))).alias("length"), "total_tf", "terms"
    )


@query
def window_members(spark, sf):
    pairs = window_membership(tb.slided_articles(spark, sf), tb.PARAMS.num_windows, tb.PARAMS.live_slides)
    return pairs


def _run(spark, sf, params=None):
    rows = tb.with_vectors(spark, sf, tb.sentences(spark, sf)).drop("sentence")
    return simulate(rows, params or tb.PARAMS)


@query
def sliding_window_run(spark, sf):
    return _run(spark, sf).articles.groupBy("slide_id", "cluster").agg(F.count("*").alias("size"), r(F.avg("sim")).alias("avg_sim"))


@query
def daily_run(spark, sf):
    corpus = daily_plan.load_context(
        tb.stored_articles(spark, sf), tb.stored_chunks(spark, sf), tb.stored_vectors(spark, sf), tb.NOW, 28
    )
    clusters, rows = _clusters(spark, sf), _assignments(spark, sf)
    run = daily_plan.run_daily(corpus, clusters, rows, tb.NOW, daily_plan.DAILY.with_(window_size=28, temperature=2), days_back=14)
    return run.assignments.groupBy("cluster_id", "assignment_type").agg(F.count("*").alias("n"))


# --- reports ---------------------------------------------------------------------------


@query
def cluster_summaries(spark, sf):
    return reports.cluster_summary(tb.clustered(spark, sf), 2).withColumn("avg_sim", r("avg_sim"))


@query
def best_clusters(spark, sf):
    best = reports.top_clusters(tb.clustered(spark, sf), 5, 2)
    return best.select("cluster", "place", "id", "date", "title", r("sim").alias("sim"), "size", r("avg_sim").alias("avg_sim"))


@query
def one_cluster(spark, sf):
    return reports.inspect_cluster(tb.clustered(spark, sf), 3, 15).withColumn("sim", r("sim"))


@query
def cluster_metadata_rows(spark, sf):
    meta = cs.cluster_metadata(tb.clustered(spark, sf), tb.keyword_table(spark, sf))
    return meta.select(
        "cluster_id", r(F.col("cluster_center")[0]).alias("first_value"), r(vectors.norm(F.col("cluster_center"))).alias("length"),
        "cluster_size", F.concat_ws(",", "keywords").alias("keywords"), "date_range_start", "date_range_end", "status",
        "similarity_threshold",
    )


@query
def mean_cosine_per_temperature(spark, sf):
    rows = tb.with_vectors(spark, sf, tb.sentences(spark, sf)).drop("sentence")
    return mean_cosine_by_temperature(rows, tb.PARAMS)


@query
def coherence(spark, sf):
    return reports.coherence_metrics(tb.clustered(spark, sf))


@query
def size_inequality(spark, sf):
    return reports.size_gini(tb.clustered(spark, sf)).withColumn("gini_size", r("gini_size"))


@query
def mean_of_cluster_means(spark, sf):
    return reports.mean_cluster_similarity(tb.clustered(spark, sf)).withColumn("mean_sim", r("mean_sim"))


@query
def run_totals(spark, sf):
    return reports.run_counts(tb.clustered(spark, sf))


@query
def projection_2d(spark, sf):
    return reports.project_2d(tb.clustered(spark, sf), sample=None).select("id", "cluster", "sim", r("x").alias("x"), r("y").alias("y"))


# --- evaluation --------------------------------------------------------------------------


@query
def class_precision_recall(spark, sf):
    return evaluate.class_precision_recall(tb.labelled(spark, sf)).withColumn("value", r("value"))


@query
def b_cubed(spark, sf):
    rows = tb.labelled(spark, sf)
    return (
        evaluate.calc_b3(rows).withColumn("variant", F.lit("element"))
        .unionByName(evaluate.calc_b3(rows, class_norm=True).withColumn("variant", F.lit("class")))
        .unionByName(evaluate.calc_b3(rows, beta=2.0).withColumn("variant", F.lit("beta2")))
        .select("variant", r("fscore").alias("fscore"), r("precision").alias("precision"), r("recall").alias("recall"))
    )


@query
def quality_metrics(spark, sf):
    found = evaluate.eval_metric(tb.labelled(spark, sf), digits=None)
    return found.select(*[r(m).alias(m) for m in evaluate.METRICS])


@query
def mean_window_metrics(spark, sf):
    return evaluate.mean_over_windows(tb.labelled(spark, sf), digits=None)


# --- experiments ----------------------------------------------------------------------------


def _sweep(spark, sf, runs):
    rows = tb.with_vectors(spark, sf, tb.sentences(spark, sf)).drop("sentence")
    return sweep(rows, runs)


@query
def temperature_sweep(spark, sf):
    return _sweep(spark, sf, grid(tb.PARAMS, temperature=[1, 2, 3, 4]))


# --- streaming ---------------------------------------------------------------------------------


@query
def streamed_term_windows(spark, sf):
    """The stream's closed windows, from files of the given documents."""
    folder = new_workspace(spark, "stream")
    rows = tb.articles(spark, sf).select("id", "date", "title", "text")
    rows.repartitionByRange(text_tasks(rows), "date").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id string, date timestamp_ntz, title string, text string").parquet(f"{folder}/in")
    counted = windowed_document_frequency(stream, tb.PARAMS_BEGIN, 14, 7, lateness_days=1)
    running = (
        counted.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, term string, df bigint").parquet(f"{folder}/out")


def _text_vectors(texts):
    """Stand-in for an embedding model: four counts per text."""
    return [[float(len(t)), float(t.count(" ")), float(t.count("e")), 1.0] for t in texts]


def _arrive(rows, path):
    """Writes an arrival in its own partitions; its number of files, which one batch takes."""
    rows.write.parquet(path)
    return max(len(rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles()), 1)


@query
def streamed_ingest(spark, sf):
    """Two arrivals of overlapping raw articles end up as one stored copy each."""
    from storyloom.streaming.ingest import raw_article_stream, start_ingest

    folder = new_workspace(spark, "ingest")
    raw = tb.raw_articles(spark, sf)
    again = raw.filter(F.col("published") >= F.lit(tb.MEMBERS_UNTIL).cast("timestamp_ntz"))
    for arrival, rows in enumerate((raw, again)):
        n_files = _arrive(rows, f"{folder}/in/{arrival}")
        stream = raw_article_stream(spark, f"{folder}/in/*", files_per_batch=n_files)
        start_ingest(stream, f"{folder}/store", f"{folder}/checkpoint", _text_vectors, tb.NOW).awaitTermination()
    stored = read_store(spark, f"{folder}/store")
    chunks = stored.chunks.join(stored.vectors.select("chunk_id", "embedding"), "chunk_id")
    per_article = chunks.groupBy("source_article_id").agg(
        F.count("*").alias("chunks"), F.sum(F.col("embedding")[0]).cast("bigint").alias("chars")
    )
    return stored.articles.select("source_article_id", "date", "sentence_counts").join(per_article, "source_article_id")


@query
def streamed_assignment(spark, sf):
    """New articles arrive in two folders; the cluster store is carried from batch to batch."""
    from storyloom.plans.ingest import Stored
    from storyloom.streaming.assign import read_cluster_store, start_assign, write_cluster_store

    folder = new_workspace(spark, "arrivals")
    new = tb.articles(spark, sf).filter(F.col("date") >= F.lit("2024-01-22").cast("timestamp_ntz")).select("id", "date")
    cut = F.lit("2024-01-29").cast("timestamp_ntz")
    write_cluster_store(_clusters(spark, sf), _assignments(spark, sf), f"{folder}/store", 0)
    stored = Stored(tb.stored_articles(spark, sf), tb.stored_chunks(spark, sf), tb.stored_vectors(spark, sf), None)
    params = daily_plan.DAILY.with_(window_size=28, temperature=2)
    for arrival, some in enumerate((new.filter(F.col("date") < cut), new.filter(F.col("date") >= cut))):
        n_files = _arrive(some.select("id"), f"{folder}/in/{arrival}")
        stream = spark.readStream.schema("id string").option("maxFilesPerTrigger", n_files).parquet(f"{folder}/in/*")
        start_assign(stream, stored, f"{folder}/store", f"{folder}/checkpoint", tb.NOW, params, days_back=28).awaitTermination()
    _, rows = read_cluster_store(spark, f"{folder}/store")
    return rows.groupBy("cluster_id", "assignment_type").agg(F.count("*").alias("n"))
