"""Ingest, stored tables, cluster store, daily run, streams."""

import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from storyloom import schemas
from storyloom.config import StoryParams
from storyloom.plans.daily import load_context, run_daily
from storyloom.plans.ingest import ingest_all, ingest_daily, ingest_days, read_store
from storyloom.session import new_workspace
from storyloom.sources import clusters as cs
from storyloom.sources.articles import assemble_sentences, fetch_processed, read_articles_from_days, read_dataset, vectors_of
from storyloom.sources.store import write_changes
from storyloom.sources.tables import claim_version, latest_version, take_version, upsert, write_version
from storyloom.streaming.assign import read_cluster_store, start_assign, write_cluster_store
from storyloom.streaming.ingest import raw_article_stream, start_ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])
NOW = datetime(2024, 1, 20, 12)


def embed(texts):
    if any("poison" in t for t in texts):
        raise RuntimeError("model refused")
    return [[float(t.count("a")) + 0.5, float(t.count("e")) + 0.5, float(len(t)) / 50] for t in texts]


def raw(spark, n=12, poison=()):
    rows = [
        (f"r{i}", NOW - timedelta(days=i), f"Title {i}", ("poison here. " if i in poison else "") + f"Alpha beta gamma {i}. Delta epsilon zeta. End of text.",
         NOW - timedelta(days=i) + timedelta(hours=1))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schemas.RAW_ARTICLES)


def test_ingest_twice_changes_nothing(spark):
    root = new_workspace(spark, "ingest")
    once = ingest_all(raw(spark), root, embed, NOW)
    counts = [t.count() for t in once]
    again = ingest_all(raw(spark), root, embed, NOW)
    assert [t.count() for t in again] == counts == [12, 48, 48, 0]
    assert again.chunks.exceptAll(once.chunks).count() == 0
    row = again.articles.filter("source_article_id = 'r3'").first()
    assert row.sentence_counts == 4 and row.sentence_tokens[1] == ["alpha", "beta", "gamma"] and len(row.sentence_tokens) == 4


def test_reprocessed_article_loses_its_old_chunks(spark):
    root = new_workspace(spark, "ingest")
    ingest_all(raw(spark), root, embed, NOW)
    shorter = raw(spark, 1).withColumn("content", F.lit("Only one sentence."))
    stored = ingest_all(shorter, root, embed, NOW)
    assert stored.chunks.filter("source_article_id = 'r0'").count() == 2 == stored.vectors.filter("source_article_id = 'r0'").count()
    assert stored.articles.count() == 12


def test_daily_ingest_takes_recent_unseen_articles_and_retries_failures(spark):
    root = new_workspace(spark, "ingest")
    first = ingest_daily(raw(spark, poison={1}), root, embed, NOW)
    assert {r[0] for r in first.articles.select("source_article_id").collect()} == {"r2", "r3"}
    assert [(r.id, "model refused" in r.error) for r in first.quarantine.collect()] == [("r1", True)]
    healed = ingest_daily(raw(spark), root, embed, NOW + timedelta(minutes=1))
    assert {r[0] for r in healed.articles.select("source_article_id").collect()} == {"r1", "r2", "r3"}
    assert healed.quarantine.count() == 0
    more = ingest_days(raw(spark), root, embed, NOW, 5)
    assert more.articles.count() == 5
    assert latest_version(spark, f"{root}/done") == 2


def test_trial_load_is_capped(spark):
    assert ingest_all(raw(spark), new_workspace(spark, "ingest"), embed, NOW, limit=3).articles.count() == 3


def test_filters_reach_the_scan(spark):
    path = new_workspace(spark, "raw")
    raw(spark).write.parquet(path)
    plan = read_articles_from_days(spark.read.parquet(path), 3, NOW)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(created_at" in plan
    assert "LessThanOrEqual(cre" in plan


def test_fetch_and_dataset(spark):
    stored = ingest_all(raw(spark), new_workspace(spark, "ingest"), embed, NOW)
    vectors = stored.vectors.filter("source_article_id <> 'r5'")
    rows = {r.id: r for r in fetch_processed(stored.articles, stored.chunks, vectors).collect()}
    assert "r5" not in rows and len(rows) == 11
    # the title is stored as a chunk and put in front again
    assert rows["r2"].sentences[:2] == ["Title 2", "Title 2"] and rows["r2"].sentence_counts == 5
    assert len(rows["r2"].sentence_embds) == 5
    assert {"id", "source_article_id", "date", "title", "text", "sentences", "sentence_counts", "sentence_tokens", "sentence_embds"} <= set(rows["r2"].asDict())
    once = assemble_sentences(stored.articles, vectors_of(stored.chunks, vectors), dedupe_title=True)
    assert once.filter("id = 'r2'").count() == 4
    corpus = read_dataset(stored.articles, stored.chunks, stored.vectors, "2024-01-15", "2024-01-17")
    assert {r.id for r in corpus.articles.collect()} == {"r3", "r4", "r5"}
    tf = {r.term: r.tf for r in corpus.article_tf.filter("id = 'r3'").collect()}
    assert tf["title"] == 2 and tf["alpha beta"] == 1


def test_upsert(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, upsert(a, b, "k").collect())) == [(1, "a"), (2, "B"), (3, "C")]


def cluster_store(spark):
    clusters = spark.createDataFrame(
        [(4, [1.0, 0.0, 0.0], 1, ["old"], NOW, NOW, "active", 0.7, NOW), (9, [0.0, 1.0, 0.0], 5, [], NOW, NOW, "retired", 0.7, NOW)],
        schemas.CLUSTERS,
    )
    return clusters, spark.createDataFrame([("r9", 4, 0.4, "initial")], schemas.ARTICLE_CLUSTERS)


def test_cluster_store_updates(spark):
    clusters, rows = cluster_store(spark)
    rows = cs.assign_articles(rows, spark.createDataFrame([("r1", 4, None), ("r9", 4, 0.9)], "source_article_id string, cluster_id bigint, sim double"), "daily")
    assert sorted((r[0], r[2], r[3]) for r in rows.collect()) == [("r1", 0.0, "daily"), ("r9", 0.9, "daily")]
    sized = {r.cluster_id: r.cluster_size for r in cs.update_sizes(clusters, rows, NOW).collect()}
    assert sized == {4: 2, 9: 0}
    dates = spark.createDataFrame([("r1", NOW - timedelta(days=1)), ("r9", NOW - timedelta(days=9))], "id string, date timestamp_ntz")
    ranged = {r.cluster_id: (r.date_range_start, r.date_range_end) for r in cs.update_date_ranges(clusters, rows, dates, NOW).collect()}
    assert ranged == {4: (NOW - timedelta(days=9), NOW - timedelta(days=1)), 9: (NOW, NOW)}
    moved = spark.createDataFrame([(4, [0.0, 0.0, 2.0])], "cluster_id bigint, cluster_center array<double>")
    new = {r.cluster_id: (r.cluster_center, r.keywords) for r in cs.update_centers(clusters, moved, NOW).collect()}
    assert new[4] == ([0.0, 0.0, 2.0], ["old"]) and new[9][0] == [0.0, 1.0, 0.0]
    assert [r.cluster_id for r in cs.load_active_clusters(clusters).collect()] == [4]


def test_saved_run_maps_ids_and_keeps_outliers(spark):
    clusters, rows = cluster_store(spark)
    window = spark.createDataFrame(
        [("x", NOW, 0, 0.5, [1.0, 1.0, 0.0]), ("y", NOW, 3, 0.6, [0.0, 1.0, 0.0]), ("z", NOW, -1, 0.0, [0.0, 0.0, 1.0])],
        "id string, date timestamp_ntz, cluster bigint, sim double, embedding array<double>",
    )
    words = spark.createDataFrame([(0, 3, ["early"]), (1, 3, ["late"]), (2, 3, [])], schemas.KEYWORDS)
    after, members = cs.save_run(clusters, rows, window, words, NOW)
    new = {r.cluster_id: r.keywords for r in after.collect()}
    assert new[10] == [] and new[11] == ["late"] and set(new) == {4, 9, 10, 11}
    assert {(r[0], r[1], r[3]) for r in members.collect()} == {("r9", 4, "initial"), ("x", 10, "initial"), ("y", 11, "initial"), ("z", None, "outlier")}


@pytest.fixture(scope="module")
def stored(spark):
    return ingest_all(raw(spark, 20), new_workspace(spark, "ingest"), embed, NOW)


PARAMS = StoryParams(num_windows=1, min_articles=2, temperature=2)


def test_daily_run(spark, stored):
    clusters, rows = cluster_store(spark)
    corpus = load_context(stored.articles, stored.chunks, stored.vectors, NOW, 14)
    run = run_daily(corpus, clusters, rows, NOW, PARAMS, days_back=3)
    new = {r.id for r in run.window.collect()}
    assert new == {"r0", "r1", "r2", "r3"}
    after = run.assignments.collect()
    assert {r.source_article_id for r in after} == new | {"r9"}
    kinds = {r.assignment_type for r in after}
    assert kinds <= {"daily", "initial", "outlier"}
    made = {r.cluster_id for r in run.new_centers.collect()}
    # ids of retired clusters are not given away again
    assert all(c > 9 for c in made) and run.clusters.count() == 2 + len(made)
    sizes = {r.cluster_id: r.cluster_size for r in run.clusters.collect()}
    for c in made:
        assert sizes[c] == sum(1 for r in after if r.cluster_id == c)


def test_daily_run_writes_no_texts_and_counts_only_theme_terms(spark, stored, monkeypatch):
    from storyloom.plans import daily

    written = {}
    for name in ("stage", "stage_by_article"):
        def spy(df, path=None, *more, plain=getattr(daily, name)):
            written[path.rsplit("/", 1)[-1]] = out = plain(df, path, *more)
            return out
        monkeypatch.setattr(daily, name, spy)
    corpus = load_context(stored.articles, stored.chunks, stored.vectors, NOW, 14)
    run_daily(corpus, *cluster_store(spark), NOW, PARAMS, days_back=3)
    assert not [n for n, df in written.items() if "sentence" in df.columns]
    counts = [n for n, df in written.items() if {"sent_idx", "term"} <= set(df.columns)]
    assert set(counts) <= {"theme_tf"}
    if counts:
        assert written["theme_tf"].join(written["theme"], "term", "left_anti").isEmpty()


def test_first_daily_run_without_clusters(spark, stored):
    empty = spark.createDataFrame([], schemas.CLUSTERS), spark.createDataFrame([], schemas.ARTICLE_CLUSTERS)
    corpus = load_context(stored.articles, stored.chunks, stored.vectors, NOW, 14)
    run = run_daily(corpus, *empty, NOW, PARAMS, days_back=13)
    assert run.window.count() == 14 and run.clusters.count() == run.new_centers.count()


def test_streamed_ingest_equals_batch(spark):
    folder = new_workspace(spark, "stream")
    raw(spark, 12, poison={4}).coalesce(1).write.parquet(f"{folder}/in")
    stream = lambda: raw_article_stream(spark, f"{folder}/in", 1)
    start_ingest(stream(), f"{folder}/store", f"{folder}/cp", embed, NOW).awaitTermination()
    got = read_store(spark, f"{folder}/store")
    assert got.articles.count() == 11 and got.quarantine.count() == 1
    raw(spark, 14).filter("id in ('r12', 'r13', 'r2')").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    start_ingest(stream(), f"{folder}/store", f"{folder}/cp", embed, NOW).awaitTermination()
    got = read_store(spark, f"{folder}/store")
    batch = ingest_all(raw(spark, 14).filter("id <> 'r4'"), new_workspace(spark, "ingest"), embed, NOW)
    ids = lambda s: sorted(r[0] for r in s.chunks.select("chunk_id").collect())
    assert ids(got) == ids(batch) and got.articles.count() == 13
    assert [r.id for r in got.quarantine.collect()] == ["r4"]


def test_streamed_assignment_equals_daily_runs(spark, stored):
    folder = new_workspace(spark, "stream")
    write_cluster_store(*cluster_store(spark), f"{folder}/store", 0)
    spark.createDataFrame([("r0",), ("r1",), ("r2",), ("r3",)], "id string").coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id string").parquet(f"{folder}/in")
    start_assign(stream, stored, f"{folder}/store", f"{folder}/cp", NOW, PARAMS, days_back=3).awaitTermination()
    _, got = read_cluster_store(spark, f"{folder}/store")
    corpus = load_context(stored.articles, stored.chunks, stored.vectors, NOW, 14)
    want = run_daily(corpus, *cluster_store(spark), NOW, PARAMS, days_back=3).assignments
    key = lambda r: (r[0], r[1], round(r[2], 9), r[3])
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, want.select(*got.columns).collect()), key=repr)


def test_half_written_versions_are_ignored(spark):
    folder = new_workspace(spark, "table")
    write_version(spark.range(3), folder, 0)
    spark.range(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/v=1")
    assert latest_version(spark, folder) == 0


def test_stream_continues_the_store_of_a_cold_start(spark):
    folder = new_workspace(spark, "stream")
    every = raw(spark, 6)
    ingest_all(every.filter("id in ('r0', 'r1', 'r2')"), f"{folder}/store", embed, NOW)
    every.filter("id in ('r3', 'r4', 'r5')").coalesce(1).write.parquet(f"{folder}/in")
    start_ingest(raw_article_stream(spark, f"{folder}/in"), f"{folder}/store", f"{folder}/cp", embed, NOW).awaitTermination()
    got = read_store(spark, f"{folder}/store")
    assert sorted(r[0] for r in got.articles.select("source_article_id").collect()) == [f"r{i}" for i in range(6)]


def test_one_row_per_id_is_stored(spark):
    twice = raw(spark, 6).unionByName(raw(spark, 6).filter("id = 'r0'"))
    got = ingest_all(twice, new_workspace(spark, "ingest"), embed, NOW)
    assert got.articles.count() == 6
    assert got.chunks.count() == got.chunks.select("chunk_id").distinct().count()


def test_replayed_batch_finds_its_version(spark):
    root = new_workspace(spark, "claims")
    assert claim_version(spark, root, "a#0", None) == 0
    assert claim_version(spark, root, "a#1", 0) == 1
    assert claim_version(spark, root, "a#0", 1) == 0
    assert claim_version(spark, root, "b#0", 4) == 5


def test_replay_keeps_what_others_stored_meanwhile(spark):
    folder = new_workspace(spark, "stream")
    root, every = f"{folder}/store", raw(spark, 6)
    ingest_all(every.filter("id in ('r0', 'r1')"), root, embed, NOW)
    every.filter("id = 'r5'").coalesce(1).write.parquet(f"{folder}/in")
    # the stream's first batch claims a version and dies; a batch ingest comes between
    assert take_version(spark, root, f"{folder}/cp#0", "done") == (1, 0)
    ingest_all(every.filter("id in ('r2', 'r3')"), root, embed, NOW)
    assert latest_version(spark, f"{root}/done") == 2
    start_ingest(raw_article_stream(spark, f"{folder}/in"), root, f"{folder}/cp", embed, NOW).awaitTermination()
    got = read_store(spark, root)
    assert sorted(r[0] for r in got.articles.select("source_article_id").collect()) == ["r0", "r1", "r2", "r3", "r5"]
    # the batch is replayed once more after it was stored
    assert take_version(spark, root, f"{folder}/cp#0 after 2", "done") == (None, 3)


def test_failed_rows_are_retried_after_a_batch_ingest(spark):
    folder = new_workspace(spark, "stream")
    root, stream = f"{folder}/store", lambda: raw_article_stream(spark, f"{folder}/in")
    sick = lambda texts: embed([t.replace("beta", "poison") for t in texts])
    raw(spark, 1).coalesce(1).write.parquet(f"{folder}/in")
    start_ingest(stream(), root, f"{folder}/cp", sick, NOW).awaitTermination()
    ingest_all(raw(spark, 3).filter("id = 'r1'"), root, embed, NOW)
    raw(spark, 3).filter("id = 'r2'").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    start_ingest(stream(), root, f"{folder}/cp", embed, NOW).awaitTermination()
    got = read_store(spark, root)
    assert sorted(r[0] for r in got.articles.select("source_article_id").collect()) == ["r0", "r1", "r2"]
    assert got.quarantine.isEmpty()


def test_ids_that_cannot_be_placed_are_set_aside(spark, stored):
    folder = new_workspace(spark, "stream")
    write_cluster_store(*cluster_store(spark), f"{folder}/store", 0)
    spark.createDataFrame([("r0",), ("r15",), ("nobody",)], "id string").coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id string").parquet(f"{folder}/in")
    start_assign(stream, stored, f"{folder}/store", f"{folder}/cp", NOW, PARAMS, days_back=3).awaitTermination()
    lost = spark.read.parquet(f"{folder}/store/unplaced/v=1")
    assert {tuple(r) for r in lost.collect()} == {("r15", "outside the days looked at"), ("nobody", "not stored")}


def test_ranges_only_grow_without_all_dates(spark):
    clusters, assignments = cluster_store(spark)
    before = {r.cluster_id: (r.date_range_start, r.date_range_end) for r in clusters.collect()}
    few = raw(spark, 12).select("id", F.col("published").alias("date")).filter("id = 'r0'")
    for r in cs.update_date_ranges(clusters, assignments, few, NOW, widen=True).collect():
        start, end = before[r.cluster_id]
        assert (start is None or r.date_range_start <= start) and (end is None or r.date_range_end >= end)


def test_arrivals_keep_their_partitions(spark, tiny, monkeypatch):
    from pathlib import Path

    from storyloom.plans import queries

    folders, raw_articles = [], queries.tb.raw_articles
    monkeypatch.setattr(queries, "new_workspace", lambda s, name: folders.append(new_workspace(s, name)) or folders[-1])
    monkeypatch.setattr(queries.tb, "raw_articles", lambda s, sf: raw_articles(s, sf).repartition(3))
    queries.QUERIES["streamed_ingest"](spark, tiny)
    written = [p.relative_to(folders[0]).parts[1] for p in Path(folders[0].removeprefix("file:")).glob("in/**/*.parquet")]
    assert written.count("0") == written.count("1") == 3
    assert len([*Path(folders[0]).glob("checkpoint/commits/[0-9]*")]) == 2


def test_a_change_writes_only_its_buckets(spark):
    from pathlib import Path

    path = new_workspace(spark, "buckets")
    rows = spark.range(400).select(F.col("id").cast("string").alias("source_article_id"), F.lit(0).alias("x"), F.lit("a").alias("_new"))
    write_changes(rows.unionAll(rows), path, buckets=64)
    files = lambda: {str(f) for f in Path(path.removeprefix("file:")).glob("bucket=*/*.parquet")}
    before = files()
    change = rows.filter("source_article_id in ('7', '8', '9', '10')").withColumn("x", F.lit(1))
    stored = write_changes(change, path, buckets=64)
    after = files()
    assert 0 < len(before - after) <= 4 and 0 < len(after - before) <= 4 and len(before & after) >= 56
    assert stored.count() == 796 and stored.filter("x = 1").count() == 4
    # the same again changes nothing, nor does an empty change; null keys are only added
    assert write_changes(change, path, buckets=64).count() == 796
    assert write_changes(change.limit(0), path, buckets=64).count() == 796
    nobody = change.limit(1).withColumn("source_article_id", F.lit(None).cast("string"))
    assert write_changes(nobody, path, buckets=64).count() == 797
    empty = new_workspace(spark, "buckets")
    assert write_changes(change.limit(0), empty, buckets=64).isEmpty()
    assert write_changes(change, empty, buckets=64).count() == 4
