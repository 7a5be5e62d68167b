"""Assignment against a small model written in NumPy from the rules."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyloom.operators.assign import assign_to_clusters, time_weighted_centers
from storyloom.operators.dense import nearest_center, score_against_centers
from storyloom.operators.state import embedding_delta, merge_embedding_state, rebuild_state, term_delta
from storyloom.operators.theme import cluster_theme, decayed_cluster_terms, keyword_history

W, TO = 14, datetime(2024, 1, 15)
K, DIM, TERMS = 5, 6, 4


def fixture(seed=3, k=K):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(12)]
    theme = {c: [(words[(c * 2 + i) % 12], float(rng.uniform(1, 5)), round(float(p), 5))
                 for i, p in enumerate(rng.dirichlet(np.ones(TERMS)))] for c in range(k)}
    centers = {c: rng.normal(size=DIM) for c in range(k)}
    # cluster 0 has only entries outside the window: its static centre counts
    state = {c: {TO - timedelta(hours=int(h)): (rng.normal(size=DIM) * 2, int(rng.integers(1, 4)))
                 for h in (rng.integers(1, 330, 3) if c else [500, 600])} for c in range(k)}
    articles = {}
    for a in range(30):
        n = int(rng.integers(1, 5))
        sents = [(rng.normal(size=DIM), {str(w): int(rng.integers(1, 3)) for w in rng.choice(words + ["zz"] * 20, 3)}) for _ in range(n)]
        articles[f"a{a}"] = (TO - timedelta(hours=int(rng.integers(1, 160))), np.mean([s[0] for s in sents], axis=0), sents)
    return theme, centers, state, articles


def tables(spark, theme, centers, state, articles):
    t = spark.createDataFrame([(c, i + 1, w, s, p) for c, ts in theme.items() for i, (w, s, p) in enumerate(ts)],
                              "cluster_id bigint, rank int, term string, score double, prob double")
    c = spark.createDataFrame([(c, [float(x) for x in v]) for c, v in centers.items()], "cluster_id bigint, center array<double>")
    e = spark.createDataFrame([(c, d, [float(x) for x in v], n) for c, s in state.items() for d, (v, n) in s.items()],
                              "cluster_id bigint, date timestamp_ntz, emb_sum array<double>, n bigint")
    a = spark.createDataFrame([(i, d, [float(x) for x in v]) for i, (d, v, _) in articles.items()],
                              "id string, date timestamp_ntz, embedding array<double>")
    tf = spark.createDataFrame([(i, j, w, n) for i, (_, _, ss) in articles.items() for j, (_, ws) in enumerate(ss) for w, n in ws.items()],
                               "id string, sent_idx int, term string, tf bigint")
    sv = spark.createDataFrame([(i, j, [float(x) for x in v]) for i, (_, _, ss) in articles.items() for j, (v, _) in enumerate(ss)],
                               "id string, sent_idx int, embedding array<double>")
    return t, c, e, a, tf, sv


def floor_day(a, b):
    return (a - b).days  # timedelta days round down


def center_at(date, c, centers, state):
    total, mass = np.zeros(DIM), 0.0
    for d, (v, n) in state[c].items():
        if floor_day(TO, d) - 1 >= W:
            continue
        w = math.exp(-abs(floor_day(date, d)) / W)
        total, mass = total + w * v, mass + w * n
    return centers[c] if mass == 0 else total / mass


def model(theme, centers, state, articles, T, time_aware, theme_aware, initial=False):
    out = {}
    cos = lambda x, y: float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)))
    k = len(centers)
    for i, (date, emb, sents) in articles.items():
        sims, seen = [], []
        for c in sorted(centers):
            cen = center_at(date, c, centers, state) if time_aware else centers[c]
            if not theme_aware:
                sims.append(cos(emb, cen)), seen.append(emb)
                continue
            raw = np.array([sum(ws.get(w, 0) * s for w, s, _ in theme[c]) for _, ws in sents])
            if raw.sum() == 0:
                sims.append(0.0), seen.append(emb)
                continue
            v = (raw / raw.sum()) @ np.array([s[0] for s in sents])
            p = np.array([p for *_, p in theme[c]])
            q = np.array([sum(ws.get(w, 0) for _, ws in sents) for w, *_ in theme[c]], dtype=float)
            p, q = p / p.sum(), q / q.sum()
            m = (p + q) / 2
            kl = lambda x: sum(xi * math.log(xi / mi) for xi, mi in zip(x, m) if xi > 0)  # noqa: E731, B023
            sims.append(max(cos(v, cen), 0.0) * (1 - math.sqrt(max((kl(p) + kl(q)) / 2, 0)))), seen.append(v)
        probs = np.exp(T * np.array(sims))
        probs /= probs.sum()
        conf = max(sims) if not initial and k == 1 else probs.max()
        best = int(np.argmax(np.round(sims, 12)))
        gone = round((1 - conf) - (1 - 1 / (k + 1)) ** T, 12) > 0
        out[i] = (-1, 0.0, emb) if gone else (sorted(centers)[best], float(probs.max()), seen[best])
    return out


@pytest.mark.parametrize("time_aware", [True, False])
@pytest.mark.parametrize("theme_aware", [True, False])
@pytest.mark.parametrize("T", [1, 3])
def test_matches_the_model(spark, time_aware, theme_aware, T):
    data = fixture()
    t, c, e, a, tf, sv = tables(spark, *data)
    got = assign_to_clusters(a, c, temperature=T, initial=False, window_size=W, to_date=TO, time_aware=time_aware,
                             theme_aware=theme_aware, emb_state=e, theme=t, sentence_tf=tf, sentence_vectors=sv).collect()
    want = model(*data, T, time_aware, theme_aware)
    assert len(got) == len(want)
    for r in got:
        cluster, sim, emb = want[r.id]
        assert r.cluster == cluster and r.sim == pytest.approx(sim, abs=1e-12)
        assert np.allclose(r.new_embedding, emb)


@pytest.mark.parametrize("initial", [True, False])
def test_single_cluster_gate(spark, initial):
    data = fixture(k=1)
    t, c, e, a, tf, sv = tables(spark, *data)
    got = {r.id: r.cluster for r in assign_to_clusters(
        a, c, temperature=2, initial=initial, window_size=W, to_date=TO, time_aware=False, theme_aware=True,
        emb_state=e, theme=t, sentence_tf=tf, sentence_vectors=sv).collect()}
    want = {i: w[0] for i, w in model(*data, 2, False, True, initial).items()}
    assert got == want
    # alone, an initial cluster takes everything; later it needs enough similarity
    assert (set(got.values()) == {0}) == initial


@pytest.mark.parametrize("T, expected", [(1, 0), (2, -1), (4, -1)])
def test_article_sharing_no_theme_term(spark, T, expected):
    theme, centers, state, articles = fixture()
    lonely = {"x": (TO - timedelta(days=1), np.ones(DIM), [(np.ones(DIM), {"unknown": 2})])}
    t, c, e, a, tf, sv = tables(spark, theme, centers, state, lonely)
    got = assign_to_clusters(a, c, temperature=T, initial=False, window_size=W, to_date=TO, time_aware=True,
                             theme_aware=True, emb_state=e, theme=t, sentence_tf=tf, sentence_vectors=sv).first()
    assert got.cluster == expected and list(got.new_embedding) == [1.0] * DIM


def test_no_cluster_leaves_outliers(spark):
    _, c, _, a, _, _ = tables(spark, *fixture())
    got = assign_to_clusters(a, c.filter("false"), temperature=2, initial=True, window_size=W)
    assert {r.cluster for r in got.collect()} == {-1}


def test_small_tiles_give_the_same_scores(spark):
    theme, centers, state, articles = fixture()
    _, c, e, a, _, _ = tables(spark, theme, centers, state, articles)
    entries = c.select("cluster_id", F.col("center").alias("vector"))
    whole = {r.id: r for r in score_against_centers(a, entries, 2.0).collect()}
    tiled = {r.id: r for r in score_against_centers(a, entries, 2.0, tile_bytes=DIM * 8 * 2).collect()}
    assert whole.keys() == tiled.keys() == articles.keys()
    for i, r in whole.items():
        assert r.k == tiled[i].k == K and r.best_cluster == tiled[i].best_cluster
        assert r.sum_exp == pytest.approx(tiled[i].sum_exp) and r.best_sim == pytest.approx(tiled[i].best_sim)
    best = {r.id: r.cluster_id for r in nearest_center(a, c).collect()}
    assert best == {i: r.best_cluster for i, r in whole.items()}


def test_ties_go_to_the_lowest_cluster(spark):
    a = spark.createDataFrame([("a", [1.0, 0.0])], "id string, embedding array<double>")
    c = spark.createDataFrame([(7, [2.0, 0.0]), (3, [5.0, 0.0]), (5, [0.0, 0.0])], "cluster_id bigint, center array<double>")
    assert nearest_center(a, c).first().cluster_id == 3


def test_slabs_of_a_large_cluster_add_up(spark):
    data = fixture()
    _, c, e, a, _, _ = tables(spark, *data)
    pairs = a.select("date").join(c.select("cluster_id"))
    one = {(r.date, r.cluster_id): r.center for r in time_weighted_centers(pairs, e, c, TO, W).collect()}
    cut = {(r.date, r.cluster_id): r.center for r in time_weighted_centers(pairs, e, c, TO, W, group_rows=1).collect()}
    assert one.keys() == cut.keys() and len(one) == K * len({d for d, _ in one})
    for (date, cluster), center in one.items():
        assert np.allclose(center, cut[date, cluster])
        assert np.allclose(center, center_at(date, cluster, data[1], data[2]))


def test_state_sums_equal_recomputation(spark):
    rows = [(f"a{i}", i % 3 - 1, TO - timedelta(days=i % 4), [float(i), 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, cluster bigint, date timestamp_ntz, embedding array<double>")
    parts = merge_embedding_state(embedding_delta(df.filter("id < 'a15'")), embedding_delta(df.filter("id >= 'a15'")))
    got = {(r.cluster_id, r.date): (r.emb_sum, r.n) for r in parts.collect()}
    want = {}
    for _, c, d, v in rows:
        if c >= 0:
            s, n = want.get((c, d), ([0.0, 0.0], 0))
            want[c, d] = ([s[0] + v[0], s[1] + v[1]], n + 1)
    assert {k: (np.round(v[0], 9).tolist(), v[1]) for k, v in got.items()} == want
    # entries of the last day have weight > 1, those older than the window are dropped
    kept = merge_embedding_state(None, embedding_delta(df), TO, 2)
    assert {r.date for r in kept.collect()} == {TO - timedelta(days=i) for i in range(3)}


def test_theme_weights_and_probabilities(spark):
    state = spark.createDataFrame(
        [(0, TO, "x", 2.0), (0, TO - timedelta(days=15), "x", 9.0), (0, TO - timedelta(days=3), "y", 1.0), (1, TO, "x", 1.0)],
        "cluster_id bigint, date timestamp_ntz, term string, tf double",
    )
    live = spark.createDataFrame([(0,), (1,)], "cluster_id bigint")
    tf = decayed_cluster_terms(state, live, TO, W)
    got = {(r.cluster_id, r.term): r.tf for r in tf.collect()}
    assert got[0, "x"] == pytest.approx(2 * math.exp(1 / W)) and got[0, "y"] == pytest.approx(math.exp(-2 / W))
    theme = {(r.cluster_id, r.term): r for r in cluster_theme(tf, 10).collect()}
    assert theme[0, "y"].score == pytest.approx(got[0, "y"] * (math.log(3 / 2) + 1))
    total = got[0, "x"] + got[0, "y"]
    assert theme[0, "x"].prob == round(got[0, "x"] / total, 5) and theme[1, "x"].prob == 1.0
    history = {r.cluster_id: r.keywords for r in keyword_history(cluster_theme(tf, 1), 4).collect()}
    assert history == {0: ["x"], 1: ["x"]}


def test_rebuilt_state_is_per_calendar_date(spark):
    ctx = spark.createDataFrame(
        [("a", TO - timedelta(hours=3), [1.0]), ("b", TO - timedelta(hours=20), [2.0]), ("c", TO - timedelta(days=14), [4.0])],
        "id string, date timestamp_ntz, embedding array<double>",
    )
    asg = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("z", None)], "source_article_id string, cluster_id bigint")
    tf = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "id string, term string, tf bigint")
    emb, terms = rebuild_state(asg, ctx, tf, TO, W)
    day = datetime(2024, 1, 14)
    assert [(r.cluster_id, r.date, r.emb_sum, r.n) for r in emb.collect()] == [(1, day, [3.0], 2)]
    assert [(r.date, r.term, r.tf) for r in terms.collect()] == [(day, "x", 3.0)]
    assert term_delta(ctx.withColumn("cluster", F.lit(-1)), tf).count() == 0
