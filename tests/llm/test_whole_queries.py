"""Queries without a SQL counterpart against plain versions or held-out labels, over the whole small tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from storyloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(tiny):
    return pd.read_parquet(f"{tiny}/documents.parquet").set_index("doc_id")


def run(spark, name, sf_dir):
    return QUERIES[name](spark, sf_dir).toPandas()


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    at, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            at[x].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for x in s for j in at[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sets, {i: root(i) for i in sets}


def test_copies_by_brute_force(spark, tiny, texts):
    sets, found = groups(texts.text)
    got = run(spark, "op2_hyperminhash_copies", tiny).set_index("doc_id")
    assert len(got) == len(texts)
    for i, r in got.iterrows():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), found[i], found[i] == i)


def test_search_recall(spark, tiny):
    rows = pd.read_parquet(f"{tiny}/embeddings.parquet")
    unit = np.array(rows.embedding.tolist(), float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids, hits, asked = rows.vec_id.to_numpy(), 0, 0
    for query, found in run(spark, "op5_multiprobe_search", tiny).groupby("query_id"):
        scores = unit @ unit[ids == query][0]
        scores[ids == query] = -2
        hits += len({*ids[np.argsort(-scores)[:5]]} & {*found.vec_id})
        asked += 5
        assert np.allclose([scores[ids == v][0] for v in found.vec_id], found.score) and sorted(found["rank"]) == [1, 2, 3, 4, 5]
    assert hits >= 0.9 * asked


def test_encoding_equals_the_library(spark, tiny, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in run(spark, "op10_prefix_bpe", tiny).itertuples():
        ids = library.encode(texts.text[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_language_on_held_out_documents(spark, tiny, texts):
    got = run(spark, "op9_marginal_language_id", tiny)
    held = got[got.held_out]
    assert (held.lang_pred == texts.lang[held.doc_id].to_numpy()).mean() > 0.95 and got.score.between(0, 1).all()


def test_toxicity_on_held_out_documents(spark, tiny):
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    both = run(spark, "op3_factored_toxicity", "/root/testdata/sf0.01").merge(labels, on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9 and both.score.between(0, 1).all()


def test_pipeline_by_brute_force(spark, tiny, texts):
    good = QUERIES["op6_distribution_quality"](spark, tiny).filter("kept").toPandas().doc_id
    _, found = groups(texts.text[sorted(good)])
    staged = [s for s, _ in corpus_pipeline.STAGES[:2]]
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:2]:
        docs = apply(spark, docs, tiny)
    assert staged == ["quality_rules", "near_dedup"]
    assert sorted(docs.toPandas().doc_id) == sorted(i for i, c in found.items() if i == c)
    out = corpus_pipeline.run(spark, tiny).toPandas()
    assert set(out.doc_id) <= {i for i, c in found.items() if i == c} and (out.n_tokens == out.ids.map(len)).all()
    assert out.groupby("doc_id").size().max() <= 3
