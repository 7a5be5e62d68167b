"""The mix of the pipeline against the operator, row by row; texts stay out of its shuffles and its tables."""

from collections import Counter

import corpus_pipeline
from storyloom.llm import mixing

ROWS = [(i, f"text {i} " + "w " * (i % 7), f"s{i % 4}" if i % 9 else None) for i in range(60)]
ROWS += [(3, ROWS[3][1], ROWS[3][2])] * 4 + [(3, "another text", ROWS[3][2]), (None, "no id", "s1"), (61, None, "s2"), (62, "", None)]


def test_rows_as_often_as_the_mix_takes_them(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    staged = []
    keep = corpus_pipeline.stage
    for module in (corpus_pipeline, mixing):
        monkeypatch.setattr(module, "stage", lambda df: staged.append(df.columns) or keep(df))
    got = Counter(map(tuple, corpus_pipeline.source_mix(spark, docs, "").collect()))
    assert staged and not [c for c in staged if any("text" in n or n.endswith("_row") for n in c)]
    expected = Counter()
    for r in mixing.fair_mix(docs, keep=("source", "text")).collect():
        expected[(r.doc_id, r.text, r.source)] += r.taken // r.size if r.size else 0
    assert got == +expected and sum(got.values())
