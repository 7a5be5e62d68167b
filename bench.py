"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from storyloom.plans.queries import QUERIES
from storyloom.session import local_session

HEADLINES = (
    "article_term_counts",
    "article_keywords",
    "bm25_scores",
    "preprocessed_articles",
    "theme_weighted_article_vectors",
    "decayed_themes_tfidf",
    "assign_theme_time",
    "assign_time_only",
    "spherical_kmeans_labels",
    "sliding_window_run",
    "cluster_metadata_rows",
    "quality_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["slide_numbers"](spark, sf_dir).count()  # starts the engine
    times = {}
    for name in HEADLINES:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 2)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 2), "unit": "sec",
                      "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus}), flush=True)


if __name__ == "__main__":
    main()
