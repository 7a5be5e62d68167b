"""Ranked search against a plain version: ties, copies, nulls, several passes, clashing names."""

import math
import random
import re
from collections import Counter

from storyloom.llm.bag_rank import rank

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(items, docs, top=10):
    bags = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(map(bool, bags)), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, _), bag in zip(docs, bags):
            score = 0
            for t in set(terms(text)) & bag.keys():
                m = 10 + 90 * sum(bag.values()) * n_docs // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:top])]
    return sorted(out, key=str)


def test_against_plain_version(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(40)] + ["Über", "ÄB", "x-y"]
    texts = [" ".join(draw.choices(words, k=draw.randrange(1, 30))) for _ in range(60)]
    docs = [(i, draw.choice(texts)) for i in range(300)]
    docs += [(300 + i, "w1 W1, w2 alike") for i in range(40)] + [(None, "w1 w2 w3"), (400, None), (401, ""), (402, "..."), (7, "w5 w5"), (7, "w5 w5"), (403, "w3 " * 50_000)]
    items = [(i, " ".join(draw.choices(words, k=6))) for i in range(12)] + [(20, "w1 w2"), (20, "w1 w2"), (21, None), (22, "unknown"), (None, "alike")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = plain(items, docs)
    shown = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert shown(rank(i, d)) == want
    clash = d.selectExpr("*", "1 as m", "2 as bag", "3 as class", "4 as `a.b`")
    assert shown(rank(i.selectExpr("*", "5 as item", "6 as terms"), clash, pass_terms=30)) == want
    assert rank(i, d.limit(0)).count() == 0 and rank(i.limit(0), d).count() == 0
