"""Fingerprints of edits against plain code, and near texts against all distances."""

import hashlib
import random

import pandas as pd

from storyloom.llm.edit_print import CHUNK, STEPS, Walks, compare_edits, fingerprint, likeness, near_edits
from storyloom.llm.queries import QUERIES

WALKS = Walks()
SCHEMA = "doc_id long, text string"


def slow_print(text):
    """The embedding step by step: what is read at each step, then the sampled steps."""
    if not text:
        return b""
    step, read = 0, []
    codes = [ord(c) for c in text]
    for code, first in zip(codes, WALKS.walk(pd.Series(codes).to_numpy("uint32"))[0]):
        assert first == step
        kind = int.from_bytes(_kind(code), "little")
        stay = WALKS.stays[kind][step % STEPS]
        read += [code] * stay
        step += stay
    places = [max(r for r in records if r < len(read)) for records in WALKS.records]
    return places, [read[p] for p in places]


def _kind(code):
    from storyloom.llm.edit_print import KINDS, _mixed

    return int(_mixed(pd.Series([code]).to_numpy("uint64"))[0] % KINDS).to_bytes(1, "little")


def test_sampled_places_read_the_embedding():
    for text in ("a", "ab", "Ein Haus am Fluß 😀 " * 30):
        places, read = slow_print(text)
        end = WALKS.walk(pd.Series([ord(c) for c in text]).to_numpy("uint32"))[1]
        assert list(WALKS.places(end)) == places
        same = fingerprint(text, WALKS)
        assert len(same) == len(read) and same == fingerprint(text, WALKS)


def test_few_edits_stay_alike_and_long_texts_are_whole():
    draw = random.Random(5)
    text = "".join(draw.choice("abcdefgh ") for _ in range(3 * CHUNK))
    one = text[:1000] + "X" + text[1001:]
    assert likeness(fingerprint(text, WALKS), fingerprint(one, WALKS)) > 0.9
    assert 0.3 < likeness(fingerprint(text, WALKS), fingerprint(text[: len(text) // 2] + text[::-1][: len(text) // 2], WALKS)) < 0.8
    assert likeness(fingerprint(text, WALKS), fingerprint(text[::-1], WALKS)) < 0.4
    assert likeness(b"", b"") == 1 and likeness(b"", b"a") == 0


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(rows)]
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        own, other, following = (fingerprint(t, WALKS) for t in (text, edited, after))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), other.hex(), likeness(own, other), likeness(own, following)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_plain_code(spark, tiny):
    docs = pd.read_parquet(f"{tiny}/documents.parquet")
    got = rows_of(QUERIES["op11_edit_prints"](spark, tiny))
    assert got == plain([(int(i), None if t is None else t) for i, t in zip(docs.doc_id, docs.text)])
    assert sum(r[5] > r[6] for r in got) > 0.95 * len(got)


def test_edges(spark):
    rows = [(5, "abc def"), (4, None), (3, ""), (2, "x"), (1, "w" * 150_000), (None, "no id")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(compare_edits(docs)) == plain(rows)
    assert rows_of(compare_edits(docs.selectExpr("*", "1 as run", "2 as h", "true as tail", "0 as `a.b`"))) == plain(rows)
    assert compare_edits(docs.limit(0)).count() == 0
    alone = compare_edits(docs.filter("doc_id = 5")).first()
    assert alone.near_next == 1 and alone.edited_sha256 == hashlib.sha256(b"abc abc").hexdigest()
    twice = rows_of(compare_edits(docs.filter("doc_id in (2, 5)").unionAll(docs.filter("doc_id = 2"))))
    assert [r[0] for r in twice] == [2, 2, 5]


def test_near_texts_against_all_distances(spark):
    draw = random.Random(3)
    base = ["".join(draw.choice("abcdefghij ") for _ in range(600)) for _ in range(12)]
    texts = list(base)
    for text in base:
        at = draw.randrange(500)
        texts += [text[:at] + text[at + 2 :], text[:at] + "XYZ" + text[at:], text]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, None), (98, "")], SCHEMA)
    found = {(r.query_id, r.doc_id): r.edits for r in near_edits(docs, docs.filter("doc_id < 12")).collect()}
    want = {(i, 12 + 3 * i + k): (2, 3)[k] for i in range(12) for k in (0, 1)}
    assert len(found.items() & want.items()) >= 0.9 * len(want) and found.items() <= want.items()
