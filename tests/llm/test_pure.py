"""Task functions against plain versions, without Spark."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from storyloom.llm import bpe, chat, dedup, langid, pii, toxicity
from storyloom.llm.lattice import SPACE_PIECE, VOCABULARY, Lattice, expected, expected_plain, forward, forward_plain, log_table

PARTS = ["<", "[", "\\", "/", "s>", "INST]", "<<SYS>>", "<|turn|>", "<|end|>", "|", "\n", "a", " ", "é", "🙂", "\r"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=9).map("".join)


@pytest.fixture(scope="module")
def words():
    path = public_tokenizers.path(bpe.VOCABULARY)
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    return bpe.PrefixEncoder(path), library


@pytest.fixture(scope="module")
def tokens():
    return chat.tokenizer(public_tokenizers.path(chat.VOCABULARY))


@pytest.fixture(scope="module")
def lattice():
    return Lattice(public_tokenizers.path(VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]) | TEXTS, TEXTS), max_size=4))
def test_chats_are_read_back_and_masked_whole(tokens, turns):
    text, spans = chat.render(turns)
    assert chat.read_back(text) == turns
    got = tokens.encode(text, add_special_tokens=False)
    offsets = np.array(got.offsets, np.int64).reshape(-1, 2)
    mask = chat.token_mask(offsets, spans)
    slow = [any(a < e and s < b for s, e in spans) for a, b in got.offsets]
    assert mask.tolist() == slow
    shown = "".join(chat.unescape(text[a:b]) for a, b in chat.masked_spans(offsets, mask, spans))
    assert shown == "".join(t for r, t in turns if r == "assistant")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30) | st.lists(st.sampled_from(["<|endoftext|>", "'s", "'T", "Σ", "ſ", "İ", "ab", " ", "１", "é", "\x1c", "\x85", "the"]), max_size=8).map("".join))
def test_bpe_equals_the_library(words, text):
    ours, library = words
    ids, shown = ours.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert shown == library.decode(ids, skip_special_tokens=False) == ours.decode(ids)


def test_bpe_of_long_words(words):
    ours, library = words
    rng = random.Random(1)
    for letters in ("a", "ab", "abcde", "the"):
        text = "".join(rng.choices(letters, k=20_000))
        assert ours.encode(text)[0] == library.encode(text, add_special_tokens=False).ids


def all_segmentations(word, lattice):
    """Every way to cut a word, by recursion: lists of pieces."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in lattice.ids:
            for rest in all_segmentations(word[n:], lattice):
                yield (lattice.ids[word[:n]], *rest)


@pytest.mark.parametrize("word", ["the", "ending", "aaaaaa", "zu", "übung"])
def test_lattice_sums_all_segmentations(lattice, word):
    logs = log_table(lattice.prior())
    w = SPACE_PIECE + word
    ways = [sum(logs[p] for p in s) for s in all_segmentations(w, lattice)]
    total = math.log(sum(map(math.exp, ways)))
    arcs = lattice.arcs(w)
    assert forward(len(w), arcs, logs)[-1] == pytest.approx(total, abs=1e-9)
    assert math.log(forward_plain(len(w), arcs, [math.exp(x) for x in logs])) == pytest.approx(total, abs=1e-9)
    uses = np.zeros(lattice.size)
    expected(len(w), arcs, logs, 2.0, uses)
    want = np.zeros(lattice.size)
    for s in all_segmentations(w, lattice):
        for p in s:
            want[p] += 2 * math.exp(sum(logs[q] for q in s) - total)
    assert np.allclose(uses, want)
    plain = [0.0] * lattice.size
    assert expected_plain(len(w), arcs, [math.exp(x) for x in logs], 2.0, plain) and np.allclose(plain, want)


def test_lattice_covers_unknown_characters_and_long_words(lattice):
    logs = log_table(lattice.prior())
    assert abs(lattice.prior().sum() - 1) < 1e-12
    for w in ("\U0001f9ff", "a\x00b", "x" * 50_000):
        assert math.isfinite(forward(len(w), lattice.arcs(w), logs)[-1])


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"ab.@-+ 0123456789(", "1.2.3.4", "a@b.c", "+1 555", "4111111111111111"]), max_size=20).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_spans_of_long_runs_are_quick():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1.2." * 50_000, "+" * 100_000, "@" * 100_000):
        pii.base_spans(text)


def test_field_learns_shapes_and_keeps_probabilities():
    texts = [f"call +1 ({a}) 555-{b:04} now" for a, b in zip(range(200, 260), range(1000, 9000, 130))]
    examples = []
    for t in texts:
        (a, kind, b), = pii.base_spans(t)
        examples += pii._shown(t, a, b, [(a, kind, b)], random.Random(a + len(examples)))
    field = pii.SpanField({})
    field.train(examples)
    run = next(pii.runs_of("or (415) 555-0199 ok"))
    segments, shares = field.marginals(run)
    assert all(-1e-9 <= p <= 1 + 1e-9 for p in shares)
    assert field.decode(run) == [(3, 3, 17)]
    assert pii.all_spans("on 2024-01-15 it was 12345678", field)[1] == []
    base, every = pii.all_spans("a@b.org and +1 (212) 555-0100", field)
    assert base == every and len(base) == 2


def test_field_looks_beside_base_spans():
    examples = []
    for i in range(120):
        t = f"+1 {200 + i} 555 {1000 + i}" if i % 2 else f"10.{i}.0.{i + 1}"
        (a, kind, b), = pii.base_spans(t)
        examples += pii._shown(t, a, b, [(a, kind, b)], random.Random(i))
    field = pii.SpanField({})
    field.train(examples)
    assert pii.written(pii.all_spans("212-555-0199", field)[1]) == "phone:0:12"
    for text, spans in (
        ("+1 212 555 0100, 212-555-0199", "phone:0:15,phone:17:29"),
        ("10.0.0.7, (212) 555-0100", "ip:0:8,phone:10:24"),
        ("212-555-0199, 10.0.0.7, (212) 555-0100", "phone:0:12,ip:14:22,phone:24:38"),
        ("10.0.0.7, 300", "ip:0:8"),
        ("10.0.0.7 2024-01-15", "ip:0:8"),
    ):
        assert pii.written(pii.all_spans(text, field)[1]) == spans, text
    assert pii.masked("call 10.0.0.7, (212) 555-0100.", field) == "call [IP], [PHONE]."


def test_field_decoding_is_the_best_segmentation():
    rng = random.Random(4)
    run = next(pii.runs_of("x 12.34.56.78 90-1234-5678 y"))
    for _ in range(4):
        field = pii.SpanField({})
        segs = [(a, b + 1, k) for a, b in run.candidates() for k in (1, 2, 3)]
        field.weights = {f"{k} {f}": rng.uniform(-2, 2) for k in (1, 2, 3) for f in ("kind", "groups 4", "groups 3", "groups 7")}
        scores = {s[:3]: s[3] for s in field._segments(run)}

        def total(at, n=len(run.groups)):
            if at == n:
                return 0.0
            return max([total(at + 1), *(scores[s] + total(s[1]) for s in segs if s[0] == at)])

        def weight(at, n=len(run.groups)):
            if at == n:
                return 1.0
            return weight(at + 1) + sum(math.exp(scores[s]) * weight(s[1]) for s in segs if s[0] == at)

        segments, shares = field.marginals(run)
        whole = weight(0)
        for s, p in zip(segments, shares):
            if s[0] == 0:
                assert p == pytest.approx(math.exp(s[3]) * weight(s[1]) / whole)


def test_shingles_and_sketches():
    a, b, short, none = dedup.shingle_sets(["A b c d e f", "a B c d e f", "x y", None])
    assert (a == b).all() and len(a) == 2 and len(short) == 1 and len(none) == 0
    rng = np.random.default_rng(1)
    for share in (0.2, 0.4, 0.75, 0.9):
        n = 4000
        k = int(2 * n * share / (1 + share))
        common, one, two = (rng.integers(0, 2**64, m, dtype=np.uint64) for m in (k, n - k, n - k))
        one, two = (np.unique(np.concatenate([common, x])) for x in (one, two))
        got = dedup.may_link(dedup.sketch(one)[None], dedup.sketch(two)[None], np.array([n]), np.array([n]))
        assert got[0] == (share > 0.6)
    assert (dedup.sketch(none) == dedup.EMPTY).all()


def test_machine_learns_a_pair():
    rng = random.Random(2)
    filler = [f"w{i}" for i in range(40)]
    texts, labels = [], []
    for i in range(1500):
        t = rng.sample(filler, 6) + (["insult"] if i % 2 else []) + (["group"] if i % 3 == 0 else [])
        texts.append(" ".join(t))
        labels.append(int(i % 2 == 1 and i % 3 == 0))
    flat, ends = toxicity.hashed([toxicity.terms(t) for t in texts])
    machine = toxicity.fit([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], np.array(labels))
    got = machine.scores(*toxicity.hashed([toxicity.terms(t) for t in ("insult group", "insult w1", "group w1", "", None)]))
    assert got[0] > 0.5 > max(got[1:]) and len(got) == 5


def _machine_scores(texts, labels, asked):
    flat, ends = toxicity.hashed([toxicity.terms(t) for t in texts])
    machine = toxicity.fit([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], np.array(labels))
    return machine.scores(*toxicity.hashed([toxicity.terms(t) for t in asked]))


def test_machine_learns_a_pair_of_neutral_terms():
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(40)]
    texts, labels = [], []
    for i in range(4000):
        one, two = i % 10 == 0, i // 10 % 10 == 0
        toxic = one and two if one or two else i // 100 % 10 == 0  # a tenth of either term's texts, and of the others
        texts.append(" ".join(rng.sample(filler, 6) + ["insult"] * one + ["group"] * two))
        labels.append(int(toxic))
    rate = lambda kept: np.mean([y for t, y in zip(texts, labels) if kept(t)])
    assert rate(lambda t: "insult" in t) == rate(lambda t: "group" in t) == rate(lambda t: not {"insult", "group"} & set(t.split())) == 0.1
    got = _machine_scores(texts, labels, ["insult group w1", "insult w1", "group w1", "w1 w2"])
    assert got[0] > 0.5 > max(got[1:])


def test_machine_learns_a_rare_term():
    rng = random.Random(5)
    filler = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.sample(filler, 6) + ["slur"] * (i % 10 == 0 and i % 500 != 0) + ["rare"] * (i % 500 == 0)) for i in range(4000)]
    got = _machine_scores(texts, [int(i % 10 == 0) for i in range(4000)], ["rare w1", "slur w1", "w1 w2"])
    assert min(got[:2]) > 0.5 > got[2]


def test_machine_without_examples():
    machine = toxicity.fit([], np.zeros(0))
    assert machine.scores(*toxicity.hashed([["a"], []])).tolist() == [0.5, 0.5]


def test_words_of_letters():
    assert langid.letter_words("Der Hund, 12 km² und_so") == ["der", "hund", "km", "und", "so"]
    assert langid.letter_words(None) == langid.letter_words("123 !") == []
