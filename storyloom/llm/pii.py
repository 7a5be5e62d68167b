"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from itertools import groupby
from math import exp, inf, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import pieces

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 3000  # documents that the fit looks at, about: its bound
SAMPLE_RUNS = 4000  # runs of numbers among them that it learns from, at most
MAX_GROUPS = 8  # digit groups of one entity at most
SURE = 0.95  # probability a span needs to be added
EPOCHS, RATE, DECAY = 6, 0.2, 1e-3

# Fixed patterns of the base rules. Searching starts only where a match can start, so none is slow on long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            yield start, free
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the fixed patterns as (start, kind, end), sorted; leftmost and non-overlapping within each kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# A run of numbers: digit groups with up to three joining marks between them.
_RUN = re.compile(r"\+?\(?[0-9]+(?:[\x20().\-/,]{1,3}[0-9]+)*")
_MASKED_EMAIL = re.compile(r"([A-Za-z0-9._%+-]{1,64})(\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)([A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)[A-Za-z0-9-]{1,63})+)(?![A-Za-z0-9])")


class Run:
    """Digit groups of one run with their places in the text and the characters around."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.groups = [(m.start(), m.end()) for m in _DIGITS.finditer(text, start, end)]

    def span(self, a: int, b: int) -> tuple[int, int]:
        """Places of groups a to b, with a plus sign or bracket right before."""
        start = self.groups[a][0]
        floor = self.groups[a - 1][1] if a else self.start
        while start > floor and self.text[start - 1] in "+(":
            start -= 1
        return start, self.groups[b][1]

    def numbers(self) -> bool:
        return sum(b - a for a, b in self.groups) >= 7 or len(self.groups) >= 4

    def without(self, spans: list[tuple[int, int, int]]) -> Iterator[Run]:
        """The run cut at ``spans``: a run for each row of groups between them, with marks right before it."""
        free = [not any(a < y and x < b for a, _, b in spans) for x, y in self.groups]
        for kept, part in groupby(range(len(free)), free.__getitem__):
            part = list(part)
            floor = max((b for _, _, b in spans if b <= self.groups[part[0]][0]), default=self.start)
            run = Run(self.text, max(floor, self.span(part[0], part[0])[0]), self.groups[part[-1]][1])
            if kept and run.numbers():
                yield run

    def candidates(self) -> Iterator[tuple[int, int]]:
        """Segments of at most MAX_GROUPS groups with 7 to 19 digits, or four groups."""
        for a in range(len(self.groups)):
            digits = 0
            for b in range(a, min(len(self.groups), a + MAX_GROUPS)):
                digits += self.groups[b][1] - self.groups[b][0]
                if digits > 19:
                    break
                if digits >= 7 or b == a + 3:
                    yield a, b

    def features(self, a: int, b: int, kind: int) -> list[str]:
        """Properties of the whole segment, for one kind."""
        start, end = self.span(a, b)
        text, groups = self.text[start:end], self.groups[a : b + 1]
        digits = "".join(c for c in text if "0" <= c <= "9")
        joins = "".join(sorted({c for c in text if not "0" <= c <= "9"}))
        before, after = self.text[max(0, start - 1) : start], self.text[end : end + 1]
        side = lambda c: "digit" if c.isdigit() else "letter" if c.isalpha() else "gap" if not c.strip() else c
        found = [
            "kind", f"digits {len(digits)}", f"groups {len(groups)}", f"joins {joins}", f"shape {'-'.join(str(y - x) for x, y in groups)}",
            f"plus {text[:1] == '+'}", f"luhn {len(digits) >= 13 and luhn(digits)}", f"small {all(_small(self.text[x:y]) for x, y in groups)} {len(groups)}",
            f"before {side(before)}", f"after {side(after)}", f"more {a > 0} {b < len(self.groups) - 1}",
        ]
        return [f"{kind} {f}" for f in found]


class SpanField:
    """Semi-Markov field over the groups of a run: outside one group at a time, or a segment with a kind."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def _segments(self, run: Run) -> list[tuple[int, int, int, float, list[str]]]:
        out = []
        for a, b in run.candidates():
            for kind in (1, 2, 3):
                f = run.features(a, b, kind)
                out.append((a, b + 1, kind, sum(self.weights.get(x, 0.0) for x in f), f))
        return out

    def marginals(self, run: Run) -> tuple[list[tuple[int, int, int, float, list[str]]], list[float]]:
        """Segments and their probabilities, by sums over all segmentations from both ends."""
        n, segments = len(run.groups), self._segments(run)
        by_start: dict[int, list] = {}
        for s in segments:
            by_start.setdefault(s[0], []).append(s)
        alpha, beta = [-inf] * (n + 1), [-inf] * (n + 1)
        alpha[0] = beta[n] = 0.0
        for i in range(n):
            alpha[i + 1] = _add(alpha[i + 1], alpha[i])
            for s in by_start.get(i, ()):
                alpha[s[1]] = _add(alpha[s[1]], alpha[i] + s[3])
        for i in range(n - 1, -1, -1):
            beta[i] = beta[i + 1]
            for s in by_start.get(i, ()):
                beta[i] = _add(beta[i], beta[s[1]] + s[3])
        return segments, [exp(alpha[s[0]] + s[3] + beta[s[1]] - alpha[n]) for s in segments]

    def decode(self, run: Run) -> list[tuple[int, int, int]]:
        """Best segmentation's segments (start, kind, end) whose probability is at least SURE."""
        n = len(run.groups)
        segments, shares = self.marginals(run)
        best, back = [0.0] + [-inf] * n, [None] * (n + 1)
        by_end: dict[int, list] = {}
        for s, p in zip(segments, shares):
            by_end.setdefault(s[1], []).append((s, p))
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for s, p in by_end.get(j, ()):
                if best[s[0]] + s[3] > best[j]:
                    best[j], back[j] = best[s[0]] + s[3], (s, p)
        out, j = [], n
        while j:
            if back[j] is None:
                j -= 1
                continue
            s, p = back[j]
            if p >= SURE:
                start, end = run.span(s[0], s[1] - 1)
                out.append((start, s[2], end))
            j = s[0]
        return out[::-1]

    def train(self, examples: list[tuple[Run, set[tuple[int, int, int]]]]) -> None:
        """Gradient steps on the log likelihood; examples are runs with their true segments (first, after last, kind)."""
        for epoch in range(EPOCHS):
            rate = RATE / (1 + epoch)
            for run, truth in examples:
                segments, shares = self.marginals(run)
                for s, p in zip(segments, shares):
                    g = ((s[0], s[1], s[2]) in truth) - p
                    if abs(g) > 1e-4:
                        for f in s[4]:
                            w = self.weights.get(f, 0.0)
                            self.weights[f] = w + rate * (g - DECAY * w)


def _add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -inf else x + log1p(exp(y - x))


def runs_of(text: str) -> Iterator[Run]:
    for m in _RUN.finditer(text):
        run = Run(text, m.start(), m.end())
        if run.numbers():
            yield run


def all_spans(text: str, field: SpanField) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base spans with the field's additions; an addition never touches a span that is there.

    A run that holds base spans is cut at them, and the field looks at the rest.
    """
    base = base_spans(text)
    found: list[tuple[int, int, int]] = []
    if field.weights:
        for run in runs_of(text):
            inside = [s for s in base if s[0] < run.end and run.start < s[2]]
            for part in run.without(inside) if inside else (run,):
                found += field.decode(part)
    if " at " in text or "at]" in text or "at)" in text:
        for m in _MASKED_EMAIL.finditer(text):
            if "dot" in m[3] or m[2].strip() != "at":
                found.append((m.start(), 0, m.end()))
    taken = sorted(base)
    for s in found:
        if not any(a < s[2] and s[0] < b for a, _, b in taken):
            taken.append(s)
    return base, sorted(taken)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_runs: int = SAMPLE_RUNS) -> SpanField:
    """A field learned from runs of numbers in about ``sample_docs`` documents, chosen by a hash of their texts.

    The base spans are the true segments; each is also shown as people write it otherwise
    (phones without a plus sign or with other joins, cards and addresses with other joins), and as
    something else (a failed check digit, a part above 255), so that the field learns the shapes
    beyond the patterns and leaves other numbers alone.
    """
    n = docs.count()
    share = min(1.0, sample_docs / n) if n else 1.0
    sample = docs.select("text").filter(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                text = text or ""
                base = base_spans(text)
                for r in runs_of(text):
                    lo, hi = max(0, r.start - 2), min(len(text), r.end + 2)
                    inside = [[a - lo, k, b - lo] for a, k, b in base if k and r.start <= a and b <= r.end]
                    if r.end - r.start <= 80:
                        rows.append((text[lo:hi], r.start - lo, r.end - lo, inside))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int32()))))], names=["t", "a", "b", "spans"]
            )

    found = sample.mapInArrow(run, "t string, a int, b int, spans array<array<int>>").distinct().orderBy(F.xxhash64("t"), "t", "a").limit(sample_runs).collect()
    rng = random.Random(5)
    examples = []
    for row in found:
        examples += _shown(row["t"], row["a"], row["b"], [tuple(s) for s in row["spans"]], rng)
    field = SpanField({})
    rng.shuffle(examples)
    field.train(examples)
    field.weights = {f: round(w, 6) for f, w in field.weights.items()}
    return field


def _example(text: str, a: int, b: int, spans: list[tuple[int, int, int]]) -> list:
    run = Run(text, a, b)
    starts = {g[0]: i for i, g in enumerate(run.groups)}
    ends = {g[1]: i + 1 for i, g in enumerate(run.groups)}
    truth = set()
    for s, kind, e in spans:
        first = next((starts[x] for x in range(s, e) if x in starts), None)
        if first is not None and e in ends:
            truth.add((first, ends[e], kind))
    return [(run, truth)]


def _shown(text: str, a: int, b: int, spans: list[tuple[int, int, int]], rng: random.Random) -> list:
    out = _example(text, a, b, spans)
    for s, kind, e in spans:
        if (s, e) != (a, b) or len(spans) != 1:
            continue
        body, pre, post = text[s:e], text[:a], text[b:]
        digits = re.sub(r"[^0-9]", "", body)
        if kind == 3:
            more = [body[1:], re.sub(r"[^0-9+]+", rng.choice("-. "), body).lstrip("+")]
            if len(digits) > 10:
                local = digits[-10:]
                more += [f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}"]
            other = [digits[-9:], f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", str(rng.randint(10**6, 10**11))]
        elif kind == 2:
            more = [rng.choice(" .-").join(digits[i : i + 4] for i in range(0, len(digits), 4))]
            other = [x for x in (digits[:-1] + str((int(digits[-1]) + d) % 10) for d in (1, 5)) if not luhn(x)]
        else:
            more = []
            other = [body.replace(body.split(".")[0], str(rng.randint(256, 999)), 1)]
        for shown, is_it in [*((m, True) for m in more), *((o, False) for o in other)]:
            m = _RUN.match(shown)
            if m and m.end() == len(shown):
                out += _example(pre + shown + post, len(pre), len(pre) + len(shown), [(len(pre), kind, len(pre) + len(shown))] if is_it else [])
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, field: SpanField) -> DataFrame:
    """Counts and spans of personal data of every whole text; one row out per row in, no shuffle.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added).
    Null and empty texts have none. Offsets are code points, ends exclusive.
    """
    narrow = docs.select("doc_id", "text")
    weights = dict(field.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = SpanField(weights)
        for batch in pieces(batches, 1000):
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = all_spans(text or "", f)
                rows.append((*(sum(k == x for _, k, _ in base) for x in range(4)), hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.string(), pa.string())))], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = narrow.schema[0].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str | None, field: SpanField) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans by the first one."""
    if not text:
        return text
    out, at = [], 0
    for a, k, b in all_spans(text, field)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, field: SpanField, column: str = "text") -> DataFrame:
    """Documents with the same columns, personal data of ``column`` replaced by its kind."""
    place = docs.columns.index(column)
    weights = dict(field.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = SpanField(weights)
        for batch in pieces(batches, 1000):
            done = pa.array([masked(t, f) for t in batch.column(place).to_pylist()], pa.string())
            yield batch.set_column(place, batch.schema.field(place), done)

    return docs.mapInArrow(run, docs.schema)
