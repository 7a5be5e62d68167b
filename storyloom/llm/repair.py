"""Conversation structure repair: the cheapest edits that give well-formed turns, by branch and bound."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import per_worker, pieces

# Costs of the edits; an edit's initial is its letter in an audit.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
MISSING = " "  # stands for a null role or text

# What has been kept so far ends with: nothing, a system turn, a user turn, an assistant turn.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_NONE, _ASSISTANT)  # where a conversation may stop: (s?(ua)+)?
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # state after the turn that a rerole or an insertion makes there
_KEPT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_NEVER = 1 << 60
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_DROPPED = re.compile(r"[\x20\x09-\x0D]+\Z")

Row = tuple[str, bool, bool]  # role initial, must go, truncated


def faults(turns: list[tuple[str, str]]) -> list[str]:
    """Of each (role, text) its first fault: blank, duplicate, truncated, or the empty string."""
    seen: set[tuple[str, str]] = set()
    out = []
    for turn in turns:
        text = turn[1]
        if not _SOLID.search(text):
            out.append("blank")
        elif turn in seen:
            out.append("duplicate")
        else:
            out.append("" if _DROPPED.sub("", text)[-1] in ".!?" else "truncated")
        seen.add(turn)
    return out


def suffix_bounds(rows: tuple[Row, ...]) -> list[list[int]]:
    """Per row and state, what the rows from there on cost at least, whatever the audit's letters.

    Found backwards. An insertion only leads to states that are worth it: two in a row at most
    are of use, so two rounds settle a row's states.
    """
    ahead = [0 if state in _ENDS else _NEVER for state in range(4)]
    bounds = [_inserted(ahead)]
    for initial, gone, cut in reversed(rows):
        ahead, more = bounds[-1], TRUNCATED if cut else 0
        here = [ahead[state] + DELETE for state in range(4)]
        for state in range(4) if not gone else ():
            here[state] = min(here[state], ahead[_NEXT[state]] + REROLE + more)
            if initial in _KEPT[state]:
                here[state] = min(here[state], ahead[_KEPT[state][initial]] + more)
        bounds.append(_inserted(here))
    return bounds[::-1]


def _inserted(costs: list[int]) -> list[int]:
    for _ in range(2):
        costs = [min(costs[state], costs[_NEXT[state]] + INSERT) for state in range(4)]
    return costs


def search(rows: tuple[Row, ...]) -> tuple[int, str]:
    """Least cost and, of all ways at that cost, the audit that comes first in ASCII order.

    Depth first with an explicit stack; children are taken in the order of their letters
    (D, I, K, R), so prefixes reach a node (row, state) in ASCII order. A prefix goes if its
    cost and the bound of what is left exceed the incumbent's cost, or equal it with an audit that
    cannot come earlier, or if the node was reached before at no higher cost: any ending serves both prefixes alike, and
    no audit is the beginning of another of the same cost, as it would hold fewer insertions.
    """
    bounds = suffix_bounds(rows)
    best: tuple[int, str] | None = None
    limit = bounds[0][_NONE]  # the whole conversation's bound: a prefix above it is left before there is an incumbent
    reached = [[_NEVER] * 4 for _ in range(len(rows) + 1)]
    stack: list[tuple[int, int, int, tuple | None]] = [(0, _NONE, 0, None)]
    while stack:
        at, state, cost, audit = stack.pop()
        total = cost + bounds[at][state]
        if cost >= reached[at][state] or total > limit or (best and total >= best[0]):
            continue  # what is popped later never has an earlier audit, so equal totals go too
        reached[at][state] = cost
        if at == len(rows) and state in _ENDS:
            best = (cost, _letters(audit))
            continue
        children = []
        if at < len(rows):
            initial, gone, cut = rows[at]
            more = TRUNCATED if cut else 0
            children.append((at + 1, state, cost + DELETE, (audit, "D")))
            children.append((at, _NEXT[state], cost + INSERT, (audit, "I")))
            if not gone:
                if initial in _KEPT[state]:
                    children.append((at + 1, _KEPT[state][initial], cost + more, (audit, "K")))
                children.append((at + 1, _NEXT[state], cost + REROLE + more, (audit, "R")))
        else:
            children.append((at, _NEXT[state], cost + INSERT, (audit, "I")))
        stack.extend(reversed(children))
    return best


def _letters(audit: tuple | None) -> str:
    out = []
    while audit:
        audit, letter = audit
        out.append(letter)
    return "".join(reversed(out))


def apply_audit(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired turns; made roles follow from their place."""
    out, at, state = [], 0, _NONE
    for letter in audit:
        made = USER if _NEXT[state] == _USER else ASSISTANT
        if letter == "I":
            out.append((made, ""))
        else:
            role, text = turns[at]
            at += 1
            if letter == "D":
                continue
            if letter == "K" and role[:1] == "s":
                out.append((role, text))
                state = _SYSTEM
                continue
            out.append((role if letter == "K" else made, text))
        state = _NEXT[state]
    return out


def _searcher():
    return lru_cache(maxsize=20_000)(search)


_COUNTS = ("blank", "duplicate", "truncated")


def repair(conversations: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, least cost, audit, repaired turns.

    Rows are turns (conv_id, turn, role, text). They are taken by turn, nulls first, then role, then text;
    null roles and texts are one blank, rows without conv_id form a conversation of their own,
    repeated rows are turns of their own (and duplicates). ``present`` names a boolean column: rows where it is not true only
    name their conversation. A conversation without rows has zeros, an empty audit and no
    repaired turns. Roles count by their first character; a system turn is kept at most as the
    first. ``repaired`` is an array of (role, text); added turns have an empty text.

    Turns are hashed by conversation and stream through the task in order, so a task holds one
    conversation at a time: its output row. Conversations with the same faults and roles are
    searched once per worker.
    """
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role"), text("text"), there.alias("there"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.withColumn("text", F.when(F.col("there"), F.col("text"))).repartition("conv_id")
    rows = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    turns = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    names = ["conv_id", "gaps", *_COUNTS, "illegal", "cost", "audit", "repaired"]
    kinds = [*[pa.int64()] * 6, pa.string(), turns]

    def one(said: list[tuple], find) -> tuple:
        live = [(role, text) for _, role, text, there in said if there]
        numbers = {turn for turn, _, _, there in said if there and turn is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        found = faults(live)
        pairs = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(live, live[1:]))
        cost, audit = find(tuple((role[:1], fault in ("blank", "duplicate"), fault == "truncated") for (role, _), fault in zip(live, found)))
        fixed = [{"role": role, "text": text} for role, text in apply_audit(live, audit)]
        return (gaps, *(found.count(c) for c in _COUNTS), pairs, cost, audit, fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = per_worker(_searcher)
        ids, out, said, here, chars = [], [], [], None, 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            made = pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], names=names)
            ids.clear(), out.clear()
            return made

        for batch in pieces(batches, 1000):
            id_type = batch.schema.field(0).type
            for conv, *turn in zip(*(c.to_pylist() for c in batch.columns)):
                if said and conv != here:
                    ids.append(here), out.append(one(said, find))
                    said = []
                    if len(out) >= 500 or chars > 8_000_000:
                        yield flush()
                        chars = 0
                here = conv
                said.append(tuple(turn))
                chars += len(turn[2] or "")
        if said:
            ids.append(here), out.append(one(said, find))
            yield flush()

    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role: string, text: string>>"
    return rows.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by a checksum of conversation and turn; nulls are one blank.

    Of 20 rows one is dropped (``present`` is false), one loses its text, one its sentence ends,
    one comes twice, one gets the role of a user.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
    kind = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, USER).otherwise(F.col("role"))
    once = F.array(F.struct("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present")))
    return rows.select(F.inline(F.when(F.col("kind") == 3, F.concat(once, once)).otherwise(once)))
