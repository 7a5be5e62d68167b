"""Conversation repair against enumeration of all edits, and the whole query against plain code."""

import hashlib
import re
import time
import zlib
from collections import Counter

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from storyloom.llm.queries import QUERIES
from storyloom.llm.repair import apply_audit, faults, repair, search

WANTED = re.compile(r"(s?(ua)+)?\Z")
row = st.tuples(st.sampled_from("suax "), st.booleans(), st.booleans()).map(lambda r: (r[0], r[1], r[2] and not r[1]))


def enumerated(rows, inserts=2):
    """The least (cost, audit) of all edit sequences with at most so many insertions."""
    best = (2 * len(rows), "D" * len(rows))

    def go(at, roles, audit, cost, left):
        nonlocal best
        if cost > best[0]:
            return
        if at == len(rows) and WANTED.match(roles):
            best = min(best, (cost, audit))
        if left:
            for role in "ua":
                go(at, roles + role, audit + "I", cost + 5, left - 1)
        if at < len(rows):
            initial, gone, cut = rows[at]
            go(at + 1, roles, audit + "D", cost + 2, left)
            if not gone:
                go(at + 1, roles + initial, audit + "K", cost + 5 * cut, left)
                for role in "ua":
                    go(at + 1, roles + role, audit + "R", cost + 1 + 5 * cut, left)

    go(0, "", "", 0, inserts)
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(row, max_size=4))
def test_search_equals_enumeration(rows):
    assert search(tuple(rows)) == enumerated(rows)


def test_long_conversations_are_searched_in_linear_time():
    rows = tuple([("u", False, False), ("u", False, True), ("a", False, False), ("s", False, False), ("a", True, False)] * 4000)
    at = time.time()
    cost, audit = search(rows)
    assert time.time() - at < 10 and len(audit) - audit.count("I") == len(rows)
    assert cost == 2 * audit.count("D") + audit.count("R") + 5 * audit.count("I") + 5 * sum(c != "D" and r[2] for c, r in zip(audit.replace("I", ""), rows))


def test_faults_and_repaired_turns():
    turns = [("system", "Be kind."), ("user", "Hi!"), ("user", "Hi!"), ("user", " \n"), ("assistant", "Yes, but"), ("assistant", "Done. \t")]
    assert faults(turns) == ["", "", "duplicate", "blank", "truncated", ""]
    assert apply_audit(turns, "KKDDDK") == [turns[0], turns[1], turns[5]]
    assert apply_audit([("user", "a."), ("user", "b.")], "KR") == [("user", "a."), ("assistant", "b.")]
    assert apply_audit([("assistant", "a.")], "IK") == [("user", ""), ("assistant", "a.")]


def plain(chats):
    """The whole contract over a pandas frame, row by row; the search is tested above."""
    out = {}
    for conv, said in chats.groupby("conv_id", dropna=False):
        rows = []
        for turn, role, text in said[["turn", "role", "text"]].itertuples(index=False):
            role, text = (" " if pd.isna(x) else x for x in (role, text))
            kind = zlib.crc32(f"{' ' if pd.isna(conv) else int(conv)}:{' ' if pd.isna(turn) else int(turn)}".encode()) % 20
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            rows += [(None if pd.isna(turn) else int(turn), "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[1:] for r in rows]
        found = faults(turns)
        numbers = {r[0] for r in rows} - {None}
        roles = "".join(r[:1] for r, _ in turns)
        cost, audit = search(tuple((r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(turns, found)))
        fixed = "\n".join(f"{r}:{t}" for r, t in apply_audit(turns, audit))
        out[None if pd.isna(conv) else int(conv)] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1)), cost, audit, hashlib.sha256(fixed.encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query_equals_plain_code(spark, size):
    folder = f"/root/testdata/sf{size}"
    want = plain(pd.read_parquet(f"{folder}/conversations.parquet"))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_branch_and_bound_repair"](spark, folder).collect()}
    assert got == want and sum(x[5] > 0 for x in want.values()) > 10


def test_edges(spark, tmp_path):
    rows = [
        (1, None, "user", "No turn."), (1, 0, None, None), (1, 5, "assistant", "x" * 200_000), (2, 1, "user", ""), (2, 1, "user", ""),
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (3, 7, "assistant", "A."), (3, 7, "assistant", "A."), (4, None, "user", "Q?"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    chats = spark.createDataFrame(rows, schema)
    chats.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_branch_and_bound_repair"](spark, str(tmp_path)).collect()}
    assert got == plain(pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    none = repair(spark.createDataFrame([], schema))
    assert none.count() == 0 and "repaired" in none.columns
    clash = chats.selectExpr("*", "'x' as there", "1 as gaps", "'y' as audit", "'z' as `a.b`", "false as present")
    assert Counter(map(str, repair(clash).collect())) == Counter(map(str, repair(chats).collect()))
    empty = repair(chats.filter("conv_id = 4"), None).first()
    assert (empty.gaps, empty.cost, empty.audit) == (0, 2, "D")
    gone = repair(chats.filter("conv_id = 4").selectExpr("*", "false as present"), "present").first()
    assert (gone.cost, gone.audit, gone.repaired) == (0, "", [])
