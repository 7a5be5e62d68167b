"""Chat formatting with loss masks aligned to tokens by character offsets."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.llm.common import per_worker, pieces

VOCABULARY = "byte_bpe_50k.json"
TRAINED = "assistant"  # the role whose texts are under the loss mask
TURN, TURN_END = "<|turn|>", "<|end|>"  # single tokens of their own

# Strings that steer some chat template; inside a role or text a backslash goes after their first character.
_TAIL = r"(?=(?:/?s>|/?SYS>>|/?INST\]|\|[A-Za-z_]+\|>))"
_PLAIN = re.compile(r"([<\[])(\\*)" + _TAIL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _TAIL)
_READ = re.compile(re.escape(TURN) + r"(.*?)\n(.*?)" + re.escape(TURN_END), re.DOTALL)


def escape(text: str) -> str:
    """Text in which no control string is left; one more backslash where some stood already."""
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation as one string, and the spans of the trained texts in it, in order.

    A line break in a role is written as ``\\n`` beside escaped backslashes, so that the first
    break always ends the role.
    """
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{TURN}{_role_out(role)}\n"
        body = escape(text)
        if role == TRAINED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, TURN_END]
        at += len(head) + len(body) + len(TURN_END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(_role_in(role), unescape(text)) for role, text in _READ.findall(formatted)]


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def token_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a trained span; both lists are sorted, so two binary searches do."""
    mask = np.zeros(len(offsets) + 1, np.int64)
    if spans and len(offsets):
        bounds = np.array([s for s in spans if s[1] > s[0]], np.int64).reshape(-1, 2)
        first = np.searchsorted(offsets[:, 1], bounds[:, 0], side="right")
        after = np.searchsorted(offsets[:, 0], bounds[:, 1], side="left")
        np.add.at(mask, first, 1)
        np.add.at(mask, after, -1)
    return np.cumsum(mask)[:-1] > 0


def masked_spans(offsets: np.ndarray, mask: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The characters of each span that its masked tokens cover."""
    out = []
    covered = offsets[mask]
    for a, b in spans:
        inside = covered[np.searchsorted(covered[:, 1], a, side="right") : np.searchsorted(covered[:, 0], b, side="left")]
        if b > a and len(inside):
            out.append((max(a, int(inside[0, 0])), min(b, int(inside[-1, 1]))))
        else:
            out.append((a, a))
    return out


def tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    found.add_special_tokens([TURN, TURN_END])
    return found


_OUT = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("n_turns", T.LongType()),
    T.StructField("formatted", T.StringType()),
    T.StructField("token_ids", T.ArrayType(T.IntegerType())),
    T.StructField("loss_mask", T.ArrayType(T.BooleanType())),
    T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
])


def format_chats(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """One training example per conversation: string, token ids, loss mask per token, trained spans.

    Input rows are turns (conv_id, turn, role, text). Turns are ordered by turn, then role,
    then text, nulls first; null roles and texts count as empty; repeated rows are turns of
    their own; rows without conv_id form one conversation of their own. ``loss_spans`` are the
    character spans of each trained text that its tokens cover: the text, whole. A
    conversation is one output row, so its turns meet in one task; long ones are spread by
    their ids like all others.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    gathered = gathered.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    names = [f.name for f in _OUT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(tokenizer, path).encode_batch
        for batch in pieces(batches, 64):
            chats = [list(zip(r, t)) for r, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            rendered = [render(c) for c in chats]
            rows = []
            for chat, (text, spans), got in zip(chats, rendered, encode([r[0] for r in rendered], add_special_tokens=False)):
                offsets = np.array(got.offsets, np.int64).reshape(-1, 2)
                mask = token_mask(offsets, spans)
                rows.append((len(chat), text, got.ids, mask.tolist(), [list(s) for s in masked_spans(offsets, mask, spans)]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.list_(pa.int32()))))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return gathered.mapInArrow(run, _OUT)


_DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("loss_tokens", T.LongType()),
])


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: counts and hashes of turns and of trained texts."""
    names = [f.name for f in _DIGEST]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            rows = []
            for row in batch.to_pylist():
                turns = read_back(row["formatted"])
                loss = "".join(unescape(row["formatted"][a:b]) for a, b in row["loss_spans"])
                said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                rows.append((row["conv_id"], len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                             len(row["formatted"]), len(row["token_ids"]), sum(row["loss_mask"])))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return formatted.select("conv_id", "formatted", "token_ids", "loss_mask", "loss_spans").mapInArrow(run, _DIGEST)
