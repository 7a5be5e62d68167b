"""BPE encoding and decoding by dynamic programming over prefixes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from storyloom.llm.common import per_worker, pieces

VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 250_000  # words, and token pairs, whose results a worker keeps
END = "￿"  # stands for the end-of-word suffix inside the automaton


class PrefixEncoder:
    """Encoder for a word-level BPE vocabulary with an end-of-word suffix.

    For every prefix of a word exactly one token can end its encoding: the one that ends
    there, encodes to itself, and goes with the last token of the prefix before it. An
    automaton lists the tokens ending at each place; the pair test undoes both tokens'
    merges along the boundary, latest first, and fails if the boundary itself would
    have merged before. Back-pointers then give the ids, in time linear in the word.
    """

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.texts = {i: t for t, i in self.ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts |= {i: t for t, i in self.added.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born = dict.fromkeys(self.ids.values(), -1)
        for at, (a, b) in enumerate(model["merges"]):
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[left, right] = at
            self.parts[whole] = (left, right)
            self.born[whole] = at
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            if self._whole(i):
                key = text[: -len(self.suffix)] + END if text.endswith(self.suffix) else text
                self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        self.letters = _byte_letters()
        words = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        letters, numbers = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾"
        quick = words.replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{numbers}]").replace(r"\s\p{L}\p{N}", rf"\t-\r \x85\xa0{letters}{numbers}")
        self.find_latin = re.compile(quick).findall  # the same pattern for texts up to U+024F; for others the file's rules are left to their library
        self.beyond_latin = re.compile("[^\x00-\u024f]").search
        self.cut_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")").split
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _whole(self, token: int) -> bool:
        """Does the token's own text encode to the token: its two parts do, and nothing merges across them before they do."""
        made = self.parts.get(token)
        return made is None or (self._whole(made[0]) and self._whole(made[1]) and self._holds(*made, self.born[token]))

    def _holds(self, left: int, right: int, until: int | None = None) -> bool:
        """Do two neighbouring tokens stay apart (``until`` their own merge at that rank)?

        The pair at the boundary merges if its rank comes before both sides grow on; at an
        equal rank the leftmost place is first, so a left side that grows goes first and
        a right side after.
        """
        left_end = right_end = float("inf") if until is None else until
        first = until is not None
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and not first and rank < left_end and rank <= right_end:
                return False
            first = False
            if self.born[left] > self.born[right]:
                left_end, left = self.born[left], self.parts[left][1]
            elif self.born[right] >= 0:
                right_end, right = self.born[right], self.parts[right][0]
            else:
                return True

    def _goes(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            found = self.pairs[key] = self._holds(left, right)
        return found

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, given in byte letters."""
        n = len(word)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        pairs = self.pairs
        for end, (token, length) in self.automaton.iter(word + END):
            if end == n:
                at, to = n + 1 - length, n  # the end mark is no place of its own
            else:
                at, to = end + 1 - length, end + 1
                if to == n:
                    continue  # the last letter always carries the end of the word
            if last[to] >= 0:
                continue
            if at and (last[at] < 0 or not (pairs.get((last[at], token)) or self._goes(last[at], token))):
                continue
            last[to], start[to] = token, at
        ids = []
        while n:
            ids.append(last[n])
            n = start[n]
        return ids[::-1]

    def word(self, word: str, plain: str | None = None) -> tuple[tuple[int, ...], str]:
        """Ids and decoding of a word; ``plain`` is the word in byte letters, if it is known."""
        if plain is None:
            plain = word if word.isascii() and word.isprintable() else "".join(map(self.letters.__getitem__, word.encode("utf-8", "surrogatepass")))
        ids = tuple(self.encode_word(plain))
        found = (ids, " ".join(map(self.texts.__getitem__, ids)))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = found
        return found

    def words(self, text: str) -> Iterator[tuple[tuple[int, ...], str]]:
        """Ids and decoding of each word of a text without added tokens."""
        known, word = self.known.get, self.word
        if not self.beyond_latin(text):
            low = text.lower()  # up to U+024F a text is its own NFC
            if not self.beyond_latin(low):
                for w in self.find_latin(low):
                    yield known(w) or word(w)
                return
        for w, _ in self.split(self.normal(text)):
            key = "\n" + w  # no word of the other way holds a line break
            yield known(key) or word(key, w)

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a whole text and its decoding."""
        ids: list[int] = []
        shown: list[str] = []
        for part in self.cut_added(text) if "<|" in text else (text,):
            if part in self.added:
                ids.append(self.added[part])
                shown.append(part)
                continue
            for found in self.words(part):
                ids.extend(found[0])
                shown.append(found[1])
        return ids, " ".join(shown)

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.texts.__getitem__, ids))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is visible, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


def encode(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids and decoded text of every document: id column, ids array<int>, decoded string.

    One row out per row in, no shuffle. Null and empty texts give no ids and an empty
    decoding; repeated rows are encoded each. ``path`` is the vocabulary file, which every
    executor must have.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    narrow = docs.select(id_column, text_column)
    kind = narrow.schema[0]
    out = pa.schema([pa.field("ids", pa.list_(pa.int32())), pa.field("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_worker(PrefixEncoder, path)
        for batch in pieces(batches, 500):
            done = [enc.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([d[0] for d in done], out.field(0).type), pa.array([d[1] for d in done])]
            yield pa.RecordBatch.from_arrays(columns, names=[kind.name, "ids", "decoded"])

    from pyspark.sql import types as T

    return narrow.mapInArrow(run, T.StructType([kind, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))


def with_ids_digest(encoded: DataFrame) -> DataFrame:
    """Count and SHA-256 of the ids as little-endian 32-bit integers, beside the decoded text."""
    import hashlib

    import numpy as np
    from pyspark.sql import types as T

    kind = encoded.schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            flat, cuts = ids.flatten().to_numpy().astype("<u4"), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            digests = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(cuts)), pa.array(digests, pa.string()), batch.column(2)], names=[kind.name, "n_tokens", "ids_sha256", "decoded"])

    fields = [kind, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded", T.StringType())]
    return encoded.select(kind.name, "ids", "decoded").mapInArrow(run, T.StructType(fields))
