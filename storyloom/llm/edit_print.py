"""Document fingerprints: a shared random walk maps edit distance to Hamming distance, then bits are sampled."""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import per_worker, pieces, stage

SLOTS = 128  # sampled places of a walk; each gives one byte of the fingerprint
BAND = 4  # slots per band
STEPS = 1 << 16  # steps after which the shared walks begin anew
KINDS = 64  # characters of one kind walk alike; places compare the characters themselves
CHUNK = 1 << 16  # characters walked at a time
_SEED = 0x51ED270B


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class Walks:
    """The randomness that all texts share, made from one seed.

    ``stays[kind][step]`` is how many steps a walk that reads a character of this kind first at this
    step stays on it: a fair coin a step says whether it moves on.
    """

    def __init__(self) -> None:
        draw = np.random.Generator(np.random.PCG64(_SEED))
        moves = draw.integers(0, 2, (KINDS, 2 * STEPS), np.uint8)
        moves[:, 254::255] = 1  # a stay fits a byte
        ahead = np.full((KINDS, 2 * STEPS), 2 * STEPS, np.int64)
        ahead[moves == 1] = np.broadcast_to(np.arange(2 * STEPS), moves.shape)[moves == 1]
        ahead = np.minimum.accumulate(ahead[:, ::-1], axis=1)[:, ::-1]
        self.stays = [row.astype(np.uint8).tobytes() for row in ahead[:, :STEPS] - np.arange(STEPS) + 1]
        self.records = [_records(draw) for _ in range(SLOTS)]

    def walk(self, codes: np.ndarray, step: int = 0) -> tuple[np.ndarray, int]:
        """The step at which each character is first read, and the step after the last one."""
        stays, mask = self.stays, STEPS - 1
        first = np.empty(len(codes), np.int64)
        for at in range(0, len(codes), CHUNK):
            kinds = (_mixed(codes[at : at + CHUNK].astype(np.uint64)) % np.uint64(KINDS)).astype(np.uint8).tobytes()
            steps = []
            for kind in kinds:
                steps.append(step)
                step += stays[kind][step & mask]
            first[at : at + len(steps)] = steps
        return first, step

    def places(self, length: int) -> np.ndarray:
        """The step that each slot samples of a walk of ``length`` steps.

        Each slot takes the step with the least of its random numbers, so walks of two lengths
        sample the same step with chance shorter over longer.
        """
        return np.array([r[bisect.bisect_left(r, length) - 1] for r in self.records])

    def print_of(self, codes: np.ndarray, first: np.ndarray, length: int) -> bytes:
        if not length:
            return b""
        places = self.places(length)
        read = codes[np.searchsorted(first, places, "right") - 1].astype(np.uint64)
        return (_mixed(read * np.uint64(0x9E3779B97F4A7C15) + places.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8).tobytes()


def _records(draw: np.random.Generator) -> list[int]:
    """Steps whose random number is below all earlier ones', drawn from one record to the next."""
    at, least, out = 0, draw.random(), [0]
    while at < 1 << 40:
        at += 1 + int(math.log(max(draw.random(), 1e-300)) / math.log1p(-least)) if least > 1e-15 else 1 << 40
        least *= draw.random()
        out.append(at)
    return out


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def likeness(a: bytes, b: bytes) -> float:
    """Share of slots with the same byte; two empty texts are alike, an empty one is like no other."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())


def fingerprint(text: str | None, walks: Walks) -> bytes:
    codes = codes_of(text or "")
    return walks.print_of(codes, *walks.walk(codes))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points), fingerprint (lowercase hex of SLOTS bytes; empty for null and empty texts), a row per document."""
    narrow = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = narrow.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = per_worker(Walks)
        for batch in pieces(batches, 500):
            texts = batch.column(1).to_pylist()
            prints = [fingerprint(t, walks).hex() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return narrow.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows (run, tail, doc_id, text) such that the next row of a run is the next document, descending doc_id.

    Ids alone are ranged first: each range's first id cuts the documents into runs, and the
    first row of a run also ends the run before (``tail``). Texts move once. Only the first ids,
    one a range, come to the driver. Equal ids go by a hash of the text, descending.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.desc_nulls_last("doc_id"), F.desc("h")]
    runs = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id", "h").repartitionByRange(runs, *order)
    heads = ids.withColumn("range", F.spark_partition_id()).groupBy("range").agg(F.max(F.struct("doc_id", "h")).alias("top"))
    key = lambda i, h: (i is None, 0 if i is None else -i, -h)
    cuts = sorted({key(r.top.doc_id, r.top.h) for r in heads.collect()})
    kind = rows.schema[0].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["run", "tail", "doc_id", "text", "h"]
        for batch in batches:
            keys = [key(i, h) for i, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            run = [bisect.bisect_right(cuts, k) - 1 for k in keys]
            ends = [n for n, (k, r) in enumerate(zip(keys, run)) if cuts[r] == k]
            for at, which, tail in ((range(len(keys)), run, False), (ends, [(run[n] - 1) % len(cuts) for n in ends], True)):
                if len(which):
                    taken = batch.take(pa.array(at, pa.int64())) if tail else batch
                    yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array([tail] * len(which)), *taken.columns], names=names)

    placed = rows.select("doc_id", "text", "h").mapInArrow(place, f"run int, tail boolean, doc_id {kind}, text string, h long")
    return placed.repartition(runs, "run").sortWithinPartitions("run", "tail", *order).select("run", "tail", "doc_id", "text")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and the next document (descending doc_id; after the last, the first).

    The edited text has the last half (rounded down) of its code points replaced by as many first ones
    of the next document, or all it has. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint
    (hex), near_edited, near_next. Null texts are empty; empty texts have an empty fingerprint, like only each other.
    Null ids come last. Equal ids go by a hash of the text; repeated rows are rows of their own. A single document is its own next one.
    An empty table gives no rows. Ids are numbers. The walk of the half that a text keeps is not done twice.
    """
    placed = _with_next(docs)
    kind = placed.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def one(before: tuple, after: str, after_print: bytes, walks: Walks) -> tuple:
        _, text, codes, first, own = before
        cut = len(text) // 2
        keep = len(text) - cut
        edited = text[:keep] + after[:cut]
        if cut:
            step = int(first[keep])
            more, end = walks.walk(codes_of(edited[keep:]), step)
            edited_print = walks.print_of(codes_of(edited), np.concatenate([first[:keep], more]), end)
        else:
            edited_print = own
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return len(text), digest, own.hex(), edited_print.hex(), likeness(own, edited_print), likeness(own, after_print)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = per_worker(Walks)
        here, before = None, None  # run, (doc_id, text, codes, first steps, fingerprint)
        for batch in pieces(batches, 200):
            ids, out, id_type = [], [], batch.schema.field(2).type
            for group, tail, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if tail and group != here:
                    continue  # a repeated end of a run already closed
                codes = codes_of(text)
                first, length = walks.walk(codes)
                own = walks.print_of(codes, first, length)
                if group == here and before is not None:
                    ids.append(before[0])
                    out.append(one(before, text, own, walks))
                here, before = (None, None) if tail else (group, (doc_id, text, codes, first, own))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], names=names)

    return placed.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def near_edits(docs: DataFrame, queries: DataFrame, edits: int = 32) -> DataFrame:
    """Pairs of different texts at most ``edits`` apart: query_id, doc_id, edits.

    Fingerprints are cut into bands of BAND slots; a query's text meets the texts that share a band,
    each pair once, and the true edit distance is measured on the whole texts. A text is named by its
    smallest id; equal texts are one and don't pair with themselves. Rows with a null id or text and
    empty texts take no part. A pair whose share of equal slots is s is missed with chance
    (1 - s^BAND)^(SLOTS / BAND), 5e-6 at s = 0.75. Empty tables give no pairs.
    """

    def classes(rows: DataFrame) -> DataFrame:
        there = rows.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isNotNull() & (F.length("text") > 0))
        return stage(there.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min(F.struct("doc_id", "text")).alias("one")).select("digest", "one.*"))

    def bands(texts: DataFrame, name: str) -> DataFrame:
        prints = fingerprints(texts.select(F.struct("doc_id", "digest").alias("doc_id"), "text"))
        cut = F.transform(F.sequence(F.lit(0), F.lit(SLOTS // BAND - 1)), lambda i: F.substring(F.col("fingerprint"), i * (2 * BAND) + 1, F.lit(2 * BAND)))
        return prints.select(F.col("doc_id.digest").alias(name), F.col("n_chars").alias(f"{name}_n"), F.posexplode(cut).alias("band", "key"))

    asked, every = classes(queries), classes(docs)
    met = bands(asked, "q").join(bands(every, "d"), ["band", "key"]).filter((F.col("q") != F.col("d")) & (F.abs(F.col("q_n") - F.col("d_n")) <= edits))
    pairs = met.select("q", "d").distinct()
    with_texts = pairs.join(asked.select(F.col("digest").alias("q"), F.col("doc_id").alias("query_id"), F.col("text").alias("q_text")), "q")
    with_texts = with_texts.join(every.select(F.col("digest").alias("d"), "doc_id", F.col("text").alias("d_text")), "d")
    return with_texts.select("query_id", "doc_id", F.levenshtein("q_text", "d_text", edits).alias("edits")).filter("edits >= 0")
