"""Near copies by HyperMinHash: banded compressed registers, corrected estimates, then whole sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.common import pieces, stage, words_of

SHINGLE = 5  # words
SIMILAR = 75  # per cent of the union that two sets share to be linked
REGISTERS = 128  # buckets of a sketch; a register holds a leading-zero count and MANTISSA bits
MANTISSA = 10
ROWS = 4  # registers per band: 32 bands; a linked pair misses all of them with chance (1 - .75^4)^32 < 6e-6
EMPTY = 0xFFFF
NO_KEY = np.uint64(0xFFFFFFFFFFFFFFFF)  # of a band whose registers are all empty
DEVIATIONS = 5  # of the estimate below the threshold that still reach verification
BLOCK = 1024  # members of a bucket that meet others in one task
BLOCK_SHINGLES = 1 << 20  # of a component's members that one task holds, at about
ASKS = 1000  # sets that a task compares with a block of a component's members, at about
_BITS = int(math.log2(REGISTERS))
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit names of each text's 5-word shingles; of the whole sequence, if it is shorter."""
    split = [words_of(t) for t in texts]
    flat = np.array([w for s in split for w in s], dtype=object)
    with np.errstate(over="ignore"):
        names = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
        out, at = [], 0
        for s in split:
            h, n = names[at : at + len(s)], len(s)
            at += n
            k = min(SHINGLE, n)
            if not k:
                out.append(np.zeros(0, np.uint64))
                continue
            total = np.full(n - k + 1, k, np.uint64)
            for j in range(k):
                total = _mixed(total + h[j : n - k + 1 + j] * _MULTIPLIERS[j])
            out.append(np.unique(total))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a sorted set: per bucket the smallest value as leading zeros and the bits after the first one."""
    registers = np.full(REGISTERS, EMPTY, np.uint16)
    if len(shingles):
        bucket = (shingles >> np.uint64(64 - _BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        value = shingles[first] & np.uint64((1 << (64 - _BITS)) - 1)
        length = np.frexp(value.astype(np.float64))[1]
        zeros = 64 - _BITS - length
        tail = (value >> np.maximum(length - MANTISSA - 1, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
        registers[bucket[first]] = (np.clip(zeros, 0, 62).astype(np.uint64) << np.uint64(MANTISSA)) | tail
    return registers


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Which pairs of sketches (rows of ``a`` and ``b``) may reach the threshold.

    Equal registers over used ones, less the collisions that chance gives registers of this
    width at these set sizes; the limit lies DEVIATIONS standard errors under the threshold.
    """
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    same = ((a == b) & (a != EMPTY)).sum(axis=-1)
    ratio = np.minimum(n_a, n_b) / np.maximum(np.maximum(n_a, n_b), 1)
    chance = 0.1699 * used / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    estimate = (same - chance) / np.maximum(used, 1)
    limit = SIMILAR / 100
    return (estimate >= limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1))) & (100 * ratio >= SIMILAR)


def prepare(docs: DataFrame) -> DataFrame:
    """doc_id, text, set size, two digests of the set, sketch; staged."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1000):
            sets = shingle_sets(batch.column(1).to_pylist())
            with np.errstate(over="ignore"):
                sums = [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                mixed = [int(_mixed(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            cols = [pa.array([len(s) for s in sets], pa.int64()), pa.array(sums, pa.int64()), pa.array(mixed, pa.int64()), pa.array([sketch(s).astype(">u2").tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=["doc_id", "text", "n", "d1", "d2", "sketch"])

    return stage(narrow.mapInArrow(run, f"doc_id {kind}, text string, n long, d1 long, d2 long, sketch binary"))


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of the edges (a, b) can reach.

    Each round takes the smallest label around, then the label of the label; rounds end when no label
    changes. Labels are written after every round.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")))
    while True:
        around = both.join(labels.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("m"))
        lower = labels.join(around, "a").select("a", F.least("c", "m").alias("c"), F.col("c").alias("was"))
        jumped = lower.alias("x").join(labels.select(F.col("a").alias("c"), F.col("c").alias("root")), "c").select("a", F.least("c", "root").alias("c"), "was")
        done = stage(jumped)
        changed = done.filter("c < was").limit(1).count()
        labels = done.select("a", "c")
        if not changed:
            return labels.select(F.col("a").alias("node"), F.col("c").alias("component"))


def linked(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sets (rep: a number of their own, least doc_id, digests, size) and verified links between them that connect what is to be connected.

    Round one compares each member of a bucket with the bucket's hub, the member that meets most
    others in all buckets: of a text and its copies, the text. Round two asks for members that
    round one left in different components whether one's set links to any of the other's component. Both rounds
    estimate from sketches first and confirm on the whole sets. Pairs inside a component that is already connected are not needed.
    """
    sets = stage(
        prepared.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min(F.struct("doc_id", "text")).alias("least"), F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("rep"), F.col("least.doc_id").alias("least"), F.col("least.text").alias("text"), "n", "d1", "d2", "sketch")
    )
    size = 2 * ROWS
    bands = sets.select("rep", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)), lambda i: F.substring(F.col("sketch"), i * size + 1, F.lit(size)))).alias("band", "key"))
    bands = bands.filter(F.col("key") != F.lit(b"\xff" * size))
    full = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = stage(bands.join(full, ["band", "key"]))
    degree = met.groupBy("rep").agg(F.sum(F.col("members") - 1).alias("degree"))
    hubs = met.join(degree, "rep").groupBy("band", "key").agg(F.max(F.struct("degree", -F.col("rep"))).alias("top")).select("band", "key", (-F.col("top.col2")).alias("hub"))
    stars = met.join(hubs, ["band", "key"]).filter("rep != hub").select("rep", "hub").distinct()
    sketches = sets.select("rep", "n", "sketch")
    first = stage(verify(_estimated(stars, sketches), sets))
    labels = stage(components(first))
    weights = labels.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    weighed = labels.join(weights, "component").select(F.col("node").alias("rep"), "component", "weight")
    where = met.join(weighed, "rep", "left").withColumns({"component": F.coalesce("component", "rep"), "weight": F.coalesce("weight", F.lit(1))})
    split = where.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("band", "key")
    open_ = where.join(split, ["band", "key"]).join(sketches, "rep")
    second = _confirmed(_crossing(open_), labels, sets)
    return sets, first.unionByName(second)


def _estimated(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (rep, hub) whose sketches may reach the threshold."""
    rows = pairs.join(sketches, "rep").join(sketches.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch")), "hub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u2").reshape(-1, REGISTERS) for i in (2, 3))
                keep = may_link(a, b, batch.column(4).to_numpy(), batch.column(5).to_numpy())
                yield batch.select([0, 1]).filter(pa.array(keep))

    return rows.select("rep", "hub", "sketch", "hub_sketch", "n", "hub_n").mapInArrow(run, "rep long, hub long")


def _crossing(members: DataFrame) -> DataFrame:
    """Sets (rep) and the components (target) that they may link to: some member lies in one bucket with the set and their sketches may reach the threshold.

    Of two components the larger one (``weight``) is the target. A set asks for a component once, however
    many of its members are close. A bucket is cut into blocks of about BLOCK members; each two blocks meet in
    a task of their own, so a large bucket is spread.
    """
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    cut = members.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    cut = cut.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")})
    rows = cut.select("band", "key", "p", "q", (F.col("part") != F.col("p")).cast("int").alias("side"), "rep", "component", "weight", "n", "sketch")
    rows = rows.repartition("band", "key", "p", "q").sortWithinPartitions("band", "key", "p", "q", "side", "rep")

    def compare(group: list[tuple], band: int, same: bool) -> tuple[np.ndarray, np.ndarray] | None:
        sides, reps, comps, weights, sizes = (np.array([g[i] for g in group]) for i in range(5))
        named, comp = np.unique(comps, return_inverse=True)
        start = 0 if same else int((sides == 0).sum())
        if start == len(group) or len(named) < 2:
            return None
        sketches = np.frombuffer(b"".join(g[5] for g in group), ">u2").reshape(-1, REGISTERS)
        before = sketches[:, : ROWS * band].copy().view(np.uint64).reshape(len(group), band)
        found = []
        for i in range(len(group) if same else start):
            ask = max(start, i + 1 if same else 0)
            ask = ask + np.flatnonzero(comp[ask:] != comp[i])
            if len(ask):
                hit = ask[may_link(sketches[i][None], sketches[ask], sizes[i : i + 1], sizes[ask])]
                # a pair counts in the first bucket that both are in
                hit = hit[~((before[hit] == before[i]) & (before[i] != NO_KEY)).any(axis=1)]
                there = (weights[hit] > weights[i]) | ((weights[hit] == weights[i]) & (comp[hit] > comp[i]))
                found.append(np.where(there, i * len(named) + comp[hit], hit * len(named) + comp[i]))
        asks = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return reps[asks // len(named)], named[asks % len(named)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, group = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            asks = compare(group, here[0], here[2] == here[3])
            if asks and len(asks[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in asks], names=["rep", "target"])

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for row in zip(*cols):
                if row[:4] != here:
                    if group:
                        yield from flush()
                    here, group = row[:4], []
                group.append(row[4:])
        if group:
            yield from flush()

    return rows.mapInArrow(run, "rep long, target long").distinct()


def _confirmed(asks: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between sets (rep) and components (target) that they ask for, confirmed on the whole sets of all members.

    A target's members are cut into blocks of about BLOCK_SHINGLES shingles and its asking sets into parts of
    about ASKS; each block meets each part in a task of its own. A set that shares too little with
    the union of a block is linked with none of its members; others are counted against every member.
    One link for a set and a block is enough, as the members are connected already.
    """
    asks = stage(asks)
    wanted = asks.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / ASKS).cast("int").alias("parts"))
    mine = labels.select(F.col("node").alias("rep"), F.col("component").alias("target"))
    alone = wanted.select(F.col("target").alias("rep"), "target")  # a component is named by its smallest member
    held = stage(mine.join(wanted.select("target"), "target", "left_semi").select("rep", "target").union(alone).distinct().join(sets.select("rep", "n"), "rep"))
    blocks = held.groupBy("target").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks")).join(wanted, "target")
    number = lambda column: F.pmod(F.xxhash64("rep"), F.col(column)).cast("int")
    spread = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    members = held.select("rep", "target").join(blocks, "target").select("rep", "target", number("blocks").alias("block"), spread("parts").alias("part"), F.lit(0).alias("kind"))
    asking = asks.join(blocks, "target").select("rep", "target", spread("blocks").alias("block"), number("parts").alias("part"), F.lit(1).alias("kind"))
    rows = _with_texts(members.unionByName(asking), sets).select("target", "block", "part", "kind", "rep", "text")
    rows = rows.repartition("target", "block", "part").sortWithinPartitions("target", "block", "part", "kind", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, reps, own, index = None, [], [], None

        def indexed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            sizes = np.array([len(s) for s in own])
            values, owner = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
            order = np.argsort(values, kind="stable")
            return sizes, values[order], owner[order]

        for batch in pieces(batches, 500):
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, kind, rep, shingles in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), shingle_sets(batch.column(5).to_pylist())):
                if key != here:
                    here, reps, own, index = key, [], [], None
                if kind == 0:
                    reps.append(rep)
                    own.append(shingles)
                    continue
                if not own:  # a block that no member fell into
                    continue
                sizes, values, owner = index = index or indexed()
                lo, hi = np.searchsorted(values, shingles, "left"), np.searchsorted(values, shingles, "right")
                common = (hi > lo).sum()
                need = SIMILAR * (len(shingles) + sizes)
                if not ((100 + SIMILAR) * np.minimum(common, sizes) >= need).any():
                    continue
                count = hi - lo
                at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
                shared = np.bincount(owner[at], minlength=len(own))
                linked_to = np.flatnonzero((100 + SIMILAR) * shared >= need)
                if len(linked_to):
                    out.append((rep, reps[linked_to[0]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _with_texts(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows with the text of their set (rep).

    The rows and their sets' numbers are written first, so that Spark knows their size and sends them to the texts
    where they are few; texts that no row asks for then never move.
    """
    rows = stage(rows)
    asked = stage(sets.select("rep", "text").join(stage(rows.select("rep").distinct()), "rep", "left_semi"))
    return rows.join(asked, "rep")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among pairs (rep, hub), confirmed on the whole shingle sets.

    Texts of the pairs go to their hubs; a hub with many is given several parts, each with its text.
    """
    pairs = stage(pairs)
    parts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / 500).cast("int").alias("parts"))
    members = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "rep")
    heads = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.col("hub").alias("rep"))
    rows = _with_texts(heads.unionByName(members), sets).select("hub", "part", "kind", "rep", "text")
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for batch in pieces(batches, 500):
            sets_here = shingle_sets(batch.column(4).to_pylist())
            out = []
            for hub, kind, rep, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), sets_here):
                if kind == 0:
                    head = own
                    continue
                shared = len(np.intersect1d(head, own, assume_unique=True))
                if 100 * shared >= SIMILAR * (len(head) + len(own) - shared):
                    out.append((rep, hub))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, set, first: one row per document.

    ``set`` numbers distinct shingle sets (null without words); ``first`` is true for one set of each
    component: of those that hold its smallest doc_id, the one with the smallest number. Documents
    without words are first, as they are linked with nothing; rows without doc_id never are.
    """
    prepared = prepare(docs)
    sets, links = linked(prepared.filter(F.col("doc_id").isNotNull()))
    labels = components(links)
    classes = sets.select("rep", "least", "n", "d1", "d2").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.withColumn("component", F.coalesce("component", "rep"))
    names = classes.groupBy("component").agg(F.min(F.struct("least", "rep")).alias("name"))
    named = classes.join(names, "component").select("n", "d1", "d2", "rep", F.col("name.least").alias("component_id"), (F.col("rep") == F.col("name.rep")).alias("first"))
    out = prepared.select("doc_id", F.xxhash64("text").alias("text_hash"), "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    first = F.col("doc_id").isNotNull() & F.coalesce("first", F.lit(True)) & (F.col("doc_id") == component)
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("rep").alias("set"), F.coalesce(first, F.lit(False)).alias("first"))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents with the same shingle set are one class; classes are linked if their sets share at
    least 75 per cent of their union. Classes have numbers of their own, so one doc_id with several
    texts has a row, and a component, for each. Documents without words are linked with nothing; rows without
    doc_id belong to no component (null, not kept), and do not link others. Repeated rows are each
    returned. A component is named by its smallest doc_id, whose rows are kept. Ids may be of any ordered type.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return grouped(docs).select("doc_id", "n_shingles", "component_id", kept)
