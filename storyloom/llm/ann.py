"""Nearest neighbours by multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.llm.common import per_worker, stage

TABLES = 8  # hash tables
HASHES = 8  # p-stable functions per table
WIDTH = 2.0  # of a hash function's cells, for vectors of length one
PROBES = 192  # cells per table that a query visits, likeliest first
MISS = 0.1  # chance of missing a row as near as the k-th found above which a query is scanned in full
GROUP_ROWS = 20_000  # index entries that one group holds at most, about
SEED = 20


class Hasher:
    """Cells of unit vectors under TABLES x HASHES functions floor((a.v + b) / WIDTH), and a query's probes."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.hashes, self.width, self.dim = tables, hashes, width, dim
        self.a = rng.standard_normal((dim, tables * hashes))
        self.b = rng.uniform(0, width, tables * hashes)
        self.mix = rng.integers(1, 2**62, (tables, hashes), dtype=np.int64) * 2 + 1
        self.salt = rng.integers(0, 2**62, tables, dtype=np.int64) + dim
        self.moves = np.array(list(itertools.product((-1, 0, 1), repeat=hashes)), np.int64)
        self.probes = min(probes, len(self.moves))

    def places(self, unit: np.ndarray) -> np.ndarray:
        return ((unit @ self.a + self.b) / self.width).reshape(len(unit), self.tables, self.hashes)

    def codes(self, cells: np.ndarray) -> np.ndarray:
        """64-bit names of cells (rows, tables, hashes); sums of odd multiples, which may wrap."""
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.mix).sum(axis=2) + self.salt

    def _nearest(self, low: np.ndarray) -> np.ndarray:
        """Places in ``moves`` of the likeliest cells of each table, by the distances (tables, hashes) to the lower sides."""
        cost = np.stack([low**2, np.zeros_like(low), (1 - low) ** 2])  # for moves -1, 0, 1
        total = sum(cost[self.moves[:, h] + 1, :, h] for h in range(self.hashes)).T
        return np.argsort(total, axis=1, kind="stable")[:, : self.probes]

    def missed(self, unit: np.ndarray, score: float) -> float:
        """Chance, over the draw of the functions, that no probed cell of one unit vector holds a row of that cosine."""
        place = self.places(unit[None])[0]
        low = place - np.floor(place)
        spread = math.sqrt(max(2 - 2 * score, 1e-12)) / self.width
        sides = np.stack([i - low for i in (-1, 0, 1, 2)]) / (spread * math.sqrt(2))
        share = np.diff(np.vectorize(math.erf)(sides), axis=0) / 2  # of moves -1, 0, 1
        likely = np.ones((self.tables, self.probes))
        at = self.moves[self._nearest(low)] + 1
        for h in range(self.hashes):
            likely *= share[at[:, :, h], np.arange(self.tables)[:, None], h]
        return float(np.prod(1 - likely.sum(axis=1)))

    def probed(self, unit: np.ndarray) -> np.ndarray:
        """Cells that one unit vector visits, (tables, probes): its own, then its neighbours.

        A neighbour's success falls with the sum of squared distances from the vector's
        place to the cell sides that have to be crossed, so cells come in that order.
        """
        place = self.places(unit[None])[0]
        own = np.floor(place)
        nearest = self._nearest(place - own)
        with np.errstate(over="ignore"):
            steps = (self.moves[nearest] * self.mix[:, None, :]).sum(axis=2)
        return self.codes(own[None])[0][:, None] + steps


def _groups(codes: np.ndarray, groups: int) -> np.ndarray:
    """Group of each cell."""
    with np.errstate(over="ignore"):
        z = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((z >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
    group_rows: int = GROUP_ROWS,
    seed: int = SEED,
    miss: float = MISS,
) -> DataFrame:
    """The ``k`` rows of largest cosine found for each query: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` have vec_id and embedding; a query never finds its own id.
    Vectors that are null, empty, zero or hold null or non-finite components take no part;
    vectors of different length never meet. Equal vectors are indexed once with their k+1
    smallest ids, which is all that any result can show, so copies cost nothing. Ties go to
    the smaller id; repeated ids count once.

    Every index entry is hashed into its cell of each table and goes to the cell's group; a query
    goes once to each group that holds one of its probed cells. Groups above
    ``group_rows`` entries are split by vector, and queries visit every part. A task keeps one
    group's entries and streams its queries past them. Cosines are computed in double precision.

    Queries that find fewer than ``k`` rows, or whose probes would miss a row as near as the k-th with a
    chance above ``miss``, are compared with all rows, in blocks of ``group_rows``.
    """
    spark = vectors.sparkSession
    distinct = stage(_distinct(vectors, k + 1))
    asked = queries.select("vec_id", "embedding").filter(_usable("embedding")).select(F.col("vec_id").alias("query_id"), _name("embedding").alias("rep")).distinct()
    asked = stage(asked)
    n = distinct.count()
    groups = max(1, math.ceil(n * tables / group_rows))
    settings = (tables, hashes, width, probes, seed)
    kept = distinct.select("rep", "embedding", F.col("ids")[0].alias("first"))
    entry = _entry(kept.schema["first"].dataType)
    entries = kept.mapInArrow(_index(settings, groups), entry)
    sizes = entries.groupBy("grp").count().select("grp", F.ceil(F.col("count") / group_rows).cast("int").alias("parts"))
    # 0 for the one part of a usual group, so that a join is only there for split ones.
    split = {r["grp"]: r["parts"] for r in sizes.filter("parts > 1").collect()} if groups < 100_000 else None
    reps = asked.select("rep").distinct().join(kept, "rep")
    visits = reps.mapInArrow(_visits(settings, groups), entry)
    parts = F.lit(1)
    if split is None:
        entries, visits = (x.join(sizes.withColumnRenamed("parts", "n_parts"), "grp") for x in (entries, visits))
        parts = F.col("n_parts")
    elif split:
        parts = F.coalesce(F.element_at(F.create_map(*itertools.chain.from_iterable((F.lit(g), F.lit(p)) for g, p in split.items())), F.col("grp")), F.lit(1))
    entries = entries.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    top = stage(_best(entries, visits, groups, distinct, k))
    hits = asked.join(top, "rep", "left").groupBy("rep").agg(F.min(F.size(F.coalesce(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), F.array()))).alias("n"))
    kth = top.select("rep", F.element_at("near", -1)["score"].alias("score"))
    judged = reps.join(hits, "rep").join(kth, "rep", "left").select("rep", "embedding", "first", "n", "score")
    short = stage(judged.mapInArrow(_unsure(settings, k, miss), T.StructType([kept.schema[c] for c in ("rep", "embedding", "first")])))
    if not short.isEmpty():
        blocks = max(1, math.ceil(n / group_rows))
        code = F.array(F.size("embedding").cast("long")).alias("codes")
        entries = kept.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("long").alias("grp"), F.lit(0).alias("part"), F.lit(0).alias("kind"), "rep", code, "embedding", "first")
        visits = short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("grp"), F.lit(0).alias("part"), F.lit(1).alias("kind"), "rep", code, "embedding", "first")
        top = top.join(short.select("rep"), "rep", "left_anti").unionByName(_best(entries, visits, blocks, distinct, k))
    mine = asked.join(top, "rep").select("query_id", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")).alias("near"))
    return mine.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )


def _best(entries: DataFrame, visits: DataFrame, groups: int, distinct: DataFrame, k: int) -> DataFrame:
    """rep and its k+1 best (r, vec_id, score) among the entries it visits; equal scores by the smaller id.

    k+1 vectors in the order of score and smallest id hold the k+1 best ids, as each of them has one at least.
    """
    columns = ["grp", "part", "kind", "rep", "codes", "embedding", "first"]
    parted = entries.select(*columns).unionByName(visits.select(*columns)).repartition(max(groups, 1), "grp", "part").sortWithinPartitions("grp", "part", "kind")
    found = parted.mapInArrow(_scan(k + 1), T.StructType([T.StructField("rep", T.LongType()), T.StructField("near", T.LongType()), T.StructField("score", T.DoubleType()), entries.schema["first"]])).distinct()
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy(F.col("score").desc(), "first"))).filter(F.col("r") <= k + 1).drop("r", "first")
    named = best.join(distinct.select(F.col("rep").alias("near"), F.explode("ids").alias("vec_id")), "near")
    order = Window.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    return named.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))


def _usable(column: str):
    v = F.col(column)
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return v.isNotNull() & F.coalesce(F.forall(v, good), F.lit(False)) & F.exists(v, lambda x: x != 0)


def _name(column: str):
    """One name for equal vectors; -0.0 and 0.0 are equal."""
    return F.xxhash64(F.transform(F.col(column), lambda x: x.cast("double") + F.lit(0.0)))


def _distinct(vectors: DataFrame, smallest: int) -> DataFrame:
    """Distinct vectors with their ``smallest`` lowest ids; ranked in 64 salted parts first, so copies never meet in one task."""
    good = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(_usable("embedding") & F.col("vec_id").isNotNull())
    good = good.withColumn("rep", _name("embedding")).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for keys in (["rep", "salt"], ["rep"]):
        good = good.withColumn("at", F.dense_rank().over(Window.partitionBy(*keys).orderBy("vec_id"))).filter(F.col("at") <= smallest)
    return good.groupBy("rep").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"), F.first("embedding").alias("embedding"))


def _entry(first: T.DataType) -> T.StructType:
    """Rows of the index and of visits; ``first`` is a vector's smallest id."""
    return T.StructType([
        T.StructField("grp", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("rep", T.LongType()),
        T.StructField("codes", T.ArrayType(T.LongType())),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("first", first),
    ])


_KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, object]]:
    values = batch.column(1).flatten().to_numpy()
    ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
    for rep, a, b, first in zip(batch.column(0).to_pylist(), np.concatenate([[0], ends[:-1]]), ends, batch.column(2).to_pylist()):
        yield rep, values[a:b], first


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def _entries(rows: list[tuple], first: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (*_KINDS, first))], names=["grp", "kind", "rep", "codes", "embedding", "first"])


def _index(settings: tuple, groups: int):
    tables, hashes, width, probes, seed = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rep, v, first in _rows(batch):
                hasher = per_worker(Hasher, len(v), tables, hashes, width, probes, seed)
                codes = hasher.codes(np.floor(hasher.places(_unit(v)[None])))[0]
                out += [(g, 0, rep, [c], v, first) for g, c in zip(_groups(codes, groups).tolist(), codes.tolist())]
            if out:
                yield _entries(out, batch.column(2).type)

    return run


def _visits(settings: tuple, groups: int):
    tables, hashes, width, probes, seed = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, v, first in _rows(batch):
                hasher = per_worker(Hasher, len(v), tables, hashes, width, probes, seed)
                codes = hasher.probed(_unit(v)).ravel()
                of = _groups(codes, groups)
                order = np.argsort(of, kind="stable")
                cuts = np.flatnonzero(np.diff(of[order])) + 1
                rows = [(int(of[p[0]]), 1, rep, codes[p], v, first) for p in np.split(order, cuts)]
                yield _entries(rows, batch.column(2).type)

    return run


def _unsure(settings: tuple, k: int, miss: float):
    """Of (rep, embedding, first, n found, score of the last one), those that need a scan of all rows."""
    tables, hashes, width, probes, seed = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (rep, v, _), n, score in zip(_rows(batch), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                hasher = per_worker(Hasher, len(v), tables, hashes, width, probes, seed)
                keep.append(n < k or score is None or hasher.missed(_unit(v), score) > miss)
            yield batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))

    return run


def _scan(best: int):
    """Streams sorted (grp, part, kind) rows: first a group's entries, then the queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, cells, firsts = None, {}, None, {}
        for batch in batches:
            cols = [batch.column(i) for i in range(7)]
            keys = zip(cols[0].to_pylist(), cols[1].to_pylist(), cols[2].to_pylist(), cols[3].to_pylist(), cols[6].to_pylist())
            codes, code_at = cols[4].flatten().to_numpy(), np.concatenate([[0], np.cumsum(cols[4].value_lengths().to_numpy())])
            values, value_at = cols[5].flatten().to_numpy(), np.concatenate([[0], np.cumsum(cols[5].value_lengths().to_numpy())])
            out = []
            for i, (grp, part, kind, rep, first) in enumerate(keys):
                if (grp, part) != here:
                    here, waiting, cells, firsts = (grp, part), {}, None, {}
                v = values[value_at[i] : value_at[i + 1]]
                if kind == 0:
                    waiting.setdefault(int(codes[code_at[i]]), []).append((rep, v))
                    firsts[rep] = first
                    continue
                if cells is None:
                    cells = {c: (np.array([r for r, _ in m]), np.stack([x for _, x in m])) for c, m in waiting.items()}
                    cells = {c: (r, m, np.sqrt((m * m).sum(axis=1))) for c, (r, m) in cells.items()}
                hit = [cells[c] for c in codes[code_at[i] : code_at[i + 1]].tolist() if c in cells]
                if not hit:
                    continue
                reps, once = np.unique(np.concatenate([h[0] for h in hit]), return_index=True)  # found in several tables
                near = np.concatenate([h[1] for h in hit])[once]
                rough = near @ v / np.concatenate([h[2] for h in hit])[once]
                least = np.partition(rough, -best)[-best] - 1e-9 if len(rough) > best else -2  # rough scores may be off by less
                exact = [(_cosine(v, near[j]), firsts[int(reps[j])], int(reps[j])) for j in np.flatnonzero(rough >= least)]
                out += [(rep, r, score, f) for score, f, r in sorted(exact, key=lambda x: (-x[0], x[1]))[:best]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), batch.column(6).type))], names=["rep", "near", "score", "first"])

    return run


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Exactly rounded sums, so that a pair has one score in whatever group it is met."""
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))
