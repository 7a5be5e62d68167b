"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.llm.common import WORD, stage

WEIGHTS = (5, 2, 1)  # of the sources in order of their names, repeating
MAX_REPEATS = 3  # a document is taken at most so many times
CELLS = 4096  # parts of a source's shuffled order whose sizes are summed apart
TICKS = 65536  # parts of the virtual time from 0 to 1


def text_size(text: Column) -> Column:
    """Words of a text; 0 for a null or blank one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: its size and its target words.

    Targets share the size of all sources by weight and stop at ``repeats`` times the
    source's own size; what is above is shared again by weight among the rest, until
    none is above. Sorted by cap per weight the level of that sharing is found in one
    pass: the first source whose level is not above its own cap sets it, and levels only fall after it. The windows
    here run over one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = per_source.withColumn(
        "w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("double")
    ).withColumn("cap", F.col("source_size").cast("double") * repeats)
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    leveled = weighted.withColumns({
        "total": F.sum("source_size").over(Window.partitionBy()).cast("double"),
        "below": F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("own_level", (F.col("total") - F.col("below")) / F.col("rest"))
    level = F.max(F.when(F.col("own_level") <= F.col("cap") / F.col("w"), F.col("own_level"))).over(Window.partitionBy())
    return leveled.withColumn("level", level).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target")
    )


def shuffle_key(seed: int = 0) -> Column:
    """Place of a document in its source's shuffled order: 52 bits of an MD5 of seed, id and size."""
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")


def fair_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    seed: int = 0,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each document with the words that the mix takes of it.

    Each source sends its documents in a shuffled order, round after round; a
    document's virtual finish time is the words its source has sent up to its end over the
    source's target. All finish times are sorted together and cut at the total budget, the
    size of all documents. Returns doc_id, size, source_size, target, taken and ``keep``.

    Running sums are two-level: a source's order is cut into ``CELLS`` ranges of the
    shuffle key whose sizes are summed first, so no task gets a whole source. The cut is
    found in the same way: words per tick of virtual time, then the one tick where the
    budget ends is sorted. The result depends on doc_id, source and size of the rows
    alone. Rows without words take nothing; an empty table gives an empty result; equal
    rows stand next to each other in the order, and which of them is first does not show.
    ``docs`` has doc_id, source and text, or in its place the size of each text.
    """
    extra = [c for c in keep if c not in ("doc_id", "source")]
    size = F.col("size") if "size" in docs.columns and "text" not in docs.columns else text_size(F.col("text"))
    sized = docs.select(F.col("doc_id"), F.col("source"), size.alias("size"), *(F.col(f"`{c}`").alias(f"_k_{c}") for c in extra))
    narrow = sized.select("source", "size")
    targets = source_targets(narrow, weights, repeats)
    keyed = sized.withColumn("key", shuffle_key(seed)).withColumn("cell", F.shiftright("key", 52 - 12))
    in_source = Window.partitionBy("source").orderBy("cell")
    before = (
        keyed.groupBy("source", "cell").agg(F.sum("size").alias("words"))
        .withColumn("before", F.sum("words").over(in_source) - F.col("words"))
        .select("source", "cell", "before")
    )
    per_cell = before.join(targets, before.source.eqNullSafe(targets.source)).select(
        before.source.alias("c_source"), F.col("cell").alias("c_cell"), "before", "source_size", "target"
    )
    in_cell = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    timed = (
        keyed.withColumn("sent", F.sum("size").over(in_cell))
        .join(per_cell, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")))
        .withColumn("sent", F.col("sent") + F.col("before"))
        .drop("before", "c_source", "c_cell", "cell")
    )
    rounds = [(F.col("sent") + F.lit(r) * F.col("source_size")).cast("double") / F.col("target") for r in range(repeats)]
    timed = stage(timed.withColumn("finish", F.when(F.col("size") > 0, F.array(*rounds))))  # read again by each step of the cut
    cut = _cut(timed)
    taken = F.lit(0)
    if cut:
        time, key, source, doc_id = cut
        for r in range(repeats):
            taken = taken + F.when(_order(F.col("finish")[r], F.col("key"), F.col("source"), F.col("doc_id"), time, key, source, doc_id), 1).otherwise(0)
    taken = F.when(F.col("size") > 0, taken * F.col("size")).otherwise(0).cast("long")
    return timed.select("doc_id", *(["source"] if "source" in keep else []), "size", "source_size", "target", taken.alias("taken"), *(F.col(f"_k_{c}").alias(c) for c in extra))


def _order(time, key, source, doc_id, cut_time, cut_key, cut_source, cut_doc) -> Column:
    """Is the unit at or before the cut: by finish time, shuffle key, source (nulls last), doc_id (nulls first)."""
    here = F.struct(time, key, source.isNull(), F.coalesce(source, F.lit("")), doc_id.isNotNull(), F.coalesce(doc_id, F.lit(0)))
    there = F.struct(
        F.lit(cut_time), F.lit(cut_key).cast("long"), F.lit(cut_source is None), F.lit(cut_source or ""),
        F.lit(cut_doc is not None), F.lit(cut_doc or 0).cast("long"),
    )
    return here <= there


def _cut(timed: DataFrame) -> tuple | None:
    """The last unit, in order of finish times, whose words still fit the total budget.

    Only three rows reach the driver: the total, the tick and the unit.
    """
    units = timed.select("key", "source", "doc_id", "size", F.explode("finish").alias("time")).withColumn("tick", F.floor(F.col("time") * TICKS))
    per_tick = units.groupBy("tick").agg(F.sum("size").alias("words"))
    budget = timed.agg(F.sum("size")).first()[0]
    if not budget:
        return None
    run = per_tick.withColumn("span", F.floor(F.col("tick") / 256))
    spans = run.groupBy("span").agg(F.sum("words").alias("words")).withColumn("upto", F.sum("words").over(Window.orderBy("span")))
    span = spans.filter(F.col("upto") >= budget).orderBy("span").select("span", (F.col("upto") - F.col("words")).alias("before")).first()
    ticks = run.filter(F.col("span") == span["span"]).withColumn("upto", F.sum("words").over(Window.orderBy("tick")) + span["before"])
    tick = ticks.filter(F.col("upto") >= budget).orderBy("tick").select("tick", (F.col("upto") - F.col("words")).alias("before")).first()
    order = ["time", "key", F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_first()]
    last = (
        units.filter(F.col("tick") == tick["tick"])
        .withColumn("upto", F.sum("size").over(Window.orderBy(*order)) + tick["before"])
        .filter(F.col("upto") <= budget)
        .orderBy(F.col("time").desc(), F.col("key").desc(), F.col("source").desc_nulls_first(), F.col("doc_id").desc_nulls_last())
        .select("time", "key", "source", "doc_id")
        .first()
    )
    # No unit of that tick fits: the cut lies just before the tick.
    return tuple(last) if last else (tick["tick"] / TICKS, -1, "", None)
