"""Sets that are close to a group of near copies, but not linked to it, meet the group once and not each of its members."""

import random

from storyloom.llm import dedup


def _texts(copies: int, close: int) -> dict[int, str]:
    """One text, copies with a changed last word, and texts with a part of their own: near, but under the threshold."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = {i: " ".join([*base[:-1], f"end{i}"]) for i in range(copies)}
    for i in range(close):
        rows[1000 + i] = " ".join([*base[:-60], *(f"own{i}x{j}" for j in range(60))])
    rows[3000] = " ".join([*base[: len(base) - 12], *(f"far{j}" for j in range(12))])
    return rows


def _brute(rows: dict[int, str]) -> dict[int, int]:
    sets = dict(zip(rows, map(set, dedup.shingle_sets(list(rows.values())))))
    least = {i: i for i in rows}
    for a in rows:
        for b in rows:
            if a < b and 100 * len(sets[a] & sets[b]) >= dedup.SIMILAR * len(sets[a] | sets[b]):
                lo, hi = sorted((least[a], least[b]))
                least = {k: lo if v == hi else v for k, v in least.items()}
    return least


def test_close_sets_ask_a_component_once(spark, monkeypatch):
    rows, asked = _texts(40, 30), []
    crossing = dedup._crossing

    def counted(members):
        pairs = dedup.stage(crossing(members))
        asked.append(pairs.count())
        return pairs

    monkeypatch.setattr(dedup, "_crossing", counted)
    out = dedup.near_copies(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == _brute(rows)
    # every two close texts at most, and each of them with the group: not 40 times
    assert asked[0] <= 30 * 29 // 2 + 31


def test_components_are_confirmed_on_whole_sets_in_blocks(spark, monkeypatch):
    rows = _texts(12, 5)
    prepared = dedup.prepare(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    sets = dedup.stage(prepared.select(dedup.F.col("doc_id").alias("rep"), "n", "text"))
    labels = spark.createDataFrame([(i, 0) for i in range(12)], "node long, component long")
    asks = spark.createDataFrame([(1000 + i, 0) for i in range(5)] + [(3000, 0), (1001, 1000)], "rep long, target long")
    for shingles, parts in ((1 << 20, 1000), (700, 2)):
        monkeypatch.setattr(dedup, "BLOCK_SHINGLES", shingles)
        monkeypatch.setattr(dedup, "ASKS", parts)
        links = dedup._confirmed(asks, labels, sets).collect()
        assert {r.a for r in links} == {3000} and {r.b for r in links} <= set(range(12))
