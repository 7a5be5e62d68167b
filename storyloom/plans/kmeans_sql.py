"""k-means in plain SQL: the same starts, steps and stop as ``operators/kmeans.py``."""

from __future__ import annotations

from storyloom.operators.kmeans import DISTANCE_STEP, MAX_ITERATIONS, START_ROUNDS, TOLERANCE


def _chance(seed: int, step: int) -> str:
    return f"((('0x' || left(md5('{seed}:{step}:' || id), 13))::bigint + 0.5) / pow(2, 52))"


def _round(seed: int, step: int) -> str:
    each = f"ceil(((select k from ks) - 1) / {START_ROUNDS}.0)"
    return f"""s{step} as materialized (select * from s{step - 1} union all
        select id, (select count(*) from s{step - 1}) + place - 1, e from (
            select id, e, row_number() over (order by -ln({_chance(seed, step)}) / gap, id) place from (
                select id, any_value(e) e, min(floor(pow(list_distance(e, c), 2) / {DISTANCE_STEP} + 0.5)) gap
                from pts cross join (select c from s{step - 1}) group by id) where gap > 0)
        where place <= least({each}, (select k from ks) - 1 - {each} * {step - 1}))"""


def kmeans_sql(points: str, k: str, body: str, seed: int = 0) -> str:
    """``body`` over ``labels`` (id, label) and ``cents`` (label, c) of ``points`` (id, e); ``n`` in ``k`` counts the points."""
    rounds = ",\n".join(_round(seed, step) for step in range(1, START_ROUNDS + 1))
    nearest = """select id, any_value(e) e, min({'near': floor(pow(list_distance(e, c), 2) * 1e12 + 0.5), 'label': label}).label as label
        from pts cross join (select label, c from %s) group by id"""
    return f"""with recursive given as materialized ({points}),
    ks as materialized (select {k} k from (select count(*) n from given)),
    pts as materialized (select id, case when length > 0 then list_transform(e, lambda v: v * (1.0 / length)) else e end e
        from (select id, e, sqrt(list_inner_product(e, e)) length from given)),
    s0 as materialized (select id, cast(0 as bigint) label, e c from pts order by {_chance(seed, 0)}, id limit 1),
    {rounds},
    steps as (select 0 step, label, c, cast(1 as double) moved from s{START_ROUNDS} union all
        select step + 1, label, after, max(list_distance(after, c)) over () from (
            select step, label, c, coalesce(mean, c) after
            from (select * from steps where moved > {TOLERANCE} and step < {MAX_ITERATIONS}) left join (
                select label, list(v order by dim) mean from (
                    select label, dim, avg(v) v from (
                        select label, unnest(e) v, generate_subscripts(e, 1) dim from ({nearest % "steps"})) group by all)
                group by label) using (label))),
    rest as materialized (select label, c from steps where step = (select max(step) from steps)),
    labels as materialized (select id, label from ({nearest % "rest"})),
    cents as materialized (select label, case when length > 0 then list_transform(c, lambda v: v * (1.0 / length)) else c end c
        from (select label, c, sqrt(list_inner_product(c, c)) length from rest))
    {body}"""
