"""DuckDB counterparts of the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

from storyloom.llm import quality as q
from storyloom.llm.chat import TRAINED, TURN, TURN_END
from storyloom.llm.mixing import MAX_REPEATS, WEIGHTS

_ESCAPED = r"[<\[]\\*(?:/?s>|/?SYS>>|/?INST\]|\|[A-Za-z_]+\|>)"


def _masked_chats() -> str:
    added = lambda c: f"len(regexp_extract_all({c}, '{_ESCAPED}'))"
    return f"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, '{TRAINED}', '</s>[INST] ok [/INST]')
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = '{TRAINED}'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = '{TRAINED}'), '')) as loss_sha256,
    cast(sum({len(TURN) + len(TURN_END) + 1} + length(role) + length(regexp_replace(role, '[^\\\\\\n]', '', 'g')) + {added('role')} + length(text) + {added('text')}) as bigint) as formatted_chars
from rows group by conv_id
"""


def _fair_mixing() -> str:
    return f"""
with sized as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size from documents
), keyed as (
    select *, cast('0x' || substr(md5('0|' || coalesce(cast(doc_id as varchar), '') || '|' || cast(size as varchar)), 1, 13) as bigint) as key from sized
), per_source as (
    select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighted as (
    select *, cast([{', '.join(map(str, WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as double) as w, cast(source_size as double) * {MAX_REPEATS} as cap from per_source
), leveled as (
    select *, (cast(sum(source_size) over () as double) - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
        / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as own from weighted
), targets as (
    select source, source_size, least(cap, coalesce((select max(own) filter (own <= cap / w) from leveled) * w, cap)) as target from leveled
), sent as (
    select k.*, t.source_size, t.target, sum(size) over (partition by k.source order by key, doc_id, size rows unbounded preceding) as upto
    from keyed k join targets t on k.source is not distinct from t.source
), units as (
    select doc_id, source, key, size, r, cast(upto + r * source_size as double) / target as time
    from sent, range({MAX_REPEATS}) as rounds(r) where size > 0
), ranked as (
    select *, sum(size) over (order by time, key, source nulls last, doc_id nulls first rows unbounded preceding) as run from units
), took as (
    select doc_id, source, key, size, sum(size) as taken from ranked where run <= (select sum(size) from sized) group by all
)
select s.doc_id, s.size, s.source_size, s.target, cast(coalesce(t.taken, 0) as bigint) as taken
from sent s left join took t on s.key = t.key and s.size = t.size and s.doc_id is not distinct from t.doc_id and s.source is not distinct from t.source
"""


def _distance(shares: str, reference: list[float]) -> str:
    ref = "[" + ", ".join(repr(float(x)) for x in reference) + "]"
    part = lambda a: f"(case when {a} > 0 then {a} * log2({a} / (({shares}[i] + {ref}[i]) / 2)) else 0 end)"
    return f"sqrt(greatest(list_sum(list_transform(range(1, {len(reference) + 1}), lambda i: ({part(f'{shares}[i]')} + {part(f'{ref}[i]')}) / 2)), 0))"


def _quality() -> str:
    count = lambda p: f"len(regexp_extract_all(t, '{p}'))"
    found = {c: count(p.replace("'", "''")) for c, p in q._COUNTED.items()}
    found |= {"beyond_ascii": "(strlen(t) - length(t))", "space": "(length(t) - word_chars)"}
    chars = "[" + ", ".join(f"cast({found[c]} as double)" for c in q.CHAR_CLASSES[:-1]) + "]"
    char_refs = [[x / sum(v) for x in v] for v in q.CHAR_SHARES.values()]
    every = sorted({v for words in q.COMMON_WORDS.values() for w in words for v in (w, w.capitalize())})
    listed = ", ".join(f"'{w}'" for w in every)
    common = {
        k: "list_transform([" + ", ".join(f"'{w}'" for w in words) + "], lambda w: cast(len(list_filter(found, lambda x: x = w)) as double))" for k, words in q.COMMON_WORDS.items()
    }
    word_far = ", ".join(_distance(f"s_{k}", [*w.values(), 1 - sum(w.values())]) for k, w in q.COMMON_WORDS.items())
    return f"""
with d as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
), split as (
    select *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d
), grams as (
    select rid, i, array_to_string(ws[i:i + 4], ' ') as gram from (select rid, ws, unnest(range(1, len(ws) - 3)) as i from split)
), marked as (
    select rid, i from (select rid, i, count(*) over (partition by rid, gram) as n from grams) where n > 1
), repeats as (
    select rid, sum(step) as n from (select rid, least(5, coalesce(lead(i) over (partition by rid order by i) - i, 5)) as step from marked) group by rid
), lined as (
    select rid, count(*) - count(distinct line) as n from (select rid, unnest(string_split(t, chr(10))) as line from d)
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by rid
), counted as (
    select s.rid, doc_id, t, ws, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
        cast({found['symbol']} as bigint) as n_symbols, cast(coalesce(l.n, 0) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words
    from split s left join lined l on l.rid = s.rid left join repeats r on r.rid = s.rid
), shaped as (
    select *, {chars} as cc, list_transform(list_filter(ws, lambda x: x in ({listed})), lambda x: lower(x)) as found from counted
), summed as (
    select *, list_sum(cc) as named, greatest(cast(length(t) as double), list_sum(cc)) as total, {', '.join(f'{v} as c_{k}' for k, v in common.items())} from shaped
), shared as (
    select *, list_transform(list_append(cc, total - named), lambda x: x / total) as cs,
        {', '.join(f'list_transform(list_append(c_{k}, len(ws) - list_sum(c_{k})), lambda x: x / len(ws)) as s_{k}' for k in common)}
    from summed
), judged as (
    select *, case when length(t) >= {q.MIN_CHARS} then least({', '.join(_distance('cs', r) for r in char_refs)}) else 0 end as char_far,
        case when n_words >= {q.MIN_WORDS} then least({word_far}) else 0 end as word_far,
        n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
    from shared
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not (char_far > {q.CHARS_FAR} or (char_far > {q.CHARS_OFF} and word_far > {q.WORDS_FAR})) as kept
from judged
"""


def _bag_ranking() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
with d as (
    select row_number() over () as rid, doc_id, {terms} as ts from documents
), sizes as (
    select count(*) filter (len(ts) > 0) as n_docs, cast(sum(len(ts)) as bigint) as n_terms from d
), counts as (
    select rid, term, count(*) as tf from (select rid, unnest(ts) as term from d) group by rid, term
), held as (
    select term, count(*) as df from counts group by term
), items as (
    select row_number() over () as iid, item_id, list_distinct({terms}) as ts from benchmark
), asked as (
    select iid, item_id, a.term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w
    from (select iid, item_id, unnest(ts) as term from items) a join held using (term), sizes
), normed as (
    select rid, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms as m from d, sizes
), scored as (
    select iid, item_id, rid, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
    from asked join counts using (term) join normed using (rid) group by all having sum(w) > 0
), ranked as (
    select *, cast(row_number() over (partition by iid order by score desc, doc_id nulls last) as integer) as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


ORACLES: dict[str, str] = {
    "op1_masked_chats": _masked_chats(),
    "op4_fair_mixing": _fair_mixing(),
    "op6_distribution_quality": _quality(),
    "op12_bag_ranking": _bag_ranking(),
}
