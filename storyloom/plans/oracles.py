"""The same results in plain SQL, for comparison with another engine."""

from __future__ import annotations

import re

from storyloom.functions.words import STOP_WORDS
from storyloom.plans.kmeans_sql import kmeans_sql

STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
LETTERS = r"'[\p{L}\p{N}]+'"
FROM = "timestamp '2024-01-01'"
TO = "timestamp '2024-02-05'"
BLANK = r"E' \t\n\r\f\x0b'"


def _days(later: str, earlier: str) -> str:
    return f"cast(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) as int)"


def _sentences(title: str, text: str) -> str:
    return (
        f"[{title}] || list_filter(list_transform(regexp_extract_all({text}, '[^.!?]+[.!?]*'), lambda s: trim(s, {BLANK})), "
        r"lambda s: not regexp_full_match(s, '([\p{L}\p{N}]+|[^\p{L}\p{N}])?'))"
    )


def _tokens(sentence: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({sentence}), {LETTERS}), "
        rf"lambda x: regexp_full_match(x, '\p{{L}}+') and not list_contains({STOP}, x))"
    )


GRAMS = "k || case when len(k) > 1 then list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1]) else [] end"


def _window_rank(partition: str) -> str:
    return f"row_number() over (partition by {partition} order by floor(score * 1e9 + 0.5) desc, term)"


CTES: dict[str, str] = {
    # articles
    "art": """select cast(doc_id as varchar) id, doc_id,
        timestamp '2024-01-01' + to_days(cast(doc_id % 35 as int)) + to_hours(cast(doc_id % 24 as int)) date,
        timestamp '2024-01-01' + to_days(cast(doc_id % 35 as int)) + to_hours(cast(doc_id % 24 as int)) + to_hours(1) created_at,
        trim(regexp_extract(text, '^[^.!?]+', 0)) title, text, lang, source,
        cast(regexp_extract(source, '[0-9]+$') as bigint) src
        from documents""",
    "sl": f"select id, date, cast(floor({_days('date', FROM)} / 7.0) as int) slide_id from art",
    "sent": f"""select id, date, cast(unnest(range(len(l))) as int) sent_idx, unnest(l) sentence
        from (select id, date, {_sentences('title', 'text')} l from art)""",
    "tok": f"select id, date, sent_idx, {_tokens('sentence')} k from sent",
    "stf": f"""select id, sent_idx, term, count(*) tf
        from (select id, sent_idx, unnest({GRAMS}) term from tok) group by all""",
    "atf": "select id, slide_id, term, cast(sum(tf) as bigint) tf from stf join sl using (id) group by all",
    # vectors
    "nvec": "select count(*) m from embeddings",
    "emb": "select vec_id, cast(unnest(embedding) as double) v, cast(generate_subscripts(embedding, 1) - 1 as int) dim from embeddings",
    "svid": "select id, sent_idx, (cast(id as bigint) * 7 + sent_idx) % (select m from nvec) vec_id from sent",
    "sv": "select id, sent_idx, dim, v from svid join emb using (vec_id)",
    # slides
    "sldf": "select slide_id, term, count(*) df from atf group by all",
    "ss": "select slide_id, n, l from (select slide_id, count(*) n from sl group by all) left join (select slide_id, sum(tf) l from atf group by all) using (slide_id)",
    "wst": """select s.slide_id, case when b.n > 0 then b.n else s.n end n,
        case when b.n > 0 then b.l / b.n else s.l / s.n end mean_length
        from ss s left join ss b on b.slide_id = s.slide_id - 1""",
    "wdf": """select w.slide_id, d.term,
        sum(exp(-(w.slide_id - d.slide_id) * 1.0 / least(w.slide_id + 1, 2)) * d.df) df, sum(d.df) plain,
        sum(case when d.slide_id = w.slide_id then d.df else 0 end) slide_rows
        from (select distinct slide_id from sl) w join sldf d on d.slide_id between w.slide_id - 1 and w.slide_id
        group by all having slide_rows > 0""",
    "idf": "select slide_id, term, n, mean_length, ln((n + 1.0) / (df + 1)) + 1 idf from wdf join wst using (slide_id)",
    "kw": "select id, slide_id, term, tf, tf * idf score from atf join idf using (slide_id, term)",
    "alen": "select id, sum(tf) dl from atf group by all",
    "kwb": """select id, term, (2.2 * x / (1.2 + x) + 1) * idf score from (
        select id, term, idf, tf / (0.25 + 0.75 * dl / mean_length) x
        from atf join idf using (slide_id, term) join alen using (id))""",
    "top": f"select id, term, score, {_window_rank('id')} rank from kw qualify rank <= 10",
    "sw": """select id, sent_idx, (coalesce(raw, 0) + 1e-5) / sum(coalesce(raw, 0) + 1e-5) over (partition by id) w
        from sent left join (select id, sent_idx, sum(tf * score) raw from stf join top using (id, term) group by all)
        using (id, sent_idx)""",
    "aemb": "select id, dim, sum(w * v) v from sw join sv using (id, sent_idx) group by all",
    "anorm": "select id, sqrt(sum(v * v)) nrm from aemb group by all",
    # given clusters
    "cen": "select vec_id cluster_id, dim, v c from emb where vec_id in (select src from art)",
    "mem": "select id, date, src cluster_id from art where date < timestamp '2024-01-15'",
    "outs": "select id, date from art where date >= timestamp '2024-01-15'",
    "est": "select cluster_id, date, dim, sum(v) s, count(*) n from mem join aemb using (id) group by all",
    "tst": "select cluster_id, date, term, sum(tf) tf from mem join atf using (id) group by all",
    "live": f"select * from est where {_days(TO, 'date')} - 1 < 28",
    "ctf": f"""select cluster_id, term, sum(exp(-delta / 28.0) * tf) tf from (
        select *, {_days(TO, 'date')} - 1 delta from tst) where delta < 28 group by all""",
    "cidf": """select term, ln(((select count(distinct cluster_id) from ctf) + 1.0) / (count(*) + 1)) + 1 idf
        from ctf group by term""",
    "thm0": f"select cluster_id, term, tf, score, {_window_rank('cluster_id')} rank from (select *, tf * idf score from ctf join cidf using (term)) qualify rank <= 10",
    "thm": "select cluster_id, rank, term, score, round_even(tf / sum(tf) over (partition by cluster_id), 5) prob from thm0",
    # time-weighted centres for all dates to assign and all clusters
    "odates": "select distinct date from outs",
    "twc": f"""select d.date, e.cluster_id, e.dim, sum(exp(-abs({_days('d.date', 'e.date')}) / 28.0) * s)
        / sum(exp(-abs({_days('d.date', 'e.date')}) / 28.0) * n) c
        from odates d cross join live e group by all""",
    "tcen": """select date, cluster_id, dim, c from twc union all
        select date, cluster_id, dim, c from odates cross join cen
        where cluster_id not in (select cluster_id from live)""",
    "tnorm": "select date, cluster_id, sqrt(sum(c * c)) nrm from tcen group by all",
    "cnorm": "select cluster_id, sqrt(sum(c * c)) nrm from cen group by all",
    "kk": "select count(distinct cluster_id) k from cen",
    # dense similarities
    "dstat": """select id, cluster_id, sum(v * c) / (any_value(a.nrm) * any_value(n.nrm)) sim
        from outs join aemb using (id) join cen using (dim) join anorm a using (id) join cnorm n using (cluster_id)
        group by all""",
    "dtime": """select id, cluster_id, sum(v * c) / (any_value(a.nrm) * any_value(n.nrm)) sim
        from outs join aemb using (id) join tcen using (date, dim) join anorm a using (id)
        join tnorm n using (date, cluster_id) group by all""",
    # theme similarities, in the dense form over all terms of a theme
    "hit": "select id, cluster_id, sent_idx, term, tf, score from outs join stf using (id) join thm using (term)",
    "raw": "select id, cluster_id, sent_idx, sum(tf * score) raw from hit group by all",
    "temb": "select id, cluster_id, dim, sum(raw * v) / sum(raw) v from raw join sv using (id, sent_idx) group by all",
    "ten": "select id, cluster_id, sqrt(sum(v * v)) nrm from temb group by all",
    "pq": """select id, cluster_id, term, prob / sum(prob) over (partition by id, cluster_id) p,
        coalesce(tf, 0) / sum(coalesce(tf, 0)) over (partition by id, cluster_id) q
        from (select distinct id, cluster_id from hit) join thm using (cluster_id) left join atf using (id, term)""",
    "js": """select id, cluster_id, 1 - sqrt(greatest(0.5 * sum(
        case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end), 0)) js
        from pq group by all""",
    "cost": """select id, cluster_id, greatest(sum(v * c) / (any_value(a.nrm) * any_value(n.nrm)), 0) cos
        from outs join temb using (id) join tcen using (date, cluster_id, dim) join ten a using (id, cluster_id)
        join tnorm n using (date, cluster_id) group by all""",
    "coss": """select id, cluster_id, greatest(sum(v * c) / (any_value(a.nrm) * any_value(n.nrm)), 0) cos
        from temb join cen using (cluster_id, dim) join ten a using (id, cluster_id) join cnorm n using (cluster_id)
        group by all""",
    "allp": "select id, cluster_id from outs cross join (select distinct cluster_id from cen)",
    "ttime": "select id, cluster_id, coalesce(cos * js, 0) sim from allp left join cost using (id, cluster_id) left join js using (id, cluster_id)",
    "tstat": "select id, cluster_id, coalesce(cos * js, 0) sim from allp left join coss using (id, cluster_id) left join js using (id, cluster_id)",
    # a finished run
    "clu": """select id, date, title, text, case when lang = 'en' then src else -1 end as cluster,
        case when lang = 'en' then length(text) / (length(text) + 1000.0) else 0 end sim,
        cast(id as bigint) % (select m from nvec) vec_id from art""",
    "kwt": """select cast(month(date) as int) window_id, src cluster_id, list_sort(list(distinct lang)) keywords
        from art group by all""",
    "cmean": "select cluster, dim, avg(v) c from clu join emb using (vec_id) group by all",
    "cosown": """select id, cluster, sum(v * c) / (sqrt(sum(v * v)) * sqrt(sum(c * c))) cos
        from clu join emb using (vec_id) join cmean using (cluster, dim) group by all""",
    "lab": """select cast(vec_id as varchar) id, label, case when vec_id % 11 = 0 then -1 else vec_id % 7 end as cluster,
        vec_id % 3 window_id, 0 one from embeddings""",
    # stored tables
    "chunk": "select cast(id as bigint) * 1000000 + sent_idx chunk_id, id source_article_id, sent_idx, sentence as text from sent",
    "cvec": """select cast(id as bigint) * 1000000 + sent_idx chunk_id, vec_id from svid
        where (cast(id as bigint) * 1000000 + sent_idx) % 11 <> 0""",
    "clus": """select src cluster_id, count(*) cluster_size, min(date) date_range_start, max(date) date_range_end,
        list_sort(list(distinct lang)) keywords, case when src % 3 = 0 then 'retired' else 'active' end status
        from art group by src""",
    "asg": """select id source_article_id, src cluster_id, 0.5 similarity_score, 'initial' assignment_type
        from art where date < timestamp '2024-01-15'""",
    "first": "select vec_id cluster_id, v fv from emb where dim = 0",
    "dwin": """select * replace (case when length(text) % 5 = 0 then 100 + length(text) % 2 else cluster end as cluster)
        from clu where date >= timestamp '2024-01-29'""",
}


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", text)))
    return [name for name in CTES if name in words]


def sql(body: str) -> str:
    """The body with the common tables it uses, directly or not, in front."""
    used: set[str] = set()

    def visit(text: str):
        for name in _needs(text):
            if name not in used:
                used.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{name} as materialized ({CTES[name]})" for name in CTES if name in used]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body


CLUSTER_ROW = "cluster_id, round(fv, 6) first_value, cluster_size, array_to_string(keywords, ',') keywords, date_range_start, date_range_end, status"


def _gate(sims: str) -> str:
    return f"""select id, case when round((1 - p) - pow(1 - 1.0 / (k + 1), 2), 12) > 0 then -1 else cluster_id end as cluster,
        case when round((1 - p) - pow(1 - 1.0 / (k + 1), 2), 12) > 0 then 0 else round(p, 6) end sim, round(p, 6) conf
        from (select id, cluster_id, exp(2 * sim) / sum(exp(2 * sim)) over (partition by id) p,
        row_number() over (partition by id order by floor(sim * 1e12 + 0.5) desc, cluster_id) r from {sims}), kk where r = 1"""


VECTORS = "select cast(vec_id as varchar) id, cast(embedding as double[]) e from embeddings"
METRIC_PARTS = """
    cells as (select {by}, label, cluster, count(*) n from lab group by all),
    ls as (select {by}, label, sum(n) a from cells group by all),
    cl as (select {by}, cluster, sum(n) b from cells group by all),
    tot as (select {by}, sum(n) t, sum(n * (n - 1) / 2) sb from cells group by all),
    hl as (select {by}, -sum(a / t * ln(a / t)) h, sum(a * (a - 1) / 2) sl from ls join tot using ({by}) group by all),
    hc as (select {by}, -sum(b / t * ln(b / t)) h, sum(b * (b - 1) / 2) sc from cl join tot using ({by}) group by all),
    mi as (select {by}, sum(n / t * ln(n * t / (a * b))) m, sum(n * n / b) / any_value(t) p, sum(n * n / a) / any_value(t) r
        from cells join ls using ({by}, label) join cl using ({by}, cluster) join tot using ({by}) group by all),
    em as (select {by}, sum(x / t * ln(t * x / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(t - a + 1) + lgamma(t - b + 1)
        - lgamma(t + 1) - lgamma(x + 1) - lgamma(a - x + 1) - lgamma(b - x + 1) - lgamma(t - a - b + x + 1))) e
        from (select {by}, a, b, t, unnest(range(cast(greatest(1, a + b - t) as bigint), cast(least(a, b) as bigint) + 1)) x
        from ls join cl using ({by}) join tot using ({by})) group by all),
    met as (select {by}, m / ((hl.h + hc.h) / 2) nmi, (m - e) / ((hl.h + hc.h) / 2 - e) ami,
        (t * (t - 1) / 2 + 2 * sb - sl - sc) / (t * (t - 1) / 2) ri,
        (sb - sl * sc / (t * (t - 1) / 2)) / ((sl + sc) / 2 - sl * sc / (t * (t - 1) / 2)) ari,
        p "precision", r recall, 2 * p * r / (p + r) fscore
        from tot join hl using ({by}) join hc using ({by}) join mi using ({by}) join em using ({by}))"""
SEVEN = ("nmi", "ami", "ri", "ari", "precision", "recall", "fscore")


def _metrics(by: str, tail: str) -> str:
    return f"with lab as ({CTES['lab']}),{METRIC_PARTS.format(by=by)}\n{tail}"


ORACLES: dict[str, str] = {
    "all_raw_articles": sql("select id, date, title, text from art"),
    "articles_of_last_days": sql("select id, date, title, text from art where created_at between timestamp '2024-01-26' and timestamp '2024-02-05 12:00:00'"),
    "articles_of_today": sql("select id, date, title from art where created_at >= timestamp '2024-02-03' and created_at < timestamp '2024-02-04'"),
    "unprocessed_articles": sql("select id, date, title from art where created_at >= timestamp '2024-01-06' and created_at <= timestamp '2024-02-05 12:00:00' and lang = 'en'"),
    "processed_articles_since": sql("select id source_article_id, date, title, created_at from art where date >= timestamp '2024-01-20' order by date desc, id"),
    "processed_articles_on_day": sql("select id source_article_id, date, title from art where date >= timestamp '2024-01-20' and date < timestamp '2024-01-21'"),
    "chunks_grouped_by_article": sql("select source_article_id, cast(sent_idx as int) place, chunk_id, text from chunk where source_article_id in (select id from art where date >= timestamp '2024-01-20')"),
    "chunk_vectors": sql("""select chunk_id, source_article_id, round(sqrt(sum(v * v)), 6) length, round(max(case when dim = 0 then v end), 6) first_value
        from chunk join cvec using (chunk_id) join emb using (vec_id) group by all"""),
    "assembled_sentences": sql(f"""select id, date, sent_idx, sentence, array_to_string({_tokens('sentence')}, ' ') tokens, length, first_value from (
        select c.source_article_id id, c.sent_idx, c.text sentence, round(sqrt(sum(v * v)), 6) length, round(max(case when dim = 0 then v end), 6) first_value
        from chunk c join cvec using (chunk_id) join emb using (vec_id) group by all
        union all
        select id, -1, title, round(sqrt(sum(v * v)), 6), round(max(case when dim = 0 then v end), 6) from (
            select source_article_id id, dim, avg(v) v from chunk join cvec using (chunk_id) join emb using (vec_id) group by all) join art using (id) group by id, title
        ) join (select id, date from art) using (id)"""),
    "json_dataset": sql("select id, date, sent_idx, sentence, cast(len(k) as int) n_tokens from sent join tok using (id, date, sent_idx)"),
    "upserted_articles": sql("""select id source_article_id, date, upper(title) title, lang from art where lang = 'en'
        union all select id, date, title, lang from art where lang <> 'en' and date < timestamp '2024-01-20'"""),
    "replaced_chunks": sql("""select chunk_id, source_article_id, sent_idx, text from chunk where source_article_id in (select id from art where lang <> 'en')
        or (source_article_id in (select id from art where lang = 'en') and not exists (select 1 from sent s where s.id = source_article_id and s.sent_idx > 0))
        union all select cast(id as bigint) * 1000000 + 500000 + sent_idx, id, sent_idx, sentence from sent join (select id, lang from art) using (id) where lang = 'en' and sent_idx > 0"""),
    "vector_metadata": sql("""select id source_article_id, length(left(sentence, 1000)) chars, left(sentence, 1000) as text, round(v, 6) first_value
        from sent join svid using (id, sent_idx) join emb using (vec_id) where dim = 0"""),
    "reingested_vectors": sql("""select id source_article_id, sent_idx, round(case when late then 2 * v else v end, 6) first_value from (
        select id, sent_idx, v, date >= timestamp '2024-02-02' and max(sent_idx) over (partition by id) > 0 late
        from sent join svid using (id, sent_idx) join emb using (vec_id) where dim = 0) where not late or sent_idx > 0"""),
    "chunk_id_uniqueness": sql("select count(*) chunks, count(distinct id) articles, 0 collisions from sent"),
    "active_clusters": sql(f"select {CLUSTER_ROW} from clus join first using (cluster_id) where status = 'active'"),
    "appended_assignments": sql("""select id source_article_id, src cluster_id,
        case when date >= timestamp '2024-01-10' then round(length(text) / 1e6, 6) else 0.5 end similarity_score,
        case when date >= timestamp '2024-01-10' then 'assigned' else 'initial' end assignment_type from art"""),
    "updated_centers": sql("""select cluster_id, round(fv * case when cluster_id < 10 then 2 else 1 end, 6) first_value, cluster_size,
        case when cluster_id < 10 and cluster_id % 2 = 0 then 'new' else array_to_string(keywords, ',') end keywords,
        date_range_start, date_range_end, status from clus join first using (cluster_id)"""),
    "assignment_lookups": sql("""select source_article_id, cluster_id from asg where cluster_id = 5
        union all select source_article_id, cluster_id from asg where source_article_id = '7'"""),
    "cluster_date_ranges": sql("""select cluster_id, round(fv, 6) first_value, cluster_size, array_to_string(keywords, ',') keywords,
        coalesce(a, date_range_start) date_range_start, coalesce(b, date_range_end) date_range_end, status
        from clus join first using (cluster_id) left join (select cluster_id, min(date) a, max(date) b from mem group by all) using (cluster_id)"""),
    "cluster_sizes": sql("""select cluster_id, round(fv, 6) first_value, coalesce(n, 0) cluster_size, array_to_string(keywords, ',') keywords,
        date_range_start, date_range_end, status from clus join first using (cluster_id)
        left join (select cluster_id, count(*) n from asg group by all) using (cluster_id)"""),
    "saved_run_clusters": sql(f"""select {CLUSTER_ROW} from clus join first using (cluster_id) union all
        select (select max(cluster_id) from clus) + row_number() over (order by cluster), round(fv, 6), n, coalesce(array_to_string(k, ','), ''), a, b, 'active'
        from (select cluster, count(*) n, min(date) a, max(date) b from clu where cluster >= 0 group by all)
        join (select cluster, c fv from cmean where dim = 0) using (cluster)
        left join (select cluster_id, arg_max(keywords, window_id) k from kwt group by all) w on w.cluster_id = cluster"""),
    "saved_run_assignments": sql("""select source_article_id, cluster_id, similarity_score, assignment_type from asg
        where true union all
        select id, case when cluster >= 0 then (select max(cluster_id) from clus) + dense_rank() over (order by case when cluster < 0 then 1000000 else cluster end) end,
        round(sim, 6), case when cluster >= 0 then 'initial' else 'outlier' end from clu"""),
    "saved_daily_clusters": sql("""select cluster_id, round(fv, 6) first_value,
        case when cluster_id in (select cluster from dwin) then coalesce(n, 0) else cluster_size end cluster_size,
        array_to_string(keywords, ',') keywords,
        case when cluster_id in (select cluster from dwin) then coalesce(a, date_range_start) else date_range_start end date_range_start,
        case when cluster_id in (select cluster from dwin) then coalesce(b, date_range_end) else date_range_end end date_range_end, status
        from clus join first using (cluster_id) left join (
            select cluster_id, count(*) n, min(date) a, max(date) b from (
                select id, cluster_id, date from mem union select id, cluster, date from dwin where cluster between 0 and 99) group by all) using (cluster_id)
        union all select cluster, round(fv, 6), count(*), '', min(date), max(date), 'active'
        from dwin join (select cluster_id + 100 as cluster, fv from first) using (cluster) where cluster >= 100 group by cluster, fv"""),
    "saved_daily_assignments": sql("""select source_article_id, cluster_id, similarity_score, assignment_type from asg
        union all select id, case when cluster >= 0 then cluster end, case when cluster >= 100 then 0 else round(sim, 6) end,
        case when cluster < 0 then 'outlier' when cluster >= 100 then 'initial' else 'daily' end from dwin"""),
    "csv_results": sql("select cluster, count(*) size, round(avg(sim), 6) avg_sim, min(date) earliest, max(date) latest from clu group by all"),
    "limited_load": sql("select id, date, title from art order by id limit 100"),
    "fetched_articles": sql(f"""select id, id source_article_id, date, created_at, title, cast(n + 1 as int) sentence_counts,
        cast(nt + len({_tokens('title')}) as int) n_tokens, cast(n + 1 as int) n_vectors, last_sentence from art join (
            select source_article_id id, count(*) n, sum(len({_tokens('text')})) nt, arg_max(text, sent_idx) last_sentence
            from chunk join cvec using (chunk_id) group by all) using (id) where date >= timestamp '2024-01-20'"""),
    # projections, filters, scalars
    "concatenated_slides": sql("select slide_id, count(*) n, min(date) first_date from sl group by all"),
    "null_text_counts": sql("select count(*) articles, count(*) filter (lang = 'fr') null_titles, count(*) filter (lang = 'de') null_texts from art"),
    "null_text_cleaned": sql("select id, case when lang = 'fr' then '' else title end title, case when lang = 'de' then 0 else length(text) end chars from art"),
    "articles_in_date_range": sql("select id, date from art where date >= timestamp '2024-01-05' and date <= timestamp '2024-01-25 23:59:59'"),
    "slide_numbers": sql("select id, date, slide_id from sl"),
    "parsed_dates": sql("select id, date from art where lang <> 'fr'"),
    "membership_split": sql("select case when cluster >= 0 then 'live' else 'outlier' end side, count(*) n, count(distinct cluster) clusters from clu group by all"),
    "assignment_rows": sql("""select id source_article_id, case when cluster >= 0 then cluster end cluster_id,
        case when length(text) % 7 in (0, 1) then 0 else round(sim, 6) end similarity_score,
        case when cluster >= 0 then 'initial' else 'outlier' end assignment_type
        from clu where cast(id as bigint) % 2 = 0 or length(id) > 1"""),
    "json_vectors": sql("select vec_id, dim, round(v, 6) \"value\" from emb"),
    "decay_and_rounding": sql(f"""select id, age, round(exp(-age / 14.0), 6) weight, round(ln(length(text) + 1.0), 6) log_chars,
        round_even(exp(-age / 14.0), 5) rounded from (select id, text, {_days(TO, 'date')} age from art)"""),
    "clean_token_counts": sql(rf"""select token, count(*) n from (select lower(trim(unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')))) token from art)
        where regexp_full_match(token, '\p{{L}}+') and not list_contains({STOP}, token) group by all"""),
    # text and terms
    "sentence_split": sql("select id, date, sent_idx, sentence from sent"),
    "sentence_counts": sql("select id, count(*) sentence_counts, max(case when sent_idx = 0 then sentence end) title_sentence from sent group by all"),
    "sentence_tokens": sql("select id, sent_idx, cast(unnest(range(len(k))) as int) place, unnest(k) token from tok"),
    "sentence_term_counts": sql("select id, sent_idx, term, tf from stf"),
    "article_term_counts": sql("select id, term, tf from atf"),
    "vocabulary_by_length": sql("select cast(len(string_split(term, ' ')) as int) words, count(distinct term) terms, min(term) first_term, max(term) last_term from atf group by all"),
    "sentence_vector_lookup": sql("select id, sent_idx, round(sqrt(sum(v * v)), 6) length, round(max(case when dim = 1 then v end), 6) second_value from sv group by all"),
    "preprocessed_articles": sql("""select id, date, cast(count(*) as int) sentence_counts, cast(sum(len(k)) as int) n_tokens, cast(count(*) as int) n_vectors,
        round(arg_max(v, sent_idx), 6) last_first_value, arg_max(sentence, sent_idx) last_sentence
        from sent join tok using (id, date, sent_idx) join sv using (id, sent_idx) where dim = 0 group by id, date"""),
    "clustering_dataset": sql(f"""with rows_ as (select id, date, sent_idx, {_tokens('s')} k from (
            select source_article_id id, sent_idx, text s from chunk join cvec using (chunk_id)
            union all select id, -1, title from art where id in (select source_article_id from chunk join cvec using (chunk_id)))
            join (select id, date from art) using (id) where date >= timestamp '2024-01-03' and date <= timestamp '2024-02-02 23:59:59')
        select id, date, count(*) sentences, coalesce(max(n), 0) terms, coalesce(max(t), 0) total_tf from rows_ left join (
            select id, count(distinct term) n, count(*) t from (select id, unnest({GRAMS}) term from rows_) group by all) using (id)
        group by id, date""").replace("\nwith rows_ as (", ",\nrows_ as (", 1),
    # term statistics and article vectors
    "slide_term_frequency": sql("select slide_id, term, df from sldf"),
    "decayed_window_frequency": sql("select slide_id, term, round(df, 6) df from wdf"),
    "plain_window_frequency": sql("select slide_id, term, round(plain, 6) df from wdf"),
    "inverse_frequency": sql("select slide_id, term, n, round(idf, 6) idf from idf"),
    "tfidf_scores": sql("select id, term, round(score, 6) score from kw"),
    "bm25_scores": sql("select id, term, round(score, 6) score from kwb"),
    "article_keywords": sql("select id, cast(rank as int) rank, term, round(score, 6) score from top"),
    "sentence_theme_weights": sql("select id, sent_idx, round(w, 6) weight from sw"),
    "theme_weighted_article_vectors": sql("select id, dim, round(v, 6) \"value\" from aemb"),
    "mean_vectors_of_articles": sql("select id, dim, round(avg(v), 6) \"value\" from sv group by all"),
    # clustering
    "assign_theme_time": sql(_gate("ttime")),
    "assign_theme_only": sql(_gate("tstat")),
    "assign_time_only": sql(_gate("dtime")),
    "assign_plain": sql(_gate("dstat")),
    "cosine_to_all_centers": sql("""select id, count(*) k, round(sum(exp(2 * s)), 6) sum_exp, round(sum(s), 6) sum_cos, round(max(s), 6) best_sim from (
        select id, cluster_id, sum(v * c) / (any_value(a.nrm) * any_value(n.nrm)) s from aemb join cen using (dim)
        join anorm a using (id) join cnorm n using (cluster_id) group by all) group by id"""),
    "centers_at_article_dates": sql("""select date, cluster_id, dim, round(c, 6) "value" from tcen join (
        select distinct o.date, m.cluster_id from outs o join mem m on hour(o.date) = hour(m.date)) using (date, cluster_id)"""),
    "cluster_specific_vectors": sql("select id, cluster_id, round(sqrt(sum(v * v)), 6) length, round(max(case when dim = 0 then v end), 6) first_value from temb group by all"),
    "jensen_shannon_similarity": sql("select id, cluster_id, round(js, 6) js_sim from js"),
    "combined_similarity": sql("select id, cluster_id, round(cos, 6) cos, round(cos * js, 6) sim from cost join js using (id, cluster_id)"),
    "replaced_embeddings": sql(f"""with g as ({_gate('ttime')}) select id, a.dim, round(case when t.v is null then a.v else t.v end, 6) "value"
        from g join aemb a using (id) left join temb t on t.id = g.id and t.cluster_id = g.cluster and t.dim = a.dim""").replace("\nwith g as (", ",\ng as (", 1),
    "merged_vector_state": sql(f"""select cluster_id, date, n, round(sqrt(sum(s * s)), 6) length from (
        select src cluster_id, date, dim, sum(v) s, count(*) n from art join aemb using (id) group by all)
        where {_days(TO, 'date')} - 1 < 28 group by all"""),
    "merged_term_state": sql(f"""select src cluster_id, date, term, cast(sum(tf) as bigint) tf from art join atf using (id)
        where {_days(TO, 'date')} - 1 < 28 group by all"""),
    "decayed_themes_tfidf": sql("select cluster_id, cast(rank as int) rank, term, round(score, 6) score, prob from thm"),
    "plain_themes_bm25": sql(f"""with pc as (select cluster_id, term, sum(tf) tf from mem join atf using (id) group by all),
        st as (select count(distinct cluster_id) k, sum(tf) / count(distinct cluster_id) avgdl from pc),
        dl as (select cluster_id, sum(tf) l from pc group by all),
        df as (select term, count(*) df from pc group by all),
        x as (select cluster_id, term, tf, tf / (0.25 + 0.75 * l / avgdl) x, ln((k + 1.0) / (df + 1)) + 1 idf from pc join dl using (cluster_id) join df using (term), st),
        y as (select *, (2.2 * x / (1.2 + x) + 1) * idf score from x)
        select cluster_id, cast({_window_rank('cluster_id')} as int) rank, term, round(score, 6) score,
        round_even(tf / sum(tf) over (partition by cluster_id), 5) prob from (select * from y qualify {_window_rank('cluster_id')} <= 10)
        """).replace("\nwith pc as (", ",\npc as (", 1),
    "keyword_history_rows": sql("select 3 window_id, cluster_id, string_agg(term, ',' order by rank) keywords from thm group by all"),
    "spherical_kmeans_labels": kmeans_sql(VECTORS, "n // 50", """select label, count(*) size, round(sqrt(list_inner_product(any_value(c), any_value(c))), 6) center_length
        from labels join cents using (label) group by label"""),
    "spherical_kmeans_members": kmeans_sql(VECTORS, "n // 50", "select id, label from labels"),
    "spherical_kmeans_centers": kmeans_sql(VECTORS, "n // 50", """select label, cast(generate_subscripts(c, 1) - 1 as int) dim, round(unnest(c), 6) "value" from cents"""),
    "initial_clusters": kmeans_sql(sql("select id, list(v order by dim) e from aemb join sl using (id) where slide_id = 0 group by id"), "n // 6", """
        select cluster, count(*) size, round(avg(sim), 6) avg_sim from (
            select case when round((1 - p) - pow(1 - 1.0 / (k + 1), 4), 12) > 0 then -1 else label end as cluster,
            case when round((1 - p) - pow(1 - 1.0 / (k + 1), 4), 12) > 0 then 0 else p end sim from (
                select label, exp(4 * s) / sum(exp(4 * s)) over (partition by id) p, count(*) over (partition by id) k,
                row_number() over (partition by id order by floor(s * 1e12 + 0.5) desc, label) place
                from (select id, label, list_cosine_similarity(e, c) s from given cross join cents)) where place = 1)
        group by cluster"""),
    "outlier_groups": kmeans_sql(sql("select id, list(v order by dim) e from aemb group by id"), "n // 6", """
        select 19 + row_number() over (order by label) as cluster, size
        from (select label, count(*) size from labels group by label having count(*) >= 6)"""),
    "nearest_centers": sql("""select id, cluster_id, round(s, 6) cos from (select id, cluster_id, sum(v * c) / (any_value(a.nrm) * any_value(n.nrm)) s
        from aemb join cen using (dim) join anorm a using (id) join cnorm n using (cluster_id) group by all)
        qualify row_number() over (partition by id order by floor(s * 1e12 + 0.5) desc, cluster_id) = 1"""),
    "rebuilt_state": sql("""select cluster_id, date, n, length, total_tf, terms from (
        select cluster_id, date, n, round(sqrt(sum(s * s)), 6) length from (
            select cluster_id, date_trunc('day', date)::timestamp date, dim, sum(v) s, count(*) n from mem join aemb using (id) where date_trunc('day', date) > timestamp '2024-01-08' group by all) group by all)
        join (select cluster_id, date_trunc('day', date)::timestamp date, cast(sum(tf) as bigint) total_tf, count(distinct term) terms from mem join atf using (id) group by all) using (cluster_id, date)"""),
    "window_members": sql("select * from (select id, slide_id, cast(unnest([slide_id, slide_id + 1]) as int) window_id from sl) where window_id < 5"),
    # reports
    "cluster_summaries": sql("select cluster, count(*) size, round(avg(sim), 6) avg_sim, min(date) earliest, max(date) latest from clu group by all having size >= 2"),
    "best_clusters": sql("""select cluster, cast(row_number() over (partition by cluster order by sim desc, id) as int) place, id, date, title, round(sim, 6) sim, size, round(avg_sim, 6) avg_sim
        from clu join (select cluster, count(*) size, avg(sim) avg_sim from clu group by all having size >= 2 order by avg_sim desc, cluster limit 5) using (cluster)
        qualify place <= 15"""),
    "one_cluster": sql("select id, date, round(sim, 6) sim, title from clu where cluster = 3 order by clu.sim desc, id limit 15"),
    "cluster_metadata_rows": sql("""select cluster cluster_id, first_value, length, n cluster_size, coalesce(array_to_string(k, ','), '') keywords, a date_range_start, b date_range_end,
        'active' status, 0.7 similarity_threshold from (select cluster, count(*) n, min(date) a, max(date) b from clu where cluster >= 0 group by all)
        join (select cluster, round(max(case when dim = 0 then c end), 6) first_value, round(sqrt(sum(c * c)), 6) length from cmean group by all) using (cluster)
        left join (select cluster_id, arg_max(keywords, window_id) k from kwt group by all) w on w.cluster_id = cluster"""),
    "coherence": sql("""select round(avg(cos), 3) mean_cos, round(avg(case when cluster = -1 then 1 else 0 end), 3) outlier_pct,
        any_value(g) gini_size from cosown, (select round(sum(abs(a.s - b.s)) / (2 * count(distinct a.cluster) * (select sum(s) from z)), 3) g from z a cross join z b)""").replace(
        "\nselect round(avg(cos)", ",\nz as (select cluster, count(*) s from clu where cluster <> -1 group by all)\nselect round(avg(cos)", 1),
    "size_inequality": sql("""select round(sum(abs(a.s - b.s)) / (2 * count(distinct a.cluster) * (select sum(s) from z)), 6) gini_size from z a cross join z b, (select 1 from clu limit 1)""").replace(
        "\nselect round(sum(abs", ",\nz as (select cluster, count(*) s from clu where cluster <> -1 group by all)\nselect round(sum(abs", 1),
    "mean_of_cluster_means": sql("select round(avg(a), 6) mean_sim from (select avg(sim) a from clu group by cluster)"),
    "run_totals": sql("select count(*) articles, count(*) filter (cluster >= 0) clustered, count(*) filter (cluster < 0) outliers, count(distinct case when cluster >= 0 then cluster end) clusters from clu"),
    # evaluation
    "class_precision_recall": _metrics("one", """select 'precision' kind, cluster \"key\", cast(any_value(b) as bigint) size, round(sum(n * n) / (any_value(b) * any_value(b)), 6) \"value\"
        from cells join cl using (one, cluster) group by cluster union all
        select 'recall', label, cast(any_value(a) as bigint), round(sum(n * n) / (any_value(a) * any_value(a)), 6) from cells join ls using (one, label) group by label"""),
    "b_cubed": _metrics("one", """, pc as (select avg(v) p from (select sum(n * n) / (any_value(b) * any_value(b)) v from cells join cl using (one, cluster) group by cluster)),
        rc as (select avg(v) r from (select sum(n * n) / (any_value(a) * any_value(a)) v from cells join ls using (one, label) group by label))
        select 'element' variant, round(fscore, 6) fscore, round("precision", 6) "precision", round(recall, 6) recall from met union all
        select 'class', round(2 * p * r / (p + r), 6), round(p, 6), round(r, 6) from pc, rc union all
        select 'beta2', round(5 * "precision" * recall / (4 * "precision" + recall), 6), round("precision", 6), round(recall, 6) from met"""),
    "quality_metrics": _metrics("one", "select " + ", ".join(f'round("{m}", 6) "{m}"' for m in SEVEN) + " from met"),
    "mean_window_metrics": _metrics("window_id", "select " + ", ".join(f'round(avg("{m}"), 6) "{m}"' for m in SEVEN) + " from met"),
    # streaming
    "streamed_term_windows": sql("""select w.a window_start, w.a + interval 14 day window_end, term, count(*) df
        from (select distinct id, date, term from stf join (select id, date from art) using (id)) t
        join (select timestamp '2023-12-25' + to_days(cast(7 * i as int)) a from range(0, 6) g(i)) w on t.date >= w.a and t.date < w.a + interval 14 day
        where w.a + interval 14 day <= (select max(date) - interval 1 day from art) group by all"""),
    "streamed_ingest": sql("""select id source_article_id, date, cast(count(*) as int) sentence_counts, count(*) chunks, sum(length(sentence))::bigint chars
        from sent group by id, date"""),
}
