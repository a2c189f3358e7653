"""Health queries over the training answers, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import health as H
from .tables import PYWS, table


def _s(spark: SparkSession, d: str) -> DataFrame:
    return H.samples(table(spark, d, "sft"), "sft_id", "question_type", "question", "answer")


def _query(f):
    return lambda spark, d: f(_s(spark, d))


def _d(spark: SparkSession, d: str) -> DataFrame:
    """The same over the documents: their kind as type, title as question, text as answer."""
    return H.samples(table(spark, d, "documents"), "doc_id", "doc_kind", "title", "text")


QUERIES = {
    "health_risk_words_of_documents": lambda spark, d: H.risk_words(_d(spark, d)),
    "health_risk_rows_of_documents": lambda spark, d: H.risk_rows(_d(spark, d)),
    "health_type_dist": _query(H.type_distribution),
    "health_entropy": _query(H.entropy),
    "health_prefix_topn": _query(H.prefix_top),
    "health_top3_share": _query(H.top3_share),
    "health_opening_topn": _query(H.opening_top),
    "health_opening_red": _query(H.opening_red),
    "health_length_overall": _query(H.length_overall),
    "health_length_by_type": _query(H.length_by_type),
    "health_tag_residual": _query(H.tag_residual),
    "health_risk_words": _query(H.risk_words),
    "health_risk_rows": _query(H.risk_rows),
    "health_charset_rates": _query(H.charset),
    "health_verdict": _query(H.verdict),
    "health_summary": _query(H.summary),
    "health_report": _query(H.report),
}

S = f"""with s as (
    select sft_id as pos, coalesce(question_type, '?') as qt,
        regexp_replace(replace(coalesce(question, ''), '<image>', ''), '^[{PYWS}]+|[{PYWS}]+$', '', 'g') as q,
        coalesce(answer, '') as a
    from sft)"""
_SCHEDULE = ", ".join(f"('{t}', {w}::double)" for t, w in H.SCHEDULE.items())
_P90 = "least(count(*) - 1, cast(floor(count(*) * 0.9::double) as bigint))"


def _top(expr: str, n: int) -> str:
    return f"select {expr} as value, count(*) as cnt, round(count(*) / (select count(*) from s)::double, 9) as share, min(pos) as p from s group by 1 order by 2 desc, 4, 1 limit {n}"


_ENTROPY = "select count(*) as k, sum(n) as t, sum(n * ln(n)) as x from (select count(*) as n from s group by qt)"
_WORDS = ", ".join(f"'{w}'" for w in H.HARD_WORDS)
_NUMERIC = "|".join(H.NUMERIC_PATTERNS)
_HITS = f"""e as (
    select pos, i, w from (select s.pos, s.a, u.w, u.i from s, (select unnest([{_WORDS}]) as w, generate_subscripts([{_WORDS}], 1) as i) u) where contains(a, w)
    union all select pos, 100, '{H.NUMERIC_HIT}' from s where regexp_matches(a, '{_NUMERIC}'))"""
_CHARS = r"""select sum(len(regexp_extract_all(a, '[\x{4e00}-\x{9fff}]'))) as cjk, sum(len(regexp_extract_all(a, '[\x{0400}-\x{04ff}]'))) as cyr, sum(length(a)) as n from s"""
_LEN = f"""round(avg(len), 6) as mean_len, median(len)::double as median_len, max(len) as max_len"""

_D = f"""with s as (
    select doc_id as pos, coalesce(doc_kind, '?') as qt, coalesce(title, '') as q, coalesce(text, '') as a from documents)"""

SQL = {
    "health_risk_words_of_documents": f"{_D}, {_HITS} select w as word, count(*) as cnt from e group by w order by 2 desc, min(pos), min(i) limit 12",
    "health_risk_rows_of_documents": f"{_D}, {_HITS} select (select count(distinct pos) from e) as risk_rows, round((select count(distinct pos) from e) / count(*)::double, 9) as risk_share from s",
    "health_type_dist": f"""{S}, g(t, target) as (values {_SCHEDULE}), n as (select qt, count(*) as n from s group by qt)
        select coalesce(qt, t) as question_type, coalesce(n, 0) as cnt, round(coalesce(n, 0) / (select count(*) from s)::double, 9) as share, target,
            case when target is null then '非目标' when coalesce(n, 0) / (select count(*) from s)::double > target * 1.5 then '偏高'
                when coalesce(n, 0) / (select count(*) from s)::double < target * 0.5 then '偏低' else '' end as flag
        from n full join g on qt = t""",
    "health_entropy": f"""{S}, w as ({_ENTROPY}), v as (select case when k <= 1 then 1.0::double else (ln(t) - x / t) / ln(k) end as e from w)
        select round(e, 9) as entropy, e < {H.ENTROPY_RED} as red from v""",
    "health_prefix_topn": f"{S} select value, cnt, share from ({_top('substr(q, 1, 6)', 12)})",
    "health_top3_share": f"{S}, t as ({_top('substr(q, 1, 6)', 3)}) select cast(sum(cnt) as bigint) as top3_cnt, round(sum(share), 6) as top3_share, sum(share) > 0.60 as red from t",
    "health_opening_topn": f"{S} select value, cnt, share from ({_top('substr(a, 1, 12)', 12)})",
    "health_opening_red": f"{S}, t as ({_top('substr(a, 1, 12)', 12)}) select round(max(share), 6) as max_share, max(share) > 0.20 as red from t",
    "health_length_overall": f"""{S}, l as (select length(a) as len from s), o as (select len, row_number() over (order by len) - 1 as i from l)
        select count(*) as cnt, {_LEN}, (select len from o where i = (select {_P90} from l)) as p90_len,
            (select len from o where i = (select {_P90} from l)) > 120 as long_warning from l""",
    "health_length_by_type": f"{S} select qt as question_type, count(*) as cnt, round(avg(length(a)), 6) as mean_len, median(length(a))::double as median_len, max(length(a)) as max_len from s group by qt",
    "health_tag_residual": f"{S} select count(*) filter (where regexp_matches(a, '</?(analysis|answer)>')) as tag_rows from s",
    "health_risk_words": f"{S}, {_HITS} select w as word, count(*) as cnt from e group by w order by 2 desc, min(pos), min(i) limit 12",
    "health_risk_rows": f"{S}, {_HITS} select (select count(distinct pos) from e) as risk_rows, round((select count(distinct pos) from e) / count(*)::double, 9) as risk_share from s",
    "health_charset_rates": f"{S}, t as ({_CHARS}) select round(cjk / n::double, 9) as cjk_rate, round(cyr / n::double, 9) as cyr_rate, cyr / n::double > 0.005 as warning from t",
    "health_verdict": f"""{S}, w as ({_ENTROPY}), p as ({_top('substr(q, 1, 6)', 3)}), o as ({_top('substr(a, 1, 12)', 12)}),
        v as (select (select case when k <= 1 then 1.0::double else (ln(t) - x / t) / ln(k) end < 0.7 from w) as entropy_red,
            (select sum(share) > 0.60 from p) as prefix_red, (select max(share) > 0.20 from o) as opening_red)
        select *, entropy_red or prefix_red or opening_red as red from v""",
    "health_summary": f"""{S}, w as ({_ENTROPY}), p as ({_top('substr(q, 1, 6)', 3)}), o as ({_top('substr(a, 1, 12)', 12)}), {_HITS}, t as ({_CHARS}),
        l as (select length(a) as len from s), r as (select len, row_number() over (order by len) - 1 as i from l)
        select 'n' as metric, count(*)::double as value from l union all select 'mean', round(avg(len), 6) from l union all select 'median', median(len)::double from l
        union all select 'p90', (select len from r where i = (select {_P90} from l))::double union all select 'max', max(len)::double from l
        union all select 'entropy', round(case when k <= 1 then 1.0::double else (ln(t) - x / t) / ln(k) end, 9) from w
        union all select 'top3_share', round(sum(share), 6) from p union all select 'max_opening_share', round(max(share), 6) from o
        union all select 'tag_rows', (count(*) filter (where regexp_matches(a, '</?(analysis|answer)>')))::double from s
        union all select 'risk_rows', (select count(distinct pos) from e)::double
        union all select 'cjk_rate', round(cjk / n::double, 9) from t union all select 'cyr_rate', round(cyr / n::double, 9) from t""",
}
SQL["health_report"] = f"select metric || ': ' || printf('%.6f', value) as line from ({SQL['health_summary']})"
