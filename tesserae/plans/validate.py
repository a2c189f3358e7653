"""Validation and repair queries over the tagged answers, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import validate as V
from ..operators.health import HARD_WORDS, NUMERIC_PATTERNS, SOFT_WORDS
from .tables import norm_sql, strip_sql, table


def _rows(spark: SparkSession, d: str) -> DataFrame:
    t = F.replace(F.lower(T.strip(F.coalesce("question_type", F.lit("?")))), F.lit("-"), F.lit("_"))
    return table(spark, d, "sft").select("sft_id", "answer", t.alias("question_type"), (F.col("answer_mode") == "analysis").alias("ea"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return V.validate(_rows(spark, d), "answer", "question_type", F.col("ea"))


def _mended(spark: SparkSession, d: str) -> DataFrame:
    return V.salvaged(_rows(spark, d), "answer", "question_type", F.col("ea"))


QUERIES = {
    "extract_sections": lambda spark, d: table(spark, d, "sft").select("sft_id", V.section(F.coalesce("answer", F.lit("")), "analysis").alias("analysis"), V.section(F.coalesce("answer", F.lit("")), "answer").alias("final")),
    "validate_answers": lambda spark, d: _judged(spark, d).select("sft_id", "is_valid", "label", F.array_join("warnings", ";").alias("warnings")),
    "validate_labels": lambda spark, d: _judged(spark, d).groupBy("question_type", "label").agg(F.count(F.lit(1)).alias("cnt")),
    "salvage_answers": lambda spark, d: _mended(spark, d).where("salvaged").select("sft_id", "new_answer", "label", "new_label", "recovered"),
    "salvage_stats": lambda spark, d: V.salvage_counts(_mended(spark, d)),
}


def _section(c: str, tag: str) -> str:
    return strip_sql(f"regexp_extract({c}, '<{tag}>(.*?)</{tag}>', 1, 's')")


def _risks(c: str) -> list[str]:
    out = [f"case when contains({c}, '{w}') then '{V.HARD}{w}' end" for w in HARD_WORDS]
    out += [f"case when contains({c}, '{w}') then '{V.SOFT}{w}' end" for w in SOFT_WORDS]
    return out + [f"case when regexp_matches({c}, '{p}') then '{V.NUMERIC}' end" for p in NUMERIC_PATTERNS]


def _judge(source: str, out: str) -> str:
    """CTEs that judge column a of a source (sft_id, a, qt, ea, ...)."""
    any_of = lambda c, words: "(" + " or ".join(f"contains({c}, '{w}')" for w in words) + ")"
    rule = lambda t: f"case when qt = '{t}' and not regexp_matches(ans, '{V.TYPE_RULES[t][0]}') then '{V.TYPE_RULES[t][1]}' end"
    steps = f"len(list_filter(string_split(ana, chr(10)), lambda x: regexp_matches({strip_sql('x')}, '^[0-9０-９]+\\.')))"
    analysis = [
        f"case when {steps} = 0 then '{V.NO_STEPS}' when {steps} > 3 then 'analysis 步骤数为 ' || {steps} || '，建议不超过 3 步' end",
        f"case when length(ana) < 20 then '{V.SHORT}' end", f"case when length(ana) > 220 then '{V.LONG}' end", f"case when {any_of('ana', V.META_REASONING)} then '{V.META}' end", *_risks("ana"),
    ]
    rest = [
        f"case when not ea and contains(a, '<analysis>') then '{V.DIRECT_TAG}' end", f"case when length(ans) > 40 then '{V.LONG_ANSWER}' end", *_risks("ans"),
        rule("unanswerable"), rule("ambiguous"), rule("counting"),
        f"case when qt in ('location', 'spatial_relation') and not ({any_of('ans', V.LOCATION_WORDS)} or {any_of('ana', V.LOCATION_WORDS)}) then '{V.NO_PLACE}' end", rule("existence"),
    ]
    warnings = ", ".join([f"case when ea then ({w}) end" for w in analysis] + rest)
    return f"""{out}_x as (select *, {_section('a', 'answer')} as ans, {_section('a', 'analysis')} as ana from {source}),
        {out}_f as (select *, case when not contains(a, '<answer>') or not contains(a, '</answer>') then '{V.NO_ANSWER_TAG}'
            when not regexp_matches(a, '<answer>.*?</answer>', 's') then '{V.NO_ANSWER}' when ans = '' then '{V.EMPTY_ANSWER}'
            when ea and (not contains(a, '<analysis>') or not contains(a, '</analysis>')) then '{V.NO_ANALYSIS_TAG}'
            when ea and not regexp_matches(a, '<analysis>.*?</analysis>', 's') then '{V.NO_ANALYSIS}' end as fail from {out}_x),
        {out}_w as (select *, case when fail is not null then [fail] else list_filter([{warnings}], lambda w: w is not null) end as ws from {out}_f),
        {out} as (select *, fail is null and len(list_filter(ws, lambda w: starts_with(w, '{V.HARD}') or w = '{V.NUMERIC}')) = 0 as ok,
            case when fail is not null then 'format_fail' when len(list_filter(ws, lambda w: starts_with(w, '{V.HARD}') or w = '{V.NUMERIC}')) = 0 then 'pass' else 'warning' end as label from {out}_w)"""


_IN = f"src as (select sft_id, coalesce(answer, '') as a, {norm_sql('question_type')} as qt, coalesce(answer_mode = 'analysis', true) as ea from sft)"
_R = "regexp_replace(a, '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+$', '')"
_FIX1 = "ea and contains(a, '<analysis>') and not contains(a, '</analysis>')"
_MEND = f"""m as (select sft_id, qt, ea, label as old_label, a as old_a, case when label = 'pass' or not contains(a, '<answer>') then a
        when ({_FIX1}) or not contains(a, '</answer>') then
            case when {_FIX1} then substr({_R}, 1, instr({_R}, '<answer>') - 1) || '</analysis>' || chr(10) || substr({_R}, instr({_R}, '<answer>')) else {_R} end
            || case when not contains(a, '</answer>') then '</answer>' else '' end
        else a end as a from j)"""
_ALL = f"with {_IN}, {_judge('src', 'j')}, {_MEND}, {_judge('m', 'k')}, s as (select *, old_label <> 'pass' and a <> old_a as mended from k)"

SQL = {
    "extract_sections": f"select sft_id, {_section('coalesce(answer, chr(32))', 'analysis')} as analysis, {_section('coalesce(answer, chr(32))', 'answer')} as final from sft",
    "validate_answers": f"with {_IN}, {_judge('src', 'j')} select sft_id, ok as is_valid, label, array_to_string(ws, ';') as warnings from j",
    "validate_labels": f"with {_IN}, {_judge('src', 'j')} select qt as question_type, label, count(*) as cnt from j group by 1, 2",
    "salvage_answers": f"{_ALL} select sft_id, a as new_answer, old_label as label, label as new_label, label = 'pass' as recovered from s where mended",
    "salvage_stats": f"{_ALL} select count(*) as total, count(*) filter (where mended) as salvaged, count(*) filter (where mended and label = 'pass') as recovered from s",
}
