"""Sampling queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sampling as S
from ..operators.health import SCHEDULE
from ..sources.images import listed
from .tables import norm_sql, table

#: Quotas of the per-dataset sample.
SPEC = "SECOND=200, LEVIR-CD+=150,EBD=0,"
RATIO = 0.05


def _typed(spark: SparkSession, d: str) -> DataFrame:
    """(sft_id, question_type, source_dataset) with types written in one way."""
    t = F.replace(F.lower(T.strip(F.coalesce("question_type", F.lit("?")))), F.lit("-"), F.lit("_"))
    return table(spark, d, "sft").select("sft_id", t.alias("question_type"), "source_dataset", "image")


def _images(spark: SparkSession, d: str) -> DataFrame:
    return listed(table(spark, d, "manifest"), "image_path")


def _ebd(df: DataFrame) -> DataFrame:
    return df.where("dataset = 'EBD'").withColumn("disaster", T.parent_folder(F.col("image_path"), 2))


QUERIES = {
    "scan_listing": _images,
    "sample_global": lambda spark, d: S.uniform(_images(spark, d), 80, "image_path", 42),
    "sample_per_group": lambda spark, d: S.per_group(_images(spark, d), "dataset", 20, "image_path", 42),
    "sample_spec": lambda spark, d: S.with_spec(_images(spark, d), "dataset", S.parse_spec(SPEC), "image_path", 42),
    "sample_nested_group": lambda spark, d: S.per_group(_ebd(_images(spark, d)), "disaster", 5, "image_path", 42),
    "assign_types": lambda spark, d: S.assign_types(_images(spark, d), "image_path", 3, 6, 42),
    "plan_text": lambda spark, d: S.plan_text(S.assign_types(_images(spark, d), "image_path", 3, 6, 42), "image_path"),
    "rebalance_caps": lambda spark, d: S.caps(_typed(spark, d)),
    "rebalance_rows": lambda spark, d: S.rebalance(_typed(spark, d), "sft_id").select("sft_id", "question_type"),
    "balanced_sample": lambda spark, d: S.balanced(_typed(spark, d), "question_type", 500, "sft_id").select("sft_id", "question_type"),
    "balanced_by_group": lambda spark, d: S.balanced(_typed(spark, d), "question_type", 90, "sft_id", by=("source_dataset",)).select("sft_id", "question_type", "source_dataset"),
    "first_n_per_group": lambda spark, d: S.first_n(_typed(spark, d), "question_type", 7, "sft_id").select("sft_id", "question_type"),
    "choose_total": lambda spark, d: S.choose(_images(spark, d), "image_path", "dataset", total=60, per_dataset="9"),
    "choose_number": lambda spark, d: S.choose(_images(spark, d), "image_path", "dataset", per_dataset=" 9 "),
    "choose_spec_nested": lambda spark, d: S.choose(_images(spark, d), "image_path", "dataset", per_dataset="SECOND=30,odd=3", nested=("EBD", T.parent_folder(F.col("image_path"), 2), 2)),
    "unknown_names": lambda spark, d: S.unknown_names({"SECOND": 1, "odd": 2, "EBD": 0}, _images(spark, d), "dataset"),
    "shuffled_output": lambda spark, d: S.shuffled(_typed(spark, d), "sft_id").select("sft_id", "question_type"),
    "train_val_split": lambda spark, d: S.train_val(_typed(spark, d), "sft_id", RATIO).select("sft_id", "split"),
}

_T = f"t as (select sft_id, {norm_sql('question_type')} as question_type, source_dataset from sft)"
_FLAT = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(image_path, '\\', '/', 'g'), '/+', '/', 'g'), '(/\.)+/', '/', 'g'), '^(\./)+', '')"
IMG = f"""i as (select distinct case when regexp_matches(p, '(^|/)SECOND/') and regexp_matches(p, '/im2/[^/]*\\.png$') then 'SECOND'
        when regexp_matches(p, '(^|/)LEVIR-CD\\+/') and regexp_matches(p, '/B/[^/]*\\.png$') then 'LEVIR-CD+'
        when regexp_matches(p, '(^|/)EBD/') and regexp_matches(p, '/images/[^/]*_post_disaster[^/]*\\.(png|jpg|jpeg)$') then 'EBD' end as dataset, p as image_path
    from (select {_FLAT} as p from manifest) where dataset is not null)"""


def md5(seed: object, *keys: str) -> str:
    return "md5(concat_ws('|', '" + str(seed) + "'" + "".join(f", cast({k} as varchar)" for k in keys) + "))"


def _unit(h: str) -> str:
    return f"(cast('0x' || substr({h}, 1, 8) as bigint) / 4294967296::double)"


def _assign() -> str:
    upto, cases = 0.0, []
    for t, w in list(SCHEDULE.items())[:-1]:
        upto += w
        cases.append(f"when u < {round(upto, 9)} then '{t}'")
    return f"""k as (select image_path, 3 + cast(floor({_unit(md5(42, 'image_path'))} * 4) as int) as k from i),
        e as (select image_path, unnest(generate_series(1, k)) as i from k), u as (select image_path, i, {_unit(md5(42, 'image_path', 'i'))} as u from e),
        a as (select image_path, i, case {' '.join(cases)} else '{list(SCHEDULE)[-1]}' end as question_type from u)"""


ASSIGN = _assign()
_GOAL = ", ".join(f"('{t}', {w!r}::double)" for t, w in ((t, SCHEDULE[t] / sum(map(SCHEDULE.get, S.MAIN_TYPES))) for t in S.MAIN_TYPES))
_CAPS = f"""g(question_type, w) as (values {_GOAL}), n as (select g.question_type, w, count(t.sft_id) as available from g left join t using (question_type) group by 1, 2),
    c as (select question_type, available, cast(least(round_even(w * (select floor(min(available / w)) from n), 0), available) as bigint) as take from n)"""
_ORDER = "case question_type " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(SCHEDULE)) + " end"

SQL = {
    "scan_listing": f"with {IMG} select * from i",
    "sample_global": f"with {IMG} select * from i order by {md5(42, 'image_path')}, image_path limit 80",
    "sample_per_group": f"with {IMG} select * from i qualify row_number() over (partition by dataset order by {md5(42, 'image_path')}, image_path) <= 20",
    "sample_spec": f"with {IMG} select * from i qualify row_number() over (partition by dataset order by {md5(42, 'image_path')}, image_path) <= case dataset when 'SECOND' then 200 when 'LEVIR-CD+' then 150 else 0 end",
    "sample_nested_group": f"""with {IMG} select *, coalesce(split_part(image_path, '/', -3), '') as disaster from i where dataset = 'EBD'
        qualify row_number() over (partition by split_part(image_path, '/', -3) order by {md5(42, 'image_path')}, image_path) <= 5""",
    "assign_types": f"with {IMG}, {ASSIGN} select image_path, i, question_type from a",
    "plan_text": f"""with {IMG}, {ASSIGN}, l as (select image_path, question_type, count(*) as n from a group by 1, 2)
        select image_path, string_agg('- ' || question_type || '：' || n || ' 个', chr(10) order by {_ORDER}) as plan from l group by 1""",
    "rebalance_caps": f"with {_T}, {_CAPS} select * from c",
    "rebalance_rows": f"""with {_T}, {_CAPS}, r as (select sft_id, question_type, row_number() over (partition by question_type order by {md5(42, 'sft_id')}, sft_id) as r from t)
        select sft_id, question_type from r join c using (question_type) where r <= take
        union all select sft_id, question_type from t where question_type in ('unanswerable', 'ambiguous')""",
    "balanced_sample": f"""with {_T}, r as (select sft_id, question_type, row_number() over (partition by question_type order by {md5(3407, 'sft_id')}, sft_id) as r from t)
        select sft_id, question_type from r order by r, question_type limit 500""",
    "balanced_by_group": f"""with {_T}, r as (select *, row_number() over (partition by source_dataset, question_type order by {md5(3407, 'sft_id')}, sft_id) as r from t)
        select sft_id, question_type, source_dataset from r qualify row_number() over (partition by source_dataset order by r, question_type) <= 90""",
    "first_n_per_group": f"with {_T} select sft_id, question_type from t qualify row_number() over (partition by question_type order by sft_id) <= 7",
    "choose_total": f"with {IMG} select * from i order by {md5(42, 'image_path')}, image_path limit 60",
    "choose_number": f"with {IMG} select * from i qualify row_number() over (partition by dataset order by {md5(42, 'image_path')}, image_path) <= 9",
    "choose_spec_nested": f"""with {IMG}, r as (select *, row_number() over (partition by dataset order by {md5(42, 'image_path')}, image_path) as r,
        row_number() over (partition by dataset, split_part(image_path, '/', -3) order by {md5(42, 'image_path')}, image_path) as n from i)
        select dataset, image_path from r where dataset = 'SECOND' and r <= 30 or dataset = 'EBD' and n <= 2""",
    "unknown_names": f"with {IMG} select x as dataset from (values ('SECOND'), ('odd'), ('EBD')) as v(x) where x not in (select dataset from i where dataset is not null)",
    "shuffled_output": f"with {_T} select sft_id, question_type from t",
    "train_val_split": f"""with {_T} select sft_id, case when row_number() over (order by {md5(42, 'sft_id')}, sft_id) <= (select floor(count(*) * {RATIO}::double) from t) then 'val' else 'train' end as split from t""",
}
