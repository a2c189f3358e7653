"""Curation, parsing and pair queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import curate as C
from ..operators import pairs as P
from ..operators import resume as R
from ..operators import teacher as X
from ..operators.ranks import last_wins
from ..sources.jsonl import stats_json
from .tables import PYWS, strip_sql, table

OLD, NEW = "/data/train/rs_images", "/mnt/pictures"
PROMPT = "这是对比图。请先识别新增地物的分布特征"


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return C.as_answers(table(spark, d, "sft"), "image", "question", "answer", "question_type", "source_dataset", "generated_at", "answer_mode")


def _paths(spark: SparkSession, d: str) -> DataFrame:
    """All pictures of the tables once, with forward slashes."""
    a, b, m = (table(spark, d, t) for t in ("sft", "val", "manifest"))
    u = a.select("image").unionAll(b.select("image")).unionAll(m.select("image_path")).where("image is not null")
    return u.select(T.flat_path(F.col("image")).alias("path")).distinct()


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """A model's list of questions for each row: its own, one of an unknown type, one without a bar, and a second one."""
    q = F.coalesce("question", F.lit(""))
    lines = F.concat(F.coalesce("question_type", F.lit("")), F.lit("|"), q, F.lit("\nfoo|x\n无分隔\n Counting | "), q, F.lit("\nlocation|a|b"))
    return table(spark, d, "sft").select("sft_id", lines.alias("response"))


def _rewards(spark: SparkSession, d: str) -> DataFrame:
    """Reward texts made of the predictions: a number, one with stars, or none."""
    p = table(spark, d, "val_pred")
    n = F.length(F.coalesce("prediction", F.lit("")))
    c = F.when(F.col("pred_id") % 3 == 0, F.concat(F.lit("ok **Reward: "), (n / 10.0).cast("string"), F.lit("** Reward: 9"))).when(F.col("pred_id") % 3 == 1, F.concat(F.lit("Reward: about "), n.cast("string"))).otherwise(F.col("prediction"))
    return p.select("pred_id", X.reward(F.coalesce(c, F.lit(""))).alias("reward"))


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return last_wins(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    b = C.content_blocks(F.coalesce("question", F.lit("")))
    return table(spark, d, "sft").select("sft_id", F.size(F.filter(b, lambda x: x["type"] == "image")).cast("bigint").alias("images"), F.array_join(F.transform(F.filter(b, lambda x: x["type"] == "text"), lambda x: x["text"]), "").alias("text"))


def _counters(spark: SparkSession, d: str) -> DataFrame:
    return R.run_counters(table(spark, d, "sft"), "source_dataset", "question_type")


QUERIES = {
    "question_keys": lambda spark, d: table(spark, d, "sft").where("image is not null and question is not null").select("sft_id", T.sample_key(F.col("image"), T.question_text(F.col("question"))).alias("id")),
    "strip_image_token": lambda spark, d: table(spark, d, "sft").select("sft_id", T.strip_image_token(F.col("question")).alias("question")),
    "squeeze_text": lambda spark, d: table(spark, d, "documents").select("doc_id", T.squeeze(F.col("text")).alias("text")),
    "remap_image": lambda spark, d: table(spark, d, "sft").select("sft_id", T.remap_image(F.col("image"), OLD, NEW).alias("image")),
    "convert_records": lambda spark, d: C.training_rows(_answers(spark, d), OLD, NEW),
    "filter_auto_validation": lambda spark, d: C.filter_counts(table(spark, d, "reviews"), C.validated(F.col("decision") == "approved", F.when(F.col("note") != "", "warning"))),
    "type_dist_desc": lambda spark, d: C.type_counts(table(spark, d, "sft"), "question_type", "sft_id"),
    "answer_mode_share": lambda spark, d: C.balance(table(spark, d, "sft"), "answer_mode"),
    "yes_no_balance": lambda spark, d: C.yes_no_balance(table(spark, d, "sft"), "answer", F.lower(T.strip(F.col("question_type")))),
    "step_histogram": lambda spark, d: C.step_histogram(table(spark, d, "sft"), "answer"),
    "resolve_path": lambda spark, d: table(spark, d, "sft").select("sft_id", T.resolve_path(F.col("image"), "/data").alias("image")),
    "two_image_records": lambda spark, d: P.record(P.complete_pairs(P.registry(_paths(spark, d), "path")).withColumn("answer", F.concat_ws("-", "event", "img_id")), "pre", "post", PROMPT, "answer").select(F.col("images")[0].alias("first"), F.col("images")[1].alias("second"), F.col("messages")[0]["content"].alias("user_text"), F.col("messages")[1]["content"].alias("answer")),
    "missing_files": lambda spark, d: C.missing_files(table(spark, d, "sft").select(T.flat_path(F.col("image")).alias("image")), "image", table(spark, d, "manifest").select(T.flat_path(F.col("image_path")).alias("p")), "p"),
    "content_blocks": _blocks,
    "rewrite_user_turn": lambda spark, d: _answers(spark, d).select("sft_id", C.rewrite_role(F.col("messages"), "user", PROMPT).alias("m")).select("sft_id", F.col("m")[0]["content"].alias("user_text"), F.col("m")[1]["content"].alias("assistant_text")),
    "parse_questions": lambda spark, d: R.parse_questions(_responses(spark, d), "response", 2).select("sft_id", "i", "question_type", "question"),
    "parse_reward": _rewards,
    "last_wins": _latest,
    "json_props": lambda spark, d: table(spark, d, "events").select(F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("cnt")),
    "natural_sort": lambda spark, d: _paths(spark, d).select("path", T.natural_key(F.col("path"), 12).alias("key")),
    "url_quote": lambda spark, d: _paths(spark, d).select("path", T.url_quote(F.col("path")).alias("url"), T.mime_type(F.col("path")).alias("mime")),
    "pre_post_registry": lambda spark, d: P.registry(_paths(spark, d), "path"),
    "pre_post_pairs": lambda spark, d: P.complete_pairs(P.registry(_paths(spark, d), "path")),
    "event_stats": lambda spark, d: P.event_stats(P.registry(_paths(spark, d), "path")),
    "image_pairs": lambda spark, d: P.by_file_name(_paths(spark, d).where("path like '%/im1/%'"), _paths(spark, d).where("path like '%/im2/%'"), "path"),
    "run_counters": _counters,
    "stats_json": lambda spark, d: stats_json(_counters(spark, d).where("metric not like 'type_%'")),
}

_FLAT = lambda c: rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\\', '/', 'g'), '/+', '/', 'g'), '(/\.)+(/|$)', '\2', 'g'), '^(\./)+', '')"
_PATHS = f"p as (select distinct {_FLAT('image')} as path from (select image from sft union all select image from val union all select image_path from manifest) where image is not null)"
_REMAP = f"""case when {_FLAT('image')} = '{OLD}' then '{NEW}' when starts_with({_FLAT('image')}, '{OLD}/') then '{NEW}' || substr({_FLAT('image')}, {len(OLD) + 1}) else image end"""
_STEM = r"regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\.[^.]*$', '')"
_REG = rf"""{_PATHS}, r as (select regexp_extract({_STEM}, '^(.*)_(\d+)_(pre|post)_disaster', 1) as event, regexp_extract({_STEM}, '^(.*)_(\d+)_(pre|post)_disaster', 2) as img_id,
        regexp_extract({_STEM}, '^(.*)_(\d+)_(pre|post)_disaster', 3) as status, path from p),
    g as (select event, img_id, max(path) filter (where status = 'pre') as pre, max(path) filter (where status = 'post') as post from r where status in ('pre', 'post') group by 1, 2)"""
_NOTOKEN = "replace(replace(question, '<image>' || chr(10), ''), '<image>', '')"
_KEY = f"""(select string_agg(case when regexp_matches(x, '^[0-9]') then lpad(case when ltrim(x, '0') = '' then '0' else ltrim(x, '0') end, 12, '0') else x end, '' order by i)
    from (select unnest(regexp_extract_all(lower(path), '[0-9]+|[^0-9]+')) as x, generate_subscripts(regexp_extract_all(lower(path), '[0-9]+|[^0-9]+'), 1) as i))"""

SQL = {
    "question_keys": f"select sft_id, image || '|' || {strip_sql(chr(114) + 'eplace(question, chr(60) || chr(105) || $$mage>$$, $$$$)')} as id from sft where image is not null and question is not null",
    "strip_image_token": f"select sft_id, {strip_sql(_NOTOKEN)} as question from sft",
    "squeeze_text": f"select doc_id, {strip_sql(f'regexp_replace(text, $$[{PYWS}]+$$, chr(32), $$g$$)')} as text from documents",
    "remap_image": f"select sft_id, {_REMAP} as image from sft",
    "convert_records": f"""select {_REMAP} as image, {strip_sql('replace(question, $$<image>$$, $$$$)')} as question, {strip_sql('answer')} as answer, coalesce(question_type, '') as question_type, coalesce(answer_mode, 'analysis') as answer_mode from sft""",
    "filter_auto_validation": """with k as (select coalesce(decision = 'approved', true) and coalesce(case when note <> '' then 'warning' end, 'pass') = 'pass' as ok from reviews)
        select count(*) filter (where ok) as kept, count(*) filter (where not ok) as dropped from k""",
    "type_dist_desc": "select coalesce(question_type, '') as question_type, count(*) as cnt from sft group by 1",
    "answer_mode_share": "select answer_mode, count(*) as cnt, round(count(*) / (select count(*) from sft)::double, 9) as share from sft group by 1",
    "yes_no_balance": f"""with t as (select {strip_sql("regexp_replace(regexp_replace(answer, '(?s)^.*<answer>', ''), '</?[a-z]+>', '', 'g')")} as a from sft where lower({strip_sql('question_type')}) = 'existence'),
        l as (select case when regexp_matches(a, '^(否|无|没有|不)') or regexp_matches(a, '(?i)^no\\b') then 'no' when regexp_matches(a, '^(是|有|存在|可见|可以)') or regexp_matches(a, '(?i)^yes\\b') then 'yes' end as label from t)
        select label, count(*) as cnt from l where label is not null group by 1""",
    "step_histogram": r"""with t as (select coalesce(nullif(regexp_extract(answer, '(?s)<analysis>(.*?)</analysis>', 1), ''), answer) as b from sft where answer is not null)
        select cast(len(regexp_extract_all(b, '(?m)^[ \t]*[0-9０-９]+[.、．]')) as bigint) as steps, count(*) as cnt from t group by 1""",
    "resolve_path": rf"""with p as (select sft_id, image, case when image is null then null when regexp_matches({_FLAT('image')}, '^(/|[A-Za-z]:/|[a-z]+:/)') then {_FLAT('image')} else '/data/' || {_FLAT('image')} end as p from sft),
        q as (select sft_id, p, case when contains(p, '/.') then array_to_string(list_reduce(list_prepend([]::varchar[], list_transform(string_split(p, '/'), lambda x: [x])), lambda acc, x: case when x[1] = '.' then acc when x[1] = '..' then case when len(acc) > 1 then acc[:-2] else acc end else list_concat(acc, x) end), '/') else p end as r from p)
        select sft_id, r as image from q""",
    "two_image_records": f"""with {_REG} select pre as first, post as second, '<image>' || chr(10) || '<image>' || chr(10) || '{PROMPT}' as user_text, event || '-' || img_id as answer from g where pre is not null and post is not null
        qualify row_number() over (partition by event order by img_id) <= 50""",
    "missing_files": f"select distinct {_FLAT('image')} as image from sft where image is not null and {_FLAT('image')} not in (select {_FLAT('image_path')} from manifest where image_path is not null)",
    "content_blocks": f"select sft_id, cast((length(coalesce(question, '')) - length(replace(coalesce(question, ''), '<image>', ''))) / 7 as bigint) as images, {strip_sql(f'coalesce({_NOTOKEN}, chr(32))')} as text from sft",
    "rewrite_user_turn": f"select sft_id, '{PROMPT}' as user_text, answer as assistant_text from sft",
    "parse_questions": f"""with l as (select sft_id, {strip_sql('coalesce(question_type, $$$$) || $$|$$ || coalesce(question, $$$$) || chr(10) || $$foo|x$$ || chr(10) || $$无分隔$$ || chr(10) || $$ Counting | $$ || coalesce(question, $$$$) || chr(10) || $$location|a|b$$')} as r from sft),
        x as (select sft_id, unnest(string_split(r, chr(10))) as line, generate_subscripts(string_split(r, chr(10)), 1) as k from l),
        y as (select sft_id, k, lower({strip_sql('split_part(line, $$|$$, 1)')}) as question_type, {strip_sql('regexp_replace(line, $$^[^|]*[|]$$, $$$$)')} as question from x where contains(line, '|')),
        z as (select *, row_number() over (partition by sft_id order by k) as i from y where question <> '' and question_type in ('existence', 'attribute', 'location', 'spatial_relation', 'counting', 'unanswerable', 'ambiguous'))
        select sft_id, i, question_type, question from z where i <= 2""",
    "parse_reward": "select pred_id, case when pred_id % 3 = 0 then length(coalesce(prediction, '')) / 10.0::double else 0.0::double end as reward from val_pred",
    "last_wins": "select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
    "json_props": "select try_cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as cnt from events group by 1",
    "natural_sort": f"with {_PATHS} select path, {_KEY} as key from p",
    "url_quote": f"""with {_PATHS} select path, replace(url_encode(path), '%2F', '/') as url,
        case when lower(path) like '%.png' then 'image/png' when lower(path) like '%.webp' then 'image/webp' when lower(path) like '%.gif' then 'image/gif' when lower(path) like '%.bmp' then 'image/bmp' else 'image/jpeg' end as mime from p""",
    "pre_post_registry": f"with {_REG} select * from g",
    "pre_post_pairs": f"with {_REG} select * from g where pre is not null and post is not null qualify row_number() over (partition by event order by img_id) <= 50",
    "event_stats": f"with {_REG} select event, count(*) as ids, cast(count(pre) + count(post) as bigint) as files from g group by 1",
    "image_pairs": f"""with {_PATHS}, n as (select regexp_extract(path, '([^/]*)$', 1) as file, path from p)
        select a.file, a.path as path_a, b.path as path_b from n a join n b using (file) where a.path like '%/im1/%' and b.path like '%/im2/%'""",
    "stats_json": """with c as (select 'phase3_completed' as metric, count(*) as value from sft union all select 'dataset_' || coalesce(source_dataset, 'None'), count(*) from sft group by 1)
        select '{' || string_agg('"' || metric || '":' || value, ',' order by metric) || '}' as stats from c""",
    "run_counters": """select 'phase3_completed' as metric, count(*) as value from sft union all select 'dataset_' || coalesce(source_dataset, 'None'), count(*) from sft group by 1
        union all select 'type_' || coalesce(question_type, 'None'), count(*) from sft group by 1""",
}
