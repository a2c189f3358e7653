"""Review, comparison, resume and model-call queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import resume as R
from ..operators import review as V
from ..operators import teacher as X
from .tables import strip_sql, table

LABELS = ("base", "tuned")
PROMPT = "请看图回答：{question}"


def _samples(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sft").where("image is not null and question is not null")
    return s.select("sft_id", T.sample_key(F.col("image"), T.question_text(F.col("question"))).alias("id"))


def _val_samples(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "val").where("image is not null and question is not null")
    return s.select("val_id", T.sample_key(F.col("image"), F.col("question")).alias("id"))


def _decided(spark: SparkSession, d: str) -> DataFrame:
    return V.decisions(table(spark, d, "reviews"), ["updated_at", "decision", "note"]).select("id", "decision")


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "val_pred").withColumn("id", T.sample_key(F.col("image"), F.col("question")))
    return V.predictions(p, "id", "run_name", "prediction", ["predicted_at", "pred_id"])


def _items(mode: str):
    return lambda spark, d: V.items(_samples(spark, d), _decided(spark, d), _predicted(spark, d), mode).select("sft_id", "id")


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """(image_path, question_type, question): generated questions, those of all training rows."""
    s = table(spark, d, "sft").where("image is not null and question is not null")
    return s.select(F.col("image").alias("image_path"), "question_type", "question")


def _listing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest").select("dataset", "image_path").where("image_path is not null").distinct()


def _answered(spark: SparkSession, d: str) -> DataFrame:
    """Answers that exist already: all that are not null."""
    return table(spark, d, "sft").where("image is not null and question is not null and answer is not null").select(F.col("image").alias("image_path"), "question")


def _described(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "val").select(F.col("image").alias("image_path"))


def _told(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "val").select("val_id", F.coalesce("image", F.lit("")).alias("image"), "question")
    return X.ask(v, X.render(PROMPT, question=F.col("question")), "image").select("val_id", "response", "error")


def _flat(spark: SparkSession, d: str) -> DataFrame:
    """Messages in several shapes, flattened: a string, a list of blocks, a nested list."""
    e = table(spark, d, "eval_items")
    q, p = F.to_json(F.struct(F.col("question").alias("text"))), F.to_json(F.struct(F.array(F.struct(F.col("passage").alias("content"))).alias("text")))
    shape = F.when(F.col("item_id") % 3 == 0, F.concat(F.lit('["'), F.col("lang"), F.lit('",'), q, F.lit(","), p, F.lit("]"))).when(F.col("item_id") % 3 == 1, F.col("passage")).otherwise(F.lit("null"))
    return e.select("item_id", T.flatten_content(shape).alias("text"))


QUERIES = {
    "review_decisions": _decided,
    **{f"review_{m}": _items(m) for m in ("pending", "approved", "rejected", "all")},
    "review_compare": lambda spark, d: V.items(_val_samples(spark, d), _decided(spark, d), _predicted(spark, d), "compare").select("val_id", "id"),
    "review_joined": lambda spark, d: V.with_review(_samples(spark, d), _decided(spark, d)).select("sft_id", "decision"),
    "review_summary": lambda spark, d: V.summary(_samples(spark, d), _decided(spark, d), _predicted(spark, d)),
    "compare_models": lambda spark, d: V.compare(_val_samples(spark, d), _predicted(spark, d), LABELS).select("val_id", *LABELS),
    "approved_train": lambda spark, d: V.approved(_samples(spark, d).join(table(spark, d, "sft").select("sft_id", "image", "question", "answer"), "sft_id"), _decided(spark, d)).select("sft_id", "image", "question", "answer"),
    "predictions_latest": _predicted,
    "resume_stage": lambda spark, d: R.stages(_listing(spark, d), _described(spark, d), _asked(spark, d)),
    "pending_answers": lambda spark, d: R.pending_answers(_listing(spark, d), _asked(spark, d), _answered(spark, d)),
    "relevant_keys": lambda spark, d: R.relevant_keys(_answered(spark, d), _listing(spark, d)),
    "pending_predictions": lambda spark, d: R.pending_of_runs(table(spark, d, "val").where("image is not null and question is not null"), table(spark, d, "val_pred"), "run_name").select("val_id", "run_name"),
    "predict_stub": _told,
    "content_flatten": _flat,
    "exact_match_reward": lambda spark, d: V.exact_match(table(spark, d, "val_pred"), "run_name", "prediction", "reference"),
    "truth_by_position": lambda spark, d: X.by_position(table(spark, d, "val_pred").select("pred_id", "prediction").withColumnRenamed("pred_id", "at"), table(spark, d, "val").select(F.col("val_id").alias("at"), "answer"), "at", "answer"),
}

_KEY = f"image || '|' || {strip_sql('replace(question, $$<image>$$, $$$$)')}"
_S = f"s as (select sft_id, {_KEY} as id from sft where image is not null and question is not null)"
_V = "v as (select val_id, image || '|' || question as id from val where image is not null and question is not null)"
_D = "d as (select id, decision from reviews where decision in ('approved', 'rejected') and id is not null qualify row_number() over (partition by id order by updated_at desc, decision desc, note desc) = 1)"
_P = "p as (select image || '|' || question as id, run_name as label, coalesce(prediction, '') as prediction from val_pred where image is not null and question is not null qualify row_number() over (partition by image, question, run_name order by predicted_at desc, pred_id desc) = 1)"
_L = "l as (select distinct dataset, image_path from manifest where image_path is not null)"
_A = "a as (select distinct image as image_path, question from sft where image is not null and question is not null and answer is not null)"
_Q = "q as (select image as image_path, question_type, question from sft where image is not null and question is not null)"

SQL = {
    "review_decisions": f"with {_D} select * from d",
    "review_pending": f"with {_S}, {_D} select * from s where id not in (select id from d)",
    "review_approved": f"with {_S}, {_D} select * from s where id in (select id from d where decision = 'approved')",
    "review_rejected": f"with {_S}, {_D} select * from s where id in (select id from d where decision = 'rejected')",
    "review_all": f"with {_S} select * from s",
    "review_compare": f"with {_V}, {_P} select * from v where id in (select id from p)",
    "review_joined": f"with {_S}, {_D} select sft_id, decision from s left join d using (id)",
    "review_summary": f"""with {_S}, {_D}, {_P} select (select count(*) from s) as total, (select count(*) from d) as reviewed, (select count(*) from d where decision = 'approved') as approved,
        (select count(*) from d where decision = 'rejected') as rejected, (select count(*) from s where id in (select id from p)) as with_prediction""",
    "compare_models": f"with {_V}, {_P} select val_id, b.prediction as base, t.prediction as tuned from v left join p b on b.id = v.id and b.label = 'base' left join p t on t.id = v.id and t.label = 'tuned'",
    "approved_train": f"with {_S}, {_D} select sft_id, image, question, answer from s join sft using (sft_id) where id in (select id from d where decision = 'approved')",
    "predictions_latest": f"with {_P} select * from p",
    "resume_stage": f"""with {_L}, {_Q} select image_path, dataset, case when image_path in (select image_path from q) then 'done' when image_path in (select image from val where image is not null) then 'phase2' else 'phase1' end as stage from l""",
    "pending_answers": f"with {_L}, {_A}, {_Q} select image_path, question_type, question from q where image_path in (select image_path from l) and not exists (select 1 from a where a.image_path = q.image_path and a.question = q.question)",
    "relevant_keys": f"with {_L}, {_A} select image_path, question from a where question <> '' and image_path in (select image_path from l)",
    "pending_predictions": """select val_id, r.run_name from val v, (select distinct run_name from val_pred) r where image is not null and question is not null
        and not exists (select 1 from val_pred p where p.run_name = r.run_name and p.image = v.image and p.question = v.question)""",
    "predict_stub": f"select val_id, 'stub-' || substr(md5(coalesce(image, '') || '|' || replace('{PROMPT}', '{{question}}', coalesce(question, ''))), 1, 12) as response, cast(null as varchar) as error from val",
    "content_flatten": f"select item_id, case item_id % 3 when 0 then {strip_sql('lang')} || chr(10) || {strip_sql('question')} || chr(10) || {strip_sql('passage')} when 1 then {strip_sql('passage')} else '' end as text from eval_items",
    "truth_by_position": """select p.pred_id as at, p.prediction, v.answer from (select *, row_number() over (order by pred_id) as r from val_pred) p join (select *, row_number() over (order by val_id) as r from val) v using (r)""",
    "exact_match_reward": f"select run_name, count(*) as cnt, count(*) filter (where {strip_sql('prediction')} = {strip_sql('reference')}) as hits from val_pred group by 1",
}
