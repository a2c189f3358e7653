"""Whole runs as queries, and their SQL where the model is not asked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import pipelines as P
from ..operators import sampling as S
from ..operators import teacher as X
from .curate import NEW, OLD, _answers
from .review import _listing
from .sampling import ASSIGN, _CAPS, md5
from .tables import norm_sql, strip_sql, table
from .verifiable import ZH_ROWS, _items

RATIO = 0.05


def teacher() -> X.TeacherFn:
    """A stand-in that lists one question for each type of a plan, and answers anything else by a hash."""
    plain = X.stub()

    def call(prompt: str, image: str, tokens: int, temperature: float) -> str:
        wanted = [x[2:].split("：")[0] for x in prompt.split("\n") if x.startswith("- ")]
        return "\n".join(f"{t}|{t}？" for t in wanted) if wanted else plain(prompt, image, tokens, temperature)

    return call


def _run(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All listed pictures, of which those of the held-out rows are described and half of the training rows' questions answered already."""
    samples = _listing(spark, d)
    none = spark.createDataFrame([], "image_path string, dataset string, description string, questions array<struct<question_type:string,question:string>>")
    described = table(spark, d, "val").where("image is not null").groupBy(F.col("image").alias("image_path")).agg(F.min("source_dataset").alias("dataset")).withColumn("description", F.lit("d"))
    answered = table(spark, d, "sft").where("image is not null and question is not null").select(F.col("image").alias("image_path"), "question").distinct()
    return P.generate(samples, described, none, answered, teacher, 3, 6)


def _prepared(rebalance: bool):
    def query(spark: SparkSession, d: str) -> DataFrame:
        t = F.replace(F.lower(T.strip(F.coalesce("question_type", F.lit("?")))), F.lit("-"), F.lit("_"))
        a = _answers(spark, d).withColumn("meta", F.col("meta").withField("question_type", t))
        return P.prepare(a, "sft_id", RATIO, rebalance, old_root=OLD, new_root=NEW).select("sft_id", "split", "question_type", "answer")

    return query


def _misread(c):
    """Every answer as a reader sees it that takes a byte order mark for letters, with one private-use mark for each comma."""
    return F.concat(F.lit("\u9518"), F.replace(c, F.lit("，"), F.lit("\ue000")))


QUERIES = {
    "generate_answers": lambda spark, d: _run(spark, d)["answers"].select(F.col("images")[0].alias("image"), F.col("meta.question_type").alias("question_type"), F.col("messages")[0]["content"].alias("user_text"), F.col("messages")[1]["content"].alias("answer")),
    "generate_counters": lambda spark, d: _run(spark, d)["counters"],
    "prepare_train": _prepared(False),
    "prepare_rebalanced": _prepared(True),
    "verifiable_subset": lambda spark, d: P.verifiable_subset(_items(spark, d)),
    "mojibake_rows": lambda spark, d: table(spark, d, "sft").select("sft_id", T.mojibake_count(_misread(F.col("answer"))).cast("bigint").alias("marks")).where("marks > 0"),
    "spec_sizes": lambda spark, d: S.with_spec(table(spark, d, "sft").select("sft_id", "source_dataset"), "source_dataset", {"EBD": 50, "SECOND": 70}, "sft_id").groupBy("source_dataset").agg(F.count(F.lit(1)).alias("cnt")),
}

_T = f"t as (select sft_id, {norm_sql('question_type')} as question_type, {strip_sql('answer')} as answer, source_dataset from sft)"


def _split(source: str) -> str:
    return f"select sft_id, case when row_number() over (order by {md5(42, 'sft_id')}, sft_id) <= (select floor(count(*) * {RATIO}::double) from {source}) then 'val' else 'train' end as split, question_type, answer from {source}"


#: One question for each type of a picture's plan, none of which stands among the training rows.
_RUN = f"""l as (select image_path, min(dataset) as dataset from manifest where image_path is not null group by 1), i as (select image_path from l), {ASSIGN},
        ready as (select distinct image_path, dataset, question_type, question_type || '？' as question from a join l using (image_path))"""

SQL = {
    "prepare_train": f"with {_T} {_split('t')}",
    "prepare_rebalanced": f"""with {_T}, {_CAPS}, r as (select sft_id, question_type, answer, row_number() over (partition by question_type order by {md5(42, 'sft_id')}, sft_id) as r from t),
        k as (select sft_id, question_type, answer from r join c using (question_type) where r <= take union all select sft_id, question_type, answer from t where question_type in ('unanswerable', 'ambiguous')) {_split('k')}""",
    "mojibake_rows": "select sft_id, 1 + length(answer) - length(replace(answer, '，', '')) as marks from sft where answer is not null and strpos(answer, '锘') = 0",
    "generate_answers": f"with {_RUN} select image_path as image, question_type, '<image>' || chr(10) || question as user_text, 'stub-' || substr(md5(image_path || '|' || question), 1, 12) as answer from ready",
    "generate_counters": f"""with {_RUN} select 'phase1_completed' as metric, count(distinct image_path) as value from l union all select 'phase2_completed', count(distinct image_path) from l union all select 'errors', 0
        union all select 'phase3_completed', (select count(*) from ready) + (select count(*) from (select distinct image, question from sft where image is not null and question <> '' and image in (select image_path from l)))
        union all select 'dataset_' || coalesce(dataset, 'None'), count(*) from ready group by dataset union all select 'type_' || question_type, count(*) from ready group by question_type""",
    "verifiable_subset": f"with {ZH_ROWS} select id, image, question, reference from z where subtype is null or subtype <> 'other_yesno'",
    "spec_sizes": "select source_dataset, least(count(*), case source_dataset when 'EBD' then 50 else 70 end) as cnt from sft where source_dataset in ('EBD', 'SECOND') group by 1",
}
