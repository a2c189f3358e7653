"""Resuming a staged run: what is done is found by keys, what is left by anti joins, before any model is called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rows import merged, salted_semi

#: Types that a generated question may have.
QUESTION_TYPES = ("existence", "attribute", "location", "spatial_relation", "counting", "unanswerable", "ambiguous")


def stages(samples: DataFrame, described: DataFrame, asked: DataFrame, image: str = "image_path") -> DataFrame:
    """samples with the stage that each picture needs next: done (questions exist), phase2 (a description) or phase1."""
    d = described.select(F.col(image), F.lit(True).alias("_d")).distinct()
    q = asked.select(F.col(image), F.lit(True).alias("_q")).distinct()
    s = samples.join(merged(q), image, "left").join(merged(d), image, "left")
    return s.withColumn("stage", F.when(F.col("_q"), "done").when(F.col("_d"), "phase2").otherwise("phase1")).drop("_q", "_d")


def pending_answers(samples: DataFrame, asked: DataFrame, answered: DataFrame, image: str = "image_path") -> DataFrame:
    """Questions of sampled pictures without an answer; a question asked twice of one picture is pending twice.

    asked has one row per picture with the array `questions`, or one row per question (question_type, question), which
    suits pictures with very many questions: they spread over the join on (picture, question).
    """
    each = asked.select(image, "question_type", "question") if "question" in asked.columns else asked.select(F.col(image), F.explode("questions").alias("q")).select(image, "q.question_type", "q.question")
    each = salted_semi(each, samples, image, "question")
    return each.join(merged(answered.select(image, "question").distinct()), [image, "question"], "left_anti")


def relevant_keys(answered: DataFrame, samples: DataFrame, image: str = "image_path") -> DataFrame:
    """Answer keys of sampled pictures with a non-empty question."""
    return salted_semi(answered.where("question is not null and question <> ''"), samples, image, "question").distinct()


def pending_predictions(rows: DataFrame, done: DataFrame, order: str, limit: int = 0) -> DataFrame:
    """Rows without a prediction; a limit is taken before, as the run does."""
    some = rows.orderBy(order).limit(limit) if limit > 0 else rows
    return some.join(done.select("image", "question").distinct(), ["image", "question"], "left_anti")


def pending_of_runs(rows: DataFrame, done: DataFrame, run: str) -> DataFrame:
    """rows once for each run that lacks a prediction for them; the runs are those that done names, few of them."""
    have = done.where("image is not null and question is not null").groupBy("image", "question").agg(F.collect_set(run).alias("_have"))
    runs = done.agg(F.array_sort(F.collect_set(run))).scalar()
    j = rows.join(have, ["image", "question"], "left")
    lacking = F.array_except(runs, F.coalesce("_have", F.array().cast("array<string>")))
    return j.select(*rows.columns, F.explode(lacking).alias(run))


def parse_questions(df: DataFrame, response: str, cap: int = 0) -> DataFrame:
    """df exploded to its 'type|question' lines: i (order in the response), question_type, question.

    A line is split at its first bar; lines without a bar, with an unknown type or no question are skipped; at most `cap`
    questions of a response are kept, counted after the filter.
    """
    body = T.strip(F.col(response))
    line = lambda x: T.strip(x)
    kind = lambda x: F.lower(T.strip(F.substring_index(x, "|", 1)))
    rest = lambda x: T.strip(F.regexp_replace(x, r"^[^|]*\|", ""))
    good = F.filter(F.transform(F.split(body, "\n"), line), lambda x: F.contains(x, F.lit("|")) & kind(x).isin(*QUESTION_TYPES) & (rest(x) != ""))
    if cap > 0:
        good = F.slice(good, 1, cap)
    e = df.withColumn("_a", good).select("*", F.posexplode("_a").alias("_i", "_l")).drop("_a")
    return e.select(*df.columns, (F.col("_i") + 1).cast("bigint").alias("i"), kind(F.col("_l")).alias("question_type"), rest(F.col("_l")).alias("question"))


def run_counters(answers: DataFrame, dataset: str, question_type: str) -> DataFrame:
    """(metric, value): phase counters, dataset_* and type_* of a run, in one pass."""
    g = answers.groupingSets([[dataset], [question_type], []], dataset, question_type).agg(
        F.grouping(dataset).alias("_gd"), F.grouping(question_type).alias("_gt"), F.count(F.lit(1)).alias("value")
    )
    name = (
        F.when((F.col("_gd") == 1) & (F.col("_gt") == 1), "phase3_completed")
        .when(F.col("_gd") == 0, F.concat(F.lit("dataset_"), F.coalesce(F.col(dataset), F.lit("None"))))
        .otherwise(F.concat(F.lit("type_"), F.coalesce(F.col(question_type), F.lit("None"))))
    )
    return g.select(name.alias("metric"), "value")


def barrier(counts: tuple[int, int, int], strict: bool = True) -> bool:
    """Whether answers may be asked for: described and asked both reach the sample total, unless the barrier is not strict.

    With the strict barrier one failed picture keeps all answers back, as in the pipeline restated here.
    """
    described, asked, total = counts
    return not strict or (described >= total and asked >= total)
