"""The three runs of the pipeline as compositions of operators: generate, prepare, and the verifiable subset.

Stages that call a model are checkpointed before the next reads them, since a retried task would ask again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rows import cut, merged
from . import curate as C
from . import resume as R
from . import sampling as S
from . import teacher as X
from . import verifiable as V

#: Prompts; any template with the same names may be passed instead.
DESCRIBE = "请描述这张遥感图像中清晰可见的地物、位置与数量。"
ASK = "图像描述：{description}\n请按下列数量出题，每行写作 类型|问题：\n{plan}"
ANSWER = "{question}"


def generate(
    samples: DataFrame, described: DataFrame, asked: DataFrame, answered: DataFrame, make: Callable[[], X.TeacherFn] = X.stub,
    low: int = 3, high: int = 4, seed: int = 42, strict: bool = True, now: str = "", in_flight: int = 24, retries: int = 3,
) -> dict[str, DataFrame]:
    """descriptions, questions, answers and counters of one resumed run.

    samples (dataset, image_path); described (image_path, dataset, description); asked (image_path, dataset, description,
    questions); answered (image_path, question). Pictures with questions go on to answers, with a description to
    questions, others start anew; a picture listed under several datasets counts as of the least. Empty descriptions and
    responses without a valid question are not kept. Answers are asked for once every picture is described and asked about
    (see resume.barrier), or at once without the strict barrier.
    """
    staged = R.stages(samples, described, asked)
    have = described.groupBy("image_path").agg(F.min(F.struct("dataset", "description")).alias("_d")).select("image_path", "_d.*")
    waiting = staged.where("stage = 'phase2'").select("image_path").distinct().join(merged(have), "image_path")
    starting = staged.where("stage = 'phase1'").groupBy("image_path").agg(F.min("dataset").alias("dataset")).withColumn("description", F.lit(None).cast("string"))
    # plans are joined first, so that a picture is described and asked about in one go, without a barrier between the two
    todo = cut(starting.unionByName(waiting.select("image_path", "dataset", "description")))
    plan = S.plan_text(S.assign_types(todo, "image_path", low, high, seed), "image_path")
    prompts = todo.join(merged(plan), "image_path", "left").withColumn("new", F.col("description").isNull())
    told = X.ask(prompts, F.lit(DESCRIBE), "image_path", make, "describe", "said", in_flight, retries, F.col("new"), "describe_error")
    told = told.withColumn("description", F.coalesce("description", "said"))
    raw = cut(X.ask(told, X.render(ASK, description=F.col("description"), plan=F.col("plan")), "image_path", make, "ask", "response", in_flight, retries, F.coalesce(F.col("description") != "", F.lit(False))))
    fresh = raw.where("new and description <> ''").select("image_path", "dataset", "description")
    lines = R.parse_questions(raw.where("error is null").select("image_path", "dataset", "description", "response"), "response", high)
    each = F.array_sort(F.collect_list(F.struct("i", "question_type", "question")))  # at most `high` of a picture
    new = lines.groupBy("image_path", "dataset", "description").agg(F.transform(each, lambda x: F.struct(x["question_type"].alias("question_type"), x["question"].alias("question"))).alias("questions"))
    new = cut(new)
    everything = asked.select("image_path", "questions").unionByName(new.select("image_path", "questions"))
    total = samples.select("image_path").distinct().count()
    done = staged.where("stage = 'done'").select("image_path").distinct().count()
    n_new, n_waiting = fresh.count(), waiting.select("image_path").distinct().count()
    n_asked = done + new.select("image_path").distinct().count()
    pending = R.pending_answers(samples, everything, answered)
    if not R.barrier((done + n_waiting + n_new, n_asked, total), strict):
        pending = pending.where(F.lit(False))
    sources = samples.groupBy("image_path").agg(F.min("dataset").alias("dataset"))
    said = cut(X.ask(pending.join(merged(sources), "image_path"), X.render(ANSWER, question=F.col("question")), "image_path", make, "answer", "answer", in_flight, retries))
    good = said.where("error is null").withColumn("_now", F.lit(now)).withColumn("_mode", F.lit("distill"))
    records = C.as_answers(good, "image_path", "question", "answer", "question_type", "dataset", "_now", "_mode").select("messages", "images", "meta")
    failed = raw.select(F.explode(F.array("describe_error", "error")).alias("error")).unionAll(said.select("error")).where("error is not null")
    per = R.run_counters(good, "dataset", "question_type").where("metric <> 'phase3_completed'")
    kept = R.relevant_keys(answered, samples).select("image_path", "question").unionAll(good.select("image_path", "question"))
    spark = samples.sparkSession
    phases = spark.createDataFrame([("phase1_completed", done + n_waiting + n_new), ("phase2_completed", n_asked)], "metric string, value bigint")
    counters = phases.unionAll(kept.agg(F.lit("phase3_completed"), F.count(F.lit(1)))).unionAll(failed.agg(F.lit("errors"), F.count(F.lit(1)))).unionAll(per)
    return {"descriptions": fresh.withColumn("generated_at", F.lit(now)), "questions": new.withColumn("generated_at", F.lit(now)), "answers": records, "counters": counters}


def prepare(answers: DataFrame, key: str, ratio: float = 0.02, rebalance: bool = False, keep_warning: bool = False, old_root: str = "", new_root: str = "", seed: int = 42) -> DataFrame:
    """Training rows with `split` from rows of the answers schema that carry a unique `key`: filter, rebalance, project, split."""
    v = F.col("meta.auto_validation") if "auto_validation" in answers.schema["meta"].dataType.names else None
    ok = answers.where(C.validated(v["is_valid"], v["label"], keep_warning)) if v is not None else answers
    ok = ok.withColumn("_type", F.coalesce("meta.question_type", F.lit("?")))
    if rebalance:
        ok = S.rebalance(ok, key, "_type", seed)
    parts = S.train_val(ok, key, ratio, seed)
    return C.training_rows(parts, old_root, new_root, key, "split")


def verifiable_subset(items: DataFrame, rural: int = 500, flood: int = 500, scenes: int = 50, yes_no: int = 500, seed: int = 3407) -> DataFrame:
    """The localised training subset: balanced rural/urban and flood rows, the first rows of each scene folder, and yes/no
    rows balanced inside each subtype, without the subtype `other_yesno` (dropped after sampling, as its quota is used).

    Sampling sees the English rows; texts are localised last.
    """
    c = V.classify(items).where("kind is not null")
    a = S.balanced(c.where("kind = 'rural_urban'"), "reference", rural, "id", seed)
    b = S.balanced(c.where("kind = 'flood_binary'"), "reference", flood, "id", seed)
    s = S.first_n(c.where("kind = 'scene_classification'").withColumn("_f", T.folder_label(F.col("image"))), "_f", scenes, "id").drop("_f")
    y = c.where("kind = 'binary_yesno'").withColumn("_s", V.yesno_subtype(F.col("question"))).withColumn("_l", V.answer_label(F.col("reference")))
    y = V.exclude(S.balanced(y, "_l", yes_no, "id", seed, by=("_s",)), "_s", {"other_yesno"}).drop("_s", "_l")
    return V.localize(a.unionByName(b).unionByName(s).unionByName(y))
