from pyspark.sql import functions as F

from tesserae.functions.rows import cut
from tesserae.operators import curate as C
from tesserae.operators import pipelines as P
from tesserae.operators import teacher as X

ASKED = "image_path string, dataset string, description string, questions array<struct<question_type:string,question:string>>"


def teacher():
    plain = X.stub()

    def call(prompt, image, tokens, temperature):
        if image == "bad" and "遥感" in prompt:
            raise ValueError("no")
        if "类型|问题" in prompt:
            return "existence|有路吗？\nlocation|路在哪？" if image != "mute" else "无"
        return plain(prompt, image, tokens, temperature)

    return call


def run(rows, images, strict=True, answered=()):
    samples = rows([(d, i) for d, i in images], "dataset string, image_path string")
    described = rows([("q", "B", "have")], "image_path string, dataset string, description string")
    asked = rows([("p", "A", "have", [("t", "old?")])], ASKED)
    out = P.generate(samples, described, asked, rows(list(answered), "image_path string, question string"), teacher, strict=strict)
    return {k: v.collect() for k, v in out.items()}


def test_generate_resumes(rows):
    out = run(rows, [("A", "p"), ("B", "q"), ("C", "r")], answered=[("p", "old?"), ("q", "路在哪？")])
    assert [r.image_path for r in out["descriptions"]] == ["r"] and sorted(r.image_path for r in out["questions"]) == ["q", "r"]
    got = sorted((r.images[0], r.messages[0].content, r.meta.source_dataset) for r in out["answers"])
    assert got == [("q", "<image>\n有路吗？", "B"), ("r", "<image>\n有路吗？", "C"), ("r", "<image>\n路在哪？", "C")]
    n = {r.metric: r.value for r in out["counters"]}
    assert n == {"phase1_completed": 3, "phase2_completed": 3, "phase3_completed": 5, "errors": 0, "dataset_B": 1, "dataset_C": 2, "type_existence": 2, "type_location": 1}


def stored(df, path):
    """df as a table of files, which the planner knows by their size."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def stored_run(rows, at):
    samples = stored(rows([(d, i) for d, i in (("A", "p"), ("B", "q"), ("C", "r"))], "dataset string, image_path string"), at / "s")
    described = stored(rows([("q", "B", "have")], "image_path string, dataset string, description string"), at / "d")
    asked = stored(rows([("p", "A", "have", [("t", "old?")])], ASKED), at / "q")
    answered = stored(rows([("p", "old?"), ("q", "路在哪？")], "image_path string, question string"), at / "a")
    return P.generate(samples, described, asked, answered, teacher)


def test_generate_broadcasts_no_pictures(rows, monkeypatch, tmp_path):
    plans = []
    monkeypatch.setattr(P, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    assert stored_run(rows, tmp_path)["answers"].count() == 3
    assert len(plans) == 4 and not any("Broadcast" in p for p in plans) and "SortMergeJoin" in plans[0]


def test_counters_broadcast_no_answers(rows, tmp_path):
    counters = stored_run(rows, tmp_path)["counters"]
    assert "Broadcast" not in counters._jdf.queryExecution().executedPlan().toString()
    assert {r.metric: r.value for r in counters.collect()}["phase3_completed"] == 5


def test_a_failing_teacher_is_asked_again(rows):
    def flaky():
        seen, plain = {}, teacher()

        def call(prompt, image, tokens, temperature):
            seen[prompt, image] = seen.get((prompt, image), 0) + 1
            if seen[prompt, image] < 3:
                raise ValueError("busy")
            return plain(prompt, image, tokens, temperature)

        return call

    d = rows([(f"i{i}", f"q{i}") for i in range(20)], "image string, q string")
    for in_flight in (1, 24):
        good = X.ask(d, F.col("q"), "image", flaky, in_flight=in_flight).collect()
        assert len(good) == 20 and all(r.error is None and r.response.startswith("stub-") for r in good)
        assert all(r.error == "ValueError: busy" and r.response is None for r in X.ask(d, F.col("q"), "image", flaky, in_flight=in_flight, retries=2).collect())


def test_calls_run_side_by_side_and_rows_are_left_out(rows):
    def slow():
        def call(prompt, image, tokens, temperature):
            import time

            time.sleep(0.05)
            return prompt

        return call

    d = rows([(f"i{i}", f"q{i}") for i in range(40)], "image string, q string").coalesce(1)
    import time

    X.ask(d, F.col("q"), "image", slow, in_flight=40).count()
    began = time.time()
    got = X.ask(d, F.col("q"), "image", slow, in_flight=40, only=F.col("q") != "q7").collect()
    assert time.time() - began < 1.8 and [r.response for r in got] == [None if i == 7 else f"q{i}" for i in range(40)] and all(r.error is None for r in got)


def test_description_and_questions_without_a_barrier(spark):
    """A picture is asked about in the same stage in which it is described: no exchange stands between the two calls."""
    d = spark.range(100).select(F.col("id").cast("string").alias("image_path"))
    one = X.ask(d, F.lit(P.DESCRIBE), "image_path", teacher, "describe", "description", error="e1")
    two = X.ask(one, F.concat(F.lit(P.ASK), "description"), "image_path", teacher, "ask")
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 2 and "Exchange" not in plan
    assert two.where("error is null and e1 is null and length(response) > 0").count() == 100


def test_truths_by_position(rows, spark):
    a, b = spark.range(50).select((F.col("id") * 3).alias("at"), F.lit("x").alias("r")).repartition(7), spark.range(20).select((F.col("id") * 5).alias("at"), F.col("id").alias("t"))
    assert {(r.at, r.t) for r in X.by_position(a, b, "at", "t").collect()} == {(3 * i, i) for i in range(20)}
    assert X.by_position(a.where("at < 0"), b, "at", "t").count() == 0


def test_barrier(rows):
    for image in ("bad", "mute"):
        images = [("A", "p"), ("C", image)]
        assert run(rows, images)["answers"] == [] and len(run(rows, images, strict=False)["answers"]) == 1
    assert {r.metric: r.value for r in run(rows, [("C", "bad")])["counters"]}["errors"] == 1


def test_prepare(rows):
    d = rows([(i, "i.png", "q", "a", t, "d", None, None) for i, t in enumerate(["existence", "odd", None, "ambiguous"] * 25)], "k long, i string, q string, a string, t string, s string, g string, m string")
    a = C.as_answers(d, "i", "q", "a", "t", "s", "g", "m")
    p = P.prepare(a, "k", 0.1)
    assert {r.split: r["count"] for r in p.groupBy("split").count().collect()} == {"val": 10, "train": 90}
    assert p.columns == ["k", "split", "image", "question", "answer", "question_type", "answer_mode"]
    assert {r.question_type for r in P.prepare(a, "k", 0.1, rebalance=True).collect()} == {"ambiguous"}


def test_empty_subset(spark):
    items = spark.createDataFrame([], "id long, image string, conversations array<struct<value:string>>")
    assert P.verifiable_subset(items).select(F.col("question")).count() == 0
