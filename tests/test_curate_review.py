from pyspark.sql import functions as F

from tesserae.operators import curate as C
from tesserae.operators import pairs as P
from tesserae.operators import resume as R
from tesserae.operators import review as V


def test_validation_filter(rows):
    d = rows([(None, None), (False, "warning"), (True, "format_fail"), (True, "warning"), (False, "pass")], "v boolean, l string")
    got = lambda keep: [r.x for r in d.select(C.validated(F.col("v"), F.col("l"), keep).alias("x")).collect()]
    assert got(False) == [True, False, False, False, False] and got(True) == [True, False, False, True, False]


def test_training_rows(rows):
    m = [{"role": "assistant", "content": " b "}, {"role": "user", "content": "<image>\nq"}]
    d = rows([(m, ["/a/x.png"], None), ([], [], ("vqa", "t", None, None, "direct"))], "messages array<struct<role:string,content:string>>, images array<string>, meta struct<task_type:string,question_type:string,source_dataset:string,generated_at:string,answer_mode:string>")
    a, b = C.training_rows(d, "/a", "/n").collect()
    assert tuple(a) == ("/n/x.png", "q", "b", "", "analysis") and tuple(b) == (None, None, None, "t", "direct")


def test_blocks_and_roles(rows):
    d = rows([("<image>\n<image>\n a",), ("<image>",)], "c string").select(C.content_blocks(F.col("c")).alias("b"))
    assert [[(x.type, x.text) for x in r.b] for r in d.collect()] == [[("image", None), ("image", None), ("text", "a")], [("image", None)]]


def test_reviews(rows):
    s = rows([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "id string, n long")
    log = rows([("a", "approved", "1"), ("a", "rejected", "2"), ("b", "approved", "1"), ("z", "approved", "1"), ("c", "odd", "1"), (None, "approved", "1")], "id string, decision string, updated_at string")
    p = V.predictions(rows([("a", "m", "x", 1), ("a", "m", "y", 2), ("c", "k", None, 1)], "id string, l string, t string, o long"), "id", "l", "t", ["o"])
    d = V.decisions(log)
    ids = lambda mode: sorted(r.n for r in V.items(s, d, p, mode).collect())
    assert [ids(m) for m in (*V.MODES, "other")] == [[4], [3], [1, 2], [1, 2, 4], [1, 2, 3, 4], [1, 2, 3, 4]]
    assert tuple(V.summary(s, d, p).first()) == (4, 3, 2, 1, 3)
    assert {(r.n, r.k, r.m) for r in V.compare(s, p, ["k", "m"]).collect()} == {(1, None, "y"), (2, None, "y"), (3, None, None), (4, "", None)}
    assert V.parse_predictions(["a = x.jsonl", "out/b.jsonl"]) == [("a", "x.jsonl"), ("b", "out/b.jsonl")] and V.parse_predictions(None) == []


def test_resume(rows):
    s = rows([("p", "d"), ("q", "d"), ("r", "d")], "image_path string, dataset string")
    asked = rows([("p", [("t", "q1"), ("t", "q1"), ("t", "q2")]), ("x", [("t", "q")])], "image_path string, questions array<struct<question_type:string,question:string>>")
    done = rows([("p", "q2"), ("p", ""), ("x", "q")], "image_path string, question string")
    assert {(r.image_path, r.stage) for r in R.stages(s, rows([("q",), ("q",)], "image_path string"), asked).collect()} == {("p", "done"), ("q", "phase2"), ("r", "phase1")}
    assert [r.question for r in R.pending_answers(s, asked, done).collect()] == ["q1", "q1"]
    assert [tuple(r) for r in R.relevant_keys(done, s).collect()] == [("p", "q2")]
    assert not R.barrier((3, 2, 3)) and R.barrier((3, 2, 3), strict=False) and R.barrier((3, 3, 3))


def stored(df, path):
    """df as a table of files, which the planner knows by their size."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pending_answers_of_a_hot_picture_without_broadcast(rows, tmp_path):
    s = stored(rows([(f"p{i}",) for i in range(0, 2000, 2)] + [(None,)], "image_path string"), tmp_path / "s")
    each = [("p0", "t", f"q{i}") for i in range(300)] + [(f"p{i}", "t", "q") for i in range(1, 2000)] + [(None, "t", "q"), ("p0", "t", None)]
    asked = stored(rows(each, "image_path string, question_type string, question string"), tmp_path / "q")
    done = stored(rows([("p0", "q7"), ("p4", "q")], "image_path string, question string"), tmp_path / "a")
    got = R.pending_answers(s, asked, done)
    want = [("p0", f"q{i}") for i in range(300) if i != 7] + [("p0", None)] + [(f"p{i}", "q") for i in range(2, 2000, 2) if i != 4]
    assert "Broadcast" not in plan(got)
    assert sorted(((r.image_path, r.question) for r in got.collect()), key=str) == sorted(want, key=str)


def test_relevant_keys_of_a_hot_picture_without_broadcast(rows, tmp_path):
    s = stored(rows([(f"p{i}",) for i in range(0, 2000, 2)] + [(None,)], "image_path string"), tmp_path / "s")
    each = [("p0", f"q{i}") for i in range(300)] * 2 + [(f"p{i}", "q") for i in range(1, 2000)] + [(None, "q"), ("p2", ""), ("p2", None), ("p2", "q")]
    got = R.relevant_keys(stored(rows(each, "image_path string, question string"), tmp_path / "a"), s)
    assert "Broadcast" not in plan(got)
    assert sorted(map(tuple, got.collect())) == sorted([("p0", f"q{i}") for i in range(300)] + [(f"p{i}", "q") for i in range(2, 2000, 2)])


def test_pending_predictions_limit_first(rows):
    a, b = rows([(i, "p", f"q{i}") for i in range(5)], "i long, image string, question string"), rows([("p", "q0")], "image string, question string")
    assert sorted(r.i for r in R.pending_predictions(a, b, "i", 2).collect()) == [1] and R.pending_predictions(a, b, "i").count() == 4


def test_parse_questions(rows):
    d = rows([("Existence|有路吗|真的\nfoo|x\ncounting|\n无分隔\n location | 在哪 ",), (None,)], "r string")
    assert [(r.i, r.question_type, r.question) for r in R.parse_questions(d, "r").collect()] == [(1, "existence", "有路吗|真的"), (2, "location", "在哪")]
    assert R.parse_questions(d, "r", 1).count() == 1


def test_pairs(rows):
    d = rows([(f"/e/images/x_{i}_{s}_disaster.png",) for i in range(60) for s in ("pre", "post")] + [("/e/images/y_1_pre_disaster.png",), ("/e/a.png",), (None,)], "p string")
    reg = P.registry(d, "p")
    assert reg.count() == 61 and P.complete_pairs(reg).count() == 50
    assert {tuple(r) for r in P.event_stats(reg).collect()} == {("x", 60, 120), ("y", 1, 1)}


def test_counters(rows):
    d = rows([("A", "t"), ("A", "u"), (None, "t")], "d string, q string")
    assert {tuple(r) for r in R.run_counters(d, "d", "q").collect()} == {("phase3_completed", 3), ("dataset_A", 2), ("dataset_None", 1), ("type_t", 2), ("type_u", 1)}


def test_two_picture_records(rows):
    from tesserae.operators import pairs as P

    r = P.record(rows([("a.png", "b.png", "说明"), (None, "c.png", None)], "p string, q string, t string"), "p", "q", "问", "t").collect()
    assert r[0].images == ["a.png", "b.png"] and [(m.role, m.content) for m in r[0].messages] == [("user", "<image>\n<image>\n问"), ("assistant", "说明")]
    assert r[1].images == [None, "c.png"] and r[1].messages[1].content is None


def test_answer_figures(rows):
    from tesserae.operators import curate as C

    a = ["<answer>有。</answer>", "没有。", "No.", "Yes, it is", "Nobody", None, "<analysis>1. 甲\n2、乙</analysis><answer>否</answer>", ""]
    d = rows([(x, "existence", 1) for x in a] + [("有", "counting", 1)], "answer string, t string, label int").drop("label")
    assert {r.label: r.cnt for r in C.yes_no_balance(d, "answer", F.col("t")).collect()} == {"yes": 2, "no": 3}
    assert {r.steps: r.cnt for r in C.step_histogram(d, "answer").collect()} == {0: 7, 2: 1}


def test_salted_semi_join(spark):
    from tesserae.functions.rows import salted_semi

    d = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    keys = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3), (None, 4)], "k string, v int")
    assert sorted(r.v for r in salted_semi(d, keys, "k", "v").collect()) == sorted([*range(0, 900, 3), 4])
    assert salted_semi(d, keys.where("v < 0"), "k", "v").count() == 0


def test_a_cluster_needs_a_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace as N

    import pytest

    from tesserae.functions.rows import cut

    conf = N(get=lambda *a: None)
    for master, fine in (("spark://h:7077", False), ("local-cluster[2,1,1024]", False), ("yarn", False), ("local[4]", True), ("local", True)):
        sc = N(getCheckpointDir=lambda: None, master=master, setCheckpointDir=lambda x: None)
        df = N(sparkSession=N(sparkContext=sc, conf=conf), checkpoint=lambda eager: "done")
        if fine:
            assert cut(df) == "done"
        else:
            with pytest.raises(RuntimeError):
                cut(df)
