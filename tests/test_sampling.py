import pytest
from pyspark.sql import functions as F

from tesserae.operators import ranks as R
from tesserae.operators import sampling as S


def sizes(df, c):
    return {r[c]: r["count"] for r in df.groupBy(c).count().collect()}


def test_balanced_fills_labels_evenly(rows):
    d = rows([(i, l) for i, l in enumerate("a" * 1 + "b" * 10 + "c" * 10)], "i long, l string")
    assert sizes(S.balanced(d, "l", 8, "i"), "l") == {"a": 1, "b": 4, "c": 3}
    assert S.balanced(d, "l", 0, "i").count() == 21 and S.balanced(d, "l", 99, "i").count() == 21


def test_sizes_and_determinism(rows):
    d = rows([(i, "x" if i % 3 else "y") for i in range(300)], "i long, g string")
    for f in (lambda x: S.uniform(x, 40, "i"), lambda x: S.per_group(x, "g", 30, "i"), lambda x: S.train_val(x, "i", 0.05).where("split = 'val'"), lambda x: S.first_n(x, "g", 4, "i")):
        a, b = ({r.i for r in f(x).collect()} for x in (d, d.repartition(7)))
        assert a == b and a
    assert S.uniform(d, 400, "i").count() == 300 and S.uniform(d, -1, "i").count() == 0
    assert sizes(S.train_val(d, "i", 0.05), "split") == {"val": 15, "train": 285}
    assert S.first_n(d, "g", 0, "i").count() == 300


@pytest.mark.parametrize(("n", "ratio", "val"), [(3785, 0.02, 75), (3785, 0.05, 189), (10, 0.0, 0)])
def test_split_sizes(spark, n, ratio, val):
    assert S.train_val(spark.range(n), "id", ratio).where("split = 'val'").count() == val


def test_spec(rows):
    assert S.parse_spec(" A=2, ,B=3,A=1,") == {"A": 1, "B": 3}
    for bad in ("A", "=1", "A=-1", "A=x"):
        with pytest.raises(ValueError):
            S.parse_spec(bad)
    d = rows([(i, "AB"[i % 2]) for i in range(20)], "i long, g string")
    assert sizes(S.with_spec(d, "g", {"A": 4, "B": 0, "C": 5}, "i"), "g") == {"A": 4}


def test_rebalance(rows):
    d = rows([(i, t) for i, t in enumerate(["existence"] * 50 + ["ambiguous"] * 3 + ["odd"] * 5)], "i long, question_type string")
    assert sizes(S.rebalance(d, "i"), "question_type") == {"ambiguous": 3}  # a missing type empties the main types
    data = [t for t, n in {"existence": 700, "location": 300, "spatial_relation": 200, "attribute": 200, "counting": 60, "unanswerable": 9}.items() for _ in range(n)]
    got = sizes(S.rebalance(rows(list(enumerate(data)), "i long, question_type string"), "i"), "question_type")
    weight = {t: S.SCHEDULE[t] / sum(map(S.SCHEDULE.get, S.MAIN_TYPES)) for t in S.MAIN_TYPES}
    cap = int(min(n / weight[t] for t, n in {"existence": 700, "location": 300, "spatial_relation": 200, "attribute": 200, "counting": 60}.items()))
    assert got == {**{t: min(round(w * cap), data.count(t)) for t, w in weight.items()}, "unanswerable": 9}


def test_assigned_types(rows):
    d = rows([(f"p{i}",) for i in range(400)], "image string")
    a = S.assign_types(d, "image", 2, 4)
    n = [r["count"] for r in a.groupBy("image").count().collect()]
    assert set(n) == {2, 3, 4} and len(n) == 400
    share = sizes(a, "question_type")["existence"] / sum(n)
    assert 0.27 < share < 0.39
    assert S.assign_types(d, "image", 2, 1).count() == 0
    line = S.plan_text(rows([("p", 1, "location"), ("p", 2, "existence"), ("p", 3, "location")], "image string, i long, question_type string"), "image").first()
    assert line.plan == "- existence：1 个\n- location：2 个"


def test_ranks_of_a_hot_group(spark):
    d = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, F.lit(None).cast("string")).otherwise("hot").alias("g"))
    r = R.shuffled_rank(d, ["g"], "id", 1, "r").groupBy("g").agg(F.min("r").alias("a"), F.max("r").alias("b"), F.countDistinct("r").alias("c")).collect()
    assert {(x.g, x.a, x.b, x.c) for x in r} == {("hot", 1, 4500, 4500), (None, 1, 500, 500)}


def test_last_wins(rows):
    d = rows([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), (None, 1, "n")], "k string, p long, v string")
    assert {(r.k, r.v) for r in R.last_wins(d, ["k"], ["p"]).collect()} == {("a", "z"), (None, "n")}


def test_choose(rows):
    d = rows([("A" if i % 2 else "E", f"E/{i % 3}/x/{i}.png") for i in range(60)], "dataset string, image_path string")
    n = lambda **k: {r.dataset: r["count"] for r in S.choose(d, "image_path", "dataset", **k).groupBy("dataset").count().collect()}
    inner = ("E", F.element_at(F.split("image_path", "/"), 2), 2)
    assert sum(n(total=7, per_dataset="3").values()) == 7 and n(per_dataset="3") == {"A": 3, "E": 3} and n(per_dataset="A=4,odd=9") == {"A": 4}
    assert n(per_dataset="3", nested=inner) == {"A": 3, "E": 6} and n(per_dataset="A=1", nested=inner) == {"A": 1, "E": 6}
    assert S.choose(d, "image_path", "dataset", manifest=d.limit(1), total=9).count() == 1
    assert [r.dataset for r in S.unknown_names({"A": 1, "odd": 9}, d, "dataset").collect()] == ["odd"]
    assert [r.image_path for r in S.shuffled(d, "image_path").collect()] == [r.image_path for r in S.shuffled(d.repartition(3), "image_path").collect()]
