from pyspark.sql import functions as F

from tesserae.operators import validate as V


def judge(rows, data):
    d = rows(data, "a string, t string, ea boolean")
    return [(r.is_valid, r.label, list(r.warnings)) for r in V.validate(d, "a", "t", F.col("ea")).collect()]


def test_format_failures(rows):
    data = [("是", "existence", False), ("<answer></answer>", "existence", False), (None, None, True), ("<answer>有</answer>", "existence", True), ("</answer><answer>x", "existence", False), ("<analysis><answer>有</answer></analysis>x", "existence", True)]
    got = judge(rows, data)
    assert [x[1] for x in got] == ["format_fail"] * 5 + ["pass"]
    assert [x[2][0] for x in got[:5]] == [V.NO_ANSWER_TAG, V.EMPTY_ANSWER, V.NO_ANSWER_TAG, V.NO_ANALYSIS_TAG, V.NO_ANSWER]


def test_warnings(rows):
    got = judge(rows, [("<answer>有，面积约30平方米</answer>", "existence", False), ("<answer>需要确认，存在</answer>", "existence", False), ("<answer>x</answer>", "location", False)])
    assert got[0] == (False, "warning", [V.NUMERIC, V.NUMERIC])
    assert got[1] == (True, "pass", [V.SOFT + "需要"])
    assert got[2] == (True, "pass", [V.NO_PLACE])


def test_analysis(rows):
    good = "<analysis>\n1. 图像右侧可见规则的矩形屋顶。\n2. 与道路相邻，排列整齐。\n</analysis>\n<answer>有</answer>"
    assert judge(rows, [(good, "existence", True)]) == [(True, "pass", [])]
    four = "<analysis>" + "\n".join(f"{i}. 我认为可见" for i in range(1, 5)) + "</analysis><answer>有</answer>"
    assert judge(rows, [(four, "existence", True)])[0][2] == ["analysis 步骤数为 4，建议不超过 3 步", V.META]
    assert judge(rows, [(four, "existence", False)])[0][2] == [V.DIRECT_TAG]


def test_salvage(rows):
    d = rows([("<answer>是",), ("<analysis>x<answer>是",), ("是",), ("<answer>是</answer> ",), (None,)], "a string")
    assert [r.x for r in d.select(V.salvage(F.col("a"), F.lit(True)).alias("x")).collect()] == ["<answer>是</answer>", "<analysis>x</analysis>\n<answer>是</answer>", "是", "<answer>是</answer> ", None]
    once = d.select(V.salvage(F.col("a"), F.lit(True)).alias("a"))
    assert [r.a for r in once.collect()] == [r.x for r in once.select(V.salvage(F.col("a"), F.lit(True)).alias("x")).collect()]


def test_salvage_counts(rows):
    d = rows([("<answer>有", "existence"), ("有", "existence"), ("<answer>有</answer>", "existence")], "a string, t string")
    r = V.salvage_counts(V.salvaged(d, "a", "t", F.lit(False))).first()
    assert (r.total, r.salvaged, r.recovered) == (3, 1, 1)
