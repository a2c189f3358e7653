import pytest
from pyspark.sql import functions as F

from tesserae.operators import teacher as X
from tesserae.operators import verifiable as V


def test_translate():
    assert V.translate("small building next to a road") == "道路旁边的小型建筑物"
    assert V.translate("a large  square forest in the image") == "大型方形森林" and V.translate("thing") == "thing"
    assert len(V.NOUN_ZH) == 58 and len(V.SCENE_ZH) == 45


def test_translate_of_nested_relations():
    assert V.translate("a road on the left of a small building next to the large forest") == "大型森林旁边的小型建筑物左侧的道路"
    assert V.translate("a road next to a small building on the left of the forest") == "森林左侧的小型建筑物旁边的道路"
    assert V.translate("The Water Areas at the bottom of a  golf course") == "高尔夫球场下方的水域"
    assert V.translate("small red pier") == "小型red pier" and V.translate("") == "" and V.translate("large") == "大型" and V.translate("a building in the image next to a road") == "道路旁边的建筑物"


def test_subtypes(rows):
    q = ["Is the entire road flooded?", "Are there more roads than water areas?", "Is there a road?", "Is the number of roads equal to the number of buildings?"]
    assert [r.x for r in rows([(x,) for x in q], "q string").select(V.yesno_subtype(F.col("q")).alias("x")).collect()] == ["other_yesno", "comparison_yesno", "presence_yesno", "count_equal_yesno"]


def test_classify_and_localize(rows):
    s = " Answer in one word or a short phrase."
    scene = "Classify the given image. Classes: Beach, sea  ice, road." + s
    data = [
        (1, "x/beach/a.png", [(scene,), ("Beach",)]), (2, "x/lake/a.png", [(scene,), ("beach",)]), (3, None, [(scene,), ("yes",)]),
        (4, "", [("<image>\nIs it a rural or an urban area?" + s,), ("Yes",)]), (5, "i", [("Are there any roads?" + s,), ("No.",)]),
        (6, "i", [("Is there a small building next to a road?" + s,), ("yes",)]), (7, "i", [("q",)]), (8, "i", None), (9, "a.png", [(scene,), ("sea ice",)]),
    ]
    c = V.classify(rows(data, "id long, image string, conversations array<struct<value:string>>"))
    assert [r.kind for r in c.orderBy("id").collect()] == ["scene_classification", None, None, "binary_yesno", "binary_yesno", "binary_yesno", None, None, "scene_classification"]
    z = {r.id: (r.question, r.reference) for r in V.localize(c).collect()}
    assert z[5] == (V.FALLBACK, "否") and z[6] == ("图中有道路旁边的小型建筑物吗？请只回答是或否。", "是") and z[9][1] == "海冰"
    assert z[1][0].startswith("请判断这张遥感图像的主要场景类别。可选类别：海滩、海冰、road。")


def test_scene_candidates(rows):
    d = rows([(list("abcdefgh") + ["c"], "i", "C ")], "c array<string>, i string, a string")
    got = d.select(V.scene_candidates(F.col("c"), F.col("i"), F.col("a")).alias("x")).first().x
    assert len(got) == 6 == len(set(got)) and "c" in got


def test_reward(rows):
    d = rows([("**Reward: 0.5**",), ("Reward: abc",), ("none",), ("Reward: 7",), ("Reward: 1 Reward: 2",), (None,), ("Reward: 0.5d",)], "c string")
    assert [r.x for r in d.select(X.reward(F.col("c")).alias("x")).collect()] == [0.5, 0.0, 0.0, 7.0, 1.0, 0.0, 0.0]


def test_reward_query(rows):
    m = [("system", "s"), ("user", "u"), ("assistant", "a#x")]
    d = rows([(m, "t")], "m array<struct<role:string,content:string>>, g string")
    assert d.select(X.reward_query("#query#|#ground_truth#|#response#", F.col("m"), F.col("g")).alias("x")).first().x == '[{"role":"user","content":"u"}]|t|a#x'


def test_ask(rows):
    def make():
        def call(prompt, image, tokens, temperature):
            if image == "bad":
                raise ValueError("no")
            return f"{prompt}/{image}/{tokens}/{temperature}"

        return call

    d = X.ask(rows([("i", "q"), ("bad", None)], "image string, q string"), X.render("<{q}> {q}.", q=F.col("q")), "image", make, "ask", in_flight=2)
    good, n = X.split_errors(d)
    assert good.first().response == "<q> q./i/2048/0.4" and tuple(n.first()) == (1, 1)


def test_patience():
    waits, tries = [], []

    class Busy(Exception):
        status_code = 503

    def call(*_):
        tries.append(1)
        if len(tries) < 3:
            raise Busy
        return "x"

    assert X.patient(call, 3, sleep=waits.append)("p", "i", 1, 0.0) == "x" and len(waits) == 2
    assert X.patient(call, 0)("p", "i", 1, 0.0) == ""
    with pytest.raises(ValueError):
        X.patient(lambda *_: "", 2)("p", "i", 1, 0.0)
    assert X.model_name("m") == "m" and X.model_name(None, lambda: "p") in ("p", __import__("os").environ.get("VLLM_MODEL"))
