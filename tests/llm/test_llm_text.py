import random
import re
from itertools import product

import pytest

from tesserae.llm import defects as D
from tesserae.llm import leakage as L
from tesserae.llm import overlap as O
from tesserae.llm import repetition as R
from tesserae.llm import spam as X
from tesserae.llm import truncation as T
from tesserae.llm.common import sift


def brute_share(x, least=12):
    seen, covered = set(), [False] * len(x)
    for i in range(len(x) - least + 1):
        g = x[i : i + least]
        if g in seen:
            covered[i : i + least] = [True] * least
        seen.add(g)
    return sum(covered) / len(x) if x else 0.0


def brute_longest(x):
    return max((n for n in range(1, len(x)) if any(x.find(x[i : i + n], i + 1) >= 0 for i in range(len(x) - n))), default=0)


def test_repetition_against_brute_force():
    rng = random.Random(5)
    texts = ["", "a", "a" * 200, "abc" * 40, "x" * 12, "x" * 13] + ["".join(rng.choice("ab") for _ in range(rng.randrange(80))) for _ in range(60)]
    base = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts += [base + base[10:40] + "zz" + base[:25], base * 3]
    share, longest = R.repeats(texts)
    for t, s, n in zip(texts, share, longest):
        assert s == pytest.approx(brute_share(t)), t
        top = brute_longest(t)
        assert n == (top if top >= 12 else 0), t


def test_repetition_table(rows):
    long = "深绿色的水渠位于图像东侧边缘地带。" * 900
    d = rows([(1, None), (2, ""), (3, "<answer>12。</answer>"), (4, long), (5, "ＡＢCDEFGHIJKLMnop abcdefghijklm 1")], "sft_id long, answer string")
    got = {r.sft_id: (r.letters, round(r.repeated_share, 3)) for r in R.measure(d, "sft_id", "answer").collect()}
    assert got[1] == got[2] == got[3] == (0, 0.0) and got[4][1] > 0.99 and got[5] == (29, round(13 / 29, 3))
    assert sorted(r.sft_id for r in R.found(d, "sft_id", "answer").collect()) == [4, 5]
    assert R.measure(d.where("sft_id > 9"), "sft_id", "answer").count() == 0


def test_overlap(rows):
    train = rows(
        [
            (1, "/srv/rsvqa/dataset/S/train/im2/1.png", "图中东侧有没有圆形铁路？", "d", 1), (2, "S/train/im1/1.png", "图中东侧有没有圆形铁路？", "d", 1), (3, "S/train/im2/1.png", "图中西侧有没有圆形铁路？", "d", 1),
            (4, "S/train/im2/2.png", "网格 12：Is it there?", None, 1), (5, None, "q", "d", 1), (6, "S/train/im2/3.png", None, "d", 1), (7, "S/train/im2/4.png", "Where is the red pier located in the image?", "e", 1),
            (8, "S/train/im2/5.png", "网格374：图中有路吗", "d", 1), (9, "S/train/im2/6.png", "？", "d", 1), (1, "S/train/im2/1.png", "图中东侧有没有圆形铁路？", "d", 1),
        ],
        "sft_id long, image string, question string, source_dataset string, val_id long",
    )
    held = rows(
        [
            (11, "D:\\rs\\dataset\\S\\train\\im2\\1.png", "<image>\n请问，影像中东侧有无圆形的铁路？谢谢。"), (12, "S/train/im2/4.png", "q: where si thee red  pier located in the picture"), (13, "S/train/im2/5.png", "网格3744：图中有路吗"),
            (14, None, "q"), (15, "S/train/im2/6.png", "？"), (16, "S/train/im2/5.png", "在编号374的格子里，图中有路吗？请直接回答。"),
        ],
        "val_id long, image string, question string",
    )
    got = sorted((r.sft_id, r.val_id) for r in O.overlaps(train.drop("val_id"), held).collect())
    assert got == [(1, 11), (1, 11), (7, 12), (8, 16)]
    assert {tuple(r) for r in O.report(train.drop("val_id"), held).collect()} == {("val", "d", 3, 2, 2), ("val", "e", 1, 1, 1)}
    assert O.overlaps(train.where("sft_id < 0").drop("val_id"), held).count() == 0


def test_words_that_differ(rows):
    ask = ["Are there buildings left of the road?", "Are three buildings left of the road?", "Is a form near the pier?", "Is a from near the pier?", "Is the seat wide?", "Is the east wide?", "Where is the wraehouse?", "Where is the warehouse?", "how manny piers are there", "How many piers are there?", "Wher eis teh pier"]
    train = rows([(i, "S/a.png", q, "d") for i, q in enumerate(ask)], "sft_id long, image string, question string, source_dataset string")
    held = rows([(100 + i, "S/a.png", q) for i, q in enumerate(ask)], "val_id long, image string, question string")
    got = {(r.sft_id, r.val_id - 100) for r in O.overlaps(train, held).collect()}
    assert got == {(i, i) for i in range(len(ask))} | {(6, 7), (7, 6), (8, 9), (9, 8)}


def test_cells_in_other_wordings(rows):
    ask = ["网格12：有路吗", "在第12号方格里，有路吗？", "格子编号12，有路吗", "标号 12 的网格中，有路吗", "单元格13，有路吗"]
    train = rows([(i, "S/a.png", q, "d") for i, q in enumerate(ask)], "sft_id long, image string, question string, source_dataset string")
    held = rows([(100, "S/a.png", "序号12的格网内，有路吗？")], "val_id long, image string, question string")
    assert sorted(r.sft_id for r in O.overlaps(train, held).collect()) == [0, 1, 2, 3]


BASE = ["画面左侧有少量云影，但不影响辨认。", "水渠的边缘与裸土相接。", "影像分辨率有限，细部只能看出模糊的轮廓。", "东侧。", "共3处水塔。"]


LONG = "从影像上看成排的水渠与裸土之间还隔着一条宽约两个像元并且沿着图幅边缘一直延伸到西南角的便道" * 3


def cut_ids(rows, extra):
    data = [(i, BASE[i % 5] + BASE[(i + 2) % 5] + LONG + "。", "s") for i in range(60)] + [(100 + i, t, "s") for i, t in enumerate(extra)]
    texts = rows([("sft", i, s, t) for i, t, s in data], "record_set string, row_id long, source string, text string")
    return sorted(r.row_id for r in T.truncated(texts, texts).collect())


def test_truncation(rows):
    extra = [
        "水渠的边缘与裸土相接。画面左侧有少量云", "画面左侧有少量云影，", "水渠的边缘与裸土相接。影像分辨率有", "水渠的边缘与裸�", "水渠的边缘与裸土相接。\n2.",  # cut
        "水渠的边缘与裸土相接。（东侧", "「东侧", LONG[:-9],  # cut
        "水渠的边缘与裸土相接", LONG, "<answer>画面左侧有少量云影，但不影响辨认", "东侧", "共8处水塔", None, "", "null", "水渠的边缘与裸土相接。</answer>", "水渠的边缘与裸土相接。（仅供参考）", "……", "<answer>东侧</answer>",
    ]
    assert cut_ids(rows, extra) == list(range(100, 108))


def test_truncation_without_broadcasts(rows, monkeypatch):
    """Where the nodes that are asked for are too many to be broadcast, the result is the same."""
    extra = ["水渠的边缘与裸土相接。画面左侧有少量云", "水渠的边缘与裸土相接", "影像分辨率有", "東", "共8处水"]
    want = cut_ids(rows, extra)
    monkeypatch.setattr(T, "WANTED", 0)
    monkeypatch.setattr(T, "maybe_broadcast", lambda df: df)
    assert cut_ids(rows, extra) == want == [100, 102, 103, 104]


def test_truncation_at_a_low_limit(rows):
    """A source that cuts at 7 letters: what is a whole answer elsewhere goes on here."""
    whole = ["水渠的边缘与裸土", "水渠的边缘与裸土相接，东侧有路。", "水渠的边缘与裸土相接，西侧有塔。"]
    data = [("sft", i, "s", whole[i % 3] + "。") for i in range(30)] + [("sft", 100 + i, "s", "东侧。水渠的边") for i in range(9)]
    texts = rows(data, "record_set string, row_id long, source string, text string")
    assert sorted(r.row_id for r in T.truncated(texts, texts).collect()) == list(range(100, 109))


def test_truncation_rates_and_empty(rows):
    schema = "record_set string, row_id long, source string, text string"
    t = rows([("sft", 1, None, "甲乙。"), ("sft", 2, None, "甲乙，"), ("sft", 3, "x", None)], schema)
    assert {(r.source, r.n_rows, r.n_truncated) for r in T.rates(t, t).collect()} == {(None, 2, 1), ("x", 1, 0)}
    assert T.truncated(t.where("row_id < 0"), t.where("row_id < 0")).count() == 0


def test_suffix_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(80):
        q, a = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(2))
        want = [max((n for n in range(i + 2) if a[i + 1 - n : i + 1] in q), default=0) for i in range(len(a))]
        got = D.SuffixAutomaton(q).walk(a)
        assert [n for n, _ in got] == want and all(q[e - n : e] == a[i + 1 - n : i + 1] for i, (n, e) in enumerate(got))
    assert D.copied("", "x") == (0.0, 0.0, 0.0, 1) and D.copied("abc图中有路吗", "图中有路吗") == (1.0, 5 / 8, 5 / 8, 0)
    assert D.copied("图中有路吗", "有路吗有路吗有路吗") == (1.0, 3 / 5, 3 / 5, 0)


def test_every_declining_phrase_reaches_the_automaton():
    net = D.Refusals()
    for slots in (*D.REFUSING, *D.BEGINNING, *D.ALONE):
        for phrase in map("".join, product(*(x.split("|") for x in slots))):
            assert net.declines(phrase) and (re.search(D.STEMS, phrase) or sum(map(str.isascii, phrase)) > 2)
    assert net.declines("无法确认。") and not net.declines("无法确认边界，但东侧有路") and not net.declines("抱歉" + "路" * 60 + "无法") and not net.declines("hawaii can't see it")
    assert net.declines("sorry, this is outside of what i can do") and net.declines("非常抱歉，没有收到图片") and not net.declines("道路不能通行")


def test_copies_in_any_form(rows):
    zh, en = "图中东侧有没有圆形铁路？", "Is there a red pier in the image?"
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in en)
    copies = [("有路吗？", "有路吗？"), ("路？", "路"), (zh, zh * 3), (zh, zh + "答："), (zh, "问题：" + zh + "\n答案："), (en, wide), ("请看图，<image>\n" + zh, "Question: 请看图，<image>\n" + zh), (en, en.upper() + " Answer:"), (zh * 300, zh * 300), (zh, "图中东侧有没有圆形铁路" + "。" * 400), (wide, en), (zh, zh + "☆☆"), ("RoadＡ？", "roada")]
    answers = [("有没有道路？", "有道路。"), ("画面左侧有没有一条道路？", "画面左侧有一条道路。"), (zh, "东侧有圆形铁路。"), (zh, "铁路"), (en, "A red pier."), ("Is the object in the left side a vehicle?", "It could be" + " the left" * 30 + "."), (zh, "有" * 2000 + "铁路")]
    data = copies + answers
    pairs = rows([("sft", i, q, a, "existence") for i, (q, a) in enumerate(data)], "record_set string, row_id long, question string, answer string, question_type string")
    assert sorted((r.row_id, r.defect) for r in D.judged(pairs).collect()) == [(i, "copied_question") for i in range(len(copies))]
    assert D.judged(pairs.where("row_id < 0")).count() == 0


def test_defects(rows):
    zh, en = "图中东侧有没有圆形铁路？", "Is there a red pier in the image?"
    data = [
        (zh, None, "existence", "empty"), (zh, "<answer> </answer>", "existence", "empty"), (zh, "N/A", "existence", "empty"), (zh, "……", "existence", "empty"), (zh, "待补充", "existence", "empty"),
        (zh, "抱歉，我无法查看图片内容。", "Existence ", "refusal"), (zh, "我无法查看图片内容。", "ambiguous", None), (en, "As a language model, I can't answer that.", "existence", "refusal"),
        (zh, zh, "existence", "copied_question"), (zh, "问题：" + zh, "existence", "copied_question"), (zh, "“图中东侧有没有圆形铁路”", "existence", "copied_question"), (zh, zh + "有", "existence", None), (en, en + " Yes.", "existence", None),
        (zh, "Yes, it is there.", "existence", "other_language"), (zh, "Да, справа видно поле.", "existence", "other_language"), (zh, "橋は右にあります。", "existence", "other_language"), (en, "存在，码头与裸土相接。", "existence", "other_language"),
        (en, "On voit une route à droite, aux contours nets.", "existence", "other_language"), (en, "There are 八.", "existence", None), (zh, "有，参见 LEVIR-CD+ 的同类样例。标注编号：A-31", "existence", None), (zh, "37", "counting", None), (None, "有。", None, None), (zh, "无", "existence", None),
    ]
    pairs = rows([("sft", i, q, a, t, 1) for i, (q, a, t, _) in enumerate(data)], "record_set string, row_id long, question string, answer string, question_type string, n long")
    texts = pairs.selectExpr("record_set", "row_id", "'s' as source", "answer as text")
    got = {r.row_id: r.defect for r in D.found(pairs, texts, texts.selectExpr("text").unionAll(pairs.selectExpr("question"))).collect() if r.defect != "truncated"}
    assert got == {i: d for i, (*_, d) in enumerate(data) if d}


PASSAGE = "棠榆岛左下角新修的加油站取代了2座圆形光伏板。从珩洄山口望去，浅灰色的湖泊依次排到第401号界桩。第441批样本取自洄鹭台地，废弃的采石场占去4成面积。"
ENGLISH = "Near Queque the annotators of sheet 984 had swapped river and guard booth until a second check. Within 6 years the large beach at the left side of Dodo Bay lost a third of its width."


def test_leaks(rows):
    filler = "统计口径按独立目标计算，连片围墙只算一处。" * 5
    alike = "棠桉岛右上角新修的仓库取代了7座矩形水塔。从珩崎山口望去，砖红色的跑道依次排到第37号界桩。第42批样本取自洄溪台地，成排的码头占去9成面积。"
    alike_en = "Near Katen the annotators of sheet 296 had swapped bridge and nursery until a second check. Within 3 years the small pond at the right side of Mika Bay lost a third of its width."
    docs = [filler + PASSAGE + filler, filler + PASSAGE[24:] + filler, filler + PASSAGE[:18] + filler, filler + alike, None, "", PASSAGE.replace("，", " ").replace("。", "\n"), filler + ENGLISH.upper(), filler + alike_en, PASSAGE.replace("441", "４４１")]
    items = rows([(1, PASSAGE, 0), (2, ENGLISH, 0), (3, None, 0), (4, "", 0)], "item_id long, passage string, doc_id long")
    d = rows([(100 + i, t, "p") for i, t in enumerate(docs)], "doc_id long, text string, passage string")
    want = [(1, 100), (1, 101), (1, 106), (1, 109), (2, 107)]
    assert sorted((r.item_id, r.doc_id) for r in L.leaks(d, items).collect()) == want
    assert L.leaks(d, items.where("item_id < 0")).count() == 0 and L.leaks(d.where("doc_id < 0"), items).count() == 0


def test_leaks_of_a_part_without_the_slots_of_the_rest(rows):
    night = "Night shots of Doul show the green belt at the center-left some 306 levels brighter than the stadium. The Lorrinva desk sorted 647 frames into 2 stacks by their ratio of wall to parking lot."
    view = "从岚榆山口望去，暗褐色的体育场依次排到第384号界桩。桉荻港上方边缘的池塘与集装箱共用一条便道，便道宽约2个像元。洄渚机房把557幅影像按鱼塘与船舶的比例分成5组。榆渚岛西侧新修的水塔取代了5座深绿色绿化带。"
    filler, first, parts = "统计口径按独立目标计算，连片围墙只算一处。" * 5, night.split(" The ")[0], view.split("。")
    alike = night.replace("Doul", "Kaven").replace("306", "41").replace("Lorrinva", "Mikatel").replace("647", "98").replace(" 2 ", " 7 ")
    docs = [filler + first + filler, filler + parts[1] + filler + parts[3] + filler, filler + alike + filler, filler + first[:60] + filler, filler + parts[3] + filler]
    items = rows([(1, night, 0), (2, view, 0)], "item_id long, passage string, doc_id long")
    d = rows([(100 + i, t, "p") for i, t in enumerate(docs)], "doc_id long, text string, passage string")
    assert sorted((r.item_id, r.doc_id) for r in L.leaks(d, items).collect()) == [(1, 100), (2, 101)]


def test_leaks_of_very_short_passages(rows):
    items = rows([(1, "东侧铁路", 0), (2, "No 42", 0), (3, "第1234567号", 0), (4, "！", 0), (5, ENGLISH, 0)], "item_id long, passage string, doc_id long")
    docs = ["图中东侧、铁路旁有水塔。", "东侧铁路", "Pier no. 42 is red.", "Casino 421 is red.", "第1234567号样本", "第7654321号样本", "", None]
    d = rows([(100 + i, t, "p") for i, t in enumerate(docs)], "doc_id long, text string, passage string")
    assert sorted((r.item_id, r.doc_id) for r in L.leaks(d, items).collect()) == [(1, 100), (1, 101), (2, 102), (3, 104)]


def test_leaks_when_windows_are_shared_by_many(rows, monkeypatch):
    """Windows that more than OWNERS passages share leave the join; what is found stays the same, and twins are found each."""
    items = rows([(i, PASSAGE.replace("401", str(500 + i)).replace("棠榆", "甲乙丙丁戊己庚辛"[i] * 2)) for i in range(8)] + [(50, ENGLISH), (51, ENGLISH), (52, "Road 12345")], "item_id long, passage string")
    docs = [PASSAGE.replace("401", "503").replace("棠榆", "丁丁"), ENGLISH + PASSAGE, "On road 12345 there is a pier.", "Road 98765", PASSAGE[:20]]
    d = rows([(100 + i, t) for i, t in enumerate(docs)] + [(100, docs[0])], "doc_id long, text string")
    want = sorted((r.item_id, r.doc_id) for r in L.leaks(d, items).collect())
    assert {(3, 100), (50, 101), (51, 101), (52, 102)} <= set(want) and len(set(want)) == len(want) and not {x for x in want if x[1] > 102}
    monkeypatch.setattr(L, "OWNERS", 2)
    assert sorted((r.item_id, r.doc_id) for r in L.leaks(d, items, parts=3).collect()) == want


def test_windows_and_sift(spark):
    rng = random.Random(1)
    x = "".join(rng.choice("abc图中") for _ in range(300))
    for k in range(1, 14):
        h = L.windows(x, k).tolist()
        assert len(h) == 301 - k and len(set(h)) == len({x[i : i + k] for i in range(301 - k)}) == len({(a, x[i : i + k]) for i, a in enumerate(h)})
    some = spark.range(5000).where("id % 100 = 7")
    kept = {r.id for r in sift(spark.range(5000), "id", some).collect()}
    assert {r.id for r in some.collect()} <= kept and len(kept) < 100 and sift(spark.range(50), "id", some.where("id < 0")).count() == 0


def test_spam(rows):
    rng = random.Random(2)
    places = ["左侧", "右上角", "北部", "东侧"]
    things = ["水渠", "仓库", "码头", "停车场", "林地", "湖泊"]
    forms = [
        "在{p}可以看到{n}处{t}，多为浅灰色。", "{t}与{u}之间的通道宽度不足{n}个像元。", "统计口径按独立目标计算，连片{t}只算一处。", "该地块曾为{t}，现已改为{u}。", "{p}的{t}受阴影影响，颜色比实地更深。", "如果{p}被云覆盖，就跳过计数类问题。",
        "本次抽检发现{t}类漏标{n}处，集中在{p}。", "描述只写清晰可见的内容，例如{p}的{t}。", "同一场景的前后两期影像里，{t}变化最明显。", "从季相看，{t}在枯水期会露出浅灰色滩地。", "教师回答偏长时，{t}的位置信息常被埋在末尾。", "{n}名志愿者参与了{t}专题的整理。",
    ]
    plain = ["".join(f.format(p=rng.choice(places), n=rng.randrange(2, 30), t=rng.choice(things), u=rng.choice(things)) for f in rng.sample(forms, 8)) for _ in range(120)]
    spam = [" ".join(rng.choice(["卫星影像", "测绘外包", "航片打印", "地图代购"]) for _ in range(60)) for _ in range(15)]
    spam += ["\n".join(f"https://geo-{rng.randrange(99)}.test/p?id={rng.randrange(9999)}" for _ in range(40)) for _ in range(15)]
    spam += ["".join(f"专业测绘外包专注影像图斑，测绘外包首选{rng.choice(places)}。测绘外包哪里买？" for _ in range(12)) for _ in range(10)]
    spam += ["贷款" * 6, "cheap shoes " * 5 + "cheap", "https://a.test/1 https://a.test/2"]
    odd = [None, "", "建筑物标注手册", "东侧有路。", "Pier. No pier.", "共3处水塔", plain[0] + "\n参考链接\n[1] 记录 https://rs.test/1\n[2] 记录 https://rs.test/2", plain[1] + "\n类别：" + "、".join(things)]
    data = [(i, t, f"h{i % 9}" if i % 10 else None, 0) for i, t in enumerate(plain + odd + spam)]
    d = rows(data, "doc_id long, text string, source string, score long")
    got = sorted(r.doc_id for r in X.found(d).collect())
    assert got == list(range(len(plain) + len(odd), len(data)))
    assert X.found(d.where("doc_id < 0")).count() == 0 and X.found(d.where("doc_id < 50")).count() == 0
    assert sum(r.spam_pages for r in X.by_host(d).collect()) == len(spam)
