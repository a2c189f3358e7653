import math

from tesserae.operators import health as H
from tesserae.operators import sampling as S


def make(rows, data):
    return H.samples(rows(data, "i long, t string, q string, a string"), "i", "t", "q", "a")


def test_entropy_of_published_counts(rows):
    counts = {"existence": 1569, "location": 817, "spatial_relation": 641, "attribute": 451, "counting": 137, "unanswerable": 85, "ambiguous": 85}
    data = [(i, t, "q", "a") for t, n in counts.items() for i in range(n)]
    s = make(rows, data)
    r = H.entropy(s).first()
    assert math.isclose(r.entropy, 0.7918226473435575, abs_tol=1e-8) and not r.red
    take = {r.question_type: r["take"] for r in S.caps(s).collect()}
    assert take == {"existence": 904, "location": 630, "spatial_relation": 520, "attribute": 384, "counting": 137}


def test_entropy_edges(rows):
    assert H.entropy(make(rows, [(1, "x", "q", "a")])).first().entropy == 1.0
    assert H.entropy(make(rows, [(1, "x", "q", "a"), (2, "y", "q", "a")])).first().entropy == 1.0


def test_lengths(rows):
    r = H.length_overall(make(rows, [(i, "t", "q", "x" * i) for i in range(1, 11)])).first()
    assert (r.cnt, r.p90_len, r.median_len, r.max_len, r.mean_len, r.long_warning) == (10, 10, 5.5, 10, 5.5, False)


def test_top_breaks_ties_by_first_occurrence(rows):
    s = make(rows, [(3, "t", "bbbbbbX", "a"), (1, "t", "aaaaaaX", "a"), (2, "t", "aaaaaaY", None), (4, "t", "bbbbbb", "a")])
    assert [(r.value, r.cnt) for r in H.prefix_top(s).collect()] == [("aaaaaa", 2), ("bbbbbb", 2)]


def test_risks_tags_and_charset(rows):
    s = make(rows, [(1, "t", "q", "坐标附近，面积约３０平方米"), (2, "t", "q", "<answer>是"), (3, None, None, "Я")])
    assert {(r.word, r.cnt) for r in H.risk_words(s).collect()} == {("坐标", 1), (H.NUMERIC_HIT, 1)}
    assert H.risk_rows(s).first().risk_rows == 1 and H.tag_residual(s).first().tag_rows == 1
    assert H.charset(s).first().warning
    dist = {r.question_type: (r.cnt, r.flag) for r in H.type_distribution(s).collect()}
    assert dist["?"] == (1, "非目标") and dist["existence"] == (0, "偏低") and dist["t"][0] == 2


def test_empty_table(rows):
    s = make(rows, [])
    assert H.verdict(s).first().asDict() == {"entropy_red": False, "prefix_red": False, "opening_red": False, "red": False}
    assert H.prefix_top(s).count() == 0 and H.length_overall(s).first().cnt == 0 and H.charset(s).first().cjk_rate == 0.0


def test_report_lines(spark):
    from tesserae.operators import health as H

    s = H.samples(spark.createDataFrame([(1, "existence", "图中有路吗", "有。")], "p long, t string, q string, a string"), "p", "t", "q", "a")
    lines = {r.line for r in H.report(s).collect()}
    assert {"n: 1.000000", "entropy: 1.000000", "top3_share: 1.000000", "tag_rows: 0.000000"} <= lines and len(lines) == 12
    assert H.verdict(s.where("pos < 0")).first().asDict() == {"entropy_red": False, "prefix_red": False, "opening_red": False, "red": False}
