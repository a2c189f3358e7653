import random

from pyspark.sql import functions as F

from tesserae.llm import proportions as P
from tesserae.llm import splits as S
from tesserae.llm.common import look_up, with_path

SFT = "sft_id long, image string, question string, answer string, question_type string, answer_mode string, source_dataset string, extra long"
TARGETS = "plan_id long, source_dataset string, question_type string, target_share double, min_rows long, sample_rows long"


def typed(rows, types, ds="A"):
    return rows([(i, None, None, None, t, None, ds, 1) for i, t in enumerate(types)], SFT)


def test_deficits_against_brute_force(rows):
    types = ["x"] * 30 + [" X　"] * 5 + ["y-z", "Y_Z ", None, "", "other"]
    sft = typed(rows, types)
    targets = rows([(1, None, "x", 0.5, 0, 70), (1, None, "y_z", 0.5, 0, 5), (2, "B", "x", 0.1, 1, 4), (3, "A", "x", 0.0, 36, 4), (4, None, "none", 0.0, 0, 0)], TARGETS)
    got = {(r.plan_id, r.question_type, r.observed_rows, r.need_rows) for r in P.deficits(sft, targets).collect()}
    assert got == {(1, "y_z", 2, 3), (2, "x", 0, 1), (3, "x", 35, 36)}  # halves round up


def test_sample_sizes(rows):
    sft = typed(rows, ["a"] * 5000 + ["b"] * 300 + ["c"] * 10)
    targets = rows([(1, None, "a", 0.5, 0, 600), (1, None, "b", 0.3, 0, 600), (1, None, "c", 0.2, 0, 600), (2, "A", "a", 0.9, 0, 100), (2, "A", "b", 0.1, 40, 100), (3, "Z", "a", 1.0, 0, 10)], TARGETS)
    n = {(r.plan_id, r.question_type): r["count"] for r in P.sample(sft, targets).groupBy("plan_id", "question_type").count().collect()}
    assert n == {(1, "a"): 369, (1, "b"): 221, (1, "c"): 10, (2, "a"): 60, (2, "b"): 40}
    one, two = (sorted(tuple(r) for r in P.sample(x, targets).collect()) for x in (sft, sft.repartition(5)))
    assert one == two and len(set(one)) == len(one)


def test_empty_tables(rows):
    none = typed(rows, [])
    targets = rows([(1, None, "a", 0.5, 0, 10)], TARGETS)
    assert P.sample(none, targets).count() == 0 and P.deficits(none, targets).first().missing_rows == 5
    assert P.sample(typed(rows, ["a"]), rows([], TARGETS)).count() == 0


def test_quotas_of_infeasible_and_short_plans(rows):
    sft = typed(rows, ["a"] * 500 + ["b"] * 500 + ["c"] * 500 + ["d"] * 10)
    targets = rows([(1, None, t, 1 / 3, 50, 100) for t in "abc"] + [(2, None, "a", 0.5, 0, 100), (2, None, "d", 0.5, 0, 100)] + [(3, None, "d", 1.0, 0, 100), (3, None, "a", None, 5, 100)] + [(4, None, "a", -1.0, None, None)], TARGETS)
    q = {(r.plan_id, r.question_type): (r.quota, r.missing_rows, r.short_rows) for r in P.quotas(sft, targets).collect()}
    assert sorted(q[1, t][0] for t in "abc") == [33, 33, 34] and all(q[1, t][1] == 0 and q[1, t][2] == 50 - q[1, t][0] for t in "abc")
    assert q[2, "a"] == (90, 0, 0) and q[2, "d"] == (10, 40, 40)
    assert q[3, "d"] == (10, 90, 90) and q[3, "a"] == (5, 0, 0) and q[4, "a"] == (0, 0, 0)
    n = {r.plan_id: r["count"] for r in P.sample(sft, targets).groupBy("plan_id").count().collect()}
    assert n == {1: 100, 2: 100, 3: 15}


def test_level_against_search():
    rng = random.Random(9)
    for _ in range(200):
        k = rng.randrange(1, 6)
        share, seen = P.np.array([rng.choice([0.0, rng.random()]) for _ in range(k)]), P.np.array([float(rng.randrange(0, 40)) for _ in range(k)])
        low = P.np.minimum(seen, [rng.randrange(0, 12) for _ in range(k)])
        n = rng.randrange(0, 100)
        x = P.level(share, low, P.np.where(share > 0, seen, 0.0), n)
        most = P.np.where(share > 0, seen, low).sum()
        assert abs(x.sum() - min(n, max(most, low.sum()))) < 1e-6 or low.sum() < n > x.sum() and abs(x.sum() - most) < 1e-6
        assert (x <= P.np.maximum(seen, low) + 1e-9).all() and (low.sum() > n or (x >= low - 1e-9).all())


def test_look_up_with_a_hot_key_and_nulls(spark):
    d = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")))
    t = spark.createDataFrame([("hot", 1.5), ("4", 2.5), ("none", 3.5)], "k string, v double")
    got = {r.id: r.v for r in look_up(d, "k", t).collect()}
    assert len(got) == 3000 and all(got[i] == (1.5 if i % 3 == 0 else 2.5 if i == 4 else None) for i in got)
    assert look_up(d.where("id < 0"), "k", t).columns == ["id", "k", "v"]


def test_paths(rows):
    same = ["/srv/rsvqa/dataset/LEVIR-CD+/train/B/1.png", "D:\\rs\\dataset\\LEVIR-CD+\\train\\B\\1.PNG", "file:///data/train/rs_images/LEVIR-CD%2B/train/B/1.png", "./LEVIR-CD+//train/./B/1.png　", "/data/train/rs_images/LEVIR-CD+/../LEVIR-CD+/train/B/1.png"]
    d = with_path(rows([(x,) for x in [*same, None, " "]], "image string"), "image", "p")
    assert [r.p for r in d.collect()] == ["levir-cd+/train/b/1.png"] * 5 + [None, None]


def scenes(rows, paths):
    return [r.s for r in S.with_scene(rows([(x,) for x in paths], "image string"), "image", "s").collect()]


def test_scenes(rows):
    a = scenes(rows, ["LEVIR-CD+/train/A/7.png", "LEVIR-CD+/train/B/7_rot90.png", "LEVIR-CD+/train/B/7-copy.jpg", "LEVIR-CD+/train/B/7 (2).png", "LEVIR-CD+/train/B/7_x128_y640.png", "LEVIR-CD+/train/B/7@2x.png"])
    assert len(set(a)) == 1
    b = scenes(rows, ["LEVIR-CD+/test/A/7.png", "SECOND/train/im1/7.png", "LEVIR-CD+/train/A/70.png", "EBD/e-1/images/e-1_00000007_pre_disaster.png", "EBD/e-2/images/e-2_00000007_post_disaster.png"])
    assert len(set(a + b)) == 6
    assert len(set(scenes(rows, ["EBD/e/images/e_01_pre_disaster.png", "EBD/e/images/e_01_post_disaster_crop3.png"]))) == 1


def test_components_against_union_find(rows):
    rng = random.Random(1)
    edges = [(f"n{rng.randrange(120)}", f"n{rng.randrange(120)}") for _ in range(90)] + [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("hub", f"h{i}") for i in range(60)] + [("x", "x"), (None, "x")]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a and b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    want = {x: find(x) for x in up if any(x in e for e in edges if None not in e and e[0] != e[1])}
    assert {r.node: r.component for r in S.components(rows(edges, "a string, b string")).collect()} == want


def test_related_pairs_and_splits(rows):
    sft = rows([(i, f"S/train/im2/{i % 40}.png", "q", "a", "t", "m", "d", 0) for i in range(400)] + [(900, None, "q", "a", "t", "m", "d", 0), (901, " ", "q", "a", "t", "m", "d", 0)], SFT)
    val = rows([(1000, "/srv/rsvqa/dataset/S/train/im1/3.png"), (1001, "P/p_1.png")], "val_id long, image string")
    man = rows([("P/p_1.png", "W/t.png"), ("W/t.png", "S/train/im2/5.png"), (None, "x"), ("y", None)], "image_path string, derived_from string")
    pairs = {tuple(r) for r in S.related_pairs(sft, val, man).collect()}
    assert pairs == {("/srv/rsvqa/dataset/S/train/im1/3.png", "S/train/im2/3.png"), ("P/p_1.png", "S/train/im2/5.png")}
    goal = rows([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    got = S.assign(sft, val, man, goal).collect()
    at = {(r.record_set, r.row_id): r.split_name for r in got}
    assert len(got) == len(at) == 404
    assert at["val", 1000] == at["sft", 3] == at["sft", 43] and at["val", 1001] == at["sft", 5]
    n = {s: sum(x == s for x in at.values()) for s in ("train", "validation", "test")}
    assert 300 <= n["train"] <= 345 and n["validation"] >= 25 and n["test"] >= 25


def test_splits_of_flat_names_and_null_pictures(rows):
    """File names without folders, a third of the rows without a picture, and one picture that holds a third."""
    types = ["existence", "Counting", None]
    sft = rows([(i, None if i % 3 == 0 else "hot.png" if i % 3 == 1 else f"{i}.png", "q", "a", types[i % 5 % 3], "m", "d", 0) for i in range(1500)], SFT)
    val = rows([(5000 + i, f"{i}.png") for i in range(50)], "val_id long, image string")
    goal = rows([("train", 0.6), ("validation", 0.2), ("test", 0.2)], "split_name string, target_share double")
    got = S.assign(sft, val, rows([], "image_path string, derived_from string"), goal).collect()
    assert len({(r.record_set, r.row_id) for r in got}) == len(got) == 1550
    n = {s: sum(r.split_name == s for r in got) for s in ("train", "validation", "test")}
    assert all(abs(n[s] / 1550 - x) < 0.01 for s, x in (("train", 0.6), ("validation", 0.2), ("test", 0.2)))
    at = {(r.record_set, r.row_id): r.split_name for r in got}
    assert len({at["sft", i] for i in range(1, 1500, 3)}) == 1 and all(at["val", 5000 + i] == at["sft", i] for i in range(2, 50, 3))


def test_flow_and_quotas():
    bundles = [(4400, 1, "a"), (9000, 9000, "a"), (12000, 6000, "b"), (7500, 2500, "a"), (4000, 800, "b"), (800, 100, "c"), (140, 7, "c")]
    given = S.allot(bundles, [0.8, 0.1, 0.1])
    total = sum(b[0] for b in bundles)
    assert all(sum(g) == b[1] for b, g in zip(bundles, given))
    assert all(abs(sum(b[0] * g[j] / b[1] for b, g in zip(bundles, given)) / total - x) < 0.002 for j, x in enumerate((0.8, 0.1, 0.1)))
    assert all(abs(given[2][j] - 6000 * x) <= 1 for j, x in enumerate((0.8, 0.1, 0.1)))
    net = S.MinCostFlow(4)
    a, b = net.edge(0, 1, 5, 0), net.edge(0, 2, 5, 0)
    c, d = net.edge(1, 3, 3, 1), net.edge(2, 3, 9, 4)
    net.run(0, 3)
    assert [net.flow(x) for x in (a, b, c, d)] == [3, 5, 3, 5]


def test_flow_against_brute_force():
    rng = random.Random(12)
    for _ in range(60):
        n = 5
        edges = [(a, b, rng.randrange(1, 3), rng.randrange(0, 4)) for a in range(n) for b in range(n) if a != b and a != n - 1 and b != 0 and rng.random() < 0.5]
        net = S.MinCostFlow(n)
        at = [net.edge(*e) for e in edges]
        net.run(0, n - 1)
        flow = [net.flow(e) for e in at]
        assert all(sum(f for f, e in zip(flow, edges) if e[1] == x) == sum(f for f, e in zip(flow, edges) if e[0] == x) for x in range(1, n - 1))
        # no way from source to sink and no cycle of negative cost is left in the residual network
        res = [(a, b, w) for f, (a, b, c, w) in zip(flow, edges) if f < c] + [(b, a, -w) for f, (a, b, c, w) in zip(flow, edges) if f]
        far = [0] * n
        for _ in range(n):
            for a, b, w in res:
                far[b] = min(far[b], far[a] + w)
        assert all(far[b] <= far[a] + w for a, b, w in res)
        seen = {0}
        for _ in range(n):
            seen |= {b for a, b, _ in res if a in seen}
        assert n - 1 not in seen


def test_scenes_with_links(rows):
    sft = rows([(1, "S/a/1.png", "q", "a", "t", "m", "d", 0), (2, "/srv/rsvqa/dataset/S/b/1.png", "q", "a", "t", "m", "d", 0), (3, "S/a/2.png", "q", "a", "t", "m", "d", 0), (4, None, "q", "a", "t", "m", "d", 0)], SFT)
    got = {r.image: r.links for r in S.scenes(sft, rows([], "val_id long, image string"), rows([], "image_path string, derived_from string")).collect()}
    assert got == {"S/a/1.png": 1, "/srv/rsvqa/dataset/S/b/1.png": 1, "S/a/2.png": 0}


def test_empty_splits(rows):
    val, man = rows([], "val_id long, image string"), rows([], "image_path string, derived_from string")
    goal = rows([("train", None)], "split_name string, target_share double")
    assert S.assign(typed(rows, []), val, man, goal).count() == 0 and S.related_pairs(typed(rows, []), val, man).count() == 0
