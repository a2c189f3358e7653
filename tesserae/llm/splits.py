"""Problem 3: splits that keep related records together.

Scenes are connected components over file keys (dates, pieces and altered copies of a picture share a key) and the ties of
the manifest. Method of the split: components are bundled by size and label (large sizes by narrow classes, so that bundles
stay few); min-cost flow allots all bundles to the splits with costs for deviations from the quotas of bundles, labels and
splits; the flow is rounded integrally and the members of a bundle are assigned by hash.

Defined results: rows with a null or blank image are related to nothing, each is a component of its own; the same value
in several rows is one picture; an empty table gives an empty result; targets that are null count as 0, and if all are 0
the splits get equal shares; a component larger than every quota goes to the split that it overfills least.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import shuffled_rank
from .common import ROOTS, cut, fits, look_up, once, with_path
from .proportions import category

#: Endings of a file name that mark a piece or an altered copy of the picture named before them.
DERIVED = r"(?:[ _-]?\(\d+\)|[_-](?:copy|copie|duplicate|dup)(?:[_-]?\d+)?|[_-](?:rot|rotate|rotated|r)[_-]?(?:90|180|270)|[_-]h?v?flip(?:[_-]?(?:lr|ud|h|v|x|y))?|[_-]mirror|[_-]crop[_-]?\d*|[_-]x\d+[_-]y\d+|[_-]r\d+[_-]c\d+|[_-](?:tile|patch|part)[_-]?\d+(?:[_-]\d+)?|[_-]\d+x\d+|@\d+x|[_-](?:aug|bright|gray|grey|blur|noise|resized?|scaled|enhanced|sharp)\d*)+$"
#: The steps of a path that only tell the date of the picture.
DATES = r"/(?:a|b|im1|im2|t1|t2|pre|post|before|after)/(?=[^/]*$)"
#: Bundles: components of more than 1 / LARGE of the rows alone, exact sizes up to EXACT, wider classes beyond, most frequent labels.
LARGE, EXACT, STEP, LABELS = 200, 64, 1.05, 8
STEM_DATE = r"[_-](?:pre|post)(?:[_-]disaster)?(?=$|[_-])"


def with_scene(df: DataFrame, source: str, name: str, roots: Sequence[str] = ROOTS) -> DataFrame:
    """df with the key of the scene that a picture's own path tells; null for null and blank paths."""
    df = with_path(df, source, "_path", roots)
    p = F.regexp_replace(F.col("_path"), r"\.[a-z0-9]{1,5}$", "")
    p = F.regexp_replace(p, DERIVED, "")
    p = F.regexp_replace(p, STEM_DATE, "")
    p = F.regexp_replace(p, DERIVED, "")
    return once(df, **{name: F.regexp_replace(p, DATES, "/")}).drop("_path")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): connected components of edges (a, b); component is the least node name.

    Each round, every node takes the least label among its own, its neighbours' and its parent's, hooks its parent to it,
    and jumps to its parent's parent: the number of rounds grows with the logarithm of the longest chain. All steps are
    joins and partial minimums, so a node with very many ties is never gathered in one task. State is checkpointed.
    """
    e = edges.where("a is not null and b is not null and a <> b")
    both = cut(e.select("a", "b").unionAll(e.select(F.col("b"), F.col("a"))).distinct())
    label = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")).withColumnRenamed("a", "n"))
    while True:
        near = both.join(label, both["b"] == label["n"]).groupBy("a").agg(F.min("l").alias("m"))
        best = label.join(near, label["n"] == near["a"]).select("n", "l", F.least("l", "m").alias("m"))
        hook = best.select("n", F.col("m").alias("x")).unionAll(best.select("l", "m")).groupBy("n").agg(F.min("x").alias("l"))
        up = hook.select(F.col("n").alias("pn"), F.col("l").alias("pl"))
        jumped = hook.join(up, hook["l"] == up["pn"], "left").select("n", F.coalesce("pl", "l").alias("l"))
        old = label.select(F.col("n").alias("on"), F.col("l").alias("ol"))
        new = cut(jumped)
        moved = new.join(old, new["n"] == old["on"]).where("l <> ol").limit(1).count()
        label = new
        if not moved:
            return label.select(F.col("n").alias("node"), F.col("l").alias("component"))


def pictures(sft: DataFrame, val: DataFrame) -> DataFrame:
    """(image, scene): every stored value of either table once."""
    images = sft.select("image").unionAll(val.select("image")).where("image is not null").distinct()
    return with_scene(images, "image", "scene").where("scene is not null")


def related(sft: DataFrame, val: DataFrame, manifest: DataFrame) -> DataFrame:
    """(image, component) for every stored value with a path."""
    m = manifest.where("image_path is not null and derived_from is not null").select("image_path", "derived_from").distinct()
    ties = with_scene(with_scene(m, "image_path", "a"), "derived_from", "b").select("a", "b")
    comp = components(ties)
    p = pictures(sft, val)
    return p.join(comp, p["scene"] == comp["node"], "left").select("image", F.coalesce("component", "scene").alias("component"))


def related_pairs(sft: DataFrame, val: DataFrame, manifest: DataFrame) -> DataFrame:
    """(image_a, image_b): all pairs of different values of one component, image_a < image_b in byte order."""
    r = cut(related(sft, val, manifest))
    a, b = r.select("component", F.col("image").alias("image_a")), r.select("component", F.col("image").alias("image_b"))
    return a.join(b, "component").where("image_a < image_b").select("image_a", "image_b")


def scenes(sft: DataFrame, val: DataFrame, manifest: DataFrame) -> DataFrame:
    """(image, component, links): every stored value once, with its class and the number of other values tied to it."""
    r = cut(related(sft, val, manifest))
    n = r.groupBy("component").agg((F.count(F.lit(1)) - 1).alias("links"))
    return look_up(r, "component", n)


class MinCostFlow:
    """Primal-dual: shortest distances by cost, then blocking flows over the edges that lie on shortest ways.

    Costs take few values, so there are few distances and few rounds, whatever the number of edges.
    """

    def __init__(self, n: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, cap: int, cost: int) -> int:
        for x, y, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def flow(self, edge: int) -> int:
        return self.cap[edge ^ 1]

    def run(self, s: int, t: int) -> None:
        pot = [0] * len(self.out)
        while True:
            dist: list[float] = [math.inf] * len(self.out)
            dist[s], heap = 0, [(0, s)]
            while heap:
                d, x = heapq.heappop(heap)
                if d > dist[x]:
                    continue
                for i in self.out[x]:
                    y, far = self.to[i], d + self.cost[i] + pot[x] - pot[self.to[i]]
                    if self.cap[i] and far < dist[y]:
                        dist[y] = far
                        heapq.heappush(heap, (far, y))
            if dist[t] == math.inf:
                return
            pot = [p + int(min(d, dist[t])) for p, d in zip(pot, dist)]
            while self._block(s, t, pot):
                pass

    def _block(self, s: int, t: int, pot: list[int]) -> bool:
        """One blocking flow over edges without reduced cost, in layers by their number; False if t is out of reach."""
        layer = [-1] * len(self.out)
        layer[s], queue = 0, [s]
        for x in queue:
            for i in self.out[x]:
                y = self.to[i]
                if self.cap[i] and layer[y] < 0 and not self.cost[i] + pot[x] - pot[y]:
                    layer[y] = layer[x] + 1
                    queue.append(y)
        if layer[t] < 0:
            return False
        at, way, x = [0] * len(self.out), [], s
        while True:
            if x == t:
                room = min(self.cap[i] for i in way)
                for i in way:
                    self.cap[i] -= room
                    self.cap[i ^ 1] += room
                k = next(k for k, i in enumerate(way) if not self.cap[i])
                x = self.to[way[k] ^ 1]
                del way[k:]
                continue
            while at[x] < len(self.out[x]):
                i = self.out[x][at[x]]
                y = self.to[i]
                if self.cap[i] and layer[y] == layer[x] + 1 and not self.cost[i] + pot[x] - pot[y]:
                    break
                at[x] += 1
            if at[x] < len(self.out[x]):
                way.append(self.out[x][at[x]])
                x = self.to[way[-1]]
            elif x == s:
                return True
            else:
                x = self.to[way.pop() ^ 1]
                at[x] += 1


#: Cost of a row beyond the whole components of a bundle's share, beyond a label's quota, and beyond a split's.
BUNDLE_COST, LABEL_COST, SPLIT_COST = 1, 4, 16


def _flow(bundles: list[tuple[int, int, str]], shares: list[float], label_room: dict[str, list[float]], room: list[float]) -> list[list[float]]:
    """Components of each bundle for each split, in fractions, by the cheapest flow of all rows over (label, split) to the splits."""
    k, n, labels = len(shares), len(bundles), sorted(label_room)
    at = {x: n + i * k for i, x in enumerate(labels)}
    split = n + len(labels) * k
    source, sink, all_rows = split + k, split + k + 1, sum(b[0] for b in bundles)
    net, arcs = MinCostFlow(sink + 1), []
    for i, (rows, count, label) in enumerate(bundles):
        net.edge(source, i, rows, 0)
        arcs.append([(net.edge(i, at[label] + j, int(rows * int(count * x + 1e-9) / count), 0), net.edge(i, at[label] + j, rows, BUNDLE_COST)) for j, x in enumerate(shares)])
    for x in labels:
        for j in range(k):
            net.edge(at[x] + j, split + j, max(0, int(label_room[x][j])), 0)
            net.edge(at[x] + j, split + j, all_rows, LABEL_COST)
    for j in range(k):
        net.edge(split + j, sink, max(0, int(room[j])), 0)
        net.edge(split + j, sink, all_rows, SPLIT_COST)
    net.run(source, sink)
    return [[sum(map(net.flow, e)) * count / max(1, rows) for e in edges] for (rows, count, _), edges in zip(bundles, arcs)]


def allot(bundles: list[tuple[int, int, str]], shares: list[float]) -> list[list[int]]:
    """Components of each bundle (rows, number of components, label) for each split.

    What a bundle gives a split beyond the whole components of its share, what a split gets of a label beyond the label's
    quota, and what it gets at all beyond its own quota costs. The flow of all bundles places the components of over
    1 / LARGE of the rows, the largest first; the others flow again around them. Flows are rounded to components: whole
    components as they flow, the rest to the split with the greatest part of a component left and, among equals, the most room.
    """
    k, total = len(shares), sum(b[0] for b in bundles)
    of: dict[str, int] = {}
    for rows, _, label in bundles:
        of[label] = of.get(label, 0) + rows
    room, label_room = [total * x for x in shares], {x: [r * y for y in shares] for x, r in of.items()}
    given = [[0] * k for _ in bundles]

    def give(i: int, j: int, number: int) -> None:
        size = bundles[i][0] / bundles[i][1]
        given[i][j] += number
        room[j] -= number * size
        label_room[bundles[i][2]][j] -= number * size

    def place(some: list[int], parts: list[list[float]]) -> None:
        for i, part in zip(some, parts):
            for j in range(k):
                give(i, j, int(part[j] + 1e-6))
        for i, part in sorted(zip(some, parts), key=lambda x: -bundles[x[0]][0] / bundles[x[0]][1]):
            size = bundles[i][0] / bundles[i][1]
            left = [p - g for p, g in zip(part, given[i])]
            for _ in range(bundles[i][1] - sum(given[i])):
                j = max(range(k), key=lambda j: (round(left[j], 6) if room[j] >= size / 2 else -1, room[j]))
                give(i, j, 1)
                left[j] -= 1

    large = [i for i, (rows, count, _) in enumerate(bundles) if rows * LARGE > total * count]
    if large:
        parts = _flow(bundles, shares, label_room, room)
        place(large, [[0.0 if p < 1 else p for p in parts[i]] for i in large])  # those that flow to several splits go where most room is
    rest = [i for i in range(len(bundles)) if not sum(given[i])]
    place(rest, _flow([bundles[i] for i in rest], shares, label_room, room))
    return given


def bundled(comps: DataFrame, total: int) -> DataFrame:
    """comps (component, size, label) with `bundle`: components of over 1 / LARGE of all rows stand alone, the others are
    together by size, from EXACT rows on by classes that are STEP wide, so that bundles are as many as a logarithm."""
    s = F.col("size")
    by_size = F.when(s <= EXACT, s).otherwise(EXACT + F.ceil(F.ln(s / EXACT) / math.log(STEP)))
    return comps.withColumn("bundle", F.when(s * LARGE > total, F.col("component")).otherwise(F.concat(F.lit("\x00"), by_size.cast("string"))))


def assign(sft: DataFrame, val: DataFrame, manifest: DataFrame, targets: DataFrame, seed: int = 3407) -> DataFrame:
    """(record_set, row_id, split_name): one split per row, one split per component.

    Only the bundles and the targets come to the driver. There are at most LARGE bundles of one component, and of the others
    at most (EXACT + ln(rows) / ln(STEP)) times (LABELS + 1): some thousands, whatever the number of rows. A component's
    label is the most frequent question type of its rows, one of the LABELS most frequent types of all or 'other'.
    """
    spark = sft.sparkSession
    rows = sft.select(F.lit("sft").alias("record_set"), F.col("sft_id").alias("row_id"), "image", category(F.col("question_type")).alias("_t")).unionAll(
        val.select(F.lit("val"), "val_id", "image", category(F.col("question_type")) if "question_type" in val.columns else F.lit(None).cast("string"))
    )
    per = cut(rows.groupBy("image", F.coalesce("_t", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("n")))
    most = [r[0] for r in per.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "label").limit(LABELS).collect()]
    label = lambda c: F.when(c.isin(most), c).otherwise("other") if most else F.lit("other")
    rel = cut(related(sft, val, manifest))
    of = per.where("image is not null").join(rel.withColumnRenamed("image", "_im"), F.col("image") == F.col("_im"))
    parts = of.groupBy("component", label(F.col("label")).alias("label")).agg(F.sum("n").alias("n"))
    comp = parts.groupBy("component").agg(F.sum("n").alias("size"), F.max_by("label", F.struct("n", "label")).alias("label"))
    # rows without a picture are components of their own
    paths = cut(rows.where("image is not null").select("image").distinct().join(rel.select("image"), "image", "left_anti"))
    alone = rows.where("image is null")
    if not fits(paths, 0):
        alone = alone.unionAll(look_up(rows.where("image is not null"), "image", paths.withColumn("_blank", F.lit(True))).where("_blank").drop("_blank"))
    alone = alone.select("record_set", "row_id", F.concat(F.col("record_set"), F.lit("\x00"), F.col("row_id").cast("string")).alias("component"), F.lit(1).cast("bigint").alias("size"), label(F.coalesce("_t", F.lit(""))).alias("label"))
    none = F.lit(None)
    everything = comp.select(none.cast("string").alias("record_set"), none.cast("bigint").alias("row_id"), "component", "size", "label").unionByName(alone)
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    comps = cut(bundled(everything, total))
    bundles = [tuple(r) for r in comps.groupBy("bundle", "label").agg(F.sum("size"), F.count(F.lit(1))).orderBy("bundle", "label").collect()]
    goal = [(r[0], max(0.0, r[1] or 0.0)) for r in targets.groupBy("split_name").agg(F.max("target_share")).orderBy("split_name").collect() if r[0] is not None]
    whole = sum(x for _, x in goal)
    shares = [x / whole if whole else 1 / len(goal) for _, x in goal]
    ends = []
    for (bundle, name, _, _), given in zip(bundles, allot([(rows_, count, name) for _, name, rows_, count in bundles], shares) if goal else []):
        upto = 0
        for (split_name, _), c in zip(goal, given):
            if c:
                ends.append((bundle, name, upto, upto + c, split_name))
            upto += c
    cuts = F.broadcast(spark.createDataFrame(ends, "_b string, _l string, _after bigint, _upto bigint, split_name string"))  # as many as the bundles at most for each split
    placed = shuffled_rank(comps, ["bundle", "label"], "component", seed, "_r")
    inside = (F.col("bundle") == F.col("_b")) & (F.col("label") == F.col("_l")) & (F.col("_r") > F.col("_after")) & (F.col("_r") <= F.col("_upto"))
    done = cut(placed.join(cuts, inside).select("record_set", "row_id", "component", "split_name"))
    images = look_up(rel, "component", done.where("row_id is null").select("component", "split_name")).select("image", "split_name")
    tied = look_up(rows.where("image is not null").select("record_set", "row_id", "image"), "image", cut(images))
    return tied.where("split_name is not null").select("record_set", "row_id", "split_name").unionByName(done.where("row_id is not null").select("record_set", "row_id", "split_name"))
