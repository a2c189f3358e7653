import itertools
import os
import random

import pytest

from tesserae.llm import packing as P

tokenizer = pytest.mark.skipif(not os.path.exists(P.TOKENIZER), reason="no tokenizer")


def best(sizes, cap):
    """Least number of containers by exhaustive search."""
    n = len(sizes)
    fits = [m for m in range(1, 1 << n) if sum(sizes[i] for i in range(n) if m >> i & 1) <= cap]
    reach = {0}
    for k in itertools.count(1):
        reach = {a | m for a in reach for m in fits if not a & m}
        if (1 << n) - 1 in reach:
            return k


def test_search_is_optimal_on_small_cases():
    rng = random.Random(4)
    for _ in range(25):
        sizes = [rng.randrange(1, 60) for _ in range(7)]
        bins = P.complete(sizes, 60)
        assert sorted(i for b in bins for i in b) == list(range(7)) and all(sum(sizes[i] for i in b) <= 60 for b in bins)
        assert len(bins) == best(sizes, 60)


def test_large_case_wastes_little():
    rng = random.Random(1)
    sizes = [min(512, int(rng.expovariate(1 / 180)) + 1) for _ in range(1500)]
    bins = P.complete(sizes, 512)
    assert sorted(i for b in bins for i in b) == list(range(1500)) and all(sum(sizes[i] for i in b) <= 512 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 512) * 1.01 + 1 and len(bins) <= len(P.best_fit(sizes, 512))
    assert P.complete([], 5) == [] and P.complete([0, 0], 5) in ([[0, 1]], [[1, 0]])


def test_search_reaches_the_bound_on_a_production_block():
    rng = random.Random(1)
    sizes = [rng.randrange(20, 400) for _ in range(P.BLOCK)]
    bins = P.complete(sizes, 512)
    assert sorted(i for b in bins for i in b) == list(range(P.BLOCK)) and all(sum(sizes[i] for i in b) <= 512 for b in bins)
    assert len(bins) == P.bound(sizes, 512) < len(P.best_fit(sizes, 512))


def test_bound_and_fillings_of_many_pieces():
    rng = random.Random(6)
    for _ in range(40):
        sizes = [rng.randrange(1, 60) for _ in range(7)]
        assert P.bound(sizes, 60) <= best(sizes, 60)
    sizes = [7, 6, 5, 5, 4, 3] * 4
    found, spent = P.search(sizes, 30, 4, 500)
    assert found and spent < 500 and sorted(i for b in found for i in b) == list(range(24)) and [sum(sizes[i] for i in b) for b in found] == [30] * 4
    assert P.search(sizes, 30, 3, 500) == (None, 0) and P.bound([], 5) == 0


@pytest.mark.parametrize("seed", range(3))
def test_search_beats_best_fit_on_remainders_of_documents(seed):
    """Sizes as token counts of documents are once full pieces are cut off."""
    rng = random.Random(seed)
    sizes = [x for x in (n if n <= 512 else n % 512 for n in (int(rng.lognormvariate(5.9, 1.0)) for _ in range(2 * P.BLOCK))) if x][: P.BLOCK]
    bins = P.complete(sizes, 512)
    assert sorted(i for b in bins for i in b) == list(range(P.BLOCK)) and all(sum(sizes[i] for i in b) <= 512 for b in bins)
    assert len(bins) == P.bound(sizes, 512) < len(P.best_fit(sizes, 512))


def test_dominated_fillings_are_left_out():
    assert P.fillings([3, 4, 9], 10) == [(2,)] and P.fillings([5, 5, 9], 10) == [(0, 1), (2,)] and P.fillings([11], 10) == [()]


@tokenizer
def test_many_limits(rows):
    d = rows([(i, "word " * i) for i in range(12)], "doc_id long, text string")
    limits = rows([(i, 20 + i) for i in range(130)], "limit_id long, capacity_tokens long")
    got = P.fill(d, limits)
    assert got.select("limit_id").distinct().count() == 130 and got.where("tokens > 20 + limit_id").count() == 0


@tokenizer
def test_fill(rows):
    rng = random.Random(8)
    docs = [(i, " ".join(["word"] * rng.randrange(1, 200)), 1) for i in range(60)] + [(100, " ".join(["word"] * 1100), 1), (101, None, 1), (102, "", 1), (103, " ".join(["word"] * 256), 1)]
    d = rows(docs, "doc_id long, text string, tokens long").drop("tokens")
    limits = rows([(1, 128), (2, 256), (3, None), (4, 0)], "limit_id long, capacity_tokens long")
    got = P.fill(d, limits).collect()
    size = {r.doc_id: r.tokens for r in P.token_counts(d, "doc_id", "text").collect()}
    assert size[101] == size[102] == 0
    for limit, cap in ((1, 128), (2, 256)):
        mine = [r for r in got if r.limit_id == limit]
        whole, used = {}, {}
        for r in mine:
            whole[r.doc_id] = whole.get(r.doc_id, 0) + r.tokens
            used[r.container] = used.get(r.container, 0) + r.tokens
        assert whole == size and all(u <= cap for u in used.values())
        assert all(r.unused == cap - used[r.container] for r in mine)
        for r in mine:
            assert sum(x.doc_id == r.doc_id for x in mine) == max(1, -(-size[r.doc_id] // cap))
        assert len(used) <= -(-sum(size.values()) // cap) * 1.05 + 1
    assert {r.limit_id for r in got} == {1, 2}
    assert P.waste(P.fill(d, limits)).count() == 2
    assert P.fill(d.where("doc_id < 0"), limits).count() == 0
