"""Problem 7: filling fixed-capacity containers with items.

Method: bin completion branch-and-bound. Around the largest open document the undominated fillings of its container are
enumerated; branches whose wasted space already exceeds what the best solution wastes are pruned; best-fit decreasing
gives the first incumbent. Documents are packed in blocks by hash of at most `BLOCK` pieces on average; the containers
of all blocks that stayed under `FULL` are opened again and repacked in a second round of blocks, so that the space
lost at block borders does not grow with the number of blocks.

Defined results: null and empty texts have 0 tokens and go into some container; a document is cut only if it is larger
than the container, into full containers and one remainder that is packed like any other piece; an empty table gives an
empty result; limits that are null or below 1 are ignored.
"""

from __future__ import annotations

import os
import random
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, spread

TOKENIZER = os.environ.get("TESSERAE_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK, FULL, NODES, BRANCH, PIECES, TRIES = 3000, 0.995, 4000, 4, 400, 48


def token_counts(docs: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER, parts: int = 0) -> DataFrame:
    """(id, tokens) by a public tokenizer, whose file is sent to the executors; whole texts."""
    docs.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in pdf[text_col]]
            yield pd.DataFrame({id_col: pdf[id_col], "tokens": n})

    return spread(docs.select(id_col, text_col), parts).mapInPandas(run, f"`{id_col}` bigint, tokens bigint")


def fillings(sizes: list[int], room: int) -> list[tuple[int, ...]]:
    """The fullest undominated fillings of `room` by up to three of the ascending sizes (positions), the fullest first.

    A filling is dominated (Martello and Toth) by one whose pieces its own fit into: the largest piece that fits dominates
    all that are no fuller, and of fillings as full as each other that with the fewest pieces is kept. For two pieces the
    largest partner of each is tried, for three the best partner of pairs near the top; search() adds what still fits.
    """
    out: dict[int, tuple[int, ...]] = {}
    i = bisect_right(sizes, room) - 1
    if i < 0:
        return [()]
    out[sizes[i]] = (i,)
    if sizes[i] == room:
        return [(i,)]
    hi, full = bisect_right(sizes, room // 2, 0, i + 1) - 1, 0
    pairs = []
    for lo in range(min(hi, i - 1), -1, -1):  # two pointers from the middle: for each smaller piece the largest partner
        while hi < i and sizes[hi + 1] <= room - sizes[lo]:
            hi += 1
        if hi > lo:
            pairs.append((sizes[lo] + sizes[hi], lo, hi))
            full += pairs[-1][0] == room
            if full == BRANCH:  # those that come later are no fuller and rank behind
                break
    pairs.sort(reverse=True)
    for s, a, b in pairs[:BRANCH]:
        out.setdefault(s, (a, b))
    if not pairs or pairs[0][0] < room:
        tried = 0
        for b in range(i, max(-1, i - 24), -1):
            left = room - sizes[b]
            for a in range(bisect_right(sizes, left, 0, b) - 1, max(-1, bisect_right(sizes, left, 0, b) - 9), -1):
                c = bisect_right(sizes, left - sizes[a], 0, a) - 1
                if c >= 0:
                    out.setdefault(sizes[a] + sizes[b] + sizes[c], (c, a, b))
                tried += 1
            if tried > 160 or room in out:
                break
    return [out[s] for s in sorted(out, reverse=True) if s >= sizes[i]][:BRANCH]


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: positions by container."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    open_: list[tuple[int, int]] = []  # (room, container), ascending
    bins: list[list[int]] = []
    for i in order:
        j = bisect_right(open_, (sizes[i] - 1, 1 << 60))
        if j < len(open_):
            room, b = open_.pop(j)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(open_, (room - sizes[i], b))
    return bins


def bound(sizes: list[int], capacity: int) -> int:
    """Containers needed at least: by the space, and with pieces over half a container that share none (Martello and Toth)."""
    s = sorted(sizes)
    sums = [0, *accumulate(s)]
    half = bisect_right(s, capacity // 2)
    need = -(-sums[-1] // capacity)
    for k in sorted(set(s[:half])):
        lo, hi = bisect_left(s, k), max(half, bisect_right(s, capacity - k))
        free = (hi - half) * capacity - (sums[hi] - sums[half])  # room beside the pieces over half that may still take one of size k
        need = max(need, len(s) - half + max(0, -(-(sums[half] - sums[lo] - free) // capacity)))
    return need


def search(sizes: list[int], capacity: int, most: int, nodes: int) -> tuple[list[list[int]] | None, int]:
    """Depth first for at most `most` containers: positions by container, None if there are none or the budget ends; nodes spent.

    A node is one container around the largest piece left, with a filling that leaves no room for any other piece; a
    branch ends when it has wasted more than `most` containers may, so every leaf that is reached is a solution.
    """
    rest = sorted((s, i) for i, s in enumerate(sizes))
    keys = [s for s, _ in rest]
    allowed, spent = most * capacity - sum(sizes), 0
    made: list[list[tuple[int, int]]] = []
    wasted = [0]

    def options() -> list[tuple[int, list[int]]]:
        below, out = keys[:-1], {}
        for pick in fillings(below, capacity - keys[-1]):
            room, chosen = capacity - keys[-1] - sum(below[p] for p in pick), set(pick)
            j = bisect_right(below, room) - 1
            while j >= 0:  # any number of pieces: the largest that still fits
                if j in chosen:
                    j -= 1
                    continue
                chosen.add(j)
                room -= below[j]
                j = min(j - 1, bisect_right(below, room) - 1)
            out.setdefault(tuple(sorted(below[p] for p in chosen)), (room, sorted(chosen, reverse=True)))
        return sorted(out.values(), key=lambda x: (x[0], len(x[1])))

    if not rest or allowed < 0:
        return ([] if not rest else None), 0
    todo = [options()]
    while todo:
        if not todo[-1] or wasted[-1] + todo[-1][0][0] > allowed:  # the fullest comes first: no later one wastes less
            todo.pop()
            if made:
                wasted.pop()
                for x in made.pop():
                    j = bisect_left(rest, x)
                    rest.insert(j, x)
                    keys.insert(j, x[0])
            continue
        if spent >= nodes:
            return None, spent
        room, pick = todo[-1].pop(0)
        spent += 1
        made.append([rest.pop(), *(rest[p] for p in pick)])
        keys.pop()
        for p in pick:
            del rest[p], keys[p]
        wasted.append(wasted[-1] + room)
        if not rest:
            return [[i for _, i in b] for b in made], spent
        todo.append(options())
    return None, spent


def complete(sizes: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Bin completion: positions by container, never more containers than best-fit decreasing.

    Parts of the block come first: the emptiest containers, which together waste one at least, are packed anew with some
    of the others. Then the whole block is searched, with a node for each container
    besides its budget, so that leaves are in reach at any size.
    """
    best = best_fit(sizes, capacity)
    least = bound(sizes, capacity)
    if len(best) > max(1, least):
        first = greedy_completion(sizes, capacity)
        best = first if len(first) < len(best) else best
    best = repack(sizes, capacity, best, least, 3 * nodes)
    left = len(best) + nodes * PIECES // max(PIECES, len(sizes))  # a node costs as the number of pieces
    while left > 0 and len(best) > max(1, least):
        found, spent = search(sizes, capacity, len(best) - 1, left)
        left -= spent
        if found is None:
            break
        best = found
    return best


def repack(sizes: list[int], capacity: int, best: list[list[int]], least: int, nodes: int) -> list[list[int]]:
    """Save containers by searching parts of about `PIECES` pieces."""
    rng, left = random.Random(0), nodes
    for _ in range(TRIES):
        if left <= 0 or len(best) <= max(1, least):
            break
        room = [capacity - sum(sizes[i] for i in b) for b in best]
        order = sorted(range(len(best)), key=lambda j: (-room[j], j))
        part, free, n = [], 0, 0
        for k, j in enumerate(order):
            if free >= capacity:
                others = order[k:]
                rng.shuffle(others)
                while others and n < PIECES:
                    part.append(others.pop())
                    n += len(best[part[-1]])
                break
            part.append(j)
            free += room[j]
            n += len(best[j])
        if free < capacity:
            break
        at = [i for j in part for i in best[j]]
        found, spent = search([sizes[i] for i in at], capacity, len(part) - 1, min(left, nodes // TRIES + len(at)))
        left -= max(1, spent)
        if found is not None:
            keep = set(part)
            best = [b for j, b in enumerate(best) if j not in keep] + [[at[i] for i in b] for b in found]
    return best


def greedy_completion(sizes: list[int], capacity: int) -> list[list[int]]:
    """The first branch of the search: each container around the largest piece takes its fullest filling."""
    rest = sorted((s, i) for i, s in enumerate(sizes))
    keys = [s for s, _ in rest]
    bins = []
    while rest:
        top = rest.pop()
        keys.pop()
        pick = fillings(keys, capacity - top[0])[0] if rest else ()
        chosen = [top[1]]
        room = capacity - top[0]
        for p in sorted(pick, reverse=True):
            chosen.append(rest[p][1])
            room -= rest[p][0]
            del rest[p], keys[p]
        while rest:  # a filling of three may leave room for more
            j = bisect_right(keys, room) - 1
            if j < 0:
                break
            chosen.append(rest[j][1])
            room -= rest[j][0]
            del rest[j], keys[j]
        bins.append(chosen)
    return bins


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["tokens", "doc_id", "piece"], kind="stable").reset_index(drop=True)
    sizes = pdf.tokens.tolist()
    bins = complete(sizes, int(pdf.capacity_tokens.iloc[0]))
    place, used = [""] * len(sizes), [0] * len(sizes)
    tag = f"{pdf['round'].iloc[0]}-{pdf.block.iloc[0]}-"
    for b, items in enumerate(bins):
        total, name = sum(sizes[i] for i in items), tag + str(b)
        for i in items:
            place[i], used[i] = name, total
    return pd.DataFrame({"limit_id": pdf.limit_id, "capacity_tokens": pdf.capacity_tokens, "container": place, "doc_id": pdf.doc_id, "piece": pdf.piece, "tokens": pdf.tokens, "used": used})


_OUT = "limit_id bigint, capacity_tokens bigint, container string, doc_id bigint, piece bigint, tokens bigint, used bigint"


def _round(pieces: DataFrame, n: int) -> DataFrame:
    """Pack pieces in blocks; the number of blocks of a limit follows the number of its pieces."""
    blocks = maybe_broadcast(pieces.groupBy("limit_id").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks")).withColumnRenamed("limit_id", "_limit"))
    at = pieces.join(blocks, F.col("limit_id") == F.col("_limit")).withColumn("block", F.pmod(F.xxhash64(F.lit(n), "doc_id", "piece"), F.col("_blocks")))
    at = at.select("limit_id", "capacity_tokens", "doc_id", "piece", "tokens", "block", F.lit(n).alias("round"))
    spark = pieces.sparkSession  # a fixed number of partitions: blocks are small but costly, and must not be put together into few tasks
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return at.repartition(tasks, "limit_id", "block").groupBy("limit_id", "block").applyInPandas(_solve, _OUT)


def fill(docs: DataFrame, limits: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, parts: int = 0) -> DataFrame:
    """(limit_id, container, doc_id, piece, tokens, unused): the container of every document or piece."""
    counts = cut(token_counts(docs, id_col, text_col, tokenizer, parts).withColumnRenamed(id_col, "doc_id"))
    lim = limits.where("capacity_tokens >= 1 and limit_id is not null").select(F.col("limit_id").cast("bigint"), F.col("capacity_tokens").cast("bigint"))
    sizes = lim.agg(F.collect_set(F.struct("limit_id", "capacity_tokens"))).scalar()  # the table of container sizes; every document is packed once for each
    both = counts.select("*", F.inline(sizes))
    cap, tok = F.col("capacity_tokens"), F.col("tokens")
    n = F.floor(tok / cap)
    whole = both.where(tok > cap).select(
        "limit_id", "capacity_tokens", "doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("piece"), cap.alias("tokens")
    ).select("limit_id", "capacity_tokens", F.concat_ws("-", F.lit("w"), "doc_id", "piece").alias("container"), "doc_id", "piece", "tokens", F.col("tokens").alias("used"))
    rest = both.where((tok <= cap) | (tok % cap > 0)).select(
        "limit_id", "capacity_tokens", "doc_id", F.when(tok > cap, n).otherwise(0).cast("bigint").alias("piece"), F.when(tok > cap, tok % cap).otherwise(tok).alias("tokens")
    )
    first = cut(_round(rest, 1))
    done = F.col("used") >= FULL * F.col("capacity_tokens")
    second = _round(first.where(~done).drop("container", "used"), 2)
    return (
        whole.unionByName(first.where(done)).unionByName(second)
        .select("limit_id", "container", "doc_id", "piece", "tokens", (F.col("capacity_tokens") - F.col("used")).alias("unused"))
    )


def waste(filled: DataFrame) -> DataFrame:
    """Per limit: containers, unused tokens and their share of all space."""
    per = filled.groupBy("limit_id", "container").agg(F.max("unused").alias("unused"), F.sum("tokens").alias("used"))
    return per.groupBy("limit_id").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("unused").alias("unused_tokens"), F.round(F.sum("unused") / F.sum(F.col("unused") + F.col("used")), 6).alias("unused_share")
    )
