"""Problem 6: repetition inside one document.

Method: a suffix array over the letters of every text of an Arrow batch at once (prefix doubling with numpy; suffixes
never run past their own text), the longest common prefixes of neighbouring suffixes, and from the LCP intervals of at
least `least` letters the spans that occurred earlier in the same text; their union is the repeated share.

Texts in which no two stretches of that length have the same hash repeat nothing and are passed by.

Defined results: null texts and texts without letters have share 0; a longest repeat below `least` counts as 0; very long texts are processed
whole; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, spread

LEAST, SHARE = 12, 0.4


def letters(c):
    """Letters alone, folded: tags, digits, white space and punctuation left out, case and width ignored."""
    return F.regexp_replace(F.lower(narrow(F.regexp_replace(c, r"</?[A-Za-z][^<>]*>", ""))), r"[^\p{L}]+", "")


def suffix_order(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and rank of the concatenated texts, texts apart: ends[i] is where the text of position i stops."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    k, at = 1, np.arange(n)
    while True:
        nxt = at + k
        second = np.where(nxt < ends, rank[np.minimum(nxt, n - 1)], 0)
        key = rank * (rank.max() + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        s = key[order]
        new[order] = np.cumsum(np.concatenate(([1], (s[1:] != s[:-1]).astype(np.int64))))
        if (new == rank).all() or k >= (ends - at).max():
            return order, new
        rank, k = new, k * 2


def neighbours(text: list[int], order: list[int]) -> list[int]:
    """Longest common prefixes of neighbouring suffixes of one text (Kasai), the first being 0."""
    n = len(text)
    place, lcp, h = [0] * n, [0] * n, 0
    for i, p in enumerate(order):
        place[p] = i
    for p in range(n):
        r = place[p]
        if not r:
            h = 0
            continue
        q = order[r - 1]
        while p + h < n and q + h < n and text[p + h] == text[q + h]:
            h += 1
        lcp[r] = h
        h = max(0, h - 1)
    return lcp


def may_repeat(texts: list[str], sizes: np.ndarray, least: int) -> np.ndarray:
    """The texts in which two stretches of `least` letters have the same hash; the others repeat nothing of that length.

    Hashes are polynomials, put together from stretches of 1, 2, 4... letters of all texts at once; equal stretches have equal
    hashes, so no repeating text is missed.
    """
    some = np.flatnonzero(sizes > least)
    if not len(some):
        return some
    part = np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le"), np.uint32).astype(np.uint64)
    doc = np.repeat(np.arange(len(some)), sizes[some])
    n = len(part) - least + 1
    h, done, size, base = None, 0, 1, 0x9E3779B97F4A7C15
    while done < least:
        if least & size:
            piece = part[done : done + n]
            h, done = (piece if h is None else h * np.uint64(base) + piece), done + size
        if done < least:
            part = part[:-size] * np.uint64(base) + part[size:]
            base, size = base * base & 0xFFFFFFFFFFFFFFFF, size * 2
    h = ((h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(24)
    inside = doc[:n] == doc[least - 1 :]
    key = np.sort((doc[:n][inside].astype(np.uint64) << np.uint64(40)) | h[inside])
    return some[np.unique((key[1:][key[1:] == key[:-1]] >> np.uint64(40)).astype(np.int64))]


def repeats(texts: list[str], least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the share of letters in stretches of `least` or more that occurred earlier in it, and the longest such stretch."""
    sizes = np.array([len(t) for t in texts], np.int64)
    share, longest = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    use = may_repeat(texts, sizes, least)
    if not len(use):
        return share, longest
    codes = np.frombuffer("".join(texts[i] for i in use).encode("utf-32-le"), np.uint32)
    size = sizes[use]
    stop = np.cumsum(size)
    doc = np.repeat(np.arange(len(use)), size)
    ends = stop[doc]
    n = len(codes)
    order, rank = suffix_order(codes, ends)
    # suffixes of one text together, in suffix order: neighbours within the text
    mine = np.lexsort((rank, doc))
    a, b = mine[:-1], mine[1:]
    same = doc[a] == doc[b]
    lcp = np.zeros(n, np.int64)  # of mine[i] with mine[i - 1]
    live, length, step = np.flatnonzero(same), np.zeros(n - 1, np.int64), 0
    while len(live):  # vectorised comparison letter by letter; few pairs stay for long
        x, y = a[live] + step, b[live] + step
        ok = (x < ends[a[live]]) & (y < ends[b[live]])
        ok[ok] = codes[x[ok]] == codes[y[ok]]
        live = live[ok]
        length[live] += 1
        step += 1
        if step >= 64 and len(live):  # long repeats: their texts one by one, each in linear time
            for d in np.unique(doc[a[live]]):
                lo, hi = int(stop[d] - size[d]), int(stop[d])
                length[lo : hi - 1] = neighbours(codes[lo:hi].tolist(), (mine[lo:hi] - lo).tolist())[1:]
            break
    lcp[1:] = length
    # LCP intervals of at least `least`: a suffix whose interval holds an earlier start is covered as far as their common prefix
    group = np.cumsum(lcp < least)
    covered = np.zeros(n + 1, np.int64)
    grp_size = np.bincount(group)
    inside = grp_size[group] > 1
    pos, g = mine[inside], group[inside]
    if len(pos):
        first = np.full(group.max() + 1, n, np.int64)
        np.minimum.at(first, g, pos)
        later = pos[pos > first[g]]
        np.add.at(covered, later, 1)
        np.add.at(covered, later + least, -1)
        hit = np.cumsum(covered[:n]) > 0
        share[use] = np.bincount(doc, weights=hit, minlength=len(use)) / size
        top = np.zeros(len(use), np.int64)
        np.maximum.at(top, doc[mine], lcp)
        longest[use] = np.where(top >= least, top, 0)
    return share, longest


def measure(rows: DataFrame, id_col: str, text_col: str, least: int = LEAST, parts: int = 0) -> DataFrame:
    """(id, letters, repeated_share, longest_repeat) for every row; one narrow pass, no shuffle."""
    batch_letters = 2_000_000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["_t"].fillna("").tolist()
            share, longest = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            i = 0
            while i < len(texts):  # bounded memory: as many texts at once as fit, at least one
                j, total = i, 0
                while j < len(texts) and (j == i or total + len(texts[j]) <= batch_letters):
                    total += len(texts[j])
                    j += 1
                share[i:j], longest[i:j] = repeats(texts[i:j], least)
                i = j
            yield pd.DataFrame({id_col: pdf[id_col], "letters": [len(t) for t in texts], "repeated_share": share, "longest_repeat": longest})

    slim = rows.select(F.col(id_col), letters(F.col(text_col)).alias("_t"))
    return spread(slim, parts).mapInPandas(run, f"`{id_col}` bigint, letters bigint, repeated_share double, longest_repeat bigint")


def found(rows: DataFrame, id_col: str, text_col: str, share: float = SHARE, parts: int = 0) -> DataFrame:
    return measure(rows, id_col, text_col, parts=parts).where(F.col("repeated_share") >= share)
