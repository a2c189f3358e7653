"""Problem 9: keyword-stuffed and link-list pages.

Method: content and link features of every page; weak labels from pages where several signs agree; bagged decision
trees trained on a bounded hash sample of the weakly labelled pages (`TRAIN_ROWS` of each label at most); the trees run as
column expressions over all pages, and the page scores are smoothed with the spam rate of their host (source).

Defined results: null and blank texts are no spam; a page of a few words is if it repeats them; a null source is a host of its own kind without smoothing;
very long texts are read whole; equal pages on one host get equal scores; an empty table, or one whose weak labels hold
only one class, falls back to the weak signs alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, spread

LETTERS = 1_000_000
TRAIN_ROWS, TREES, DEPTH, LEAF, SALTS, SMOOTH, PRIOR, THRESHOLD, SEED = 8000, 21, 5, 5, 16, 0.1, 20.0, 0.5, 3407
FEATURES = ("list_share", "link_share", "link_rate", "tag_share", "stop_rate", "function_rate", "repeat_share", "top_share", "offer_rate", "piece_length", "digit_share", "key_share", "n_units")
#: Words and links below which a page is short.
SHORT = 25
#: Weight of the weak signs of a short page beside the trees.
SIGNS = 0.6
#: Frequent function words, which sentences cannot do without.
FUNCTION_ZH = frozenset("的是在了与和有以为从不把被后应而就将其由到可也或及于则各让使若如再先后只这那该并并未均曾现需处会")
FUNCTION_EN = frozenset("the a an of to in on at is are was were be been and or but not no by for from with that this these those it its as than then so such most some only yet how what which where when who has had have does do did can may must should will would into over near within after before between there".split())
_LINK = re.compile(r"!?\[[^\]\n]{0,80}\]\([^)\s]{1,300}\)|https?://\S+|www\.\S+|<a\s[^>]*>.*?</a>", re.I)
_TAG = re.compile(r"#[^\s#]{1,40}|<[^<>\n]{1,200}>")
_OFFER = re.compile(r"[$￥¥€£]\s?\d|\bSKU\b|\d\s?(?:元|USD|RMB|CNY|包邮)|free shipping|in stock|现货|包邮", re.I)
#: Each offer holds one of these in lower case, or a number of yuan.
_OFFER_SIGNS, _YUAN = ("$", "￥", "¥", "€", "£", "sku", "usd", "rmb", "cny", "包邮", "free shipping", "in stock", "现货"), re.compile(r"\d\s?元")
DIGITS = "0123456789０１２３４５６７８９"
#: What separates the entries of a list, what ends a sentence, and what ends a piece.
SPLITS, STOPS, ENDS = ",，、;；|｜/·#>»•-–—:：()[]（）【】", "。！？!?", "。！？!?.\n"
#: Usual shares of function words among Han characters and among Latin words of written text.
USUAL_HAN, USUAL_LATIN = 0.15, 0.32
_HAN, _LATIN, _FUNCTION, _SPACE, _SPLIT, _STOP, _END, _HASH = (1 << i for i in range(8))


def classes() -> np.ndarray:
    """A table from code points to the bits of the classes above; the last entry stands for all code points beyond."""
    t = np.zeros(0x10001, np.uint8)
    t[0x4E00:0xA000] |= _HAN
    for chars, bit in (("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", _LATIN), ("".join(FUNCTION_ZH), _FUNCTION), (SPLITS, _SPLIT), (STOPS, _STOP), (ENDS, _END), ("#", _HASH)):
        for c in chars:
            t[ord(c)] |= bit
    for i in range(0x10000):
        if chr(i).isspace():
            t[i] |= _SPACE | _SPLIT
    return t


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _word_hash(words: list[str]) -> np.ndarray:
    codes = _codes("".join(words)).astype(np.uint64)
    sizes = np.array(list(map(len, words)))
    return _runs_hash(codes, np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)


def _runs_hash(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each run of letters, by polynomials in the place of a letter."""
    if not len(start):
        return np.zeros(0, np.uint64)
    at = np.repeat(start, size)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        power = _POWERS[np.minimum(inside, len(_POWERS) - 1)]
        h = np.add.reduceat((codes[at + inside] + np.uint64(1)) * power, np.cumsum(size) - size)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int = 4096) -> np.ndarray:
    out, x = [], 1
    for _ in range(n):
        out.append(x)
        x = x * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return np.array(out, np.uint64)


_POWERS = _powers()


def _counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, count) of the different hashes of each document; hashes are told apart by 44 bits inside a document."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return (key[first] >> np.uint64(44)).astype(np.int64), np.diff(np.append(first, len(key)))


def _top(doc: np.ndarray, count: np.ndarray, n: int, docs: int) -> np.ndarray:
    """Sum of the n greatest counts of each document."""
    order = np.lexsort((-count, doc))
    d, c = doc[order], count[order]
    first = np.searchsorted(d, d, "left")
    best = np.arange(len(d)) - first < n
    return np.bincount(d[best], weights=c[best], minlength=docs)


def _sum(doc: np.ndarray, hit: np.ndarray, docs: int) -> np.ndarray:
    return np.bincount(doc[hit], minlength=docs).astype(float)


def features(texts: list[str], table: np.ndarray, function: np.ndarray) -> np.ndarray:
    """The features of some pages, a row each, in the order of FEATURES; all pages are measured at once as one array of code points.

    table: classes(); function: sorted hashes of the function words in Latin letters.
    """
    k = len(texts)
    n = np.maximum(1, np.array(list(map(len, texts)), float))
    linked, links, tags, offers = (np.zeros(k) for _ in range(4))
    bare = []
    for i, t in enumerate(texts):
        if "http" in t or "](" in t or "www." in t or "<a" in t:
            found = _LINK.findall(t)
            links[i], linked[i] = len(found), sum(map(len, found))
            b = (_LINK.sub(" \n", t) if found else t).lower()
        else:
            b = t.lower()
        if "#" in b or "<" in b:
            tags[i] = sum(map(len, _TAG.findall(b)))
        if any(map(b.__contains__, _OFFER_SIGNS)) or "元" in b and _YUAN.search(b):
            offers[i] = len(_OFFER.findall(t))
        bare.append(b)
    sizes = np.array([len(b) + 1 for b in bare])
    codes = _codes("\n".join(bare) + "\n")
    doc = np.repeat(np.arange(k), sizes)
    cls = table[np.minimum(codes, 0x10000)]
    has = lambda bit: (cls & bit) > 0
    end, han, latin, space = has(_END), has(_HAN), has(_LATIN), has(_SPACE)
    piece = np.concatenate(([0], np.cumsum(end)[:-1]))  # a page ends with a line end, so no piece runs on into the next page
    pieces = int(piece[-1]) + 1
    begin = latin & ~np.concatenate(([False], latin[:-1]))
    start = np.flatnonzero(begin)
    length = np.flatnonzero(latin & ~np.append(latin[1:], False)) + 1 - start
    codes64 = codes.astype(np.uint64)
    h = _runs_hash(codes64, start, length)
    at = np.minimum(np.searchsorted(function, h), len(function) - 1)
    is_function = function[at] == h
    in_piece = lambda places: np.bincount(piece[places], minlength=pieces)
    words = in_piece(han) + in_piece(start)
    size = in_piece(han) + in_piece(latin)
    functional = in_piece(han & has(_FUNCTION)) + in_piece(start[is_function])
    lists = (words > 0) & ((functional < np.maximum(1, 0.035 * words)) | (in_piece(has(_HASH)) * 12 > size))
    owner = doc[np.append(np.flatnonzero(end), len(codes) - 1)[:pieces]]
    per = lambda x: np.bincount(owner, weights=x, minlength=k)
    all_words, all_letters, all_functional, in_lists, all_pieces = per(words), per(size), per(functional), per(size * lists), per(words > 0)
    n_latin, n_han = np.bincount(doc[start], minlength=k).astype(float), _sum(doc, han, k)
    # entries between separators
    inner = ~has(_SPLIT)
    e_start = np.flatnonzero(inner & ~np.concatenate(([False], inner[:-1])))
    e_size = np.flatnonzero(inner & ~np.append(inner[1:], False)) + 1 - e_start
    e_doc, e_count = _counted(doc[e_start], _runs_hash(codes64, e_start, e_size))
    entries = np.maximum(1, np.bincount(doc[e_start], minlength=k))
    next_space = np.append(space[1:], True)
    stops = _sum(doc, has(_STOP) | ((codes == 46) & next_space), k)
    # frequent phrases: four Han characters running on over other letters, or one content word
    phrase = np.zeros(k)
    place = np.flatnonzero(han & (2 * n_han >= all_words)[doc])
    if len(place) >= 4:
        same = doc[place[3:]] == doc[place[:-3]]
        quad = np.stack([codes64[place[i : len(place) - 3 + i]] for i in range(4)], 1)[same].ravel()
        q = _runs_hash(quad, np.arange(0, len(quad), 4), np.full(len(quad) // 4, 4))
        d, c = _counted(doc[place[:-3]][same], q)
        phrase = np.minimum(1.0, 4 * _top(d[c >= 3], c[c >= 3], 3, k) / np.maximum(1, n_han)) * (2 * n_han >= all_words)
    content = (length > 2) & ~is_function
    n_content = np.bincount(doc[start[content]], minlength=k)
    d, c = _counted(doc[start[content]], h[content])
    word = np.minimum(1.0, _top(d[c >= 3], c[c >= 3], 3, k) / np.maximum(1, n_content)) * ((6 * n_content >= all_words) & (n_latin > 0))
    digits = np.array([sum(map(t.count, DIGITS)) for t in texts], float)
    bare_n = np.maximum(1, sizes - 1)
    return np.stack(
        [
            (in_lists + linked) / np.maximum(1, all_letters + linked), linked / n, 100.0 * links / n, tags / n, 100.0 * stops / bare_n,
            all_functional / np.maximum(1.0, USUAL_LATIN * n_latin + USUAL_HAN * n_han), 1.0 - np.bincount(e_doc, minlength=k) / entries, _top(e_doc, e_count, 5, k) / entries,
            100.0 * offers / n, all_letters / np.maximum(1, all_pieces), digits / n, np.maximum(phrase, word), all_words + 10 * links,
        ],
        axis=1,
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", parts: int = 0) -> DataFrame:
    """(id, host, features...) of every page with text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, function = classes(), np.sort(_word_hash(sorted(FUNCTION_EN)))
        for pdf in batches:
            texts, made, i = pdf["_text"].tolist(), [np.zeros((0, len(FEATURES)))], 0
            while i < len(texts):  # bounded memory: as many pages at once as fit, at least one
                j, total = i, 0
                while j < len(texts) and (j == i or total + len(texts[j]) <= LETTERS):
                    total += len(texts[j])
                    j += 1
                made.append(features(texts[i:j], table, function))
                i = j
            f = np.concatenate(made)
            yield pd.concat([pdf[["doc_id", "host"]].reset_index(drop=True), pd.DataFrame(f, columns=list(FEATURES))], axis=1)

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("_text")).where("_text is not null")
    return spread(slim, parts).mapInPandas(run, "doc_id bigint, host string, " + ", ".join(f"{f} double" for f in FEATURES))


def weak_label() -> Column:
    """1.0 where several signs of piled-up entries agree, 0.0 where the page is clearly sentences, else null."""
    c = F.col
    entries = (c("list_share") >= 0.8) & ((c("repeat_share") >= 0.4) | (c("link_share") >= 0.3) | (c("tag_share") >= 0.3) | (c("offer_rate") >= 1))
    stuffed = (c("key_share") >= 0.4) & (c("function_rate") <= 0.45) | (c("key_share") >= 0.5) & (c("function_rate") <= 0.6)
    # what a page of a few words repeats counts for more than what it is made of: a title is no list
    short = (c("n_units") < SHORT) & ((c("key_share") >= 0.6) & (c("function_rate") <= 0.45) & (c("repeat_share") >= 0.5) | (c("key_share") >= 0.9) | (c("link_share") >= 0.7))
    piled = (c("n_units") >= SHORT) & (entries | stuffed | (c("link_share") >= 0.7)) | short
    written = (c("function_rate") >= 0.55) | (c("n_units") < 60) & (c("key_share") < 0.2)
    plain = written & ((c("list_share") <= 0.45) | (c("n_units") < SHORT)) & (c("link_share") <= 0.25) & (c("tag_share") <= 0.2) & (c("offer_rate") < 0.5) & ((c("key_share") <= 0.5) | (c("function_rate") >= 0.8))
    return F.when(piled, 1.0).when(plain, 0.0)


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> tuple:
    """One decision tree (Gini) as nested tuples (feature, threshold, left, right), or a share at a leaf."""
    p = float(y.mean())
    if depth == 0 or p in (0.0, 1.0) or len(y) < 2 * LEAF:
        return (p,)
    best = None
    for j in rng.permutation(x.shape[1])[: (2 * x.shape[1] + 2) // 3]:
        order = np.argsort(x[:, j], kind="stable")
        v, c = x[order, j], np.cumsum(y[order])
        n = np.arange(1, len(y))
        left, right = c[:-1] / n, (c[-1] - c[:-1]) / (len(y) - n)
        cost = n * left * (1 - left) + (len(y) - n) * right * (1 - right)
        cost[(v[1:] <= v[:-1]) | (n < LEAF) | (len(y) - n < LEAF)] = np.inf
        i = int(cost.argmin())
        if cost[i] < np.inf and (best is None or cost[i] < best[0]):
            best = (cost[i], int(j), float(v[i] + v[i + 1]) / 2)
    if best is None:
        return (p,)
    go = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[go], y[go], rng, depth - 1), grow(x[~go], y[~go], rng, depth - 1))


def bag(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = SEED) -> list[tuple]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        pick = rng.integers(0, len(y), len(y))
        out.append(grow(x[pick], y[pick], rng))
    return out


def as_column(tree: tuple) -> Column:
    if len(tree) == 1:
        return F.lit(tree[0])
    j, t, a, b = tree
    return F.when(F.col(FEATURES[j]) <= t, as_column(a)).otherwise(as_column(b))


def train(pages: DataFrame) -> list[tuple]:
    """Bagged trees from at most TRAIN_ROWS pages of each stratum, drawn by hash.

    Strata are the piled-up pages, the written pages that hold some lists, links or repeated phrases, and the other
    written pages; without the second the few pages of sentences with references or class lists would hardly be seen.
    """
    hard = (F.col("list_share") > 0.12) | (F.col("key_share") > 0.25) | (F.col("link_share") > 0.03) | (F.col("function_rate") < 0.7) | (F.col("n_units") < 60)
    labelled = pages.withColumn("y", weak_label()).where("y is not null").withColumn("stratum", F.when(F.col("y") == 1.0, "piled").when(hard, "hard").otherwise("plain"))
    counts = {r["stratum"]: r["count"] for r in labelled.groupBy("stratum").count().collect()}
    if "piled" not in counts or len(counts) < 2:
        return []
    u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id"), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("stratum") == name, min(1.0, 0.9 * TRAIN_ROWS / n)).otherwise(share)
    rows = labelled.where(u <= share).select("doc_id", "y", *FEATURES).limit(3 * TRAIN_ROWS).toPandas().sort_values("doc_id")
    return bag(rows[list(FEATURES)].to_numpy(), rows["y"].to_numpy())


def scored(docs: DataFrame, parts: int = 0) -> DataFrame:
    """(doc_id, host, page_score, host_rate, score) of every page with text."""
    pages = cut(measured(docs, parts=parts))
    trees = train(pages)
    page = sum((as_column(t) for t in trees), F.lit(0.0)) / max(1, len(trees)) if trees else F.coalesce(weak_label(), F.lit(0.0))
    # a short page gives the trees little to go on: where its signs agree, they count for more
    signs = weak_label()
    page = F.when((F.col("n_units") < SHORT) & signs.isNotNull(), (1 - SIGNS) * page + SIGNS * signs).otherwise(page)
    p = pages.select("doc_id", "host", page.alias("page_score"))
    p = p.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    total = p.groupBy().agg(F.coalesce(F.avg("page_score"), F.lit(0.0)).alias("base")).collect()[0][0]
    hosts = p.where("host is not null").groupBy("host").agg(F.sum("page_score").alias("_s"), F.count(F.lit(1)).alias("_n"))
    rate = hosts.select(F.col("host").alias("_host"), ((F.col("_s") + PRIOR * total) / (F.col("_n") + PRIOR)).alias("host_rate"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_at"))
    # a host with very many pages is spread over the salts
    j = p.join(rate, (F.col("host") == F.col("_host")) & (F.col("_salt") == F.col("_at")), "left")
    return j.select("doc_id", "host", "page_score", "host_rate", ((1 - SMOOTH) * F.col("page_score") + SMOOTH * F.coalesce("host_rate", "page_score")).alias("score"))


def found(docs: DataFrame, parts: int = 0) -> DataFrame:
    return scored(docs, parts).where(F.col("score") >= THRESHOLD).select("doc_id")


def by_host(docs: DataFrame, parts: int = 0) -> DataFrame:
    """Per host: pages, spam pages and the smoothed rate."""
    s = scored(docs, parts)
    return s.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("score") >= THRESHOLD).alias("spam_pages"), F.round(F.max("host_rate"), 6).alias("host_rate"))
