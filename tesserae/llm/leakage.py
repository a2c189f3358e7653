"""Problem 8: evaluation texts leaking into training text.

Method: template canonicalisation. Passages and documents become runs of letters in which numbers and units are typed
placeholders; the names that a passage speaks of are its own slots, and no window runs over them. Windows of the templates are hash-joined:

1. passages that read alike become one class; a table holds the hashed windows of every class,
2. one scan of the documents keeps the windows that pass a filter of at most 2 ** FILTER_BITS bits,
3. these are joined with the table and counted by (document, class); pairs with enough windows in common are candidates,
4. the documents of candidates are read again, and the slots are checked (the same numbers and names in the same places)
   along with an alignment of the passage's own letters, so that sentences merely built alike do not count. A document
   that holds only a part of a passage cannot have the slots of the rest: verbatim parts count by their letters.

Neither items nor documents are collected, and the documents are scanned twice whatever their number. A window that more than
OWNERS classes share is left out of the join for a class as far as its other windows suffice: who has t of n windows has
t - d of those that remain without d of them, and at least one of the n - t + 1 rarest.

Defined results: null and empty passages and texts meet nothing; a passage whose template has no window is found by
windows of its own letters, and one of fewer than six letters must stand whole, as words of its own; equal documents are
reported each, a repeated row once; windows over several sentences are bridged where a document reorders or breaks them.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, maybe_broadcast, sift, spread

WINDOW, OWN, SHARE = 8, 6, 0.5
#: Share of a passage's template windows that a candidate has; more of them than classes share stay out of the join if they can.
NEED, OWNERS, FILTER_BITS = 0.28, 1000, 27
#: Share of an item's slots that must agree: in Han script six letters are a phrase, in Latin script hardly a word.
SLOTS_HAN, SLOTS_LATIN = 0.3, 0.5
#: Share of a passage that a verbatim stretch with a slot of its own must have to count as a part of it.
PART = 0.15
#: Units after numbers.
UNITS = r"(?:米|公里|千米|天|日|年|月|级|张|幅|座|块|处|组|成|次|个|像元|号|批|%|％|meters?|kilometers?|km|days?|years?|months?|levels?|pixels?|times?|tenths?|frames?|stacks?|pieces?)"
NUM, NAME, UNIT = "", "", ""
#: English words that may begin a sentence in capitals without being names.
PLAIN = frozenset("the a an on at in near after within every night batch some no this that from over along between it its is are was were and of to for by with only".split())
#: Endings of Chinese place names.
PLACES = "镇|岛|港|农场|河湾|山口|台地|支线|机房|图幅"
_BREAK, _RUN = re.compile(r"[\W_]+"), re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    return unicodedata.normalize("NFKC", text).lower()


def names_of(passage: str) -> set[str]:
    """Names in a passage: capitalised words that no sentence needs, and what stands before Chinese place endings."""
    found = set()
    for w in re.findall(r"(?<![A-Za-z])[A-Z][a-z]{2,}", passage):
        if w.lower() not in PLAIN:
            found.add(w.lower())
    for w in re.findall(rf"([一-鿿]{{2}})(?={PLACES})", passage):
        found.add(w)
    return found


def stream(text: str) -> str:
    """Letters and digits only, folded; the windows run across breaks, marks and line ends."""
    run = "".join(_RUN.findall(text))
    return (run if unicodedata.is_normalized("NFKC", run) else _BREAK.sub("", unicodedata.normalize("NFKC", run))).lower()


def names_pattern(names: set[str]) -> re.Pattern | None:
    """One pattern for all names, by first letter, so that a text is skipped through quickly; longer names first."""
    by: dict[str, list[str]] = {}
    for n in sorted(names, key=lambda x: (-len(x), x)):
        by.setdefault(n[0], []).append(re.escape(n[1:]))
    return re.compile("|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by.items()))) if by else None


_NUMBER = re.compile(r"\d+")
_MEASURE = re.compile(rf"\d+({UNITS})?")


def template(letters: str, names: re.Pattern | None) -> str:
    """A letter run with typed placeholders for names, for numbers with units, and for other numbers."""
    return _MEASURE.sub(lambda m: NUM + UNIT if m[1] else NUM, names.sub(NAME, letters) if names else letters)


def windows(s: str, k: int) -> np.ndarray:
    """Hashes of all windows of k letters: polynomials of windows of 1, 2, 4... letters, put together and mixed."""
    n = len(s) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    part = np.frombuffer(s.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h, done, size, base = None, 0, 1, 0x9E3779B97F4A7C15
    while done < k:
        if k & size:
            piece = part[done : done + n]
            h, done = (piece if h is None else h * np.uint64(base) + piece), done + size
        if done < k:
            part = part[:-size] * np.uint64(base) + part[size:]
            base, size = base * base & 0xFFFFFFFFFFFFFFFF, size * 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def whole_pattern(letters: str) -> re.Pattern:
    """A few letters as they may stand in a folded text: marks between them, and no Latin letter or digit beside their own."""
    before, after = (r"(?<![a-z0-9])" if letters[0].isascii() else ""), (r"(?![a-z0-9])" if letters[-1].isascii() else "")
    return re.compile(before + r"[\W_]*".join(map(re.escape, letters)) + after)


class Passage:
    """A passage as its letters, its template windows, its own-letter windows and its slots."""

    def __init__(self, text: str) -> None:
        self.run = stream(text)
        self.names = sorted(names_of(text))
        pattern = names_pattern(set(self.names))
        self.slots = [m.span() for pat in (pattern, _NUMBER) if pat for m in pat.finditer(self.run)]
        self.own = windows(self.run, OWN)
        self.latin = 2 * sum(c.isascii() for c in self.run) > len(self.run)
        parts = [windows(x, WINDOW) for x in template(self.run, pattern).split(NAME)]
        self.windows = np.unique(np.concatenate(parts))
        #: Letters of the windows by which the passage is looked up: 0 for those of its template.
        self.kind = 0 if len(self.windows) else min(OWN, len(self.run))
        if self.kind:
            self.windows = np.unique(windows(self.run, self.kind)) ^ np.uint64(self.kind)
        self.whole = whole_pattern(self.run) if 0 < len(self.run) < OWN else None

    def held_by(self, text: str, run: str, own: np.ndarray) -> bool:
        """Whether half of the passage's letters lie in windows that the document has, slots included."""
        if self.whole:
            return bool(self.whole.search(fold(text)))
        if not len(self.own) or not len(own):
            return False
        size = len(self.run)
        at = np.flatnonzero(own[np.minimum(np.searchsorted(own, self.own), len(own) - 1)] == self.own)
        mark = np.zeros(size + 1, np.int64)
        np.add.at(mark, at, 1)
        np.add.at(mark, at + OWN, -1)
        covered = np.cumsum(mark[:size]) > 0
        if covered.mean() < SHARE:
            return False
        if not self.slots:
            return True
        # a slot is the same if it and the letters beside it are covered: its number or name stands in its own template place
        same = [bool(covered[max(0, a - 1) : b + 1].all()) for a, b in self.slots]
        if sum(same) >= (SLOTS_LATIN if self.latin else SLOTS_HAN) * len(same):
            return True
        return self.parts(run, at) >= SHARE * size

    def parts(self, run: str, at: np.ndarray) -> int:
        """Letters of the passage in verbatim parts: stretches of at least PART that stand unbroken in the document, with a slot."""
        r, found = self.run, np.zeros(len(self.run), bool)
        # windows side by side may come from several places of the document, so the longest of these runs are searched for as they are
        spans = [(int(g[0]), int(g[-1]) + OWN) for g in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)]
        spans = [(a, b) for a, b in spans if b - a >= PART * len(r)]
        for a, b in spans if sum(b - a for a, b in spans) >= SHARE * len(r) else ():
            end = a
            for start in range(a, b):
                before, end = end, max(end, start)
                while end < b and r[start : end + 1] in run:
                    end += 1
                if end > before and end - start >= PART * len(r) and any(start <= max(0, x - 1) and min(len(r), y + 1) <= end for x, y in self.slots):
                    found[start:end] = True
        return int(found.sum())


def classes(items: DataFrame) -> DataFrame:
    """(item_id, passage, class): class is the least item whose passage has the same letters and names."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            runs = [(stream(t), sorted(names_of(t))) for t in pdf["passage"]]
            pdf["key"] = [hashlib.md5("\n".join([r, *n]).encode()).hexdigest() if r else None for r, n in runs]
            yield pdf.dropna(subset=["key"])

    keyed = cut(items.mapInPandas(keys, "item_id bigint, passage string, key string"))
    least = keyed.groupBy("key").agg(F.min("item_id").alias("class"))
    return cut(keyed.join(least, "key").select("item_id", "passage", "class"))


def table(passages: DataFrame) -> DataFrame:
    """(class, kind, h, need): the windows by which classes are looked up, and how many of them a candidate has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [Passage(t) for t in pdf["passage"]]
            n = [len(p.windows) for p in made]
            hashes = np.concatenate([p.windows for p in made]) if made else np.zeros(0, np.uint64)
            yield pd.DataFrame({"class": np.repeat(pdf["class"].to_numpy(np.int64), n), "kind": np.repeat([p.kind for p in made], n), "h": hashes.view(np.int64), "n": np.repeat(n, n)})

    w = cut(passages.mapInPandas(run, "class bigint, kind int, h bigint, n bigint"))
    owners = w.groupBy("h").agg(F.count(F.lit(1)).alias("owners"))
    least = F.greatest(F.lit(1), F.ceil(F.col("n") * NEED))
    one = Window.partitionBy("class")  # as many rows as a passage has letters
    w = w.join(owners, "h").withColumn("place", F.row_number().over(one.orderBy("owners", "h")))
    w = w.where((F.col("owners") <= OWNERS) | (F.col("place") <= F.col("n") - least + 1))
    kept = F.count(F.lit(1)).over(one)
    return cut(w.select("class", "kind", "h", F.greatest(F.lit(1), least - (F.col("n") - kept)).cast("bigint").alias("need")))


def bits_of(w: DataFrame) -> tuple[np.ndarray, int]:
    """A filter of one hash over the table's windows, as bytes, and the number of its address bits: FILTER_BITS at most."""
    size = min(FILTER_BITS, max(16, (16 * w.count()).bit_length()))
    x = F.col("h").bitwiseAND((1 << size) - 1) + 1
    rows = w.groupBy(F.bitmap_bucket_number(x).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits")).collect()
    out = np.zeros(1 << (size - 3), np.uint8)
    for b, bits in rows:
        out[(b - 1) * 4096 : b * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out, size


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", passage_col: str = "passage", parts: int = 0) -> DataFrame:
    """(item_id, doc_id) for every document that holds at least half of an item's passage."""
    sc = docs.sparkSession.sparkContext
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).where("_text is not null and doc_id is not null")
    of = classes(items.select(F.col(item_col).alias("item_id"), F.col(passage_col).alias("passage")).where("item_id is not null and passage is not null and passage <> ''"))
    passages = of.where("item_id = class").select("class", "passage")
    w = table(passages)
    facts = w.agg(F.coalesce(F.min("need"), F.lit(1)), F.collect_set("kind")).first()  # kinds are OWN + 1 at most
    shared = sc.broadcast((*bits_of(w), int(facts[0]), sorted(facts[1])))

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, size, least, kinds = shared.value
        mask = np.uint64((1 << size) - 1)
        for pdf in batches:
            ids, found = [], []
            for doc, text in zip(pdf["doc_id"], pdf["_text"]):
                run = stream(text)
                made = [windows(run, k) ^ np.uint64(k) if k else windows(template(run, None), WINDOW) for k in kinds]
                h = np.concatenate(made) if made else np.zeros(0, np.uint64)
                x = h & mask
                h = np.unique(h[(bits[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1])
                if len(h) >= least:
                    ids.append(np.full(len(h), doc, np.int64))
                    found.append(h.view(np.int64))
            yield pd.DataFrame({"doc_id": np.concatenate(ids) if ids else np.zeros(0, np.int64), "h": np.concatenate(found) if found else np.zeros(0, np.int64)})

    met = spread(slim, parts).mapInPandas(hits, "doc_id bigint, h bigint").join(maybe_broadcast(w.select("class", "h", "need"), 500_000), "h")
    likely = cut(met.groupBy("doc_id", "class", "need").agg(F.count(F.lit(1)).alias("n")).where("n >= need").select("doc_id", "class"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passage = lru_cache(4096)(Passage)
        last = None
        for pdf in batches:
            keep = []
            for doc, text, p in zip(pdf["doc_id"], pdf["_text"], pdf["passage"]):
                if last is None or last[0] != doc or last[1] != text:
                    run = stream(text)
                    last = doc, text, run, np.unique(windows(run, OWN))
                keep.append(passage(p).held_by(text, last[2], last[3]))
            yield pdf.loc[keep, ["class", "doc_id"]]

    both = sift(slim, "doc_id", likely).join(likely.join(passages, "class"), "doc_id").select("class", "doc_id", "_text", "passage")
    sure = both.sortWithinPartitions("doc_id").mapInPandas(check, "class bigint, doc_id bigint").distinct()
    return sure.join(of.select("item_id", "class"), "class").select("item_id", "doc_id")


def report(found: DataFrame) -> DataFrame:
    """Per leaked item the number of documents that hold it."""
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))
