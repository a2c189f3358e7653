"""Problem 2: broken prompt and response pairs.

Method: a suffix automaton of the prompt is traversed with the response to measure how much of it is copied; refusals
are found by one automaton (Aho and Corasick) over all declining phrases, unfinished responses by the truncation
operator with its stack of open delimiters, and the language by script and stop-word votes. All rows pass one projection
of built-in functions that tells the empty ones and those that may be defective; only the latter reach the automata.

Defined results: a null response is `empty`; a null prompt can neither be copied nor set a language; a row has at most
one of empty, refusal, other_language and copied_question, in this order, and `truncated` besides where it was cut;
repeated rows are judged alike; prompts and responses of any length are judged whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NARROW, WIDE, narrow, once
from .proportions import category
from .truncation import BLANKS, NUMBERS, STAND_INS, truncated

#: Phrases that decline to answer, by slots; every way to fill the slots is a phrase, and '' leaves one out.
REFUSING = (
    ("我|本助手|本模型|系统|暂时|目前|这个问题|这个问题我", "|暂时|目前|还|也", "无法|不能|没法|没办法|不便|无权", "|为您|为你|给您|替您|帮您", "回答|解答|作答|查看|处理|分析|判断|识别|提供|给出|访问|协助|看到"),
    ("恕不", "|能", "作答|回答|奉告"),
    ("不在", "支持|服务|允许", "|的", "范围"),
    ("超出", "|了", "|我的|我", "能力|知识|服务|权限"),
    ("没有权限", "分析|查看|访问|处理"),
    ("没有收到", "|可用的|可用|任何|有效的|有效", "图像|图片|影像|照片"),
    ("拒绝", "回答|作答"),
    ("无可奉告",),
    ("i'm |i am ", "sorry|afraid|unable|not able|not allowed"),
    ("i ", "can't|cannot|can not|could not|couldn't|won't|will not|am unable to|must decline|must decline to|decline to", " answer| help| assist| view| see| process| analyze| analyse| provide| comply| access| judge| do| comment"),
    ("as a|as an", "| large", " ai| language", "| language", " model| assistant"),
    ("outside|beyond", "| of", " what i can| my abilities| my ability| my scope| my capabilities"),
    ("not ", "able|permitted|allowed", " to ", "help|answer|assist|analyze|analyse|view"),
    ("no ", "|usable ", "image|picture", " was| has been", " received| provided| attached| uploaded"),
    ("did not|didn't|have not|haven't", " receive| received", "| a| an| any| the", "| usable", " image| picture"),
    ("do not|don't", " have ", "permission|access|the right"),
    ("this request ", "is|falls", " not supported| outside| beyond"),
    ("cannot ", "answer|help with|process", " that| this"),
)
#: Phrases that decline if the response begins with them, or consists of them.
BEGINNING = (("暂时不能给出答案",), ("这个问题我没法回答",), ("无法回答",))
ALONE = (("无法|不能", "|根据图像|从图像|从图中|根据图片", "确认|回答|作答|判断|确定"),)
#: Openings that decline together with a phrase that follows within so many letters.
TOGETHER = (
    ("抱歉|对不起|不好意思|很遗憾|非常抱歉|很抱歉|作为语言模型|作为ai|作为人工智能|作为一个ai|作为一个人工智能", "无法|不能|没法|没办法|不便|无权|没有权限|没有收到|超出|恕不|拒绝|不在支持|不在服务|不在允许", 40),
    ("不便对", "作出判断|作出评价|作出回答|作出分析|做出判断|做出评价|做出回答|做出分析|给出判断|给出评价|给出回答|给出分析|进行判断|进行评价|进行回答|进行分析", 12),
    ("sorry|unfortunately|apologies|i apologize|i apologise", "can't|cannot|unable|not able|not possible|outside|beyond|not supported|no image|permission", 60),
)
#: Every phrase in Han script holds one of these.
STEMS = "无[法权可]|不[能便]|没[法办]|没有收到|权限|恕不|拒绝|范围|超出"
#: Words that announce a prompt without adding to it.
LABELS = "用户提问|用户问题|原问题|问题是|问题|提问|题目|问|question|query|prompt|user|q|image"
#: Words that announce an answer which then fails to come.
TRAILERS = "答案是|答案|回答是|回答|答|answer is|answer|reply|response"
#: Frequent words of languages written in Latin letters.
STOPWORDS = {
    "en": "the|is|are|was|in|of|a|an|it|its|to|with|and|there|no|yes|not|this|on|at|by|for|from|as|that|be|or|here|which|lies|close",
    "fr": "le|la|les|un|une|des|du|de|et|il|elle|est|sont|pas|dans|au|aux|oui|non|on|voit|sur|avec|ne|en|ce|cette|à|qui|que",
    "es": "el|la|los|las|un|una|se|sí|en|de|del|al|hay|con|y|que|es|no|por|para|está|están|lo|su",
    "pt": "o|os|as|um|uma|se|sim|não|em|no|na|do|da|dos|das|há|com|e|que|é|por|para|está",
    "de": "der|die|das|ist|sind|und|ein|eine|einen|nicht|im|in|ja|nein|auf|mit|von|zu|am|den|dem|es|gibt",
    "it": "il|lo|la|gli|le|un|una|si|sì|no|non|è|sono|nel|nella|di|del|della|con|e|che|c'è|per",
}
#: Code ranges: Han; kana, Hangul, Cyrillic, Greek, Hebrew, Arabic, Devanagari and Thai.
HAN = r"[\x{3400}-\x{9FFF}]"
FOREIGN = r"\x{3041}-\x{30FF}\x{AC00}-\x{D7AF}\x{0370}-\x{06FF}\x{0900}-\x{097F}\x{0E00}-\x{0E7F}"
OTHER = r"\x{C0}-\x{24F}" + FOREIGN
#: Marks that often end a response; another one makes a row a suspect.
MARKS = "。．.!！?？…,，;；:：、\"'”’」』)）】》*~"
TAGS = "</?[A-Za-z]{1,20}>"
LEAST_ZH, LEAST_LATIN = 3, 6


class SuffixAutomaton:
    """Suffix automaton of one prompt; walk() gives, for each letter of a response, the longest match that ends there and where it ends in the prompt."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.size, self.end, last = [-1], [0], [0], 0
        for c in text:
            cur = self._add({}, self.size[last] + 1, 0, self.end[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.size[q] == self.size[p] + 1:
                    self.link[cur] = q
                else:
                    twin = self._add(dict(self.next[q]), self.size[p] + 1, self.link[q], self.end[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = self.link[p]
                    self.link[q] = self.link[cur] = twin
            last = cur

    def _add(self, to: dict[str, int], size: int, link: int, end: int) -> int:
        self.next.append(to)
        self.size.append(size)
        self.link.append(link)
        self.end.append(end)
        return len(self.size) - 1

    def walk(self, text: str) -> list[tuple[int, int]]:
        state, length, out = 0, 0, []
        for c in text:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            out.append((length, self.end[state]))
        return out


def copied(prompt: str, response: str) -> tuple[float, float, float, int]:
    """Share of the response's letters and of the prompt's that are copied, the prompt's share in the longest stretch, and the letters after the last copied one.

    A stretch counts from three letters on (six for prompts in ASCII); a shorter prompt must be met whole.
    """
    if not prompt or not response:
        return 0.0, 0.0, 0.0, len(response)
    least = min(len(prompt), LEAST_LATIN if prompt.isascii() else LEAST_ZH)
    hit, source, longest = bytearray(len(response)), bytearray(len(prompt)), 0
    met = SuffixAutomaton(prompt).walk(response)
    for i, (n, end) in enumerate(met):
        if n >= least and (i + 1 == len(met) or met[i + 1][0] != n + 1):
            hit[i + 1 - n : i + 1] = source[end - n : end] = b"\x01" * n
            longest = max(longest, n)
    return sum(hit) / len(response), sum(source) / len(prompt), longest / len(prompt), len(response) - 1 - hit.rfind(1)


def gives_back(prompt: str, response: str) -> bool:
    """Whether a folded response is the folded prompt and nothing else, but for labels before and after it.

    Nine tenths of the response must be copied, up to its end. What it copies must be the prompt but for a twentieth, or three quarters
    of it in one stretch; pieces that leave out more may be an answer in the prompt's words.
    """
    bare = _LABEL.sub("", response)
    for text in {response, bare, _TRAILER.sub("", response), _TRAILER.sub("", bare)}:
        mine, theirs, longest, rest = copied(prompt, text)
        if mine >= 0.9 and rest == 0 and (theirs >= 0.95 or longest >= 0.75):
            return True
    return False


class Refusals:
    """One automaton for all phrases that decline."""

    def __init__(self) -> None:
        import ahocorasick

        kinds: dict[str, set[tuple]] = {}
        for slots, kind in [*((x, ("any", 0)) for x in REFUSING), *((x, ("begin", 0)) for x in BEGINNING), *((x, ("alone", 0)) for x in ALONE)]:
            for phrase in map("".join, product(*(x.split("|") for x in slots))):
                kinds.setdefault(phrase, set()).add(kind)
        for i, (openings, rest, _) in enumerate(TOGETHER):
            for kind, phrases in (("open", openings), ("close", rest)):
                for phrase in phrases.split("|"):
                    kinds.setdefault(phrase, set()).add((kind, i))
        self.net = ahocorasick.Automaton()
        for phrase, found in kinds.items():
            self.net.add_word(phrase, (len(phrase), phrase[0].isascii(), phrase[-1].isascii(), tuple(sorted(found))))
        self.net.make_automaton()

    def declines(self, text: str) -> bool:
        """text: a response in lower case, without outer blanks."""
        text = text.replace("’", "'")
        opened: dict[int, int] = {}
        for end, (size, first, last, kinds) in self.net.iter(text):
            start = end + 1 - size
            # a phrase in Latin letters begins at a word; its last word may go on (answer, answers)
            if first and start and text[start - 1].isascii() and text[start - 1].isalpha():
                continue
            for kind, i in kinds:
                if kind == "any" or kind == "begin" and not start:
                    return True
                if kind == "alone" and not start and not any(map(str.isalnum, text[end + 1 :])):
                    return True
                if kind == "open" and not start:
                    opened[i] = max(opened.get(i, 0), end + 1)
                if kind == "close" and i in opened and 0 <= start - opened[i] <= TOGETHER[i][2] + 1:
                    return True
        return False


_LABEL, _TRAILER = re.compile(f"^(?:{LABELS})+"), re.compile(f"(?:{TRAILERS.replace(' ', '')})+$")
_CODES = re.compile(r"(?<![^\W\d_])[A-Z0-9][A-Z0-9+\-_.]*(?![^\W\d_])|https?://\S+")
_WORDS = re.compile(r"[A-Za-z\u00c0-\u024f]+(?:['’][A-Za-z]+)?")
_PAIR = re.compile("[A-Za-z\u00c0-\u024f]{2}")
_TOKENS = re.compile(r"(?<![\w'])[^\W\d_]+(?:'è)?")
_HAN, _HAN_WORDS, _FOREIGN = re.compile("[\u3400-\u9fff]"), re.compile(rf"(?![{NUMBERS}])[\u3400-\u9fff]"), re.compile("[\u3041-\u30ff\uac00-\ud7af\u0370-\u06ff\u0900-\u097f\u0e00-\u0e7f]")
_TAGS = re.compile(TAGS)
_WIDTH = str.maketrans(WIDE, NARROW)
_NO_LETTER = re.compile(r"[\W_]+")
_STOPWORDS = {k: frozenset(v.split("|")) for k, v in STOPWORDS.items()}


def other_language(question: str, body: str) -> bool:
    """Whether the words of the response are of another language than the question's; names in capitals, codes and numbers aside."""
    words, foreign = len(_WORDS.findall(_CODES.sub(" ", body))), len(_FOREIGN.findall(body))
    han = len(_HAN.findall(body))
    if _HAN.search(question):
        return (foreign > 0 or _PAIR.search(body) is not None) and (foreign * 5 > han + foreign or words * 3 > han * 2)
    if not re.search("[A-Za-z]", question):
        return False
    if foreign > words or (han and len(_HAN_WORDS.findall(body)) > words * 2):
        return True
    if words < 3:
        return False
    tokens = _TOKENS.findall(body.lower())
    votes = {k: sum(map(v.__contains__, tokens)) for k, v in _STOPWORDS.items()}
    return max(n for k, n in votes.items() if k != "en") > votes["en"]


def pairs_of(sft: DataFrame, val_pred: DataFrame) -> DataFrame:
    """(record_set, row_id, question, answer, question_type) of the two record sets."""
    a = sft.select(F.lit("sft").alias("record_set"), F.col("sft_id").alias("row_id"), "question", "answer", "question_type")
    b = val_pred.select(F.lit("val_pred").alias("record_set"), F.col("pred_id").alias("row_id"), "question", F.col("prediction").alias("answer"), "question_type")
    return a.unionByName(b)


def _body(c: Column) -> Column:
    marked = F.contains(c, F.lit("<")) | F.contains(c, F.lit("**"))
    return F.btrim(F.when(marked, F.regexp_replace(c, rf"{TAGS}|\*\*[^*\n]{{1,12}}\*\*", " ")).otherwise(c), F.lit(BLANKS))


def _fold(c: Column) -> Column:
    """Letters and digits in lower case and of one width; the width is levelled only where something wide is left."""
    x = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    return F.when(x.rlike(r"[\x{FF10}-\x{FF5A}]"), narrow(x)).otherwise(x)


def ends_of(words: str) -> list[str]:
    """The letters in which some words end."""
    return sorted({x[-1] for x in words.split("|")})


def _stands_in(c: Column) -> Column:
    x = F.rtrim(F.ltrim(F.lower(c), F.lit("([{<「【\"'")), F.lit(")]}>」】\"'.。"))
    names = [y for x in STAND_INS.split("|") for y in ({x.replace("/?", ""), x.replace("?", "")} if "?" in x else {x})]
    return x.isin(names) | (x.rlike(r"[\x{FF0F}-\x{FF5A}]") & narrow(x).isin(names))


def suspects(pairs: DataFrame) -> DataFrame:
    """(record_set, row_id, question, _body, empty, declinable, may_copy, may_differ) of the rows that may be defective.

    Each condition is necessary for its defect. A copy ends with letters of the prompt, before or after trailing labels,
    and is half as long at least: the last three letters of the response's end are looked up in the folded prompt, and rows
    whose end or prompt is too short to tell are passed on.
    """
    d = once(pairs, _body=_body(F.col("answer")))
    prompt = F.when(F.contains("question", F.lit("<")), F.regexp_replace("question", TAGS, " ")).otherwise(F.col("question"))
    # most rows are told by their last letter: it does not stand in the prompt
    d = once(d, _n=F.length("_body"), _z=F.lower(F.substring(F.rtrim("_body", F.lit(MARKS + BLANKS)), -1, 1)), _ask=F.lower("question"))
    z, ask = F.col("_z"), F.col("_ask")
    wide = r"[\x{FF10}-\x{FF5A}]"
    near = F.contains(ask, z) | z.isin(ends_of(TRAILERS)) | (F.length(ask) <= 6) | z.rlike(rf"[^\p{{L}}\p{{N}}]|{wide}") | (z.rlike("[a-z0-9]") & ask.rlike(wide))
    d = once(d, _near=near)
    d = once(d, _q=F.when(F.col("_near"), _fold(prompt)), _tail=F.when(F.col("_near"), _fold(F.right("_body", F.lit(24)))))
    b, q, tail, asked = F.col("_body"), F.col("_q"), F.col("_tail"), F.col("question")
    empty = F.col("answer").isNull() | ~b.rlike(r"[\p{L}\p{N}]") | ((F.col("_n") <= 24) & _stands_in(b))
    d = once(d, empty=empty, _other=b.rlike(f"[A-Za-z{OTHER}]"))
    stem = F.col("_other") | b.rlike(STEMS)
    ends_in_label = F.substring(tail, -1, 1).isin(ends_of(TRAILERS))
    bare = F.when(ends_in_label, F.regexp_replace(tail, f"(?:{TRAILERS.replace(' ', '')})+$", "")).otherwise(tail)
    short = (F.col("_n") > 24) & (F.length(bare) < 3) | (F.length(q) < 3)
    ends = F.contains(q, F.substring(tail, -3, 3)) | F.contains(q, F.substring(bare, -3, 3))
    may_copy = (F.length(q) > 0) & (F.col("_n") * 2 >= F.length(q)) & (ends | short)
    may_differ = asked.isNotNull() & (F.col("_other") | ~asked.rlike(HAN))
    declinable = ~F.coalesce(category(F.col("question_type")), F.lit("")).isin("unanswerable", "ambiguous")
    d = once(d, stem=stem, may_copy=F.coalesce(may_copy, F.lit(False)), may_differ=may_differ)
    return d.where("empty or stem or may_copy or may_differ").select("record_set", "row_id", "question", "_body", "empty", declinable.alias("declinable"), "may_copy", "may_differ")


def judged(pairs: DataFrame) -> DataFrame:
    """(record_set, row_id, defect) of the rows that are empty, refusals, in another language, or give the prompt back."""

    def fold(s: str) -> str:
        return _NO_LETTER.sub("", s.translate(_WIDTH).lower())

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = Refusals()
        for pdf in parts:
            out = []
            for q, b, empty, declinable, may_copy, may_differ in zip(*(pdf[c] for c in ("question", "_body", "empty", "declinable", "may_copy", "may_differ"))):
                if empty:
                    out.append("empty")
                elif declinable and net.declines(b.lower()):
                    out.append("refusal")
                elif may_differ and other_language(q, b):
                    out.append("other_language")
                else:
                    out.append("copied_question" if may_copy and gives_back(fold(_TAGS.sub(" ", q)), fold(b)) else None)
            yield pdf[["record_set", "row_id"]].assign(defect=pd.Series(out, dtype=object, index=pdf.index)).dropna(subset=["defect"])

    return suspects(pairs).mapInPandas(run, "record_set string, row_id bigint, defect string")


def found(pairs: DataFrame, texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """(record_set, row_id, defect), one row per defect."""
    return judged(pairs).unionByName(truncated(texts, corpus).withColumn("defect", F.lit("truncated")))
