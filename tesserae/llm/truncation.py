"""Problem 4: text cut off by field limits.

Method: a vocabulary trie over the whole corpus, kept as a table of the nodes that are asked for. Texts are cut into tokens
at punctuation (a token is a clause for scripts without spaces); each token counts as a complete word of the vocabulary, as
one that ends a sentence or one that goes on after a comma, and each of its prefixes is a node of the trie. A text without
final punctuation is cut if its final token is an unknown proper prefix of known tokens, or is only known to go on; the
ending of tokens decides where the token itself is unknown, a bracket or quotation mark left open is a cut, and texts at a
length at which their source's texts pile up need stronger evidence of being complete.

Defined results: null and blank texts are not cut (they are empty, not truncated); a text that ends in a broken
character (U+FFFD) is cut; a finished text without final punctuation, a short answer or a missing end tag is not; tokens of
any length are looked up whole; repeated rows are judged alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, fits, maybe_broadcast, once

#: What ends a sentence, what only ends a clause, and the marks that may follow an end.
STOPS, COMMAS, CLOSERS = "。．.!！?？…", ",，、;；:：", "\"'”’」』)）】》〉~"
#: Brackets and quotation marks that open and, in the same order, close.
OPENING, CLOSING = "（(【[《「『“", "）)】]》」』”"
#: Number words, which stand for any number in the vocabulary.
NUMBERS = "0-9一二三四五六七八九十百千万两〇零"
#: What stands for a missing value.
STAND_INS = r"null|none|n/?a|nan|nil|tbd|todo|undefined|missing|empty|unknown|待补充|待填写|待定|暂无|暂缺|缺失|空缺|空值|未填写|未填|无内容|无答案|没有内容"
#: Letters by which tokens and the final tokens that are asked about meet.
HEAD = 4
#: Nodes that may be broadcast: of some tens of letters each, a few tens of MB at most.
WANTED = 60_000
#: Rows of a source of one length, against the typical number at its lengths, that make the length a field limit.
PILE, PILE_ROWS = 6.0, 5


def texts_of(sft: DataFrame, val_pred: DataFrame) -> DataFrame:
    """(record_set, row_id, source, text) of the two record sets."""
    a = sft.select(F.lit("sft").alias("record_set"), F.col("sft_id").alias("row_id"), F.col("source_dataset").alias("source"), F.col("answer").alias("text"))
    b = val_pred.select(F.lit("val_pred").alias("record_set"), F.col("pred_id").alias("row_id"), F.col("run_name").alias("source"), F.col("prediction").alias("text"))
    return a.unionByName(b)


#: One mark for each kind of break, so that sentences and clauses are split without regular expressions that look around.
STOP, COMMA = "\x01", "\x02"
_STOPS, _COMMAS, _DIGITS = STOPS + "\n\r", ",，、;；:：", "0123456789０１２３４５６７８９一二三四五六七八九十百千万两〇零"
TRIM = " \t　 ​\"'“”‘’「」『』()（）《》【】[]*-—·~"
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0            ​    ⁠　﻿"


def _marked(c: Column) -> Column:
    """Text with tags as sentence ends, one mark per kind of break, and '#' for every numeral."""
    tagged = F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, r"</?[A-Za-z]{1,20}>|<[/A-Za-z]{0,20}$", "\n")).otherwise(c)
    return F.translate(tagged, _STOPS + _COMMAS + _DIGITS, STOP * len(_STOPS) + COMMA * len(_COMMAS) + "#" * len(_DIGITS))


def _bare(c: Column) -> Column:
    """A token without outer blanks and marks, runs of numerals as one '#'."""
    t = F.btrim(c, F.lit(TRIM))
    return F.when(F.contains(t, F.lit("##")), F.regexp_replace(t, "##+", "#")).otherwise(t)


def tokens_of(corpus: DataFrame) -> DataFrame:
    """(place, token, last, n): the tokens of all sentences and how often each sentence occurs.

    corpus: column `text`. place is 'f' for tokens that begin a sentence and 'm' for later ones, since a word that is a
    whole answer may as well begin a longer sentence. Equal sentences are counted first, with map-side combine. The
    unfinished end of a text counts as nothing.
    """
    parts = once(corpus.where("text is not null").select("text"), _s=F.split(_marked(F.col("text")), STOP))
    s = parts.select(F.explode(F.slice("_s", F.lit(1), F.size("_s") - 1)).alias("s"))  # what follows the last stop is no sentence
    s = s.where("s <> ''").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    t = s.select("n", F.split(F.lower(F.rtrim("s", F.lit(COMMA + " "))), COMMA).alias("_a"))
    t = t.select("n", F.posexplode("_a").alias("_i", "_t"), F.size("_a").alias("_k"))
    t = once(t, token=_bare(F.col("_t"))).where("token <> ''")
    return t.select(F.when(F.col("_i") == 0, "f").otherwise("m").alias("place"), "token", (F.col("_i") + 1 == F.col("_k")).alias("last"), "n")


def trie(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """(kind, node, ends, goes_on, below): the nodes of the trie that are asked for.

    kind 'f' or 'm' are nodes by place: how often the node is a whole token that ends a sentence or one that goes on after
    a comma, and how often longer tokens run through it. kind 't' are endings of tokens that end a sentence. wanted:
    (kind, node), different rows. Tokens of any length are looked up whole, and only nodes as long as a wanted one with
    the same first letters are made.
    """
    size, most = F.length("token"), F.least(F.length("token"), F.lit(HEAD))
    heads = wanted.where("kind <> 't'").groupBy(F.col("kind").alias("_p"), F.substring("node", 1, HEAD).alias("_h")).agg(F.collect_set(F.length("node")).alias("_ls"))  # at most one element per length
    t = tokens.select("*", F.explode(F.sequence(F.lit(1), most)).alias("_m"))
    t = t.join(maybe_broadcast(heads), (F.col("place") == F.col("_p")) & (F.substring("token", F.lit(1), F.col("_m")) == F.col("_h")), "left")
    # the ending, as length 0, goes with the longest head, so that each token gives it once
    with_end = (F.col("_m") == most) & F.col("last")
    none = F.array().cast("array<int>")
    e = t.select("place", "token", "last", "n", F.explode(F.concat(F.coalesce("_ls", none), F.when(with_end, F.array(F.lit(0))).otherwise(none))).alias("_n")).where(F.col("_n") <= size)
    whole, end = F.col("_n") == size, F.col("_n") == 0
    e = once(
        e,
        kind=F.when(end, "t").otherwise(F.col("place")),
        node=F.when(end, ending(F.col("token"))).otherwise(F.substring("token", F.lit(1), F.col("_n"))),
        ends=F.when(end | (whole & F.col("last")), F.col("n")).otherwise(0),
        goes_on=F.when(~end & whole & ~F.col("last"), F.col("n")).otherwise(0),
        below=F.when(~end & ~whole, F.col("n")).otherwise(0),
    )
    if fits(wanted, WANTED):  # spares the other nodes the shuffle; without it they are left alone by the join that follows
        e = e.join(F.broadcast(wanted), ["kind", "node"], "left_semi")
    return e.groupBy("kind", "node").agg(F.sum("ends").alias("ends"), F.sum("goes_on").alias("goes_on"), F.sum("below").alias("below"))


def ending(c: Column) -> Column:
    """The letters by which an unknown token is judged: the last four, or the last eight of Latin script."""
    return F.when(c.rlike("[a-z]$"), F.substring(c, -8, 8)).otherwise(F.substring(c, -4, 4))


def unclosed(c: Column) -> Column:
    """Whether a bracket or quotation mark is still open at the end: a stack of the closing marks that are awaited."""
    marks = F.split(F.regexp_replace(c, f"[^{re.escape(OPENING + CLOSING)}]", ""), "")
    wait = F.translate(F.lit(OPENING), OPENING, CLOSING)

    def step(stack: Column, x: Column) -> Column:
        opens = F.instr(F.lit(OPENING), x)
        return (
            F.when((x != "") & (opens > 0), F.concat(stack, F.substring(wait, opens, F.lit(1))))
            .when((x != "") & (F.substring(stack, -1, 1) == x), F.substring(stack, F.lit(1), F.length(stack) - 1))
            .otherwise(stack)
        )

    return F.when(c.rlike(f"[{re.escape(OPENING)}]"), F.aggregate(marks, F.lit(""), step) != "").otherwise(False)


def candidates(texts: DataFrame) -> DataFrame:
    """Texts without final punctuation: their final token, its place, and whether the end alone tells that they were cut."""
    t = texts.where("text is not null")
    t = once(t, _r=F.rtrim("text", F.lit(BLANKS + "*；;")), _n=F.length("text"))
    t = once(t, _z=F.substring("_r", -1, 1))
    has = lambda c, *marks: F.coalesce(*[F.nullif(F.contains(c, F.lit(m)), F.lit(False)) for m in marks], F.lit(False))
    item = F.col("_r").rlike(r"\n[0-9]{1,3}[.、]$")
    ended = F.when(F.col("_z").isin(*[*CLOSERS]), F.col("_r").rlike(rf"[{STOPS}][{CLOSERS}]*$|[)）】]$|</[A-Za-z]{{1,20}}>$")).otherwise(F.col("_z").isin(*[*STOPS]) & ~((F.col("_z") == ".") & item))
    t = t.where((F.col("_z") != "") & ~ended)
    # from here on only unfinished texts
    plain = F.when(has("_r", "<"), F.regexp_replace("_r", r"<[/A-Za-z]{0,20}$", "")).otherwise(F.col("_r"))
    t = once(t, _m=F.lower(_marked(F.rtrim(plain, F.lit(BLANKS + "；;")))))
    body = F.regexp_replace("_r", rf"(?s)^(?:.*<answer>|[{SPACE}*]*(?:回答|答案|answer|Answer)\*+)", "")
    whole = F.when(has("_r", "<", "*"), F.lower(_marked(body))).otherwise(F.col("_m"))
    t = once(t, _last=F.substring_index("_m", STOP, -1), _whole=F.btrim(whole, F.lit(TRIM + STOP)))
    asks = has("_r", "?", "？") & F.col("_r").rlike(rf"[?？][{SPACE}\"'”’]*[^?？{STOPS}\n]*$")
    t = once(t, _clause=_bare(F.substring_index("_last", COMMA, -1)), _q=asks, _one=~has("_last", COMMA))
    return once(
        t.where((F.length("_whole") > 24) | ~F.col("_whole").rlike(f"^(?:{STAND_INS})?$") | F.col("_r").endswith("�")),
        token=F.col("_clause"),
        place=F.when(F.col("_one"), "f").otherwise("m"),
        sure=F.col("_z").isin(*[*",，、:：", "�", "."]) | unclosed(F.col("_r")),
        alone=F.col("_one") & (F.col("_q") | (_bare(F.col("_whole")) == F.col("_clause"))),
        n_chars=F.col("_n"),
    ).drop("_r", "_n", "_z", "_m", "_last", "_whole", "_clause", "_q", "_one", "text")


def limits(unfinished: DataFrame) -> DataFrame:
    """(record_set, source, n_chars): lengths at which a source's unfinished texts pile up, against lengths up to 8 away."""
    n = unfinished.groupBy("record_set", "source", "n_chars").agg(F.count(F.lit(1)).alias("_n"))
    near = n.select("record_set", "source", F.explode(F.sequence(F.col("n_chars") - 8, F.col("n_chars") + 8)).alias("n_chars"), F.col("_n").alias("_m"), F.lit(0).alias("_n"))
    both = near.unionByName(n.withColumn("_m", F.lit(0))).groupBy("record_set", "source", "n_chars").agg(F.sum("_m").alias("_m"), F.sum("_n").alias("_n"))
    return both.where((F.col("_n") >= PILE_ROWS) & (F.col("_n") > PILE * F.greatest((F.col("_m") - F.col("_n")) / 16.0, F.lit(0.5)))).select("record_set", "source", "n_chars")


def judged(texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """Candidates with `cut`: whether each ends within a word, clause or sentence."""
    c = once(cut(candidates(texts)), _tail=ending(F.col("token")))
    open_ = c.where("not sure and token <> ''")
    asked = open_.select(F.col("place").alias("kind"), F.col("token").alias("node")).unionAll(open_.select(F.lit("t"), "_tail")).distinct()
    nodes = cut(trie(tokens_of(corpus), cut(asked)))
    here = nodes.where("kind <> 't'").select(F.col("kind").alias("_pl"), F.col("node").alias("_nd"), "ends", "goes_on", "below")
    tails = nodes.where("kind = 't'").select(F.col("node").alias("_te"), F.col("ends").alias("tail_ends"))
    j = c.join(here, (F.col("place") == F.col("_pl")) & (F.col("token") == F.col("_nd")), "left")
    j = cut(j.join(tails, F.col("_tail") == F.col("_te"), "left"))
    e, g, b, t = (F.coalesce(F.col(x), F.lit(0)) for x in ("ends", "goes_on", "below", "tail_ends"))
    # a short text that is known as a whole sentence tells nothing of a limit
    pile = limits(j.where(~(F.col("alone") & (e > 0)))).select(F.col("record_set").alias("_rs"), F.col("source").alias("_s"), F.col("n_chars").alias("_c"), F.lit(True).alias("at_limit"))
    j = j.join(maybe_broadcast(pile), (F.col("record_set") == F.col("_rs")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("n_chars") == F.col("_c")), "left")
    at = F.coalesce(F.col("at_limit"), F.lit(False))
    known = e + g + b > 0
    complete = e >= F.when(at, 0.5).when(F.col("alone"), 0.0).otherwise(0.2) * (e + g + b)
    verdict = (
        F.when(F.col("sure"), True)
        .when(F.col("token") == "", False)
        .when(known & (e > 0), ~complete)
        .when(known & F.col("alone") & (g == 0) & (t > 0), False)
        .when(known, True)
        .otherwise(t == 0)
    )
    return j.withColumn("cut", verdict)


def truncated(texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """(record_set, row_id) of the texts that were cut."""
    return judged(texts, corpus).where("cut").select("record_set", "row_id")


def corpus_of(sft: DataFrame, val_pred: DataFrame) -> DataFrame:
    """Column text: all answers and predictions, and the questions (answers may give them back)."""
    return (
        sft.select(F.col("answer").alias("text"))
        .unionAll(val_pred.select("prediction"))
        .unionAll(sft.select("question"))
    )


def rates(texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """Per record set and source: rows, truncated rows and their rate."""
    n = texts.groupBy("record_set", "source").agg(F.count(F.lit(1)).alias("n_rows"))
    k = judged(texts, corpus).where("cut").groupBy("record_set", "source").agg(F.count(F.lit(1)).alias("_k"))
    k = k.select(F.col("record_set").alias("_rs"), F.col("source").alias("_s"), "_k")
    return (
        n.join(k, (n["record_set"] == F.col("_rs")) & n["source"].eqNullSafe(F.col("_s")), "left")
        .select("record_set", "source", "n_rows", F.coalesce("_k", F.lit(0)).alias("n_truncated"), F.round(F.coalesce("_k", F.lit(0)) / F.col("n_rows"), 6).alias("rate"))
    )
