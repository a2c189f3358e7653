"""Health report of training answers: distribution of types, collapse of prompts and openings, lengths, residues, risky
wording and character classes.

Input: columns pos, question_type, question, answer (samples() makes them). Null types count as '?', null texts as ''.
An empty table gives empty details and a verdict without red lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .ranks import top_counts

#: The schedule of question types.
SCHEDULE = {"existence": 0.33, "location": 0.23, "spatial_relation": 0.19, "attribute": 0.14, "counting": 0.05, "unanswerable": 0.03, "ambiguous": 0.03}
REFUSAL_TYPES = ("unanswerable", "ambiguous")
#: Wordings that go beyond the picture.
HARD_WORDS = ("坐标", "经度", "纬度", "GPS", "GNSS", "InSAR", "禁建区", "缓冲区", "避让", "治理", "修复", "方案", "传感器", "赔偿", "补偿", "安置")
SOFT_WORDS = ("成因", "原因", "导致", "引发", "建议", "应该", "需要", "必须", "监测", "政府", "部门")
_NUM = "[0-9０-９零一二三四五六七八九十百千万两]+"
NUMERIC_PATTERNS = (
    f"面积[{T.WS}]*(?:约|为|是)?[{T.WS}]*{_NUM}",
    f"{_NUM}[{T.WS}]*(?:平方米|平方公里|公顷)",
    f"距离[{T.WS}]*(?:约|为|是)?[{T.WS}]*{_NUM}",
    f"{_NUM}[{T.WS}]*(?:米|公里|千米)",
)
NUMERIC_HIT = "精确数值+单位"
TAG = "</?(?:analysis|answer)>"
#: Red lines and warnings.
ENTROPY_RED, TOP3_RED, OPENING_RED, LONG_P90, CYRILLIC_WARN, PREFIX, OPENING, TOP_N = 0.7, 0.60, 0.20, 120, 0.005, 6, 12, 12


def samples(df: DataFrame, pos: str, question_type: str, question: str, answer: str) -> DataFrame:
    """A slim projection, read once by each part of the report."""
    return df.select(
        F.col(pos).alias("pos"),
        F.coalesce(F.col(question_type), F.lit("?")).alias("question_type"),
        T.question_text(F.coalesce(F.col(question), F.lit(""))).alias("question"),
        F.coalesce(F.col(answer), F.lit("")).alias("answer"),
    )


def type_distribution(s: DataFrame) -> DataFrame:
    """Counts and shares by type against the schedule; scheduled types that are absent are listed with 0."""
    spark = s.sparkSession
    goal = spark.createDataFrame(list(SCHEDULE.items()), "t string, target double")
    have = s.groupBy("question_type").agg(F.count(F.lit(1)).alias("n"))
    both = have.join(F.broadcast(goal), have["question_type"] == goal["t"], "full_outer").withColumn("total", have.agg(F.sum("n")).scalar())
    share = F.coalesce("n", F.lit(0)) / F.col("total")
    flag = F.when(F.col("target").isNull(), "非目标").when(share > F.col("target") * 1.5, "偏高").when(share < F.col("target") * 0.5, "偏低").otherwise("")
    return both.select(F.coalesce("question_type", "t").alias("question_type"), F.coalesce("n", F.lit(0)).cast("bigint").alias("cnt"), F.round(share, 9).alias("share"), "target", flag.alias("flag"))


def entropy(s: DataFrame) -> DataFrame:
    """Entropy of the types over its maximum for the types seen; 1 for one type or none."""
    n = s.groupBy("question_type").agg(F.count(F.lit(1)).alias("n"))
    w = n.groupBy().agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.ln("n")).alias("nlogn"))
    h = F.ln("t") - F.col("nlogn") / F.col("t")
    e = F.when(F.col("k") <= 1, 1.0).otherwise(h / F.ln("k"))
    return w.select(F.round(e, 9).alias("entropy"), F.coalesce(e < ENTROPY_RED, F.lit(False)).alias("red"))


def _top(s: DataFrame, column: str, letters: int, n: int) -> DataFrame:
    # the share is taken from the same counts: no second pass for the total
    top = s.groupBy(F.substring(column, 1, letters).alias("value")).agg(F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first_pos"))
    best = top.orderBy(F.col("cnt").desc(), "first_pos", "value").limit(n).withColumn("total", top.agg(F.sum("cnt")).scalar())
    return best.select("value", "cnt", F.round(F.col("cnt") / F.col("total"), 9).alias("share"))


def prefix_top(s: DataFrame, n: int = TOP_N) -> DataFrame:
    return _top(s, "question", PREFIX, n)


def opening_top(s: DataFrame, n: int = TOP_N) -> DataFrame:
    return _top(s, "answer", OPENING, n)


def top3_share(s: DataFrame) -> DataFrame:
    t = prefix_top(s, 3).agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("c"), F.coalesce(F.sum("share"), F.lit(0.0)).alias("x"))
    return t.select(F.col("c").cast("bigint").alias("top3_cnt"), F.round("x", 6).alias("top3_share"), (F.col("x") > TOP3_RED).alias("red"))


def opening_red(s: DataFrame, n: int = TOP_N, threshold: float = OPENING_RED) -> DataFrame:
    return opening_top(s, n).agg(F.round(F.coalesce(F.max("share"), F.lit(0.0)), 6).alias("max_share"), F.coalesce(F.max("share") > threshold, F.lit(False)).alias("red"))


def _lengths(s: DataFrame, *by: str) -> DataFrame:
    """Histogram of lengths with running counts: there are never more rows than different lengths."""
    h = s.groupBy(*by, F.length("answer").cast("bigint").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy("len")
    whole = Window.partitionBy(*by)
    return h.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(whole))


def _at(rank: Column) -> Column:
    """The length that holds a rank (from 1) of the ordered answers."""
    return F.min(F.when(F.col("upto") >= rank, F.col("len")))


def _stats(h: DataFrame, *by: str) -> DataFrame:
    t = F.col("total")
    low, high = F.floor((t + 1) / 2), F.floor((t + 2) / 2)
    p90 = F.least(t - 1, F.floor(t * F.lit(0.9))) + 1
    g = h.groupBy(*by) if by else h.groupBy()
    return g.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("cnt"),
        F.round(F.sum(F.col("n") * F.col("len")) / F.sum("n"), 6).alias("mean_len"),
        ((_at(low) + _at(high)) / 2.0).alias("median_len"),
        _at(p90).cast("bigint").alias("p90_len"),
        F.max("len").alias("max_len"),
    )


def length_overall(s: DataFrame) -> DataFrame:
    """Mean, interpolated median, p90 (the value at index min(n - 1, int(0.9 n))) and maximum in code points."""
    return _stats(_lengths(s)).withColumn("long_warning", F.coalesce(F.col("p90_len") > LONG_P90, F.lit(False)))


def length_by_type(s: DataFrame) -> DataFrame:
    return _stats(_lengths(s, "question_type"), "question_type").drop("p90_len")


def tag_residual(s: DataFrame) -> DataFrame:
    return s.agg(F.count_if(F.col("answer").rlike(TAG)).alias("tag_rows"))


def risk_hits() -> Column:
    """Risky wordings of an answer: each hard word once, all numeric patterns together once."""
    words = [F.when(F.contains("answer", F.lit(w)), F.lit(w)) for w in HARD_WORDS]
    return F.array_compact(F.array(*words, F.when(F.col("answer").rlike("|".join(NUMERIC_PATTERNS)), F.lit(NUMERIC_HIT))))


def risk_words(s: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n most frequent risky wordings."""
    e = s.select("pos", F.posexplode(risk_hits()).alias("i", "word"))
    return top_counts(e, F.col("word"), F.struct("pos", "i"), n, "word").select("word", "cnt")


def risk_rows(s: DataFrame) -> DataFrame:
    hit = F.size(risk_hits()) > 0
    return s.agg(F.count_if(hit).alias("risk_rows"), F.round(F.coalesce(F.count_if(hit) / F.count(F.lit(1)), F.lit(0.0)), 9).alias("risk_share"))


def charset(s: DataFrame) -> DataFrame:
    """Shares of Chinese and Cyrillic among all code points; a warning above half a percent of Cyrillic."""
    t = s.agg(F.sum(T.cjk_count(F.col("answer"))).alias("cjk"), F.sum(T.cyrillic_count(F.col("answer"))).alias("cyr"), F.sum(F.length("answer")).alias("n"))
    rate = lambda c: F.when(F.coalesce(F.col("n"), F.lit(0)) == 0, 0.0).otherwise(F.col(c) / F.col("n"))
    return t.select(F.round(rate("cjk"), 9).alias("cjk_rate"), F.round(rate("cyr"), 9).alias("cyr_rate"), (rate("cyr") > CYRILLIC_WARN).alias("warning"))


def _figures(s: DataFrame) -> DataFrame:
    """One row: entropy, share of the three most frequent prefixes and of the most frequent opening, from one pass.

    Types, prefixes and openings are counted together by grouping sets; of the prefixes only the best of each partition
    reach the task that ranks them.
    """
    cols = ("question_type", "prefix", "opening")
    d = s.select("pos", "question_type", F.substring("question", 1, PREFIX).alias("prefix"), F.substring("answer", 1, OPENING).alias("opening"))
    g = d.groupingSets([[c] for c in cols], *cols).agg(F.grouping_id(*cols).alias("_g"), F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
    kind = F.when(F.col("_g") == 3, "type").when(F.col("_g") == 5, "prefix").otherwise("opening")
    g = g.select(kind.alias("kind"), F.coalesce(*cols).alias("value"), "n", "first_pos")
    best = Window.partitionBy("kind").orderBy(F.col("n").desc(), "first_pos", "value")
    top = g.where("kind = 'prefix'").withColumn("_r", F.row_number().over(best)).where("_r <= 3").drop("_r")
    n = lambda k, c: F.when(F.col("kind") == k, c)
    w = g.where("kind <> 'prefix'").unionByName(top).agg(
        F.sum(n("type", F.col("n"))).alias("t"), F.count(n("type", F.lit(1))).alias("k"), F.sum(n("type", F.col("n") * F.ln("n"))).alias("x"),
        F.sum(n("prefix", F.col("n"))).alias("p"), F.max(n("opening", F.col("n"))).alias("o"),
    )
    e = F.when(F.col("k") <= 1, 1.0).otherwise((F.ln("t") - F.col("x") / F.col("t")) / F.ln("k"))
    share = lambda c: F.coalesce(F.col(c) / F.col("t"), F.lit(0.0))
    return w.select(e.alias("entropy"), share("p").alias("top3_share"), share("o").alias("max_opening_share"))


def verdict(s: DataFrame) -> DataFrame:
    """One row: the three red lines and whether any is crossed."""
    parts = _figures(s).select((F.col("entropy") < ENTROPY_RED).alias("entropy_red"), (F.col("top3_share") > TOP3_RED).alias("prefix_red"), (F.col("max_opening_share") > OPENING_RED).alias("opening_red"))
    return parts.withColumn("red", F.col("entropy_red") | F.col("prefix_red") | F.col("opening_red"))


def _marks(s: DataFrame) -> DataFrame:
    """One row: rows with residual tags and with risky wording, and the rates of Chinese and Cyrillic, from one pass."""
    t = s.agg(
        F.count_if(F.col("answer").rlike(TAG)).cast("double").alias("tag_rows"), F.count_if(F.size(risk_hits()) > 0).cast("double").alias("risk_rows"),
        F.sum(T.cjk_count(F.col("answer"))).alias("_cjk"), F.sum(T.cyrillic_count(F.col("answer"))).alias("_cyr"), F.coalesce(F.sum(F.length("answer")), F.lit(0)).alias("_n"),
    )
    rate = lambda c: F.when(F.col("_n") == 0, 0.0).otherwise(F.round(F.col(c) / F.col("_n"), 9))
    return t.select("tag_rows", "risk_rows", rate("_cjk").alias("cjk_rate"), rate("_cyr").alias("cyr_rate"))


def summary(s: DataFrame) -> DataFrame:
    """All single figures of the report in long form (metric, value), from three passes: counts, lengths and marks."""
    long = lambda df, **cols: df.select(F.map_from_arrays(F.array(*map(F.lit, cols)), F.array(*[c.cast("double") for c in cols.values()])).alias("m"))
    c = F.col
    one = (
        long(length_overall(s), n=c("cnt"), mean=c("mean_len"), median=c("median_len"), p90=c("p90_len"), max=c("max_len"))
        .unionAll(long(_figures(s), entropy=F.round("entropy", 9), top3_share=F.round("top3_share", 6), max_opening_share=F.round("max_opening_share", 6)))
        .unionAll(long(_marks(s), tag_rows=c("tag_rows"), risk_rows=c("risk_rows"), cjk_rate=c("cjk_rate"), cyr_rate=c("cyr_rate")))
    )
    return one.select(F.explode("m").alias("metric", "value"))


def report(s: DataFrame) -> DataFrame:
    """The figures as lines of text (line), ready to be shown."""
    return summary(s).select(F.format_string("%s: %.6f", "metric", "value").alias("line"))
