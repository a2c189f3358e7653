"""Rule-based validation and repair of tagged answers, one projection and no UDF.

Null answers count as '' (a format failure), null types as none of the known types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rows import once
from .health import HARD_WORDS, NUMERIC_PATTERNS, SOFT_WORDS

#: Wordings of place, and of thinking aloud.
LOCATION_WORDS = ("左上", "左下", "右上", "右下", "左侧", "右侧", "上方", "下方", "中部", "中央", "附近", "相邻", "之间")
META_REASONING = ("我认为", "我猜测", "让我", "先分析", "分析用户请求", "构建最终答案", "格式化输出", "最终审查")
#: The warnings.
NO_ANSWER_TAG, NO_ANSWER, EMPTY_ANSWER = "缺少 answer 标签", "无法解析 answer 内容", "answer 内容为空"
NO_ANALYSIS_TAG, NO_ANALYSIS = "缺少 analysis 标签", "无法解析 analysis 内容"
NO_STEPS, SHORT, LONG, META = "analysis 没有分步证据", "analysis 过短，证据链可能不足", "analysis 过长，建议压缩为简短证据链", "analysis 含有元推理或过程废话"
DIRECT_TAG, LONG_ANSWER = "直答样本不应包含 analysis 标签", "answer 过长，建议只保留最终结论"
NUMERIC, HARD, SOFT = "包含疑似精确数值/单位表达", "包含高风险词汇: ", "包含需复核词汇: "
TYPE_RULES = {
    "unanswerable": ("无法|不确定|难以确认|不能确定", "unanswerable 题答案未给出拒答/不确定表达"),
    "ambiguous": ("可能|也可能|无法准确区分|难以区分|或", "ambiguous 题答案未给出多解/不确定表达"),
    "counting": ("[0-9０-９]+|零|一|二|三|四|五|六|七|八|九|十|约|大约|无法确认|不确定", "计数题答案中没有数量或不确定表达"),
    "existence": ("有|没有|存在|不存在|可见|不可见", "存在性问题答案不够直接"),
}
NO_PLACE = "位置/空间关系题缺少方位或关系表达"


def section(c: Column, tag: str) -> Column:
    """The first section of a tag, stripped; '' if there is none (see has_section)."""
    return T.strip(F.regexp_extract(c, f"(?s)<{tag}>(.*?)</{tag}>", 1))


def has_section(c: Column, tag: str) -> Column:
    return c.rlike(f"(?s)<{tag}>.*?</{tag}>")


def risks(c: Column) -> list[Column]:
    """Warnings of risky wording, null where one doesn't apply; each numeric pattern warns by itself."""
    out = [F.when(F.contains(c, F.lit(w)), HARD + w) for w in HARD_WORDS]
    out += [F.when(F.contains(c, F.lit(w)), SOFT + w) for w in SOFT_WORDS]
    return out + [F.when(c.rlike(p), NUMERIC) for p in NUMERIC_PATTERNS]


def validate(df: DataFrame, answer: str, question_type: str, expect_analysis: Column) -> DataFrame:
    """df with is_valid, warnings and label (pass, warning, format_fail)."""
    a = F.coalesce(F.col(answer), F.lit(""))
    d = df.withColumn("_a", a).withColumn("_ea", F.coalesce(expect_analysis, F.lit(True)))
    d = once(d, _ans=section(F.col("_a"), "answer"), _ana=section(F.col("_a"), "analysis"))
    text, ans, ana, ea, qt = F.col("_a"), F.col("_ans"), F.col("_ana"), F.col("_ea"), F.coalesce(F.col(question_type), F.lit(""))
    has = lambda x: F.contains(text, F.lit(x))
    fail = (
        F.when(~has("<answer>") | ~has("</answer>"), NO_ANSWER_TAG)
        .when(~has_section(text, "answer"), NO_ANSWER)
        .when(ans == "", EMPTY_ANSWER)
        .when(ea & (~has("<analysis>") | ~has("</analysis>")), NO_ANALYSIS_TAG)
        .when(ea & ~has_section(text, "analysis"), NO_ANALYSIS)
    )
    steps = F.size(F.filter(F.split(ana, "\n"), lambda x: T.strip(x).rlike(r"^[0-9０-９]+\.")))
    meta = F.lit(False)
    for w in META_REASONING:
        meta = meta | F.contains(ana, F.lit(w))
    place = F.lit(False)
    for w in LOCATION_WORDS:
        place = place | F.contains(ans, F.lit(w)) | F.contains(ana, F.lit(w))
    with_analysis = [
        F.when(steps == 0, NO_STEPS).when(steps > 3, F.concat(F.lit("analysis 步骤数为 "), steps.cast("string"), F.lit("，建议不超过 3 步"))),
        F.when(F.length(ana) < 20, SHORT),
        F.when(F.length(ana) > 220, LONG),
        F.when(meta, META),
        *risks(ana),
    ]
    warnings = [F.when(ea, w) for w in with_analysis]
    warnings += [F.when(~ea & has("<analysis>"), DIRECT_TAG), F.when(F.length(ans) > 40, LONG_ANSWER), *risks(ans)]
    for t in ("unanswerable", "ambiguous", "counting"):
        warnings.append(F.when((qt == t) & ~ans.rlike(TYPE_RULES[t][0]), TYPE_RULES[t][1]))
    warnings.append(F.when(qt.isin("location", "spatial_relation") & ~place, NO_PLACE))
    warnings.append(F.when((qt == "existence") & ~ans.rlike(TYPE_RULES["existence"][0]), TYPE_RULES["existence"][1]))
    d = once(d, _fail=fail)
    d = once(d, warnings=F.when(F.col("_fail").isNotNull(), F.array(F.col("_fail"))).otherwise(F.array_compact(F.array(*warnings))))
    blocked = F.exists("warnings", lambda w: w.startswith(HARD) | (w == NUMERIC))
    d = once(d, is_valid=F.col("_fail").isNull() & ~blocked)
    label = F.when(F.col("_fail").isNotNull(), "format_fail").when(F.col("is_valid"), "pass").otherwise("warning")
    return d.withColumn("label", label).drop("_a", "_ea", "_ans", "_ana", "_fail")


def salvage(c: Column, expect_analysis: Column) -> Column:
    """The answer with missing end tags put back; unchanged without an opening answer tag, or with nothing to mend."""
    t = T.rstrip(c)
    has = lambda x: F.contains(c, F.lit(x))
    at = F.instr(t, "<answer>")
    fix1 = expect_analysis & has("<analysis>") & ~has("</analysis>")
    one = F.when(fix1, F.concat(F.substring(t, F.lit(1), at - 1), F.lit("</analysis>\n"), F.substring(t, at, F.length(t)))).otherwise(t)
    fix2 = ~has("</answer>")
    two = F.when(fix2, F.concat(one, F.lit("</answer>"))).otherwise(one)
    return F.when(~has("<answer>"), c).when(fix1 | fix2, two).otherwise(c)


def salvaged(df: DataFrame, answer: str, question_type: str, expect_analysis: Column) -> DataFrame:
    """df judged before and after the repair: label, salvaged, new_answer, new_label, recovered.

    Rows that pass are not touched; others are judged again only if the repair changed them.
    """
    d = validate(df, answer, question_type, expect_analysis).drop("warnings", "is_valid")
    new = F.when(F.col("label") == "pass", F.col(answer)).otherwise(salvage(F.coalesce(F.col(answer), F.lit("")), F.coalesce(expect_analysis, F.lit(True))))
    d = once(d, new_answer=new)
    d = once(d, salvaged=(F.col("label") != "pass") & (F.col("new_answer") != F.coalesce(F.col(answer), F.lit(""))))
    as_is = d.where(~F.col("salvaged")).withColumn("new_label", F.col("label"))
    mended = d.where("salvaged").withColumnRenamed("label", "_old")
    mended = validate(mended, "new_answer", question_type, expect_analysis).drop("warnings", "is_valid").withColumnRenamed("label", "new_label").withColumnRenamed("_old", "label")
    both = as_is.unionByName(mended)
    return both.withColumn("recovered", F.col("salvaged") & (F.col("new_label") == "pass"))


def salvage_counts(judged: DataFrame) -> DataFrame:
    return judged.agg(F.count(F.lit(1)).alias("total"), F.count_if("salvaged").alias("salvaged"), F.count_if("recovered").alias("recovered"))
