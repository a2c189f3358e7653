"""From answers to training rows: filter, project, split, count.

Missing validation means valid; null answers give null training answers; null types and modes take their defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def validated(is_valid: Column, label: Column, keep_warning: bool = False) -> Column:
    """Keep valid rows that pass; with keep_warning also valid rows of other labels, except format failures.

    The validator marks every warning as not valid, so its warnings stay out either way.
    """
    lab = F.coalesce(label, F.lit("pass"))
    fine = (lab == "pass") | ((lab != "format_fail") if keep_warning else F.lit(False))
    return F.coalesce(is_valid, F.lit(True)) & fine


def filter_counts(df: DataFrame, ok: Column) -> DataFrame:
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def training_rows(df: DataFrame, old_root: str = "", new_root: str = "", *keep: str) -> DataFrame:
    """Rows of the answers schema as (image, question, answer, question_type, answer_mode), after the columns to keep.

    The first message of each role counts, wherever it stands.
    """
    said = lambda role: F.try_element_at(F.filter("messages", lambda m: m["role"] == role), F.lit(1))["content"]
    return df.select(
        *keep,
        T.remap_image(F.get("images", F.lit(0)), old_root, new_root).alias("image"),
        T.strip_image_token(said("user")).alias("question"),
        T.strip(said("assistant")).alias("answer"),
        F.coalesce("meta.question_type", F.lit("")).alias("question_type"),
        F.coalesce("meta.answer_mode", F.lit("analysis")).alias("answer_mode"),
    )


def as_answers(df: DataFrame, image: str, question: str, answer: str, question_type: str, dataset: str, generated_at: str, answer_mode: str) -> DataFrame:
    """Flat rows assembled as chat records with one image."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return df.select(
        "*",
        F.array(turn("user", F.concat(F.lit("<image>\n"), T.question_text(F.col(question)))), turn("assistant", F.col(answer))).alias("messages"),
        F.array(F.col(image)).alias("images"),
        F.struct(
            F.lit("vqa_distill").alias("task_type"), F.col(question_type).alias("question_type"), F.col(dataset).alias("source_dataset"),
            F.col(generated_at).alias("generated_at"), F.col(answer_mode).alias("answer_mode"),
        ).alias("meta"),
    )


def type_counts(df: DataFrame, type_col: str, position: str) -> DataFrame:
    """Types by falling count, ties by first occurrence."""
    return (
        df.groupBy(F.coalesce(F.col(type_col), F.lit("")).alias("question_type")).agg(F.count(F.lit(1)).alias("cnt"), F.min(position).alias("_p"))
        .orderBy(F.col("cnt").desc(), "_p").drop("_p")
    )


def missing_files(rows: DataFrame, image: str, listing: DataFrame, path: str) -> DataFrame:
    """Different pictures of rows that the listing doesn't have."""
    return rows.select(F.col(image).alias("image")).where("image is not null").distinct().join(listing.select(F.col(path).alias("image")), "image", "left_anti")


def rewrite_role(messages: Column, role: str, text: str) -> Column:
    """Messages with one text for every turn of a role."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), F.when(m["role"] == role, text).otherwise(m["content"]).alias("content")))


def content_blocks(c: Column) -> Column:
    """A message as blocks: one image block per image token, then a text block unless the text is empty."""
    n = (F.length(c) - F.length(F.replace(c, F.lit(T.IMAGE), F.lit("")))) / len(T.IMAGE)
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    text = T.strip_image_token(c)
    images = F.array_repeat(block("image", F.lit(None).cast("string")), n.cast("int"))
    return F.concat(images, F.when(text != "", F.array(block("text", text))).otherwise(F.array().cast("array<struct<type:string,text:string>>")))


def yes_no(answer: Column) -> Column:
    """'yes' or 'no' of an answer that begins with an affirmation or a denial, else null; tags aside."""
    text = T.strip(F.regexp_replace(F.regexp_replace(answer, "(?s)^.*<answer>", ""), "</?[a-z]+>", ""))
    return F.when(text.rlike("^(?:否|无|没有|不)|(?i)^no\\b"), "no").when(text.rlike("^(?:是|有|存在|可见|可以)|(?i)^yes\\b"), "yes")


def yes_no_balance(df: DataFrame, answer: str, question_type: Column) -> DataFrame:
    """(label, cnt) of the existence answers that affirm or deny."""
    d = df.where(question_type == "existence").select(yes_no(F.col(answer)).alias("label"))
    return d.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("cnt"))


def steps(answer: Column) -> Column:
    """Numbered lines in an answer's analysis (or in the answer itself where there is none)."""
    body = F.coalesce(F.nullif(F.regexp_extract(answer, "(?s)<analysis>(.*?)</analysis>", 1), F.lit("")), answer)
    return F.regexp_count(body, F.lit(r"(?m)^[ \t]*[0-9０-９]+[.、．]"))


def step_histogram(df: DataFrame, answer: str) -> DataFrame:
    """(steps, cnt) over all answers that are not null."""
    return df.where(F.col(answer).isNotNull()).groupBy(steps(F.col(answer)).cast("bigint").alias("steps")).agg(F.count(F.lit(1)).alias("cnt"))


def balance(df: DataFrame, mode: str) -> DataFrame:
    """Rows and share per answer mode."""
    n = df.groupBy(mode).agg(F.count(F.lit(1)).alias("cnt"))
    return n.withColumn("share", F.round(F.col("cnt") / n.agg(F.sum("cnt")).scalar(), 9))
