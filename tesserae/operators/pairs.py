"""Pictures before and after an event, and two-picture records.

File names without the pattern belong to no event. Where a status occurs twice, the later row in order wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

PER_EVENT = 50


def registry(df: DataFrame, path: str) -> DataFrame:
    """(event, img_id, pre, post): one row per place of an event; the greater path wins where a status repeats."""
    p = F.col(path)
    r = df.select(T.event_of(p).alias("event"), T.event_image_of(p).alias("img_id"), T.event_status_of(p).alias("status"), p.alias("path")).where("status in ('pre', 'post')")
    return r.groupBy("event", "img_id").agg(F.max(F.when(F.col("status") == "pre", F.col("path"))).alias("pre"), F.max(F.when(F.col("status") == "post", F.col("path"))).alias("post"))


def complete_pairs(reg: DataFrame, per_event: int = PER_EVENT) -> DataFrame:
    """Complete pairs, at most `per_event` of each event in place order; the cap is the report's size, not a guard."""
    w = Window.partitionBy("event").orderBy("img_id")
    return reg.where("pre is not null and post is not null").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_event).drop("_r")


def event_stats(reg: DataFrame) -> DataFrame:
    """Places and files of each event."""
    return reg.groupBy("event").agg(F.count(F.lit(1)).alias("ids"), F.sum(F.col("pre").isNotNull().cast("bigint") + F.col("post").isNotNull().cast("bigint")).alias("files"))


def by_file_name(a: DataFrame, b: DataFrame, path: str) -> DataFrame:
    """(file, path_a, path_b): pictures of two folders with the same file name, in natural order."""
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    x, y = a.select(name.alias("file"), F.col(path).alias("path_a")), b.select(name.alias("file"), F.col(path).alias("path_b"))
    return x.join(y, "file").orderBy(T.natural_key(F.col("file")), "file", "path_a", "path_b")


def record(df: DataFrame, first: str, second: str, prompt: str, answer: str) -> DataFrame:
    """Chat records of two pictures."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return df.select(
        F.array(turn("user", F.lit("<image>\n<image>\n" + prompt)), turn("assistant", F.col(answer))).alias("messages"),
        F.array(F.col(first), F.col(second)).alias("images"),
    )
