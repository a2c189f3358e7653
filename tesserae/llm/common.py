"""Helpers shared by the training-data operators: tables, checkpoints, skew-free ranks, text and path forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rows import cut, once

#: Full-width ASCII forms and the ideographic space, mapped to ASCII by a rule (U+FF01..U+FF5E lie 0xFEE0 above ASCII).
WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)) + "\u3000"
NARROW = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
#: Unicode white space, the zero-width characters and the byte order mark, for Java regular expressions.
SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200F}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(c: Column) -> Column:
    return F.translate(c, WIDE, NARROW)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def spread(df: DataFrame, parts: int) -> DataFrame:
    """df dealt out to `parts` partitions, or as it is for 0.

    Meant for costly work in Python on small tables in few files; the caller knows whether its table is one (see few_files).
    """
    return df.repartition(parts) if parts > 0 else df


def few_files(scan: DataFrame) -> int:
    """The number of cores if a plain scan has fewer partitions than that, else 0."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return cores if scan.rdd.getNumPartitions() < cores else 0


def fits(df: DataFrame, rows: int) -> bool:
    """Whether df has at most `rows` rows; reads no more than one row beyond."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """A broadcast hint only where the side is proven to have at most `rows` rows."""
    return F.broadcast(df) if fits(df, rows) else df


def sift(df: DataFrame, key: str, keys: DataFrame, bits: int = 24) -> DataFrame:
    """df without most of the rows whose key is not among keys[key]: a filter of 2 ** bits bits (2 MB) is broadcast.

    A row whose key is there always passes; it spares a join the shuffle of rows that would find nothing.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)) + 1
    marks = keys.groupBy(F.bitmap_bucket_number(place(F.col(key))).alias("_at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place(F.col(key)))).alias("_bits"))
    at = df.withColumn("_x", place(F.col(key)))
    byte = lambda pos: F.conv(F.hex(F.substring("_bits", (F.shiftright(pos, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = at.join(F.broadcast(marks), F.bitmap_bucket_number("_x") == F.col("_at"))
    pos = F.bitmap_bit_position("_x")
    return met.where(F.call_function("shiftright", byte(pos), F.pmod(pos, F.lit(8)).cast("int")).bitwiseAND(1) == 1).drop("_x", "_at", "_bits")


#: A key is hot if it holds more than a HOT-th of all rows: there are fewer than HOT hot keys.
HOT = 1000


def look_up(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """rows left-joined to a table with one row per key.

    Hot keys meet their rows by a broadcast of fewer than HOT rows, so that no task gathers a key; the others are shuffled.
    Rows with a null key find nothing and stay where they are.
    """
    right = table.withColumnRenamed(key, "_key")
    n = cut(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_hot", F.lit(True)))
    total = n.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = n.where(F.col("_n") * HOT > total).select(F.col(key).alias("_hk"), "_hot")
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left").drop("_hk")
    some = F.broadcast(right.join(F.broadcast(hot), F.col("_key") == F.col("_hk"), "left_semi"))
    of_hot = marked.where("_hot").join(some, F.col(key) == F.col("_key"), "left")
    others = marked.where(F.col("_hot").isNull() & F.col(key).isNotNull()).join(right, F.col(key) == F.col("_key"), "left")
    null = rows.where(F.col(key).isNull())
    for f in table.schema.fields:
        if f.name != key:
            null = null.withColumn(f.name, F.lit(None).cast(f.dataType))
    return of_hot.drop("_hot", "_key").unionByName(others.drop("_hot", "_key")).unionByName(null)


#: Folders under which the same picture collection is mounted.
ROOTS = ("srv/rsvqa/dataset", "data/train/rs_images", "d:/rs/dataset")


def with_path(df: DataFrame, source: str, name: str, roots: Sequence[str] = ROOTS) -> DataFrame:
    """df with one spelling for every way to write a file's path; null stays null, a blank path becomes null.

    Width, case, outer white space, back slashes, file URLs with percent codes, doubled slashes, '.' and '..' steps and
    the mounted roots are levelled out.
    """
    p = F.col("_p")
    df = once(df, _p=F.lower(F.replace(strip(narrow(F.col(source))), F.lit("\\"), F.lit("/"))))
    coded = F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p)
    df = once(df, _p1=F.regexp_replace(F.when(p.contains("%"), F.lower(coded)).otherwise(p), "^file:/+", ""))
    parts = F.aggregate(
        F.split("_p1", "/+"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when((x == "") | (x == "."), acc)
        .when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(x))),
    )
    plain = ~F.col("_p1").rlike(r"(?:^|/)\.{0,2}(?:/|$)")
    flat = F.when(plain, F.col("_p1")).otherwise(F.array_join(parts, "/"))
    known = "^(?:" + "|".join(r"\Q" + r + r"\E" for r in roots) + ")/"
    return once(df, **{name: F.nullif(F.regexp_replace(flat, known, ""), F.lit(""))}).drop("_p", "_p1")
