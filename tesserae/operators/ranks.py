"""Deterministic orders and ranks that hold under any partitioning.

Random choices follow md5(seed | key), which every engine computes alike; ties go to the smaller key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rows import cut


def shuffle_key(seed: int | str, *keys: Column) -> Column:
    """The place of a row in the shuffle of a seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def unit(h: Column) -> Column:
    """A number in [0, 1) from a shuffle key."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def shuffled_rank(df: DataFrame, group: Sequence[str], key: str, seed: int | str, name: str = "rank") -> DataFrame:
    """df with the rank (from 1) of each row in its group's shuffle.

    No group is ordered as a whole: the first three digits of the shuffle key cut it into 4096 buckets, whose counts are
    summed up; rows are ordered inside (group, bucket). A group that holds most rows is as evenly spread as any other.
    """
    h = shuffle_key(seed, F.col(key))
    at = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 3))
    cols = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    runs = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        at.groupBy(*cols, F.col("_b").alias("_rb")).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_rb", "_b")
        .withColumn("_before", F.coalesce(F.sum("_n").over(runs), F.lit(0))).withColumnRenamed("_b", "_rb").drop("_n")
    )
    on = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)] + [F.col("_b") == F.col("_rb")]
    inside = Window.partitionBy(*group, "_b").orderBy("_h", key)
    return (
        at.join(before, on).withColumn(name, (F.col("_before") + F.row_number().over(inside)).cast("bigint"))
        .drop("_h", "_b", "_rb", "_before", *[f"_g{i}" for i in range(len(group))])
    )


def numbered(df: DataFrame, order: str, name: str = "place") -> DataFrame:
    """df with the running number (from 0) of each row in the order of a column; equal values in any order.

    Rows are sorted inside range partitions, whose counts are summed up: numbers inside a partition come from
    monotonically_increasing_id, which holds the partition above its 33 lower bits.
    """
    at = cut(df.orderBy(order).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)))
    counts = at.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.col("_id").bitwiseAND((1 << 33) - 1)
    return at.join(before, F.col("_part") == F.col("_p")).withColumn(name, F.col("_before") + inside).drop("_id", "_part", "_p", "_n", "_before")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in order; max_by is combined before the shuffle, so hot keys cost nothing extra."""
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("_r")).select(*keys, "_r.*")


def top_counts(df: DataFrame, value: Column, position: Column, n: int, name: str = "value") -> DataFrame:
    """The n most frequent values; ties go to the value seen first."""
    return (
        df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("cnt"), F.min(position).alias("first_pos"))
        .orderBy(F.col("cnt").desc(), F.col("first_pos"), F.col(name)).limit(n)
    )
