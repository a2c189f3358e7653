"""Row-wise steps on DataFrames."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """df with more columns, each computed exactly once a row.

    A plain projection is merged into whatever uses it, so that a costly expression used by a filter, a hash and an
    output would run three times. A one-element generator is not merged.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))


def cut(df: DataFrame) -> DataFrame:
    """Materialise df on reliable storage and cut its lineage.

    The folder is spark.checkpoint.dir as the session names it. Only in local mode, where driver and executors share one
    machine, is a temporary folder used instead; on a cluster the setting is required.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        at = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not at and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(at or os.path.join(tempfile.gettempdir(), "tesserae-checkpoints"))
    return df.checkpoint(eager=True)


#: A key is hot if it holds more than a HOT-th of all rows: there are fewer than HOT hot keys.
HOT = 1000


def salted_semi(rows: DataFrame, keys: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """Rows whose key is among keys[key], for keys that may hold any share of the rows.

    Rows of a hot key are dealt out by a hash of another column, and only hot keys are repeated for each salt. rows are
    counted by key when this is called. The keys are never broadcast, see merged().
    """
    n = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = [r[0] for r in n.where(F.col("_n") * HOT > n.agg(F.sum("_n")).scalar()).collect()]
    salt = F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0)
    of_key = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    each = keys.select(key).where(F.col(key).isNotNull()).distinct().select(key, F.explode(of_key).alias("_salt"))
    return rows.withColumn("_salt", salt).join(merged(each), [key, "_salt"], "left_semi").select(*rows.columns)


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that must be shuffled and merged.

    For a table that grows with the pictures: before it has run, the planner knows it by the size of its compressed files and
    takes no account of explode(), so it would broadcast millions of rows from the driver.
    """
    return df.hint("merge")
