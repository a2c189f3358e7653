"""Tables of a folder, and SQL fragments that the checks share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: White space as Python's strip() sees it, for RE2.
PYWS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def norm_sql(c: str) -> str:
    """A type written in one way: no outer white space, lower case, '_' for '-'."""
    return f"replace(lower({strip_sql(f'coalesce({c}, chr(63))')}), '-', '_')"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^[{PYWS}]+|[{PYWS}]+$', '', 'g')"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")
