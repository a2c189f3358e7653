"""Picture listings: datasets are folders with a rule for the pictures that count.

Listing reads names only; the bytes are read where encode() is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .jsonl import exists

#: Per dataset, the pictures that count, as a pattern on the path.
DATASETS: Mapping[str, str] = {
    "EBD": r"/images/[^/]*_post_disaster[^/]*\.(?:png|jpg|jpeg)$",
    "LEVIR-CD+": r"/B/[^/]*\.png$",
    "SECOND": r"/im2/[^/]*\.png$",
}


def keep(path: Column, dataset: str, rules: Mapping[str, str] = DATASETS) -> Column:
    """Whether a path counts as a picture of the dataset."""
    return path.rlike(rules[dataset])


def scan(spark: SparkSession, root: str, datasets: Sequence[str], rules: Mapping[str, str] = DATASETS) -> DataFrame:
    """(dataset, image_path) of the named datasets under a root; unknown or missing ones give nothing."""
    out = spark.createDataFrame([], "dataset string, image_path string")
    for name in datasets:
        if name in rules and exists(spark, f"{root}/{name}"):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/{name}").select("path")
            out = out.unionByName(files.where(keep(F.col("path"), name, rules)).select(F.lit(name).alias("dataset"), F.col("path").alias("image_path")).distinct())
    return out


def listed(df: DataFrame, image: str, rules: Mapping[str, str] = DATASETS) -> DataFrame:
    """(dataset, image_path) from a column of paths that name their dataset's folder."""
    p = T.flat_path(F.col(image))
    name = F.lit(None).cast("string")
    for d, rule in rules.items():
        quoted = d.replace("+", r"\+")
        name = F.when(p.rlike(rf"(?:^|/){quoted}/") & p.rlike(rule), d).otherwise(name)
    return df.select(name.alias("dataset"), p.alias("image_path")).where("dataset is not null").distinct()


def by_suffix(paths: DataFrame, path: str, suffixes: Sequence[str]) -> DataFrame:
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | F.col(path).endswith(s)
    return paths.where(cond)


def encode(df: DataFrame, content: str = "content") -> DataFrame:
    """The bytes of pictures in base64, with their type."""
    return df.select("path", T.mime_type(F.col("path")).alias("mime"), F.base64(F.col(content)).alias("data"))
