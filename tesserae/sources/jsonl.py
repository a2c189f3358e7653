"""JSON Lines and JSON array sources: strict, tolerant and keyed readers, and sinks.

A missing path gives an empty table from tolerant readers and an error from strict ones. Blank lines are skipped. Where
order matters (last occurrence wins), rows carry `pos`: append() numbers its runs, so rows of a later run come later; inside
a run, and among files that were not appended here (run 0), `pos` follows the file names and the lines inside them. A file
that is one JSON array is read by one task, as it cannot be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import resolve_path
from ..operators.ranks import last_wins
from ..schemas import MANIFEST


POS = "struct<run:bigint,file:string,start:bigint,row:bigint>"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or a glob has anything, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every non-blank line must parse, else the read fails."""
    return spark.read.schema(schema_of(schema)).options(mode="FAILFAST", recursiveFileLookup=True).json(path)


def read_strict_lines(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT per line; a blank or malformed line raises."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(F.parse_json(F.col("value")).alias("value"))


def read_tolerant(spark: SparkSession, path: str, schema: str, with_pos: bool = False) -> DataFrame:
    """Malformed lines are dropped, a missing path is empty; optionally with the position of each row."""
    s = schema_of(schema)
    cols = [f.name for f in s.fields]
    if not exists(spark, path):
        empty = spark.createDataFrame([], s)
        return empty.select(*cols, F.lit(None).cast(POS).alias("pos")) if with_pos else empty
    if not with_pos:
        return spark.read.schema(s).options(mode="DROPMALFORMED", recursiveFileLookup=True).json(path)
    file = F.col("_metadata.file_path")
    run = F.coalesce(F.regexp_extract(file, r"/run=(\d+)/[^/]*$", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    # parts of a file are told apart by where they begin; inside a part numbers rise with the lines
    place = F.struct(run.alias("run"), file.alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", place.alias("pos"))
    parsed = lines.select("pos", F.from_json("value", T.StructType(s.fields + [T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r is not null and r._bad is null").select(*[F.col(f"r.{c}").alias(c) for c in cols], "pos")


def read_keyed(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Tolerant; rows without a key are dropped and the last row of a key wins."""
    rows = read_tolerant(spark, path, schema, with_pos=True).where(F.col(key).isNotNull() & (F.col(key) != ""))
    return last_wins(rows, [key], ["pos"]).drop("pos")


def read_keys(spark: SparkSession, path: str, schema: str, key: Column) -> DataFrame:
    """The different keys of a tolerant read."""
    return read_tolerant(spark, path, schema).select(key.alias("key")).where("key is not null").distinct()


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema_of(schema)).option("multiLine", True).json(path)


def head(spark: SparkSession, path: str, schema: str, n: int) -> DataFrame:
    """The first n rows in file order."""
    return read_tolerant(spark, path, schema, with_pos=True).orderBy("pos").limit(n).drop("pos")


def _names(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    return [x.getPath().getName() for x in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []]


def append(df: DataFrame, path: str) -> None:
    """Append a run of rows: a folder of its own with the next number, so that its rows come after all earlier ones.

    A task's rows are visible once the whole run is committed; of two writers at once one fails, as the folder exists.
    """
    runs = [int(n.split("=")[1]) for n in _names(df.sparkSession, f"{path}/run=*")]
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(f"{path}/run={max(runs, default=0) + 1:08d}")


def overwrite(df: DataFrame, path: str) -> None:
    """Write to a fresh folder beside the target, then swap, so that a table may be rewritten from itself.

    The former table stays as `.bak`, from which it can be restored should the run die between the two renames.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, fresh, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new", f"{path}.bak"))
    fs = target.getFileSystem(conf)
    df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}.new")
    if fs.exists(target):
        fs.delete(old, True)
        fs.rename(target, old)
    fs.rename(fresh, target)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, image_path) of an earlier run's sample, in its order of rows; lines without either are dropped."""
    return read_tolerant(spark, path, MANIFEST).where("dataset is not null and image_path is not null")


def write_manifest(samples: DataFrame, path: str, root: str = "") -> None:
    """Keep a run's sample, with resolved paths; replaces what was there."""
    overwrite(samples.select("dataset", resolve_path(F.col("image_path"), root).alias("image_path")), path)


def stats_json(counters: DataFrame) -> DataFrame:
    """Counters (metric, value) as one JSON object."""
    return counters.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))).alias("stats"))
