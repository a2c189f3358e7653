"""Incremental runs on Structured Streaming: append what is new by key, and upsert decisions.

Both read a folder of files with availableNow: a run takes what has arrived since the last one and ends; a restart goes on
where the checkpoint stands. Neither keeps state in the engine: what is there already is found in the target itself, so that
nothing grows but the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import last_wins
from ..sources.jsonl import schema_of

#: Buckets of an upserted table; a micro-batch rewrites those that it touches.
BUCKETS = 64


def append_new(spark: SparkSession, source: str, schema: str, keys: Sequence[str], target: str, checkpoint: str, files_per_batch: int = 100) -> None:
    """Append rows whose key the target does not have, one of each key: the least of a batch's rows.

    A batch is one folder of the target, written over if the batch is run again; its keys are compared with those of the
    other folders, of which only the key columns are read.
    """

    def write(batch: DataFrame, i: int) -> None:
        fresh = batch.groupBy(*keys).agg(F.min(F.struct(*[c for c in batch.columns if c not in keys])).alias("_r")).select(*keys, "_r.*") if set(batch.columns) - set(keys) else batch.distinct()
        others = [f"{target}/{n}" for n in folders(spark, target, "batch") if n != f"batch={i:08d}"]
        if others:
            seen = spark.read.parquet(*others).select(*keys)
            fresh = fresh.join(seen, [fresh[k].eqNullSafe(seen[k]) for k in keys], "left_anti")
        fresh.select(*batch.columns).write.mode("overwrite").parquet(f"{target}/batch={i:08d}")

    rows = spark.readStream.schema(schema_of(schema)).option("maxFilesPerTrigger", files_per_batch).json(source)
    q = rows.writeStream.foreachBatch(lambda df, i: write(df, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def folders(spark: SparkSession, table: str, name: str) -> list[str]:
    """Names of the complete folders name=<number> of a table, in order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{table}/{name}=*/_SUCCESS")
    return sorted(s.getPath().getParent().getName() for s in p.getFileSystem(conf).globStatus(p) or [])


def upsert(batch: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], version: int, buckets: int = BUCKETS) -> None:
    """Merge a batch into a table, last in order wins.

    The table is cut into hash buckets of its keys. Only the buckets that the batch touches are read and written anew, each
    as the version of the batch; others keep their version. A version that a failed attempt left behind is overwritten, so
    that a batch may run twice.
    """
    spark = batch.sparkSession
    at = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = {r[0] for r in at.select("bucket").distinct().collect()}  # BUCKETS at most
    if not touched:
        return
    now = {b: v for b, v in current(spark, table, version).items() if b in touched}
    rows = at
    if now:
        old = spark.read.parquet(*[f"{table}/v={v:08d}/bucket={b}" for b, v in now.items()]).select(*batch.columns)
        rows = old.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).unionByName(at)
    last_wins(rows, [*keys, "bucket"], order).select(*batch.columns, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/v={version:08d}")


def current(spark: SparkSession, table: str, before: int = 1 << 40) -> dict[int, int]:
    """The newest version of each bucket below a version; one listing."""
    whole = {int(n.split("=")[1]) for n in folders(spark, table, "v")}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{table}/v=*/bucket=*")
    out: dict[int, int] = {}
    for s in p.getFileSystem(conf).globStatus(p) or []:
        v, b = int(s.getPath().getParent().getName().split("=")[1]), int(s.getPath().getName().split("=")[1])
        if v in whole and v < before:
            out[b] = max(v, out.get(b, -1))
    return out


def upsert_stream(spark: SparkSession, source: str, schema: str, keys: Sequence[str], order: Sequence[str], table: str, checkpoint: str) -> None:
    """Upsert every micro-batch of a folder of JSON Lines files."""
    rows = spark.readStream.schema(schema_of(schema)).json(source).where(F.col(keys[0]).isNotNull())
    q = rows.writeStream.foreachBatch(lambda df, i: upsert(df, table, keys, order, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def newest(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The newest state of an upserted table; empty if nothing has been written."""
    now = current(spark, table)
    s = schema_of(schema)
    if not now:
        return spark.createDataFrame([], s)
    return spark.read.schema(s).parquet(*[f"{table}/v={v:08d}/bucket={b}" for b, v in sorted(now.items())])
