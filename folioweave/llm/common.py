"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only a local master (one JVM, as in tests) may go without: it gets a temporary folder. Any
    other raises, since executors would write to disks of their own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    kept = sc._jsc.sc().getCheckpointDir()
    if kept.isDefined():
        return kept.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="folioweave-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Spark deletes the shuffle files of a plan when the plan has run.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back, which cuts the lineage.

    The plan's shuffle files go as soon as it is written. The folder goes with discard(), or when
    the driver's JVM ends. A lost executor costs no more than the tasks it was running: the
    written files live in the shared store.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioweave-{uuid.uuid4().hex}"
    schema = df.schema
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(schema).parquet(path)
    out._folioweave_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a DataFrame that materialize() returned and that nothing reads any more."""
    spark, where = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folioweave_path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def input_bytes(df: DataFrame, default: int = 256 << 20) -> int:
    """Size of the files below df as Spark's statistics have it; no job runs.

    It sets numbers of partitions only, so a wrong guess costs speed and never rows.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        size = int(leaves.apply(i).stats().sizeInBytes())
        total += size if size < 1 << 60 else default
    return total or default


def parts(df: DataFrame, mb_each: float, least: int = 8, most: int = 200_000) -> int:
    """Number of partitions so that each stands for about mb_each MB of input files."""
    return int(max(least, min(most, input_bytes(df) / (mb_each * 1e6))))


def split_of(doc_id: str = "doc_id"):
    """Column: crc32 of doc_id as text, modulo 5; 0 is the held-out fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def row_batches(batches, target_bytes: int, text: str = "text"):
    """Cut Arrow record batches so that none holds much more than target_bytes of text."""
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        size = sum(b.size for b in col.buffers() if b is not None) or 1
        step = max(1, int(batch.num_rows * target_bytes / max(size, 1)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)
