"""Tables that a job writes for itself into the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def new_folder(spark: SparkSession) -> str:
    """A name of its own below spark.checkpoint.dir; only a local master may go without that setting."""
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        kept = sc._jsc.sc().getCheckpointDir()
        if not kept.isDefined():
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="folioweave-"))
            kept = sc._jsc.sc().getCheckpointDir()
        top = kept.get()
    return f"{top.rstrip('/')}/folioweave-{uuid.uuid4().hex}"


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table at path was written to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def once(df: DataFrame, path: str) -> DataFrame:
    """df as a Parquet table at path; one that is there already is read as it is."""
    if not written(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(df: DataFrame, path: str, name: str) -> DataFrame:
    """df, written, with numbers that no later reading changes."""
    return once(df.withColumn(name, F.monotonically_increasing_id()), path)
