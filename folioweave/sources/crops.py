"""Crops on disk: binary scans of the class folders and the key in a crop's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_KEY = r"(?i)page_(\d+)_entry_(\d+)\.png$"


def crop_key(path: Column, strict: bool = True) -> list[Column]:
    """page and entry_index out of a crop's path; a path without them raises, or gives nulls if not strict."""
    bad = F.raise_error(F.concat(F.lit("not a crop's name: "), path)).cast("int") if strict else F.lit(None).cast("int")
    part = lambda i: F.when(path.rlike(_KEY), F.regexp_extract(path, _KEY, i).cast("int")).otherwise(bad)
    return [part(1).alias("page"), part(2).alias("entry_index")]


def scan_crops(spark: SparkSession, normal_dir: str, deleted_dir: str, document: str, strict: bool = True) -> DataFrame:
    """image_path, png, deleted, page, entry_index of a document's crops in both class folders, in order.

    A folder that is not there counts as empty.
    """
    out = None
    for folder, deleted in ((normal_dir, False), (deleted_dir, True)):
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{document}")
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            continue
        one = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(f"{folder}/{document}").select(F.col("path").alias("image_path"), F.col("content").alias("png"), F.lit(deleted).alias("deleted"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], "image_path string, png binary, deleted boolean")
    keyed = out.select("*", *crop_key(F.col("image_path"), strict))
    return keyed.orderBy("page", "entry_index", F.lower(F.element_at(F.split("image_path", "/"), -1)))
