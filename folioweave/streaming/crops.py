"""Crops as they arrive: a file stream through classification and extraction into growing tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.crops import crop_key


def crop_stream(spark: SparkSession, folder: str, files_per_batch: int = 500) -> DataFrame:
    """page, entry_index, name, png of crop files as they appear in a folder; other names are left out."""
    spark_schema = "path string, modificationTime timestamp, length long, content binary"
    found = spark.readStream.format("binaryFile").schema(spark_schema).option("pathGlobFilter", "*.png").option("maxFilesPerTrigger", files_per_batch).load(folder)
    keyed = found.select(*crop_key(F.col("path"), strict=False), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("content").alias("png"))
    return keyed.where("page is not null")


def grow_table(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends work(rows) to a Parquet table batch by batch.

    A batch is written under its own number, so one that is run again after a failure replaces
    itself and leaves no rows twice.
    """
    def write(rows: DataFrame, number: int) -> None:
        work(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
