"""JSON files of records: a list of objects, or one object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """row (from 0), json: each record of a file as its JSON text, in order. Anything but objects raises ValueError."""
    root = F.trim(F.regexp_replace("value", r"^\ufeff", ""), F.lit(" \t\r\n"))
    items = F.when(F.startswith(root, F.lit("[")), F.from_json(root, "array<string>")).when(F.startswith(root, F.lit("{")), F.array(root))
    whole = spark.read.text(path, wholetext=True).select(items.alias("items"))
    bad = F.col("items").isNull() | F.exists("items", lambda x: x.isNull() | ~F.startswith(F.ltrim(x), F.lit("{")))
    if whole.where(bad).limit(1).count():
        raise ValueError("records must be a list of objects or an object")
    return whole.select(F.posexplode("items").alias("row", "json"))
