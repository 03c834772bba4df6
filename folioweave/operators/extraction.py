"""Records of crops by a chosen way: a model, recognised text, or the model first and the text where it fails."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from . import models
from .records import records

log = logging.getLogger("folioweave")
BACKENDS = ("auto", "ocr", "llm")


def chosen_backend(name: str, client: Callable | None, model: str | None) -> str:
    """The way that is taken: auto without a model is ocr, llm without one is an error, as is an unknown name."""
    plain = name.strip().lower()
    if plain not in BACKENDS:
        raise ValueError(f"unknown extraction backend: {name}")
    if plain == "ocr" or (client and model):
        return plain
    if plain == "llm":
        raise RuntimeError("the llm backend needs a client and a model")
    log.warning("no model is set; records come from recognised text")
    return "ocr"


def extracted(crops: DataFrame, backend: str = "auto", client: Callable | None = None, model: str | None = None, fallback: str | None = None, lines: str = "lines", read: Callable[[DataFrame], DataFrame] | None = None, **how) -> DataFrame:
    """crops (png, lines as cards have them, other columns) with a record's fields, raw_text, model and error.

    With ``read`` (which adds lines to crops) there is no such column: text is recognised for those crops
    alone whose lines are parsed.

    The model is asked once for each row. A row on which it fails keeps the error (llm) or is parsed
    from its lines (auto, where model is then null). A payload without raw text gets its lines as
    {"ocr_text": [...]}. Rows that the model settles are parsed as if they had no lines, which costs nothing.
    """
    way = chosen_backend(backend, client, model)
    none = F.lit(None).cast("string")
    if way == "ocr":
        return records(read(crops) if read else crops, lines).withColumns({"model": none, "error": none})
    asked = models.extracted(crops, client, model, fallback, **how)
    if read:
        return asked if way == "llm" else _read_where_failed(asked, read, lines)
    told = F.to_json(F.struct(F.transform(F.col(lines), lambda l: l["text"]).alias("ocr_text")))
    asked = asked.withColumn("raw_text", F.when(F.col("error").isNull(), F.coalesce("raw_text", told)))
    if way == "llm":
        return asked
    fields = (*models.FIELDS, "raw_text")
    kept = [c for c in asked.columns if c not in fields]
    own = asked.select(*kept, F.struct(*fields).alias("model_"), F.when(F.col("error").isNotNull(), F.col(lines)).otherwise(F.slice(F.col(lines), 1, 0)).alias("lines_left_"))
    read = records(own, "lines_left_")
    failed = F.col("error").isNotNull()
    picked = [F.when(failed, F.col(n)).otherwise(F.col(f"model_.{n}")).alias(n) for n in fields]
    out = read.select(*[F.when(failed, none).otherwise(F.col("model")).alias("model") if c == "model" else F.col(f"`{c}`") for c in kept], *picked)
    return out.withColumn("error", none)


def _read_where_failed(asked: DataFrame, read: Callable[[DataFrame], DataFrame], lines: str) -> DataFrame:
    """The model's records, and records of recognised lines of the crops on which it failed."""
    own = asked.where("error is not null").drop(*models.FIELDS, "raw_text", "model", "error")
    none = F.lit(None).cast("string")
    parsed = records(read(own), lines).withColumns({"model": none, "error": none}).drop(lines)
    return asked.where("error is null").unionByName(parsed.select(*asked.columns))
