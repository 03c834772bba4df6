"""Text recognition: an injected engine, and its nested answers as typed lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import png
from . import engines, images


def _items(json: Column) -> Column:
    """A JSON list's items as JSON texts (strings bare); null if it is no list."""
    return F.when(F.startswith(F.ltrim(json), F.lit("[")), F.from_json(json, "array<string>"))


def points(json: Column) -> Column:
    """array<struct<x, y>>; what is no list of two or more numbers is left out."""
    pairs = F.transform(F.coalesce(_items(json), F.array().cast("array<string>")), lambda p: F.from_json(p, "array<double>"))
    return F.transform(F.filter(pairs, lambda p: F.size(p) >= 2), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def lines(raw: Column, language: str) -> Column:
    """array<struct<text, confidence, language, bounding_box>> of an answer's JSON: pages of [box, [text, confidence]].

    Pages are joined; empty answers and pages give nothing, and malformed lines are left out.
    """
    none = F.array().cast("array<string>")
    pages = F.coalesce(_items(raw), none)
    split = F.transform(F.flatten(F.transform(pages, lambda p: F.coalesce(_items(p), none))), lambda l: F.coalesce(_items(l), none))
    parts = F.transform(F.filter(split, lambda l: F.size(l) >= 2), lambda l: F.struct(l[0].alias("box"), F.coalesce(_items(l[1]), none).alias("content")))
    good = F.filter(parts, lambda l: F.size(l["content"]) >= 2)
    return F.transform(good, lambda l: F.struct(l["content"][0].alias("text"), l["content"][1].cast("double").alias("confidence"), F.lit(language).alias("language"), points(l["box"]).alias("bounding_box")))


def recognized(crops: DataFrame, engine: Callable[[], Callable[[bytes], object]], language: str = "hi", image: str = "png", prepare: bool = True) -> DataFrame:
    """Adds ocr (lines) and ocr_error to crops.

    ``engine`` makes a function from an image's bytes to a nested answer; it is called once in each
    worker, and an error of it, or of one image, becomes that row's ocr_error. With ``prepare`` the
    engine sees a grey copy without noise (few-levelled images as they are); what is no PNG goes to it untouched.
    """

    make = engines.per_worker(engine)

    def run(batches):
        import json

        import pyarrow as pa

        read, broken = None, None
        try:
            read = make()
        except engines.EngineFailed as e:  # every row reports it
            broken = str(e)

        def seen(data: bytes) -> bytes:
            return png.encode(images.for_reading(png.decode(data))) if prepare and data.startswith(b"\x89PNG") else data

        for batch in batches:
            answers, errors = [], []
            for data in batch.column(batch.schema.get_field_index(image)).to_pylist():
                answer, error = None, broken
                if read is not None and data is not None:
                    try:
                        answer = json.dumps(read(seen(data)) or [], ensure_ascii=False, default=float)
                    except Exception as e:  # noqa: BLE001 - one image must not end the task
                        error = f"{type(e).__name__}: {e}"
                answers.append(answer)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string()), pa.array(errors, pa.string())], [*batch.schema.names, "raw_", "ocr_error"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema)
    return crops.mapInArrow(run, f"{kept}, raw_ string, ocr_error string").withColumn("ocr", lines(F.col("raw_"), language)).drop("raw_")
