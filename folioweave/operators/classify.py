"""From page images to crops, and from crops to deleted or normal, as one DataFrame plan."""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from ..functions import png
from ..functions.text import stamp
from . import decide as D, engines, geometry as G, images as I, regions, watermark as W


class TimedOut(Exception):
    """A crop took longer than its limit."""


@contextmanager
def time_limit(seconds: float):
    """Raises TimedOut in the block after so many seconds; no limit if not above 0 or off the main thread."""
    if seconds <= 0 or not hasattr(signal, "setitimer") or threading.current_thread() is not threading.main_thread():
        yield
        return

    def ring(*_):
        raise TimedOut(f"no result within {seconds} s")

    before = signal.signal(signal.SIGALRM, ring)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def _schema(df: DataFrame, *drop: str) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name not in drop)


def grids(clean: DataFrame, image: str = "clean") -> DataFrame:
    """Adds entries: a page's cells in reading order (clean_pages' columns are needed).

    The raster gives boxes; which of them are cells, duplicates or outliers, and their order, are Columns.
    Write the table before filtering on entries: a pushed-down filter would inline all steps.
    """

    def run(batches):
        import pyarrow as pa

        box = pa.list_(pa.struct([(n, pa.int32()) for n in ("x", "y", "width", "height")]))
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column(batch.schema.get_field_index(image))[k].as_py()
                found = [] if data is None else [dict(zip(("x", "y", "width", "height"), map(int, b))) for b in I.cells(I.grid_mask(png.decode(data)))]
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, pa.array([found], box)], [*batch.schema.names, "boxes_"])

    found = clean.mapInArrow(run, f"{_schema(clean)}boxes_ array<struct<x:int,y:int,width:int,height:int>>")
    steps = (
        lambda r: F.filter(r, lambda x: G.is_cell(x, F.col("width"), F.col("height"))),
        G.by_place,
        G.without_similar,
        G.without_overlaps,
        G.without_outliers,
        G.in_rows,
    )
    for step in steps:  # a column of its own each, as a step reads its input more than once
        found = found.withColumn("boxes_", step(F.col("boxes_")))
    return found.withColumnRenamed("boxes_", "entries")


def crops(pages: DataFrame, image: str = "png", least_width: int = 40, least_height: int = 40) -> DataFrame:
    """page, entry_index (from 1; dropped boxes leave gaps), name, png: the cells cut out of the raw pages."""
    box = F.transform("entries", lambda r, i: F.struct((i + 1).cast("int").alias("entry_index"), G.clamped(r, F.col("width"), F.col("height"), least_width, least_height).alias("r")))
    held = pages.select("page", F.col(image).alias("png"), F.filter(box, lambda b: b["r"].isNotNull()).alias("cut_"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for page, data, cut in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not cut:
                    continue
                picture = png.decode(data)
                for c in cut:
                    r = c["r"]
                    part = picture[r["y"] : r["y"] + r["height"], r["x"] : r["x"] + r["width"]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((page, pa.int32()), (c["entry_index"], pa.int32()), (png.encode(part), pa.binary()))], ["page", "entry_index", "png"])

    out = held.select(F.col("page").cast("int"), "png", "cut_").mapInArrow(run, "page int, entry_index int, png binary")
    return out.select("page", "entry_index", F.format_string("page_%03d_entry_%03d.png", "page", "entry_index").alias("name"), "png")


def _texts(answer) -> list[str]:
    """The texts of an engine's nested answer."""
    found = [str(line[1][0]) for page in answer or [] for line in page or [] if isinstance(line, list | tuple) and len(line) > 1 and isinstance(line[1], list | tuple) and len(line[1]) > 1]
    return [t for t in (" ".join(x.split()) for x in found) if t]  # white space collapsed, blank lines dropped


def _measured(engine: Callable, seconds: float):
    def run(batches):
        import pyarrow as pa

        kinds = {"width": pa.int32(), "height": pa.int32(), "box": pa.list_(pa.string()), "left": pa.list_(pa.string()), "right": pa.list_(pa.string()), "visual_q": pa.bool_()}
        kinds["found"] = pa.list_(pa.struct([(n, pa.float64() if n == "mean" else pa.int32()) for n in ("angle", "x", "y", "width", "height", "letters", "mean")]))
        kinds |= {"status": pa.string(), "error": pa.string()}
        read, broken = None, None
        try:
            read = engine()
        except engines.EngineFailed as e:  # every crop of this worker reports it
            broken = str(e)

        def safe(part) -> list[str]:
            try:
                return _texts(read(png.encode(I.for_reading(part)))) if part.size else []
            except TimedOut:
                raise
            except Exception:  # noqa: BLE001 - what cannot be read has no text
                return []

        for batch in batches:
            rows = []
            for data in batch.column(batch.schema.get_field_index("png")).to_pylist():
                row = dict.fromkeys(kinds)
                if broken:
                    rows.append(row | {"status": "failed", "error": broken})
                    continue
                try:
                    with time_limit(seconds):
                        g = I.gray(png.decode(data or b""))
                        h, w = g.shape
                        left, top, right, low = W.SERIAL_BOX
                        box = g[int(h * top) : int(h * low), int(w * left) : int(w * right)]
                        row |= {"width": w, "height": h, "box": safe(box), "left": safe(box[:, : int(box.shape[1] * 0.34)]), "right": safe(box[:, int(box.shape[1] * 0.55) :])}
                        row |= {"visual_q": bool(box.size and I.visual_q(box)), "found": W.candidates(g), "status": "ok"}
                except TimedOut as e:
                    row = dict.fromkeys(kinds) | {"status": "timed_out", "error": str(e)}
                except Exception as e:  # noqa: BLE001 - one crop must not end the task
                    row = dict.fromkeys(kinds) | {"status": "failed", "error": f"{type(e).__name__}: {e}"}
                rows.append(row)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[n] for r in rows], t) for n, t in kinds.items())], [*batch.schema.names, *(f"m_{n}" for n in kinds)])

    return run


def _band_texts(engine: Callable):
    def run(batches):
        import pyarrow as pa

        read = None
        for batch in batches:
            out = []
            for data, g in zip(batch.column(batch.schema.get_field_index("png")).to_pylist(), batch.column(batch.schema.get_field_index("geometry")).to_pylist()):
                texts: list[str] = []
                if g is not None:
                    try:
                        read = read or engine()
                        turned, b = I.rotated(W.masked(I.gray(png.decode(data))), g["angle"]), g["band"]
                        texts = _texts(read(png.encode(I.for_reading(turned[b["y"] : b["y"] + b["height"], b["x"] : b["x"] + b["width"]]))))
                    except Exception:  # noqa: BLE001 - what cannot be read has no text
                        texts = []
                out.append(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.string()))], [*batch.schema.names, "band_texts"])

    return run


def classified(crops_: DataFrame, engine: Callable, seconds: float = 20.0) -> DataFrame:
    """Adds status (ok, timed_out, failed), error, deleted, confidence, rule, ocr_confidence and the structs of all stages.

    The stage structs (serial, geometry, watermark) are what a reader needs to follow a decision.
    ``engine`` maps an image's bytes to nested text lines; it is made once in each worker and sees grey
    parts without noise. Where it does not start, crops have the status failed.
    """
    engine = engines.per_worker(engine)
    texts = "array<string>"
    seen = crops_.mapInArrow(_measured(engine, seconds), f"{_schema(crops_)}m_width int, m_height int, m_box {texts}, m_left {texts}, m_right {texts}, m_visual_q boolean, m_found array<{W.CANDIDATE}>, m_status string, m_error string")
    best = W.geometry(F.col("m_found"), F.col("m_width"), F.col("m_height"))
    seen = seen.withColumn("g_", best)
    banded = F.when(F.col("g_").isNotNull(), F.struct("g_.*", regions.band(F.col("g_.box"), F.col("m_width"), F.col("m_height")).alias("band")))
    seen = seen.withColumn("geometry", banded).withColumn("serial", F.when(F.col("m_status") == "ok", D.serial_stage(F.col("m_box"), F.col("m_left"), F.col("m_right"), F.col("m_visual_q"))))
    seen = seen.drop("g_", "m_found", "m_visual_q", "m_box", "m_left", "m_right", "m_width", "m_height")
    read = seen.mapInArrow(_band_texts(engine), f"{_schema(seen)}band_texts {texts}")
    lines = F.transform("band_texts", stamp)
    words = F.flatten(F.transform(lines, lambda t: F.regexp_extract_all(t, F.lit("[A-Z]+"), 0)))
    read = read.withColumn("tokens_", F.filter(F.array_distinct(F.concat(lines, words)), lambda t: t != "")).withColumn("ratio_", D.similarity(F.col("tokens_")))
    level = F.when(F.col("geometry").isNull(), "none").otherwise(D.watermark_level(F.array_contains("tokens_", "DELETED"), F.col("ratio_")))
    score = F.when(F.col("w_") == "strong", 0.95).when(F.col("w_") == "medium", 0.7).otherwise(0.0)
    read = read.withColumn("w_", level).withColumn("watermark", F.struct(F.col("w_").alias("level"), score.alias("score"), F.round("ratio_", 4).alias("ratio"), F.col("tokens_").alias("tokens")))
    decided = F.when(F.col("m_status") == "ok", D.decision(F.col("serial.level"), F.coalesce("geometry.level", F.lit("none")), F.col("w_")))
    ocr = F.round(F.greatest("serial.score", "watermark.score"), 4)
    out = read.withColumn("d_", decided).select("*", F.col("m_status").alias("status"), F.col("m_error").alias("error"), "d_.deleted", F.round("d_.confidence", 4).alias("confidence"), "d_.rule", F.when(F.col("m_status") == "ok", ocr).alias("ocr_confidence"))
    return out.drop("m_status", "m_error", "band_texts", "tokens_", "ratio_", "w_", "d_")
