"""What a reader needs to follow a decision: pictures of a crop's steps, its decision as JSON, and a page's grid drawn in."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions import png
from . import images as I, watermark as W


def drawn(image: np.ndarray, boxes: list[tuple[int, int, int, int]], width: int = 3) -> np.ndarray:
    """The image in colour with green frames; what lies outside is cut off."""
    out = np.repeat(image[..., None], 3, axis=2) if image.ndim == 2 else image.copy()
    h, w = out.shape[:2]
    for x, y, bw, bh in boxes:
        l, t, r, b = max(0, x), max(0, y), min(w, x + bw), min(h, y + bh)
        for part in (np.s_[t : t + width, l:r], np.s_[max(t, b - width) : b, l:r], np.s_[t:b, l : l + width], np.s_[t:b, max(l, r - width) : r]):
            out[part] = (0, 255, 0)
    return out


def grid_overlays(pages: DataFrame, image: str = "png") -> DataFrame:
    """path (page_0001_entries.png), data: pages with their entries drawn in; page, image and entries are needed."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, data, entries in zip(*(batch.column(i).to_pylist() for i in range(3))):
                boxes = [(e["x"], e["y"], e["width"], e["height"]) for e in entries or []]
                try:
                    out = png.encode(drawn(png.decode(data or b""), boxes))
                except ValueError:  # a page that cannot be read has no overlay
                    out = None
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([out], pa.binary())], ["path", "data"])

    name = F.format_string("page_%04d_entries.png", "page")
    return pages.select(name.alias("path"), F.col(image).alias("data"), "entries").mapInArrow(run, "path string, data binary")


def _pictures(data: bytes, angle: int | None, band: dict | None) -> dict[str, bytes]:
    gray = I.gray(png.decode(data))
    h, w = gray.shape
    left, top, right, low = W.SERIAL_BOX
    plain = W.masked(gray)
    turned = I.rotated(plain, angle or 0)
    letter, joined = I.watermark_masks(turned)
    seen = {"original": gray, "serial": gray[int(h * top) : int(h * low), int(w * left) : int(w * right)], "masked": plain, "turned": turned, "letters": letter * np.uint8(255), "bands": joined * np.uint8(255)}
    if band:
        seen["found"] = drawn(turned, [(band["x"], band["y"], band["width"], band["height"])], 2)
        seen["band"] = turned[band["y"] : band["y"] + band["height"], band["x"] : band["x"] + band["width"]]
    return {f"{n}.png": png.encode(a) for n, a in seen.items() if a.size}


def decision_files(done: DataFrame) -> DataFrame:
    """path (<crop>/<picture>.png or <crop>/decision.json), data: files for every crop that ``classified`` could read."""
    told = F.to_json(F.struct("deleted", "confidence", "rule", "ocr_confidence", "serial", "geometry", "watermark"), {"ignoreNullFields": "false"})
    held = done.where("status = 'ok'").select(F.regexp_replace("name", r"\.png$", "").alias("crop"), "png", F.col("geometry.angle").alias("angle"), F.col("geometry.band").alias("band"), told.alias("told"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for crop, data, angle, band, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                files = _pictures(data, angle, band) | {"decision.json": text.encode()}
                yield pa.RecordBatch.from_arrays([pa.array([f"{crop}/{n}" for n in files]), pa.array(list(files.values()), pa.binary())], ["path", "data"])

    return held.mapInArrow(run, "path string, data binary")
