"""A page made ready for grid detection: deskew and the chain of raster steps, alone and over a table of pages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import png
from . import images as I

STEPS = ("deskew", "denoise", "contrast", "threshold", "border_cleanup")


@dataclass(frozen=True)
class Options:
    """Steps to take, and their parameters."""

    steps: tuple[str, ...] = STEPS
    kernel: int = 3
    clip: float = 2.0
    tiles: int = 8
    block: int = 31
    c: float = 15
    margin: int = 12


def _hull(p: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points sorted by x, then y."""
    def half(points):
        out: list = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    points = p.tolist()
    return np.array(half(points) + half(points[::-1]) or points, np.float64)


def skew(ink: np.ndarray) -> float:
    """Degrees, from -45 to under 45, by which the least rectangle around the ink is turned; 0 without ink."""
    rows = np.flatnonzero(ink.any(axis=1))
    if not len(rows):
        return 0.0
    left, right = ink[rows].argmax(axis=1), ink.shape[1] - 1 - ink[rows][:, ::-1].argmax(axis=1)
    p = np.unique(np.concatenate([np.c_[left, rows], np.c_[right, rows]]), axis=0)
    hull = _hull(p)
    edges = np.roll(hull, -1, axis=0) - hull
    turn = np.unique((np.rad2deg(np.arctan2(edges[:, 1], edges[:, 0])) + 45) % 90 - 45)
    t = np.deg2rad(turn)[:, None]
    u, v = hull[:, 0] * np.cos(t) + hull[:, 1] * np.sin(t), hull[:, 1] * np.cos(t) - hull[:, 0] * np.sin(t)
    area = np.ptp(u, axis=1) * np.ptp(v, axis=1)
    close = turn[area <= area.min() + 1e-9]
    return float(close[np.abs(close).argmin()])


def deskewed(image: np.ndarray) -> np.ndarray:
    """A grey page turned upright; a turn below a tenth of a degree is left."""
    inverted = 255 - image
    angle = skew(inverted > I.otsu(inverted))
    return image if abs(angle) < 0.1 else I.rotated(image, angle)


def prepared(image: np.ndarray, options: Options = Options()) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The page after all chosen steps, and the picture after each, from ``original`` on."""
    seen = {"original": image}
    out = I.gray(image)
    work = {
        "deskew": deskewed,
        "denoise": lambda a: I.median_blur(a, options.kernel),
        "contrast": lambda a: I.equalized(a, options.clip, options.tiles),
        "threshold": lambda a: I.adaptive_threshold(a, options.block + (options.block % 2 == 0), options.c),
        "border_cleanup": lambda a: I.cleaned_border(a, max(0, options.margin)),
    }
    for step in STEPS:
        if step in options.steps:
            out = work[step](out)
        seen[step] = out
    return out, seen


def clean_pages(pages: DataFrame, options: Options = Options(), image: str = "png", debug: bool = False) -> DataFrame:
    """Adds clean (PNG), width, height, steps (map of PNG after each step; empty unless debug) and clean_error.

    An image that cannot be read gives nulls and its error; other pages go on.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):  # a page may be 100 MB as an array
                data, row = batch.column(batch.schema.get_field_index(image))[k].as_py(), (None, None, None, [], None)
                try:
                    out, seen = prepared(png.decode(data or b""), options)
                    row = (png.encode(out), out.shape[1], out.shape[0], [(n, png.encode(a)) for n, a in seen.items()] if debug else [], None)
                except Exception as e:  # noqa: BLE001 - the row reports it
                    row = (*row[:4], f"{type(e).__name__}: {e}")
                kinds = (pa.binary(), pa.int32(), pa.int32(), pa.map_(pa.string(), pa.binary()), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, *(pa.array([v], t) for v, t in zip(row, kinds))], [*batch.schema.names, "clean", "width", "height", "steps", "clean_error"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.mapInArrow(run, f"{kept}, clean binary, width int, height int, steps map<string,binary>, clean_error string")


def clean_files(spark: SparkSession, folder: str, out: str, options: Options = Options(), debug: str | None = None) -> DataFrame:
    """PNG files of a folder made ready, each as <stem>_clean.png below ``out``; under ``debug``, the picture after each step as <stem>/<step>.png below that folder.

    Returns name, clean_name, width, height, debug_names (of the order of steps; empty without ``debug``) and
    clean_error of each file. Pages are worked out once, into a table of the job's own; a file that cannot be
    read writes nothing and has an error. Files that end in _clean.png are passed over.
    """
    from .. import scratch
    from ..sinks.files import write_files

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][nN][gG]").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    pages = found.select(name.alias("name"), F.col("content").alias("png")).where(~F.col("name").endswith("_clean.png"))
    pages = pages.withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", ""))
    done = scratch.once(clean_pages(pages, options, debug=debug is not None).drop("png"), scratch.new_folder(spark))
    target = F.when(F.col("clean_error").isNull(), F.concat("stem", F.lit("_clean.png")))
    write_files(done.select(target.alias("path"), F.col("clean").alias("data")), out)
    if debug is not None:
        steps = done.select("stem", F.explode("steps").alias("step", "data"))
        write_files(steps.select(F.concat("stem", F.lit("/"), "step", F.lit(".png")).alias("path"), "data"), debug)
    names = F.transform(F.coalesce(F.map_keys("steps"), F.array().cast("array<string>")), lambda s: F.concat("stem", F.lit("/"), s, F.lit(".png")))
    return done.select("name", target.alias("clean_name"), "width", "height", names.alias("debug_names"), "clean_error")
