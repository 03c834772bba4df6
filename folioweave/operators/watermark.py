"""Diagonal watermarks of a crop: what pixels show is measured in NumPy, what follows is decided in Columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from . import images as I
from .decide import geometry_level
from .regions import best_of, crosses_centre, turned_back

# The serial and the photo box as shares of a crop, and the turns tried, in order.
SERIAL_BOX = (0.015, 0.02, 0.34, 0.18)
PHOTO_BOX = (0.74, 0.17, 0.97, 0.93)
ANGLES = (-45, -40, -35, -30, -25, 25, 30, 35, 40, 45)

CANDIDATE = "struct<angle:int,x:int,y:int,width:int,height:int,letters:int,mean:double>"


def masked(gray: np.ndarray) -> np.ndarray:
    """The crop with its margin, its serial box and its photo box white."""
    h, w = gray.shape
    out, m = np.full_like(gray, 255), max(8, min(h, w) // 40)
    out[m : h - m, m : w - m] = gray[m : h - m, m : w - m]
    for left, top, right, bottom in (SERIAL_BOX, PHOTO_BOX):
        out[int(h * top) : int(h * bottom), int(w * left) : int(w * right)] = 255
    return out


def plausible(box: tuple[int, int, int, int], w: int, h: int) -> bool:
    """Neither at the edge nor too large, too narrow or too flat."""
    x, y, bw, bh = box
    edge = max(8, min(w, h) // 45)
    inside = edge < x and edge < y and x + bw < w - edge and y + bh < h - edge
    return inside and bw * bh / (w * h) < 0.14 and bw / w >= 0.1 and bh / h >= 0.02


def bands(boxes: list[tuple[int, int, int, int]], height: int) -> list[tuple[int, int, int, int]]:
    """Boxes, and the bounds of those on a level: each joins the first band whose mean centre is near.

    A band is kept as the sum of its boxes' centres and their number, so a box is held against all bands at once.
    """
    given = np.array(sorted(boxes, key=lambda b: (b[1], b[0])), np.int64).reshape(-1, 4)
    middles = given[:, 1] + given[:, 3] / 2
    sums, sizes, level = np.zeros(len(given)), np.zeros(len(given)), np.zeros(len(given), np.int64)
    used = 0
    for i, middle in enumerate(middles):
        near = np.flatnonzero(np.abs(sums[:used] / np.maximum(sizes[:used], 1) - middle) <= max(24, int(height * 0.08)))
        level[i] = near[0] if len(near) else used
        used = max(used, int(level[i]) + 1)
        sums[level[i]] += middle
        sizes[level[i]] += 1
    out: list[tuple[int, int, int, int]] = []
    for k in range(used):
        own = given[level == k]
        corner, far = own[:, :2].min(0), (own[:, :2] + own[:, 2:]).max(0)
        hull = np.r_[corner, far - corner][None]
        out += map(tuple, (own if len(own) == 1 else np.concatenate([own, hull])).tolist())
    return list(dict.fromkeys(out))


def banded(rects: Column, height: int) -> Column:
    """bands() of arrays of struct<x,y,width,height> (an Arrow-batched function)."""
    names = ("x", "y", "width", "height")

    @F.pandas_udf("array<struct<x:int,y:int,width:int,height:int>>")
    def grouped(batch: pd.Series) -> pd.Series:
        return batch.map(lambda rs: [dict(zip(names, b)) for b in bands([tuple(int(r[n]) for n in names) for r in rs], height)])

    return grouped(rects)


def letters(mask: np.ndarray, box: tuple[int, int, int, int]) -> int:
    """Connected parts of at least a five-hundredth of the box."""
    x, y, w, h = box
    part = mask[y : y + h, x : x + w]
    return sum(c[4] >= 0.002 * max(1, part.size) for c in I.components(part))


def candidates(gray: np.ndarray, angles: tuple[int, ...] = ANGLES) -> list[dict]:
    """Bands of every turn in order, with their letters and the mean grey of their watermark pixels."""
    plain, out = masked(gray), []
    h, w = plain.shape
    for angle in angles:
        turned = I.rotated(plain, angle)
        letter, band = I.watermark_masks(turned)
        boxes = [c[:4] for c in I.components(band) if plausible(c[:4], w, h)]
        for x, y, bw, bh in bands(boxes, h):
            pixels = turned[y : y + bh, x : x + bw][band[y : y + bh, x : x + bw]]
            out.append({"angle": angle, "x": x, "y": y, "width": bw, "height": bh, "letters": letters(letter, (x, y, bw, bh)), "mean": float(pixels.mean()) if pixels.size else 255.0})
    return out


def geometry(found: Column, width: Column, height: Column) -> Column:
    """struct<level, score, angle, box, letters, mean, polygon> of the best candidate; null if none counts.

    Candidates count if they cross the middle of the crop and are as grey as a watermark. The
    greatest score wins, the first of equal ones.
    """
    box = lambda c: F.struct(*(c[n].alias(n) for n in ("x", "y", "width", "height")))
    drawn = F.transform(found, lambda c: F.struct(c.alias("c"), turned_back(box(c), c["angle"], width, height).alias("polygon")))

    def levelled(d: Column) -> Column:
        c = d["c"]
        fits = c["mean"].between(105.0, 240.0) & crosses_centre(d["polygon"], width, height)
        return F.struct(F.when(fits, geometry_level(c["width"] / width, c["height"] / height, c["letters"])).otherwise("none").alias("level"), c.alias("c"), d["polygon"].alias("polygon"))

    def scored(d: Column) -> Column:
        c, score = d["c"], F.when(d["level"] == "strong", 0.8).when(d["level"] == "medium", 0.58).otherwise(0.0)
        return F.struct(d["level"].alias("level"), score.alias("score"), c["angle"].alias("angle"), box(c).alias("box"), c["letters"].alias("letters"), c["mean"].alias("mean"), d["polygon"].alias("polygon"))

    return best_of(F.transform(F.transform(drawn, levelled), scored))
