"""Regions of a crop: fixed boxes, padded bands, and boxes found in a turned image, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    """struct<x, y, width, height>; an empty region has no width or no height."""
    whole = lambda c: c.cast("int")
    return F.struct(whole(left).alias("x"), whole(top).alias("y"), whole(F.greatest(right - left, F.lit(0))).alias("width"), whole(F.greatest(bottom - top, F.lit(0))).alias("height"))


def region(width: Column, height: Column, relative: tuple[float, float, float, float]) -> Column:
    """A box given as shares of the image, in whole pixels inside it."""
    at = lambda size, share: F.least(size, F.greatest(F.lit(0), (size * F.lit(float(share))).cast("int")))
    return _box(at(width, relative[0]), at(height, relative[1]), at(width, relative[2]), at(height, relative[3]))


def band(box: Column, width: Column, height: Column) -> Column:
    """A watermark's box with its safety padding, inside the image."""
    across = F.greatest(F.lit(10), F.floor(box["width"] / 18))
    down = F.greatest(F.lit(8), F.floor(box["height"] / 3))
    return _box(F.greatest(F.lit(0), box["x"] - across), F.greatest(F.lit(0), box["y"] - down), F.least(width, box["x"] + box["width"] + across), F.least(height, box["y"] + box["height"] + down))


def turned_back(box: Column, angle: Column, width: Column, height: Column) -> Column:
    """array<struct<x, y>>: the corners of a box of the turned image, in the image before the turn."""
    t = F.radians(angle)
    cx, cy = width / 2, height / 2

    def corner(right: int, low: int) -> Column:
        dx, dy = box["x"] + right * box["width"] - cx, box["y"] + low * box["height"] - cy
        inside = lambda v, size: F.least(F.greatest(v, F.lit(0.0)), size - 1.0).cast("int")
        return F.struct(inside(dx * F.cos(t) - dy * F.sin(t) + cx, width).alias("x"), inside(dx * F.sin(t) + dy * F.cos(t) + cy, height).alias("y"))

    return F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))


def crosses_centre(polygon: Column, width: Column, height: Column) -> Column:
    """Whether the bounds of a polygon (both end pixels belong to them) overlap the middle of the image."""
    low = lambda size: (size * 0.35).cast("int")
    high = lambda size: (size * 0.65).cast("int")
    least = lambda n: F.array_min(F.transform(polygon, lambda p: p[n]))
    most = lambda n: F.array_max(F.transform(polygon, lambda p: p[n])) + 1
    overlap = lambda n, size: F.least(most(n), high(size)) > F.greatest(least(n), low(size))
    return F.coalesce(overlap("x", width) & overlap("y", height), F.lit(False))


def best_of(candidates: Column) -> Column:
    """The struct of the greatest score above 0; the first of equal ones; null if there is none."""
    top = F.array_max(F.transform(candidates, lambda c: c["score"]))
    return F.when(top > 0, F.get(F.filter(candidates, lambda c: c["score"] == top), F.lit(0)))
