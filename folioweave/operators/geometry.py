"""Rectangles of a page as arrays of struct<x,y,width,height>, and folds over them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RECT = "struct<x:int,y:int,width:int,height:int>"
RECTS = f"array<{RECT}>"


def is_cell(r: Column, width: Column, height: Column, w=(0.15, 0.4), h=(0.05, 0.2), aspect=(1.2, 4.5)) -> Column:
    """Cell-sized, inside the page, and of a cell's shape."""
    part = lambda size, ratio: (size * F.lit(ratio)).cast("int")
    shape = r["width"] / F.greatest(r["height"], F.lit(1))
    return (
        r["width"].between(part(width, w[0]), part(width, w[1])) & r["height"].between(part(height, h[0]), part(height, h[1]))
        & (r["x"] > 0) & (r["y"] > 0) & (r["x"] + r["width"] < width) & (r["y"] + r["height"] < height) & shape.between(*aspect)
    )


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union; 0 if the rectangles do not meet in an area."""
    side = lambda at, size: F.least(a[at] + a[size], b[at] + b[size]) - F.greatest(a[at], b[at])
    w, h = side("x", "width"), side("y", "height")
    inter = w * h
    union = a["width"] * a["height"] + b["width"] * b["height"] - inter
    return F.when((w <= 0) | (h <= 0) | (union <= 0), F.lit(0.0)).otherwise(inter / union)


def without_similar(rects: Column, move: int = 4, size: int = 6) -> Column:
    """Drop a rectangle if one kept before it is nearly the same."""
    near = lambda a, b: (F.abs(a["x"] - b["x"]) <= move) & (F.abs(a["y"] - b["y"]) <= move) & (F.abs(a["width"] - b["width"]) <= size) & (F.abs(a["height"] - b["height"]) <= size)
    return F.aggregate(rects, F.lit([]).cast(RECTS), lambda kept, r: F.when(F.exists(kept, lambda k: near(k, r)), kept).otherwise(F.array_append(kept, r)))


def by_place(rects: Column) -> Column:
    """Sorted by y, x and, largest first, area."""
    key = lambda r: F.struct(r["y"].alias("y"), r["x"].alias("x"), (-r["width"] * r["height"]).alias("area"), r.alias("r"))
    return F.transform(F.array_sort(F.transform(rects, key)), lambda k: k["r"])


def without_overlaps(rects: Column, least: float = 0.9) -> Column:
    """In order of place, a rectangle replaces the first kept one that it nearly covers if it is larger."""
    area = lambda r: r["width"] * r["height"]

    def step(kept, r):
        hit = F.array_position(F.transform(kept, lambda k: overlap(k, r) >= least), True).cast("int")
        return F.when(hit == 0, F.array_append(kept, r)).otherwise(F.transform(kept, lambda k, i: F.when((i == hit - 1) & (area(r) > area(k)), r).otherwise(k)))

    return F.aggregate(by_place(rects), F.lit([]).cast(RECTS), step)


def _median(values: Column) -> Column:
    s, n = F.array_sort(values), F.size(values)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2.0


def without_outliers(rects: Column, low: float = 0.55, high: float = 1.65, least: int = 4) -> Column:
    """Rectangles of about the median size; all of them if there are few or none would stay."""
    w, h = _median(F.transform(rects, lambda r: r["width"])), _median(F.transform(rects, lambda r: r["height"]))
    kept = F.filter(rects, lambda r: r["width"].between(w * low, w * high) & r["height"].between(h * low, h * high))
    return F.when((F.size(rects) < least) | (F.size(kept) == 0), rects).otherwise(kept)


def in_rows(rects: Column) -> Column:
    """Row by row: a row takes what lies near the y of its first rectangle, and is sorted by x."""
    near = F.greatest(F.lit(10), F.floor(F.floor(_median(F.transform(rects, lambda r: r["height"]))) / 2).cast("int"))
    start = F.struct(F.lit([]).cast(f"array<struct<row:int,x:int,y:int,r:{RECT}>>").alias("out"), F.lit(0).alias("row"), F.lit(None).cast("int").alias("y"))

    def step(acc, r):
        new = acc["y"].isNull() | (F.abs(r["y"] - acc["y"]) > near)
        row = F.when(new, acc["row"] + 1).otherwise(acc["row"])
        return F.struct(F.array_append(acc["out"], F.struct(row.alias("row"), r["x"].alias("x"), r["y"].alias("y"), r.alias("r"))).alias("out"), row.alias("row"), F.when(new, r["y"]).otherwise(acc["y"]).alias("y"))

    return F.transform(F.array_sort(F.aggregate(by_place(rects), start, step)["out"]), lambda k: k["r"])


def clamped(r: Column, width: Column, height: Column, least_width: int = 40, least_height: int = 40) -> Column:
    """A box cut to its page; null if it starts outside or is too narrow or too low."""
    x, y = F.greatest(r["x"], F.lit(0)), F.greatest(r["y"], F.lit(0))
    w, h = F.least(r["width"], width - x), F.least(r["height"], height - y)
    return F.when((x < width) & (y < height) & (w >= least_width) & (h >= least_height), F.struct(x.alias("x"), y.alias("y"), w.alias("width"), h.alias("height")))
