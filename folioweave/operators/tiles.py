"""Large pages as tables of tiles: operators on a tile and its surroundings, and connected parts across tiles.

A page of tens of megapixels is many rows in place of one. A mask operator runs on a tile with a halo of
its neighbours' pixels as wide as the operator reaches, so each tile is shuffled once a chain of operators.
Connected parts are labelled inside tiles; labels that meet at a seam are edges of a graph, whose parts are
found by star contraction in Columns. Sums of the labels' boxes and areas give those of the whole page.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .. import scratch
from ..functions import png
from . import images as I

TILE = 1024
#: pixels: a tile's rows, one byte a pixel; width and height are the page's.
TILES = "page long, ty int, tx int, width int, height int, pixels binary"
_ROW_BITS = 31


def cuts(length: int, size: int) -> list[int]:
    """Where tiles begin and the last one ends; none is shorter than size but the only one."""
    n = max(1, length // size)
    return [length * i // n for i in range(n + 1)]


def _box(ty: int, tx: int, width: int, height: int, size: int) -> tuple[int, int, int, int]:
    ys, xs = cuts(height, size), cuts(width, size)
    return ys[ty], xs[tx], ys[ty + 1], xs[tx + 1]


def _row(page: int, ty: int, tx: int, width: int, height: int, a: np.ndarray) -> dict:
    return {"page": page, "ty": ty, "tx": tx, "width": width, "height": height, "pixels": np.ascontiguousarray(a, np.uint8).tobytes()}


def _batch(rows: list[dict], schema: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])


def tiled(pages: DataFrame, image: str = "png", size: int = TILE) -> DataFrame:
    """Tiles of grey pages (page, a PNG); a page that cannot be read has none."""

    def run(batches):
        for batch in batches:
            for page, data in zip(*(batch.column(i).to_pylist() for i in range(2))):
                try:
                    a = I.gray(png.decode(data or b""))
                except Exception:  # noqa: BLE001 - other pages go on
                    continue
                ys, xs = cuts(a.shape[0], size), cuts(a.shape[1], size)
                for ty in range(len(ys) - 1):
                    yield _batch([_row(page, ty, tx, a.shape[1], a.shape[0], a[ys[ty] : ys[ty + 1], xs[tx] : xs[tx + 1]]) for tx in range(len(xs) - 1)], TILES)

    return pages.select(F.col("page").cast("long"), image).mapInArrow(run, TILES)


def drawn(pixels: DataFrame, width: int, height: int, size: int = TILE) -> DataFrame:
    """Tiles of pages given by their dark pixels (page, y, x): 1 there, 0 elsewhere, for every page that has one."""
    ys, xs = cuts(height, size), cuts(width, size)
    place = lambda c, at: F.size(F.filter(F.array(*[F.lit(v) for v in at[1:-1]]), lambda v: v <= F.col(c))) if len(at) > 2 else F.lit(0)
    grid = F.explode(F.array(*[F.struct(F.lit(a).alias("ty"), F.lit(b).alias("tx")) for a in range(len(ys) - 1) for b in range(len(xs) - 1)]))
    every = pixels.select(F.col("page").cast("long")).distinct().withColumn("t", grid).select("page", "t.ty", "t.tx")
    own = pixels.select(F.col("page").cast("long"), place("y", ys).alias("ty"), place("x", xs).alias("tx"), (F.col("y") * width + F.col("x")).cast("int").alias("at")).groupBy("page", "ty", "tx").agg(F.collect_set("at").alias("at"))

    def run(batches):
        for batch in batches:
            for page, ty, tx, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                top, left, low, right = _box(ty, tx, width, height, size)
                a, at = np.zeros((low - top, right - left), np.uint8), np.array(at or [], np.int64)
                a[at // width - top, at % width - left] = 1
                yield _batch([_row(page, ty, tx, width, height, a)], TILES)

    return every.join(own, ["page", "ty", "tx"], "left").mapInArrow(run, TILES)


_PIECES = "page long, ty int, tx int, width int, height int, oy int, ox int, rows int, pixels binary"


def applied(tiles: DataFrame, work: Callable[[np.ndarray, tuple[int, int]], np.ndarray], halo: int, size: int = TILE) -> DataFrame:
    """Tiles after ``work`` (pixels and the page's height and width -> pixels), which looks no further than ``halo``.

    At a page's edge work sees the edge, as it would on the whole page. A halo wider than a tile raises.
    """
    if halo > size:
        raise ValueError(f"a halo of {halo} pixels needs tiles of that size or more")

    def sent(batches):
        for batch in batches:
            for r in batch.to_pylist():
                top, left, low, right = _box(r["ty"], r["tx"], r["width"], r["height"], size)
                a = np.frombuffer(r["pixels"], np.uint8).reshape(low - top, right - left)
                ny, nx = len(cuts(r["height"], size)) - 1, len(cuts(r["width"], size)) - 1
                part = {-1: slice(0, halo), 0: slice(None)}
                rows = []
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        if 0 <= r["ty"] + dy < ny and 0 <= r["tx"] + dx < nx:
                            piece = a[part.get(dy, slice(max(0, a.shape[0] - halo), None)), part.get(dx, slice(max(0, a.shape[1] - halo), None))]
                            rows.append(_row(r["page"], r["ty"] + dy, r["tx"] + dx, r["width"], r["height"], piece) | {"oy": -dy, "ox": -dx, "rows": piece.shape[0]})
                yield _batch(rows, _PIECES)

    def joined(table):
        rows = table.to_pylist()
        r = rows[0]
        at = {(p["oy"], p["ox"]): np.frombuffer(p["pixels"], np.uint8).reshape(p["rows"], -1) for p in rows}
        big = np.block([[at[oy, ox] for ox in (-1, 0, 1) if (0, ox) in at] for oy in (-1, 0, 1) if (oy, 0) in at])
        y, x = (at[-1, 0].shape[0] if (-1, 0) in at else 0), (at[0, -1].shape[1] if (0, -1) in at else 0)
        h, w = at[0, 0].shape
        out = work(big, (r["height"], r["width"]))[y : y + h, x : x + w]
        import pyarrow as pa

        return pa.Table.from_batches([_batch([_row(r["page"], r["ty"], r["tx"], r["width"], r["height"], out)], TILES)])

    return tiles.mapInArrow(sent, _PIECES).groupBy("page", "ty", "tx").applyInArrow(joined, TILES)


def grid_masks(tiles: DataFrame, width: int, height: int, ratio: int = 30, size: int = TILE, ink: bool = False) -> DataFrame:
    """G1-G4 on tiles of pages that are no larger than width and height; with ``ink`` tiles are binary already."""
    reach = max(10, width // ratio, height // ratio) + 5 + (0 if ink else I.THRESHOLD_BLOCK // 2)
    return applied(tiles, lambda a, page: I.line_mask(a > 0, page, ratio) if ink else I.grid_mask(a, ratio, page), reach, size)


def watermark_masks(tiles: DataFrame, size: int = TILE) -> DataFrame:
    """D12's band mask on tiles."""
    return applied(tiles, lambda a, page: I.watermark_masks(a)[1], I.WATERMARK_REACH, size)


def pixels_of(tiles: DataFrame, size: int = TILE) -> DataFrame:
    """page, y, x of all pixels that are not 0."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                top, left, low, right = _box(r["ty"], r["tx"], r["width"], r["height"], size)
                y, x = np.nonzero(np.frombuffer(r["pixels"], np.uint8).reshape(low - top, right - left))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), r["page"])), pa.array(y + top), pa.array(x + left)], ["page", "y", "x"])

    return tiles.mapInArrow(run, "page long, y long, x long")


_LABELS = "page long, dark boolean, node long, x0 long, y0 long, x1 long, y1 long, area long, border boolean, first long, around long, y long, x long"


def _labels(kinds: tuple[tuple[bool, bool], ...], size: int):
    """For each (dark, eight): a row for each part of a tile, and one (with y and x) for each of its pixels on the tile's edge.

    first is the part's first pixel on the page; around is the other kind's part to its left, null where that
    is another tile's, or if one kind alone is labelled.
    """

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                top, left, low, right = _box(r["ty"], r["tx"], r["width"], r["height"], size)
                a = np.frombuffer(r["pixels"], np.uint8).reshape(low - top, right - left) > 0
                start = (r["ty"] * len(cuts(r["width"], size)) + r["tx"]) << _ROW_BITS
                found = {dark: I.labelled(a == dark, eight) for dark, eight in kinds}
                node = lambda dark, k: start + 2 * int(k) + dark
                rows = []
                for dark, (boxes, label) in found.items():
                    none = dict.fromkeys(("x0", "y0", "x1", "y1", "area", "border", "first", "around", "y", "x")) | {"page": r["page"], "dark": dark}
                    for k, ((x, y, w, h, n), at) in enumerate(zip(boxes, I.first_pixels(label, len(boxes)).tolist())):
                        fy, fx = divmod(at, label.shape[1])
                        around = node(not dark, found[not dark][1][fy, fx - 1]) if fx and (not dark) in found else None
                        x, y = x + left, y + top
                        edge = x == 0 or y == 0 or x + w == r["width"] or y + h == r["height"]
                        rows.append(none | {"node": node(dark, k), "x0": x, "y0": y, "x1": x + w, "y1": y + h, "area": n, "border": edge, "first": (fy + top) * r["width"] + fx + left, "around": around})
                    rim = np.zeros_like(a)
                    rim[0], rim[-1], rim[:, 0], rim[:, -1] = True, True, True, True
                    for y, x in zip(*np.nonzero(rim & (label >= 0))):
                        rows.append(none | {"node": node(dark, label[y, x]), "y": int(y) + top, "x": int(x) + left})
                if rows:
                    yield _batch(rows, _LABELS)

    return run


def contracted(edges: DataFrame, folder: str) -> DataFrame:
    """(page, u, v): each node u of a graph and the least node v of its part, for nodes that are not that one.

    Large and small stars in turn: every node links its larger neighbours, then its smaller ones, to the
    least it knows, until nothing changes; the number of rounds grows with the logarithm of the longest way.
    """
    now = scratch.once(edges.select("page", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), f"{folder}/edges=0")
    before, k = None, 0
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("page", "u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now
        before, k = mark, k + 1
        both = now.unionByName(now.select("page", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("page", "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, ["page", "u"]).where("v > u").select("page", F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("page", "u").agg(F.min("v").alias("m"))
        small = large.join(least, ["page", "u"]).where("v <> m").select("page", F.col("v").alias("u"), F.col("m").alias("v"))
        now = scratch.once(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), f"{folder}/edges={k}")


def _joined(tiles: DataFrame, kinds: tuple[tuple[bool, bool], ...], size: int, folder: str | None) -> tuple[DataFrame, DataFrame]:
    """Nodes with the root of the part that each belongs to, and the pixels on edges of tiles."""
    folder = folder or scratch.new_folder(tiles.sparkSession)
    labels = scratch.once(tiles.mapInArrow(_labels(kinds, size), _LABELS), f"{folder}/labels")
    rim, nodes = labels.where("y is not null").select("page", "dark", "node", "y", "x"), labels.where("y is null").drop("y", "x")
    eight = F.array(*[F.lit(dark) for dark, e in kinds if e] or [F.lit(None).cast("boolean")])
    near: Column = F.when(F.array_contains(eight, F.col("dark")), F.array(F.lit(-1), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    other = rim.withColumnRenamed("node", "v")
    below = rim.select("page", "dark", F.col("node").alias("u"), (F.col("y") + 1).alias("y"), F.explode(F.transform(near, lambda d: F.col("x") + d)).alias("x"))
    beside = rim.select("page", "dark", F.col("node").alias("u"), F.explode(F.transform(near, lambda d: F.col("y") + d)).alias("y"), (F.col("x") + 1).alias("x"))
    edges = below.unionByName(beside).join(other, ["page", "dark", "y", "x"]).select("page", "u", "v")
    roots = contracted(edges, folder).select("page", F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, ["page", "node"], "left").withColumn("root", F.coalesce("root", "node")), rim


def _summed(nodes: DataFrame, *more: Column) -> DataFrame:
    sums = [F.min("x0").alias("x"), F.min("y0").alias("y"), (F.max("x1") - F.min("x0")).alias("width"), (F.max("y1") - F.min("y0")).alias("height"), F.sum("area").alias("area"), F.max("border").alias("border")]
    return nodes.groupBy("page", "dark", "root").agg(*sums, *more)


def parts(tiles: DataFrame, eight: bool = True, dark: bool = True, size: int = TILE, folder: str | None = None) -> DataFrame:
    """page, x, y, width, height, area, border (touches the page's edge) of the connected parts of pages.

    ``dark`` takes the pixels that are not 0, else those that are.
    """
    return _summed(_joined(tiles, ((dark, eight),), size, folder)[0]).drop("dark", "root")


def contours(masks: DataFrame, size: int = TILE, folder: str | None = None) -> DataFrame:
    """The tree of outlines of pages in tiles, as images.contours() has it: page, contour, x, y, width, height, area, hole, parent."""
    nodes, rim = _joined(masks, ((True, True), (False, False)), size, folder)
    whole = _summed(nodes, F.min("first").alias("contour"), F.min_by("around", "first").alias("around"))
    pages = masks.select("page", F.col("width").alias("page_width")).distinct()
    whole = scratch.once(whole.join(pages, "page"), scratch.new_folder(masks.sparkSession))
    left = rim.join(pages, "page").select("page", (~F.col("dark")).alias("dark"), (F.col("y") * F.col("page_width") + F.col("x") + 1).alias("contour"), F.col("node").alias("beside"))
    inner = F.col("contour") % F.col("page_width") != 0
    held = whole.join(left, ["page", "dark", "contour"], "left").withColumn("around", F.when(inner, F.coalesce("around", "beside")))
    of = nodes.select("page", F.col("node").alias("around"), F.col("root").alias("outer"))
    outer = whole.select("page", F.col("root").alias("outer"), F.when(F.col("dark") | ~F.col("border"), F.col("contour")).alias("parent"))
    held = held.join(of, ["page", "around"], "left").join(outer, ["page", "outer"], "left").where("dark or not border")
    by = F.when(F.col("dark"), 0).otherwise(1)
    return held.select("page", "contour", (F.col("x") - by).alias("x"), (F.col("y") - by).alias("y"), (F.col("width") + 2 * by).alias("width"), (F.col("height") + 2 * by).alias("height"), "area", (~F.col("dark")).alias("hole"), "parent")


def cell_boxes(masks: DataFrame, size: int = TILE) -> DataFrame:
    """G5 on tiles: page, x, y, width, height, area and hole of the lines, and of the areas that they enclose."""
    return contours(masks, size).drop("contour", "parent")
