"""Raster operators on NumPy arrays, and their batch forms over PNG-decoded columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def odd(value: Column) -> Column:
    """At least 1, and one more if even."""
    v = F.greatest(F.lit(1), value)
    return v + F.when(v % 2 == 0, 1).otherwise(0)


def gray(image: np.ndarray) -> np.ndarray:
    """Blue, green, red to one channel; a grey image is copied."""
    if image.ndim == 2:
        return image.copy()
    b, g, r = (image[..., i].astype(np.float64) for i in range(3))
    return np.rint(0.299 * r + 0.587 * g + 0.114 * b).astype(np.uint8)


def _windows(image: np.ndarray, k: int, mode: str = "edge") -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(np.pad(image, k // 2, mode=mode), (k, k))


#: Rows of a page that are worked on at a time.
BAND = 256


def median_blur(image: np.ndarray, k: int = 3) -> np.ndarray:
    k = max(1, k) + (max(1, k) % 2 == 0)
    big, out = np.pad(image, k // 2, mode="edge"), np.empty_like(image)
    h, w = image.shape
    for y in range(0, h, BAND):
        n = min(BAND, h - y)
        shifted = np.stack([big[y + a : y + a + n, b : b + w] for a in range(k) for b in range(k)])
        out[y : y + n] = np.partition(shifted, k * k // 2, axis=0)[k * k // 2]
    return out


def _gauss(k: int) -> np.ndarray:
    sigma = 0.3 * ((k - 1) * 0.5 - 1) + 0.8
    x = np.arange(k) - k // 2
    g = np.exp(-(x**2) / (2 * sigma**2))
    return g / g.sum()


def blur(image: np.ndarray, k: int) -> np.ndarray:
    g, p = _gauss(k), k // 2
    rows = np.apply_along_axis(np.convolve, 1, np.pad(image.astype(np.float64), ((0, 0), (p, p)), "edge"), g, "valid")
    return np.apply_along_axis(np.convolve, 0, np.pad(rows, ((p, p), (0, 0)), "edge"), g, "valid")


def adaptive_threshold(image: np.ndarray, block: int = 31, c: float = 15, inverted: bool = False) -> np.ndarray:
    above = image.astype(np.float64) > np.rint(blur(image, block)) - c
    return np.where(above != inverted, 255, 0).astype(np.uint8)


def otsu(image: np.ndarray) -> int:
    n = np.bincount(image.ravel(), minlength=256).astype(np.float64)
    w = np.cumsum(n)
    m = np.cumsum(n * np.arange(256))
    total, mean = w[-1], m[-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mean * w / total - m) ** 2 / (w * (total - w))
    return int(np.nanargmax(between)) if np.isfinite(between).any() else 0


def equalized(image: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Contrast-limited histogram equalisation by tiles, blended between tile centres."""
    h, w = image.shape
    tiles = max(1, tiles)
    ph, pw = -h % tiles, -w % tiles
    big = np.pad(image, ((0, ph), (0, pw)), "reflect" if h > ph and w > pw else "edge")
    th, tw = big.shape[0] // tiles, big.shape[1] // tiles
    cut = big.reshape(tiles, th, tiles, tw).swapaxes(1, 2).reshape(tiles * tiles, -1)
    hist = np.stack([np.bincount(t, minlength=256) for t in cut]).astype(np.float64)
    limit = max(1, int(clip * th * tw / 256))
    over = np.maximum(hist - limit, 0).sum(1, keepdims=True)
    table = np.cumsum(np.minimum(hist, limit) + over / 256, axis=1) * (255 / (th * tw))
    table = np.clip(np.rint(table), 0, 255).reshape(tiles, tiles, 256)
    y, x = (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    at = lambda a, b: table[np.clip(a, 0, tiles - 1)[:, None], np.clip(b, 0, tiles - 1)[None, :], image]
    top = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx
    low = at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def cleaned_border(image: np.ndarray, margin: int = 12) -> np.ndarray:
    """Whitens the margin if it fits; without one, the dark flat areas at the corners."""
    out = image.copy()
    h, w = out.shape[:2]
    if 0 < margin < min(h, w):
        out[:margin], out[-margin:], out[:, :margin], out[:, -margin:] = 255, 255, 255, 255
        return out
    for y, x in ((0, 0), (0, w - 1), (h - 1, 0), (h - 1, w - 1)):
        if out[y, x] < 250:
            out[_flood(out == out[y, x], y, x)] = 255
    return out


def _flood(mask: np.ndarray, y: int, x: int) -> np.ndarray:
    """The 4-connected part of mask that holds a place, grown by whole passes."""
    seen = np.zeros_like(mask)
    seen[y, x] = mask[y, x]
    while True:
        grown = seen.copy()
        grown[1:] |= seen[:-1]
        grown[:-1] |= seen[1:]
        grown[:, 1:] |= seen[:, :-1]
        grown[:, :-1] |= seen[:, 1:]
        grown &= mask
        if (grown == seen).all():
            return seen
        seen = grown


def _shifted(mask: np.ndarray, k: int, axis: int, every: bool) -> np.ndarray:
    p = [(0, 0), (0, 0)]
    p[axis] = (k // 2, k - 1 - k // 2)
    v = np.lib.stride_tricks.sliding_window_view(np.pad(mask, p, constant_values=every), k, axis=axis)
    return v.all(-1) if every else v.any(-1)


def erode(mask: np.ndarray, w: int, h: int) -> np.ndarray:
    return _shifted(_shifted(mask, w, 1, True), h, 0, True)


def dilate(mask: np.ndarray, w: int, h: int) -> np.ndarray:
    return _shifted(_shifted(mask, w, 1, False), h, 0, False)


def opened(mask: np.ndarray, w: int, h: int) -> np.ndarray:
    return dilate(erode(mask, w, h), w, h)


def closed(mask: np.ndarray, w: int, h: int) -> np.ndarray:
    return erode(dilate(mask, w, h), w, h)


def _runs(mask: np.ndarray, eight: bool) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Runs of rows (y, from, to), and for each the first run of the connected part it belongs to."""
    parent: list[int] = []
    runs: list[tuple[int, int, int]] = []
    before: list[int] = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    reach = 1 if eight else 0
    for y, row in enumerate(mask):
        edge = np.flatnonzero(np.diff(np.r_[0, row.astype(np.int8), 0]))
        now = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            k = len(runs)
            runs.append((y, a, b))
            parent.append(k)
            for p in before:
                if runs[p][1] < b + reach and a < runs[p][2] + reach:
                    parent[find(p)] = find(k)
            now.append(k)
        before = now
    return runs, [find(k) for k in range(len(runs))]


def labelled(mask: np.ndarray, eight: bool = True) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """components(), and each pixel's index in that list (-1 outside)."""
    runs, first = _runs(mask, eight)
    boxes: dict[int, list[int]] = {}
    number: dict[int, int] = {}
    label = np.full(mask.shape, -1, np.int32)
    for (y, a, b), root in zip(runs, first):
        box = boxes.setdefault(root, [a, y, b, y + 1, 0])
        box[0], box[1], box[2], box[3], box[4] = min(box[0], a), min(box[1], y), max(box[2], b), max(box[3], y + 1), box[4] + b - a
        label[y, a:b] = number.setdefault(root, len(number))
    return [(x, y, r - x, low - y, n) for x, y, r, low, n in boxes.values()], label


def components(mask: np.ndarray, eight: bool = True) -> list[tuple[int, int, int, int, int]]:
    """x, y, width, height, area of the connected parts of mask, by runs of rows."""
    return labelled(mask, eight)[0]


def first_pixels(label: np.ndarray, n: int) -> np.ndarray:
    """The first pixel (by rows) of each of n labelled parts, as an index into the flat image."""
    at = np.flatnonzero(label >= 0)[::-1]
    out = np.zeros(n, np.int64)
    out[label.ravel()[at]] = at  # the last assignment, that of the first pixel, stays
    return out


def contours(mask: np.ndarray) -> list[dict]:
    """The tree of outlines: parts (8-connected) and the holes in them (4-connected), each with its parent.

    A part's or a hole's number is that of its first pixel, y * width + x. What lies to the left of that pixel
    is what encloses it: a part's parent is a hole, a hole's is a part, and what lies in the open has none.
    Boxes of holes run on the pixels around them.
    """
    w = mask.shape[1]
    (parts, part), (gaps, gap) = labelled(mask), labelled(~mask, eight=False)
    part_at, gap_at = first_pixels(part, len(parts)), first_pixels(gap, len(gaps))
    free = [x == 0 or y == 0 or x + bw == w or y + bh == mask.shape[0] for x, y, bw, bh, _ in gaps]
    out = []
    for at, (x, y, bw, bh, n) in zip(part_at.tolist(), parts):
        k = gap[at // w, at % w - 1] if at % w else -1
        out.append({"contour": at, "x": x, "y": y, "width": bw, "height": bh, "area": n, "hole": False, "parent": None if k < 0 or free[k] else int(gap_at[k])})
    for at, open_, (x, y, bw, bh, n) in zip(gap_at.tolist(), free, gaps):
        if not open_:
            out.append({"contour": at, "x": x - 1, "y": y - 1, "width": bw + 2, "height": bh + 2, "area": n, "hole": True, "parent": int(part_at[part[at // w, at % w - 1]])})
    return out


THRESHOLD_BLOCK = 31


def grid_mask(image: np.ndarray, ratio: int = 30, page: tuple[int, int] | None = None) -> np.ndarray:
    """Long horizontal and vertical lines of a page, joined; ``page`` (height, width) if image is a part of one."""
    return line_mask(adaptive_threshold(gray(image), THRESHOLD_BLOCK, inverted=True) > 0, page or image.shape[:2], ratio)


def line_mask(ink: np.ndarray, page: tuple[int, int], ratio: int = 30) -> np.ndarray:
    h, w = page
    across, down = opened(ink, max(10, w // ratio), 1), opened(ink, 1, max(10, h // ratio))
    return closed(dilate(across, 3, 3) | dilate(down, 3, 3), 5, 5)


def cells(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Boxes of the lines and of the areas they enclose."""
    holes = [c for c in components(~mask, eight=False) if c[0] > 0 and c[1] > 0 and c[0] + c[2] < mask.shape[1] and c[1] + c[3] < mask.shape[0]]
    return [c[:4] for c in components(mask)] + [(x - 1, y - 1, w + 2, h + 2) for x, y, w, h, _ in holes]


def _cubic(f: np.ndarray) -> list[np.ndarray]:
    """Weights of the four pixels around a place, ``f`` beyond the second (a = -0.75)."""
    a = np.float32(-0.75)
    far = lambda d: ((a * d - 5 * a) * d + 8 * a) * d - 4 * a
    near = lambda d: ((a + 2) * d - (a + 3)) * d * d + 1
    return [far(f + 1), near(f), near(1 - f), far(2 - f)]


def rotated(image: np.ndarray, degrees: float, fill: int = 255) -> np.ndarray:
    """About the centre, counter-clockwise, cubic between pixels; a band of rows at a time."""
    h, w = image.shape
    t = np.deg2rad(degrees)
    c, s = np.cos(t), np.sin(t)
    big, out = np.pad(image, 2, constant_values=fill), np.empty_like(image)
    dx = np.arange(w) - w / 2
    for top in range(0, h, BAND):
        dy = (np.arange(top, min(h, top + BAND)) - h / 2)[:, None]
        sx, sy = dx * c - dy * s + w / 2, dx * s + dy * c + h / 2
        x0, y0 = np.floor(sx).astype(np.int32), np.floor(sy).astype(np.int32)
        across, down = _cubic((sx - x0).astype(np.float32)), _cubic((sy - y0).astype(np.float32))
        total = np.zeros(sx.shape, np.float32)
        for i in range(4):
            rows = np.clip(y0 + i + 1, 0, h + 3)
            line = sum(across[j] * big[rows, np.clip(x0 + j + 1, 0, w + 3)] for j in range(4))
            total += down[i] * line
        out[top : top + BAND] = np.clip(np.rint(total), 0, 255)
    return out


def denoised(image: np.ndarray, strength: float = 7.0, patch: int = 7, search: int = 21) -> np.ndarray:
    """Non-local means of a grey image: each pixel becomes the mean of those near it, weighted by how alike
    the patches around them are. Patch distances come from running sums, one shift at a time."""
    r, p, (h, w) = search // 2, patch // 2, image.shape
    big = np.pad(image, r + p, mode="reflect" if min(h, w) > r + p else "edge").astype(np.int32)
    own = big[r : r + h + 2 * p, r : r + w + 2 * p]
    weights, total = np.zeros((h, w), np.float32), np.zeros((h, w), np.float32)
    for dy in range(2 * r + 1):
        for dx in range(2 * r + 1):
            other = big[dy : dy + h + 2 * p, dx : dx + w + 2 * p]
            far = own - other
            far *= far
            for axis in (0, 1):
                far = np.cumsum(far, axis, dtype=np.int64 if far.shape[1] > 4000 else np.int32)
                head, tail = (slice(patch - 1, None), slice(None, -patch)) if axis == 0 else ((slice(None), slice(patch - 1, None)), (slice(None), slice(None, -patch)))
                ends, before = far[head].copy(), far[tail]
                (ends[1:] if axis == 0 else ends[:, 1:])[...] -= before
                far = ends
            weight = np.exp(far.astype(np.float32) * np.float32(-1 / (patch * strength) ** 2))
            weights += weight
            total += weight * other[p : p + h, p : p + w]
    return np.clip(np.rint(total / weights), 0, 255).astype(np.uint8)


def for_reading(image: np.ndarray) -> np.ndarray:
    """What a recognition engine is given: grey, and without noise unless it has few levels already."""
    g = gray(image)
    return g if few_levels(g) else denoised(g)


def few_levels(image: np.ndarray, most: int = 4) -> bool:
    return np.unique(image).size <= most


def visual_q(image: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Dark parts of a serial box that are large and placed as a leading Q is."""
    g = gray(image)
    h, w = g.shape
    fits = lambda x, y, cw, ch, n: n >= 180 and x <= int(0.55 * w) and y >= int(0.15 * h) and y + ch <= int(0.9 * h) and cw >= int(0.12 * w) and ch >= int(0.25 * h) and not (x == 0 and cw >= w - 2)
    return [c for c in components(g <= otsu(g)) if fits(*c)]


#: Pixels that watermark_masks() looks around it: a blur of 5, an opening of 21, a closing of 31 and a dilation of 3.
WATERMARK_REACH = 64


def watermark_masks(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and band of a grey watermark."""
    soft = blur(gray(image), 5)
    letters = opened((soft >= 100) & (soft <= 240), 21, 5)
    return letters, dilate(closed(letters, 31, 7), 3, 3)
