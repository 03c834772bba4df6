"""PNG bytes to NumPy arrays and back, with zlib alone: every bit depth, palettes, transparency and interlacing."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_HEAD = b"\x89PNG\r\n\x1a\n"
#: Channels by colour type: grey, RGB, palette, grey with alpha, RGB with alpha.
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
# Fixed values of the format: bit depths by colour type, and the interlaced passes as first column, first row and steps.
_DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


def size(data: bytes) -> tuple[int, int]:
    """Width and height out of the header."""
    if data[:8] != _HEAD or data[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">II", data[16:24])


def _chunks(data: bytes):
    at = 8
    while at + 8 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        end = at + 8 + n
        if len(data) < end + 4 or zlib.crc32(data[at + 4 : end]) != int.from_bytes(data[end : end + 4], "big"):
            raise ValueError("a PNG chunk is cut off or damaged")
        yield data[at + 4 : at + 8], data[at + 8 : end]
        at = end + 4


def _unfiltered(rows: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    if kinds.size and kinds.max() > 4:
        raise ValueError("unknown PNG filter")
    out = np.zeros_like(rows)
    above = np.zeros(rows.shape[1], np.uint8)
    for y, (kind, row) in enumerate(zip(kinds.tolist(), rows)):
        if kind == 0:
            out[y] = row
        elif kind == 1:
            out[y] = np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[y] = row + above
        else:
            got, up, raw = bytearray(len(row)), above.tobytes(), row.tobytes()
            for i, v in enumerate(raw):
                a, b = got[i - step] if i >= step else 0, up[i]
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    c = up[i - step] if i >= step else 0
                    guess = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                got[i] = (v + guess) & 255
            out[y] = np.frombuffer(bytes(got), np.uint8)
        above = out[y]
    return out


def _shapes(width: int, height: int, interlaced: int) -> list[tuple[slice, slice, int, int]]:
    """Where the rows and columns of each pass go, and how many there are; passes without pixels are left out."""
    if not interlaced:
        return [(slice(None), slice(None), height, width)]
    found = [(slice(y, None, dy), slice(x, None, dx), -(-(height - y) // dy), -(-(width - x) // dx)) for x, y, dx, dy in _PASSES]
    return [p for p in found if p[2] > 0 and p[3] > 0]


def _samples(rows: np.ndarray, depth: int, n: int) -> np.ndarray:
    """Bytes of rows as numbers."""
    if depth == 8:
        return rows[:, :n]
    if depth == 16:
        return np.ascontiguousarray(rows).view(">u2")[:, :n].astype(np.uint16)
    bits = np.unpackbits(rows, axis=1)
    return (bits.reshape(len(rows), -1, depth) @ (1 << np.arange(depth - 1, -1, -1))).astype(np.uint8)[:, :n]


def decode(data: bytes, alpha: bool = False) -> np.ndarray:
    """Rows by columns (grey) or rows by columns by blue, green, red; with ``alpha`` a last channel says how solid a pixel is.

    Grey of fewer bits is spread over 0 to 255, of sixteen bits the upper eight count. Raises ValueError for
    what is no PNG image, is cut off or damaged.
    """
    width, height = size(data)
    depth, colour, _, _, interlaced = data[24:29]
    if depth not in _DEPTHS.get(colour, ()) or interlaced > 1 or not width or not height:
        raise ValueError("a PNG header that the format does not know")
    parts: dict[bytes, bytearray] = {}
    for kind, part in _chunks(data):
        parts.setdefault(kind, bytearray()).extend(part)
    n = _CHANNELS[colour]
    shapes = _shapes(width, height, interlaced)
    strides = [(w * n * depth + 7) // 8 + 1 for _, _, _, w in shapes]
    try:
        flat = np.frombuffer(zlib.decompress(bytes(parts.get(b"IDAT", b""))), np.uint8)
    except zlib.error as e:
        raise ValueError(f"a PNG image whose pixels cannot be unpacked: {e}") from e
    if len(flat) < sum(stride * h for stride, (_, _, h, _) in zip(strides, shapes)):
        raise ValueError("a PNG image that lacks pixels")
    out, at = np.empty((height, width, n), np.uint16 if depth == 16 else np.uint8), 0
    for stride, (rows, columns, h, w) in zip(strides, shapes):
        lines = flat[at : at + stride * h].reshape(h, stride)
        at += stride * h
        out[rows, columns] = _samples(_unfiltered(lines[:, 1:], lines[:, 0], max(1, n * depth // 8)), depth, w * n).reshape(h, w, n)
    clear = parts.get(b"tRNS")
    if colour == 3:
        palette = np.frombuffer(bytes(parts.get(b"PLTE", b"")), np.uint8)
        palette = palette[: len(palette) // 3 * 3].reshape(-1, 3)
        index = out[..., 0]
        if index.max() >= len(palette):
            raise ValueError("a PNG image whose palette lacks a colour")
        solid = np.full(256, 255, np.uint8)
        solid[: len(clear or b"")] = np.frombuffer(bytes(clear or b""), np.uint8)
        out, solid = palette[index], solid[index]
    else:
        colours = n - (colour in (4, 6))
        if colours < n:
            solid = out[..., -1]
        elif clear:
            key = np.frombuffer(bytes(clear), ">u2")[:n]
            solid = np.where((out == key).all(-1), 0, (1 << depth) - 1).astype(out.dtype)
        else:
            solid = np.full((height, width), (1 << depth) - 1, out.dtype)
        eight = lambda a: (a >> 8).astype(np.uint8) if depth == 16 else a * np.uint8(255 // ((1 << depth) - 1))
        out, solid = eight(out[..., :colours]), eight(solid)
    out = out[..., ::-1]
    if alpha:
        return np.ascontiguousarray(np.concatenate([out, solid[..., None]], axis=2))
    return np.ascontiguousarray(out[..., 0] if out.shape[2] == 1 else out)


def encode(image: np.ndarray, depth: int = 8, interlaced: bool = False) -> bytes:
    """A grey or a blue, green, red array as PNG bytes; other depths keep the upper bits (16: a copy below)."""
    colour, rows = (0, image) if image.ndim == 2 else (2, image[..., ::-1])
    if depth not in _DEPTHS[colour]:
        raise ValueError(f"no PNG image of that kind has {depth} bits")
    h, w = image.shape[:2]
    rows = np.ascontiguousarray(rows, np.uint8).reshape(h, w, -1)
    body = b""
    for down, across, ph, pw in _shapes(w, h, int(interlaced)):
        part = rows[down, across].reshape(ph, -1)
        if depth == 16:
            part = np.repeat(part, 2, axis=1)
        elif depth < 8:
            bits = (part[..., None] >> 8 - depth) >> np.arange(depth - 1, -1, -1) & 1
            part = np.packbits(bits.reshape(ph, -1).astype(np.uint8), axis=1)
        body += np.concatenate([np.zeros((ph, 1), np.uint8), part], axis=1).tobytes()
    chunk = lambda kind, inner: struct.pack(">I", len(inner)) + kind + inner + struct.pack(">I", zlib.crc32(kind + inner))
    return _HEAD + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, int(interlaced))) + chunk(b"IDAT", zlib.compress(body, 6)) + chunk(b"IEND", b"")
