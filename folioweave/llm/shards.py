"""Texts as shards of word numbers, which the phrase and the language model operators share.

A shard is a run of whole documents of a few MB. Its words are cut and numbered in NumPy and Arrow,
and what shards say of words or word pairs travels as few rows of packed arrays, one a shard and
partition, so Spark shuffles megabytes in place of a row for each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import row_batches

#: Bytes of text that a shard holds about; a longer document makes a shard of its own.
SHARD_BYTES = 16 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ROW_BITS = 33  # of monotonically_increasing_id: rows of one partition


def cut_words(texts: pa.Array, spaces: bytes, breaks: bytes = b"") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all texts in order (A-Z in lower case), the text each lies in, and whether it begins a piece.

    Words end at the bytes of spaces and breaks (all ASCII) and with their text; a piece also ends at each
    byte of breaks. A null text has no words.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, bool)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8))[at[0] : at[-1]]
    at = at[:-1] - at[0]
    kind = np.zeros(256, np.uint8)
    kind[list(spaces)] = 1
    kind[list(breaks)] = 2
    inside = (kind == 0)[data]
    cuts = np.flatnonzero((kind == 2)[data]) if breaks else np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[at[at < len(data)]] = False
    first = inside & ~before
    del before
    starts = np.flatnonzero(first)
    offsets = np.append(np.flatnonzero(first[inside]), np.count_nonzero(inside)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])])
    doc = np.searchsorted(at, starts, side="right") - 1
    piece = np.searchsorted(cuts, starts)
    opens = np.ones(len(starts), bool)
    opens[1:] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
    return words, doc, opens


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each word within the shard, and the distinct words by number."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.binary())


def packed(a: np.ndarray) -> bytes:
    """An integer array as bytes: planes of equal significance, compressed."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T
    return np.int64(len(a)).tobytes() + a.dtype.str.encode().ljust(4) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(b: bytes) -> np.ndarray:
    n, kind = int(np.frombuffer(b[:8], np.int64)[0]), np.dtype(b[8:12].decode().strip())
    flat = np.frombuffer(pa.decompress(b[12:], decompressed_size=n * kind.itemsize, codec="zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(kind.itemsize, n).T).reshape(-1).view(kind) if n else np.zeros(0, kind)


def packed_sorted(a: np.ndarray) -> bytes:
    """An ascending array as its differences."""
    return packed(np.diff(a, prepend=a.dtype.type(0)))


def unpacked_sorted(b: bytes) -> np.ndarray:
    a = unpacked(b)
    return np.cumsum(a, dtype=a.dtype)


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with the sums of their counts."""
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def member(codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where codes stand in the ascending array of, and whether they do."""
    if not len(of):
        return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
    k = np.minimum(np.searchsorted(of, codes), len(of) - 1)
    return k, of[k] == codes


def mixed(codes: np.ndarray, n: int) -> np.ndarray:
    """A number under n for each code, spread evenly."""
    return ((codes.astype(np.uint64) * _MIX >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def dealt(part: np.ndarray):
    """Each part that occurs with the places that it has, in order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    ends = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else np.zeros(0, int)
    for i, j in zip(ends[:-1], ends[1:]):
        yield int(part[i]), order[i:j]


def shards(docs: DataFrame, one, schema: str, columns: list[Column], text: str = "text") -> DataFrame:
    """Rows of one(batch, number) for each shard; number differs between shards. schema names one's fields."""
    def each(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in row_batches(batches, SHARD_BYTES, text):
            yield row_of(one(batch, (part << _ROW_BITS) + k), arrow)
            k += 1

    arrow = arrow_schema(docs.sparkSession, schema)
    return docs.select(*columns).mapInArrow(each, schema)


def row_of(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    """One row; a list field takes an Arrow array."""
    cols = []
    for f in schema:
        v = values.get(f.name)
        if isinstance(v, (pa.Array, np.ndarray)):
            v = pa.array(v) if isinstance(v, np.ndarray) else v
            cols.append(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(f.type.value_type)))
        else:
            cols.append(pa.array([v], f.type))
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)


def arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def dense(df: DataFrame, numbered_by: str = "id") -> DataFrame:
    """Turn the monotonically_increasing_id of a written table into numbers without gaps.

    The driver sees one count a partition of that table.
    """
    part = F.shiftright(numbered_by, _ROW_BITS)
    base, total = {}, 0
    for p, n in sorted(df.groupBy(part.alias("p")).count().collect()):
        base[p], total = total, total + n
    if not base:
        return df
    bases = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
    return df.withColumn(numbered_by, bases[part] + F.col(numbered_by).bitwiseAND((1 << _ROW_BITS) - 1))
