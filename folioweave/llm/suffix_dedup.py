"""Removal of bytes whose 50-byte strings already start in an earlier document.

Method: a distributed suffix array by prefix doubling, over sampled suffixes. The name (rank)
of the 2h bytes at a position is made from the names of the h bytes at it and h further on.
Every 50-byte window picks one suffix, the one with the least 25-byte name among those that
start in its first 26 bytes, so equal windows pick the same place; only picked suffixes (about
1 in 13) are dealt out and sorted.

Round 1 sorts them by (25-byte name, name of all bytes that their windows cover), document last.
A suffix whose whole run of windows starts in an earlier document is settled; one whose 25-byte
name occurs in one document only is unique and leaves. Round 2 doubles the offset for the rest:
the windows of a remaining run are ranked by pairs (25 bytes, next 25 bytes), sorted again, and
those that also start in an earlier document are settled. 50 bytes is the threshold, so it ends.

Names are hashes of 64 bits or more (104 and 128 bits where they decide), in place of dense
ranks, so no round needs a total order over all tasks: equal names meet by a bucket of the name.
Occurrences of one run in the documents of one batch of a map task are settled there, and only the
earliest leaves it, so a passage that a third of all documents share costs a row per batch. Names
that many documents hold with different surroundings are found in a sample of documents; their
suffixes meet by the name of the whole run, so they spread over all buckets, and all that are not
settled go to round 2, where their windows spread by pair. The sample moves work and no result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import materialize, parts, row_batches

LENGTH = 50
#: Bytes of text that a task turns into names at a time.
BATCH_BYTES = 1 << 20
#: Bytes of packed suffixes that a task holds before it sends them.
FLUSH_BYTES = 12 << 20
#: One document in so many is looked at for hot names; a name is hot if the sample has it so often, with different surroundings.
HOT_SHARE, HOT_LEAST = 64, 200
#: The most hot names that are told to tasks (the most frequent).
HOT_NAMES = 100_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    x ^= x >> np.uint64(29)
    x *= _M3
    x ^= x >> np.uint64(32)
    return x


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two neighbouring pieces from their names."""
    out = a * _M1
    out ^= out >> np.uint64(31)
    out += b
    out *= _M3
    out ^= out >> np.uint64(29)
    return out


def names(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """By prefix doubling, the 64-bit name of the ``length`` bytes at each position that has them."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    now, h = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + seed)) * _M1)[data], 1
    while h < length:
        step = min(h, length - h)
        now = _pair(now[:-step], now[step:])
        h += step
    return now


def picked(name: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` positions the place of its least name, the first of ties."""
    low, off, h = name, np.zeros(len(name), np.uint8 if width < 256 else np.uint32), 1
    while h < width:
        step = min(h, width - h)
        a, b = low[:-step], low[step:]
        later = b < a
        low = np.where(later, b, a)
        off = np.where(later, off[step:] + off.dtype.type(step), off[:-step])
        h += step
    return np.arange(len(off)) + off


class Docs:
    """The documents of a batch, least doc_id first, as one run of bytes."""

    def __init__(self, ids, texts):
        pairs = sorted(zip(ids, texts), key=lambda x: x[0])
        self.ids = np.array([i for i, _ in pairs], np.int64)
        self.marks = np.array([zlib.crc32(t) for _, t in pairs], np.uint32)
        self.sizes = np.array([len(t) for _, t in pairs], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(t for _, t in pairs), np.uint8)


def _pack(doc, ids, marks, start, run, *more) -> bytes:
    """Runs of windows in document order (doc: index into ids), and further arrays as they are."""
    import zstandard

    used, counts = np.unique(doc, return_counts=True)
    head = np.array([len(used), len(doc), *(x.dtype.itemsize for x in more)], np.uint32)
    raw = b"".join(x.tobytes() for x in (head, ids[used], marks[used], counts.astype(np.uint32), start.astype(np.uint32), run.astype(np.uint32)))
    packed = zstandard.ZstdCompressor(1).compress(raw)
    return b"".join([np.uint32(len(packed)).tobytes(), np.uint32(len(head)).tobytes(), packed, *(x.tobytes() for x in more)])


def _unpack(payload: bytes):
    """doc_id, mark, start, run of each run of windows, and the further arrays."""
    import zstandard

    size, heads = np.frombuffer(payload, np.uint32, 2)
    raw = zstandard.ZstdDecompressor().decompress(payload[8 : 8 + size])
    head = np.frombuffer(raw, np.uint32, heads)
    d, n, at = int(head[0]), int(head[1]), 4 * int(heads)
    cols = []
    for kind, k in ((np.int64, d), (np.uint32, d), (np.uint32, d), (np.uint32, n), (np.uint32, n)):
        cols.append(np.frombuffer(raw, kind, k, at))
        at += cols[-1].nbytes
    ids, marks, counts, start, run = cols
    more, at = [], 8 + int(size)
    for width in head[2:]:
        more.append(np.frombuffer(payload, np.uint64 if width == 8 else np.uint8, n if width == 8 else n * 5, at))
        at += more[-1].nbytes
    return np.repeat(ids, counts), np.repeat(marks, counts), start, run, *more


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (_mix(ids.astype(np.int64).view(np.uint64) * _M1) % np.uint64(groups)).astype(np.int64)


def _as_bytes(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _rows(found):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([p for _, p in found], pa.binary())], ["key", "payload"])


class Out:
    """Packed runs by key, sent when they are large."""

    def __init__(self):
        self.rows, self.size = [], 0

    def add(self, key: np.ndarray, doc, ids, marks, start, run, *more, offset: int = 0) -> None:
        if not len(key):
            return
        order = np.lexsort((start, doc, key))
        key = key[order]
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(key)]):
            at = order[a:b]
            payload = _pack(doc[at], ids, marks, start[at], run[at], *(x[at] for x in more))
            self.rows.append((int(key[a]) + offset, payload))
            self.size += len(payload)

    def flush(self, least: int = 0):
        if self.rows and self.size >= least:
            for i in range(0, len(self.rows), 512):
                yield _rows(self.rows[i : i + 512])
            self.rows, self.size = [], 0


def _low5(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :5])


def _wide(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), np.uint8)
    out[:, :5] = x.reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _doc_index(ids: np.ndarray, marks: np.ndarray):
    """Index, in order of doc_id, of each row's document, with the documents' ids and marks."""
    pair = np.empty(len(ids), [("i", np.int64), ("m", np.uint32)])
    pair["i"], pair["m"] = ids, marks
    uniq, index = np.unique(pair, return_inverse=True)
    return index, np.ascontiguousarray(uniq["i"]), np.ascontiguousarray(uniq["m"])


class Runs:
    """The picked suffixes of a batch's documents, each with the run of windows that picked it."""

    def __init__(self, batch, length: int):
        half = length // 2
        docs = self.docs = Docs(batch.column(0).to_pylist(), _as_bytes(batch.column(1).to_pylist()))
        held = np.maximum(docs.sizes - length + 1, 0)
        self.n = int(held.sum())
        if not self.n:
            return
        name = names(docs.data, half)
        place = picked(name, length - half + 1)[: len(docs.data) - length + 1]
        owner = np.repeat(np.arange(len(docs.ids)), held)
        window = np.arange(len(owner)) + np.repeat(docs.starts - np.cumsum(held) + held, held)
        place = place[window]
        cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
        run = self.run = np.diff(np.r_[cut, len(window)])
        first, place = window[cut], place[cut]
        self.doc = owner[cut]
        self.anchor = _mix(name[place])
        self.whole = _mix(_pair(_pair(name[first], name[first + half]), name[first + run - 1 + length - half]) + _mix((run * 64 + (place - first)).astype(np.uint64)))
        self.start = first - docs.starts[self.doc]


def _in_smaller(name: np.ndarray, other: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a smaller id has the same two names; ids are in order."""
    order = np.argsort(name, kind="stable")
    a, b, i = name[order], other[order], ids[order]
    head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    out = np.zeros(len(ids), bool)
    out[order] = i > i[np.flatnonzero(head)][np.cumsum(head) - 1]
    return out


def hot_names(docs: DataFrame, length: int) -> np.ndarray:
    """Sorted 25-byte names that a sample of documents holds often in different surroundings."""

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, BATCH_BYTES):
            own = Runs(batch, length)
            if own.n:
                a = np.unique(np.stack([own.anchor, own.whole]), axis=1)[0]
                name, n = np.unique(a, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n)], ["name", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SHARE)) == 0).mapInArrow(run, "name long, n long")
    found = some.groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_LEAST).orderBy(F.desc("n"), "name").limit(HOT_NAMES).collect()  # a bounded list that only deals work out
    return np.sort(np.array([r["name"] for r in found], np.int64).view(np.uint64))


def is_in(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether values are among sorted ones."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _sampled(buckets: int, groups: int, length: int, hot: np.ndarray):
    """Round 1, map side: keys under ``groups`` are groups of documents, the next are buckets by name,
    the last are buckets of hot names by the whole run."""

    def run(batches):
        out = Out()
        for batch in row_batches(batches, BATCH_BYTES):
            own = Runs(batch, length)
            if not own.n:
                continue
            docs, doc, whole, anchor = own.docs, own.doc, own.whole, own.anchor
            settled = _in_smaller(whole, anchor, docs.ids[doc])  # the same run of windows in a smaller document of this batch
            g = group_of(docs.ids[doc], groups)
            out.add(g[settled], doc[settled], docs.ids, docs.marks, own.start[settled], own.run[settled])
            rest = ~settled
            is_hot = is_in(anchor[rest], hot)
            bucket = np.where(is_hot, buckets + ((whole[rest] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), ((anchor[rest] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64))
            out.add(bucket, doc[rest], docs.ids, docs.marks, own.start[rest], own.run[rest], _low5(anchor[rest]), whole[rest], offset=groups)
            yield from out.flush(FLUSH_BYTES)
        yield from out.flush()

    return run


def _by_key(batches):
    """key and all payloads of that key, for rows sorted by key."""
    key, got = None, []
    for batch in batches:
        for k, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key and got:
                yield key, got
                got = []
            key = k
            got.append(p)
    if got:
        yield key, got


def _sorted_round(groups: int, buckets: int):
    """Round 1, reduce side: out come settled runs (key: group of documents) and, with the group's
    number + groups as key, runs whose windows go to round 2."""

    def run(batches):
        for key, payloads in _by_key(batches):
            if key < groups:
                yield _rows([(key, p) for p in payloads])
                continue
            cols = [np.concatenate(x) for x in zip(*map(_unpack, payloads))]
            ids, marks, start, length, anchor, whole = cols
            anchor = _wide(anchor)
            order = np.lexsort((ids, whole, anchor))
            ids, marks, start, length, anchor, whole = (x[order] for x in (ids, marks, start, length, anchor, whole))
            new_a = np.r_[True, anchor[1:] != anchor[:-1]]
            new_w = new_a | np.r_[True, whole[1:] != whole[:-1]]
            least = ids[np.flatnonzero(new_w)][np.cumsum(new_w) - 1]
            settled = ids > least
            at = np.cumsum(new_a) - 1
            low, high = np.full(at[-1] + 1, np.iinfo(np.int64).max), np.full(at[-1] + 1, np.iinfo(np.int64).min)
            np.minimum.at(low, at[~settled], ids[~settled])
            np.maximum.at(high, at[~settled], ids[~settled])
            shared = ~settled & ((low < high)[at] if key < groups + buckets else True)
            index, doc_ids, doc_marks = _doc_index(ids, marks)
            out = Out()
            g = group_of(ids, groups)
            out.add(g[settled], index[settled], doc_ids, doc_marks, start[settled], length[settled])
            out.add(g[shared], index[shared], doc_ids, doc_marks, start[shared], length[shared], offset=groups)
            yield from out.flush()

    return run


def _collect(payload: bytes, runs: dict) -> None:
    """Add the runs of a payload to those of each (doc_id, mark)."""
    ids, marks, start, run = _unpack(payload)[:4]
    cut = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])])
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(ids)]):
        runs.setdefault((int(ids[a]), int(marks[a])), []).append((start[a:b], run[a:b]))


def _texts_with(batches, groups: int):
    """For rows of a group, packed runs first: (doc_id, text as bytes, its runs as (start, run))."""
    key, runs = None, {}
    for batch in batches:
        for k, p, i, t in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if k != key:
                key, runs = k, {}
            if p is not None:
                _collect(p, runs)
            else:
                data = (t or "").encode("utf-8", "surrogatepass")
                yield i, data, runs.get((i, zlib.crc32(data)), ())


def _windows(groups: int, buckets: int, length: int):
    """Round 2, map side: pairs of half names of each window that is left."""
    half = length // 2

    def run(batches):
        out = Out()
        held, size = [], 0

        def send():
            held.sort(key=lambda h: h[0])
            docs = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
            ids, marks = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.uint32)
            at, left, right = (np.concatenate([h[i] for h in held]) for i in (2, 3, 4))
            one = np.ones(len(at), np.uint32)
            settled = _in_smaller(left, right, ids[docs])  # the same window in a smaller document held here
            out.add(group_of(ids[docs], groups)[settled], docs[settled], ids, marks, at[settled], one[settled])
            docs, at, left, right, one = (x[~settled] for x in (docs, at, left, right, one))
            out.add(((left >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), docs, ids, marks, at, one, left, right, offset=groups)

        for i, data, runs in _texts_with(batches, groups):
            if not len(runs):
                continue
            array = np.frombuffer(data, np.uint8)
            name = names(array, half)
            start, count = (np.concatenate(x).astype(np.int64) for x in zip(*runs))
            at = np.unique(np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            one, two = name[at], name[at + length - half]
            held.append((i, zlib.crc32(data), at, _mix(_pair(one, two)), _mix(_pair(two, one) + _M2)))
            size += len(at)
            if size > 1 << 19:
                send()
                held, size = [], 0
                yield from out.flush(FLUSH_BYTES)
        if held:
            send()
        yield from out.flush()

    return run


def _sorted_pairs(groups: int):
    """Round 2, reduce side: the windows that also start in a smaller document."""

    def run(batches):
        for key, payloads in _by_key(batches):
            if key < groups:
                yield _rows([(key, p) for p in payloads])
                continue
            ids, marks, start, _, left, right = [np.concatenate(x) for x in zip(*map(_unpack, payloads))]
            order = np.lexsort((ids, right, left))
            i, a, b = ids[order], left[order], right[order]
            head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            least = i[np.flatnonzero(head)][np.cumsum(head) - 1]
            at = order[i > least]
            out = Out()
            index, doc_ids, doc_marks = _doc_index(ids[at], marks[at]) if len(at) else (at, ids, marks)
            out.add(group_of(ids[at], groups), index, doc_ids, doc_marks, start[at], np.ones(len(at), np.uint32))
            yield from out.flush()

    return run


def _cover(size: int, runs, length: int) -> np.ndarray:
    change = np.zeros(size + 1, np.int32)
    for start, run in runs:
        np.add.at(change, start, 1)
        np.add.at(change, start.astype(np.int64) + run + length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, int]:
    """Packed runs of windows to remove, by group of documents (key, payload), and how many groups.

    docs has doc_id (a long, not null) and text.
    """
    buckets = groups = parts(docs, 4, 32)
    tasks = max(8, buckets // 2)
    rows = "key long, payload binary"
    sent = docs.mapInArrow(_sampled(buckets, groups, length, hot_names(docs, length)), rows)
    first = materialize(sent.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(_sorted_round(groups, buckets), rows))
    left = first.where(F.col("key") >= groups).select((F.col("key") - groups).alias("key"), "payload")
    told = _with_texts(docs, left, groups, tasks)
    pairs = told.mapInArrow(_windows(groups, buckets, length), rows)
    second = materialize(pairs.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(_sorted_pairs(groups), rows))
    return first.where(F.col("key") < groups).unionByName(second), groups


def _with_texts(docs: DataFrame, packed: DataFrame, groups: int, tasks: int) -> DataFrame:
    """Rows of key, payload, doc_id, text and docs' other columns: each group's packed runs, then its documents."""

    def keyed(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(group_of(b.column(0).to_numpy(), groups)), pa.nulls(b.num_rows, pa.binary()), *b.columns], ["key", "payload", *b.schema.names])

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("payload", T.BinaryType()), *docs.schema.fields])
    texts = docs.mapInArrow(keyed, schema)
    runs = packed.select("key", "payload", *[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema])
    return texts.union(runs).repartition(tasks, "key").sortWithinPartitions("key", F.col("doc_id").isNotNull())


def _plain(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def dedup_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row with a doc_id.

    Null text counts as empty; texts under ``length`` bytes keep all; rows that share a doc_id
    never cover one another; an empty table gives an empty result.
    """
    plain = _plain(docs)
    packed, groups = repeated_spans(plain, length)

    def run(batches):
        import pyarrow as pa

        rows = []
        for i, data, runs in _texts_with(batches, groups):
            array = np.frombuffer(data, np.uint8)
            gone = _cover(len(array), runs, length) if len(runs) else np.zeros(len(array), bool)
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + bool(len(gone) and gone[0]))
            rows.append((i, len(array), int(gone.sum()), spans, hashlib.sha256(array[~gone].tobytes()).hexdigest()))
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pydict(dict(zip(names_, zip(*rows))))
                rows = []
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(names_, zip(*rows))))

    names_ = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    told = _with_texts(plain, packed, groups, max(8, groups // 2))
    return told.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of docs with the repeated bytes cut out of text (bytes of a cut character go too).

    n_chars, where docs has it, is counted anew. Every row stays, if with less text; rows without
    doc_id and null texts stay as they are.
    """
    if not docs.columns:
        return docs
    own = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text", "n_chars")] or [F.lit(1).alias("none_")]).alias("rest_"))
    packed, groups = repeated_spans(own.select("doc_id", "text"), length)

    def cut(batches):
        import pyarrow as pa

        key, runs = None, {}
        for batch in batches:
            for some in range(0, batch.num_rows, 512):
                b = batch.slice(some, 512)
                at, texts = [], []
                for n, (k, p, i, t) in enumerate(zip(*(b.column(c).to_pylist() for c in range(4)))):
                    if k != key:
                        key, runs = k, {}
                    if p is not None:
                        _collect(p, runs)
                        continue
                    data = (t or "").encode("utf-8", "surrogatepass")
                    own = runs.get((i, zlib.crc32(data)), ())
                    if len(own):
                        array = np.frombuffer(data, np.uint8)
                        t = array[~_cover(len(array), own, length)].tobytes().decode("utf-8", "ignore")
                    at.append(n)
                    texts.append(t)
                if at:
                    kept = b.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([kept.column(2), pa.array(texts, pa.string()), kept.column(4)], ["doc_id", "text", "rest_"])

    told = _with_texts(own, packed, groups, max(8, groups // 2)).mapInArrow(cut, own.schema)
    out = []
    for f in docs.schema:
        value = F.col(f.name) if f.name in ("doc_id", "text") else F.char_length("text") if f.name == "n_chars" else F.col("rest_").getField(f.name)
        out.append(value.cast(f.dataType).alias(f.name))
    return told.select(*out).union(docs.where("doc_id is null or text is null"))
