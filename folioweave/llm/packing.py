"""Packing of documents into token sequences by exact complements, then best fit.

Pieces are cut and counted by length. The plan works on that histogram alone (``capacity`` bins,
however many documents there are): for gaps that single, pair and triple length sums fill
exactly, an index of sums gives combinations, which are consumed under the counts that remain;
what is left goes best fit. The plan names each kind of sequence by its lengths and how many
sequences it makes, so its size depends on the capacity and not on the input. Pieces then find
their places by their rank among the pieces of their length; ranks come from counts by
(length, salt), so no length needs all its pieces in one task.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import materialize, parts, row_batches

CAPACITY = 2048
#: The letters and numbers of U+0000 to U+017F once lower-cased, as the vocabulary's splitting rule has them.
_L, _N = "a-zªµºß-öø-ſ", "0-9²³¹¼½¾"
#: A line feed matches too: it stands between the chunks that are split together.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|\n|[^\s{_L}{_N}]+")
#: Texts with other characters, or with the vocabulary's control strings, go through the tokenizer whole.
_OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa0-ſ]")
#: The same by bytes: what these leave of UTF-8 needs a closer look.
_PLAIN = bytes([*range(9, 14), *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5])
_CONTROL = ("<|startoftext|>", "<|endoftext|>")
#: Chunks (between white space), and words, that a worker remembers before it lets go of those not met since half as many.
REMEMBERED = 600_000


class Memory(dict):
    """A dict that keeps what was met lately: at half its size it becomes ``old`` and starts anew."""

    old: dict = {}

    def turn(self) -> None:
        if len(self) > REMEMBERED // 2:
            self.old = dict(self)
            self.clear()

    def without(self, keys) -> list:
        """The keys that are not remembered; those that are only old are met again."""
        out = []
        for k in keys:
            x = self.old.get(k)
            if x is None:
                out.append(k)
            else:
                self[k] = x
        return out


class Encoder:
    """Ids, as little-endian 32-bit bytes, of texts.

    No token crosses white space, so texts are cut there and each chunk's ids are remembered. New
    chunks of a batch are split into words by the vocabulary's rule, and only new words are encoded.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.chunks, self.words = Memory(), Memory()
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def plain(text: str) -> bool:
        """Whether the text may be cut at white space."""
        try:
            data = text.encode()
        except UnicodeEncodeError:
            return False
        return not (data.translate(None, _PLAIN) and _OTHER.search(text)) and not ("<|" in text and any(c in text for c in _CONTROL))

    def learn(self, new: list[str]) -> None:
        """Remember the ids of chunks."""
        words = _SPLIT.findall(unicodedata.normalize("NFC", "\n".join(new)).lower())
        known = self.words
        known.turn()
        some = known.without({w for w in words if w not in known and w != "\n"})
        if some:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1  # each word's last id is marked as such in the vocabulary
            data, at = ids.tobytes(), 0
            for w, end in zip(some, (4 * ends).tolist()) if len(ends) == len(some) else ():
                known[w] = data[at:end]
                at = end
            for w in some if len(ends) != len(some) else ():
                known[w] = self.whole(w)
        chunks, own = iter(new), []
        for w in words:
            if w == "\n":
                self.chunks[next(chunks)] = b"".join(own)
                own = []
            else:
                own.append(known[w])
        self.chunks[next(chunks)] = b"".join(own)

    def many(self, texts):
        """The ids of each text of an Arrow array (null: empty), as arrays."""
        import pyarrow as pa
        import pyarrow.compute as pc

        self.chunks.turn()
        texts = texts.fill_null("")
        odd = {i: t for i, t in enumerate(texts.to_pylist()) if not self.plain(t)}
        if odd:
            texts = pc.if_else(pa.array([i not in odd for i in range(len(texts))]), texts, "")
        lists = pc.ascii_split_whitespace(texts)
        named = lists.flatten().dictionary_encode()
        own, code = named.dictionary.to_numpy(zero_copy_only=False).tolist(), named.indices.to_numpy()
        known = self.chunks
        ids = list(map(known.get, own))
        if None in ids:
            new = known.without([c for c, x in zip(own, ids) if x is None])
            if new:
                self.learn(new)
            ids = list(map(known.__getitem__, own))
        size = np.array([len(x) // 4 for x in ids], np.int64)
        start = (np.cumsum(size) - size)[code]
        much = size[code]
        end = np.cumsum(much)
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(start - end + much, much) + np.arange(end[-1] if len(end) else 0)]
        edge = np.r_[0, end][np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]].tolist()
        return [np.frombuffer(self.whole(odd[i]), "<u4") if i in odd else flat[edge[i] : edge[i + 1]] for i in range(len(texts))]

    def __call__(self, text: str) -> bytes:
        import pyarrow as pa

        return self.many(pa.array([text]))[0].tobytes()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and ``end_id``, cut only where
    longer than the capacity. ``vocabulary`` is a file that every executor has; by default the
    installed public one. Null text counts as empty and makes one piece of length 1."""

    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = Encoder(vocabulary or default_vocabulary()), np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in row_batches(batches, 4 << 20):
            out = []
            for i, own in zip(batch.column(0).to_pylist(), encode.many(batch.column(1))):
                ids = own.tobytes() + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "piece" else pa.int64()) for n, c in zip(names, cols)], names)

    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences (their lengths, how many of them) that use up the counts of lengths."""
    left = {n: c for n, c in counts.items() if c > 0}
    plan: list[tuple[tuple[int, ...], int]] = []
    if left.pop(capacity, 0):
        plan.append(((capacity,), counts[capacity]))
    live = sorted(left)

    def use(kind: tuple[int, ...], most: int | None = None) -> int:
        need: dict[int, int] = {}
        for n in kind:
            need[n] = need.get(n, 0) + 1
        if any(left.get(n, 0) < k for n, k in need.items()):
            return 0
        times = min(left[n] // k for n, k in need.items())
        times = times if most is None else min(times, most)
        for n, k in need.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
                live.pop(bisect_left(live, n))
        plan.append((kind, times))
        return times

    # the index of sums: for the longest length, gaps that one, two or three lengths fill exactly
    for big in range(capacity - 1, 0, -1):
        if big not in left:
            continue
        gap = capacity - big
        if gap in left:
            use((big, gap))
        # pairs: a + b = gap, the longer one first, so that short lengths stay for later
        if big in left:
            for a in live[bisect_left(live, (gap + 1) // 2) : bisect_left(live, gap)][::-1]:
                if big not in left:
                    break
                if a in left and gap - a in left:
                    use((big, a, gap - a))
        # triples: a + b + c = gap
        if big in left:
            for a in live[bisect_left(live, -(-gap // 3)) : bisect_left(live, gap)][::-1]:
                if big not in left:
                    break
                rest = gap - a
                for b in live[bisect_left(live, (rest + 1) // 2) : bisect_left(live, min(a, rest - 1) + 1)][::-1]:
                    if big not in left or a not in left:
                        break
                    if b in left and rest - b in left:
                        use((big, a, b, rest - b))
        # what no exact sum takes: best fit, the longest length that still fits each gap
        while big in left:
            kind, room = [big], gap
            taken = {big: 1}
            while room:
                at = bisect_left(live, room + 1) - 1
                while at >= 0 and left[live[at]] - taken.get(live[at], 0) <= 0:
                    at -= 1
                if at < 0:
                    break
                n = live[at]
                kind.append(n)
                taken[n] = taken.get(n, 0) + 1
                room -= n
            use(tuple(kind))
    return plan


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length and other columns, whatever their names)."""
    own, cut = cut.columns, cut.select("length", F.struct(*[F.col(f"`{c}`") for c in cut.columns]).alias("own"))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("own.doc_id", "own.piece"), F.lit(parts(cut, 2, 64, 20_000))))
    held = salted.groupBy("length", "salt").count()
    total = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = held.withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).drop("count")
    rows, used, first = [], {}, 0
    for kind, times in plan_sequences(total, capacity):
        offset = 0
        for n in kind:
            rows.append((n, used.get(n, 0), first, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        first += times
    ranked = salted.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("length", "salt").orderBy("own.doc_id", "own.piece", "own.ids_crc32")) - 1)

    # each length's steps: from a rank on, sequences from a number on, at an offset
    by: dict[int, tuple] = {}
    for n, *step in rows:
        by.setdefault(n, []).append(step)
    by = {n: tuple(np.array(c, np.int64) for c in zip(*steps)) for n, steps in by.items()}

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                ranks, firsts, offsets = by[int(n)]
                k = np.searchsorted(ranks, rank[at], "right") - 1
                seq[at], off[at] = firsts[k] + rank[at] - ranks[k], offsets[k]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(seq), pa.array(off)], ["own", "sequence_id", "offset"])

    out = ranked.select("own", "length", "rank").mapInArrow(place, T.StructType([cut.schema["own"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    return out.select(*[F.col("own").getField(c).alias(c) for c in own if c not in ("sequence_id", "offset")], "sequence_id", "offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = materialize(pieces(docs, capacity, vocabulary))
    return placed(cut, capacity)
