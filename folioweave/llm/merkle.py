"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces.

Leaves are pieces of a paragraph, cut after words that end in a content-defined place (about
every PIECE_WORDS words; where no space comes for long, at such a place of the bytes), so an edit
changes the leaves it touches and no others. A piece of more than MOST bytes is cut on from its
start, at the first space after LEAST bytes or at MOST bytes, so a leaf is never longer; the next
content-defined place brings edited and unedited texts together again. Lines are paragraphs; a section ends at a blank line
or after a paragraph whose hash says so. A leaf's hash is that of its bytes, any other node's the
128-bit hash of its children's whole hashes, up to the root. Equal roots mean equal texts; for
others, equal sections are passed over and the leaves of differing branches tell how alike two
texts are and where they differ.

A fingerprint is ``root/section;section...``, a section ``hash:paragraph,paragraph...``, a
paragraph ``hash.leaves``; hashes below the root are written short.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import parts, row_batches

PIECE_WORDS = 6
SECTION_PARAGRAPHS = 6
LEAF = 6
#: Bytes without a space after which a leaf may end anywhere, and about how many more it then takes.
UNSPACED, UNSPACED_PIECE = 48, 16
#: Bytes of a leaf: none is longer than MOST, and one cut for its length is longer than LEAST.
LEAST, MOST = 40, 80
#: Hexadecimal digits of the hashes of sections and paragraphs as written.
SHORT = 8
_EMPTY = "0" * 32 + "/"


def leaf_ends(data: bytes) -> list[int]:
    """Where the leaves of a text that is not empty end."""
    b = np.frombuffer(data, np.uint8)
    w = np.zeros(len(b) + 4, np.uint32)
    w[4:] = b
    tail = w[4:] + w[3:-1] * np.uint32(257) + w[2:-2] * np.uint32(66049) + w[1:-3] * np.uint32(16974593)
    tail = (tail * np.uint32(2654435761)) >> np.uint32(16)
    line, space = b == 10, b == 32
    at = np.arange(len(b), dtype=np.int64)
    far = at - np.maximum.accumulate(np.where(line | space, at, 0)) > UNSPACED
    cut = np.flatnonzero(line | (space & (tail % np.uint32(PIECE_WORDS) == 0)) | (far & (tail % np.uint32(UNSPACED_PIECE) == 0))) + 1
    if not len(cut) or cut[-1] != len(b):
        cut = np.append(cut, len(b))
    long = np.flatnonzero(np.diff(cut, prepend=0) > MOST)
    if not len(long):
        return cut.tolist()
    spaces = np.flatnonzero(space)
    more = []
    for i in long:
        at, end = int(cut[i - 1]) if i else 0, int(cut[i])
        while end - at > MOST:
            k = np.searchsorted(spaces, at + LEAST)
            at = min(int(spaces[k]) + 1 if k < len(spaces) else end, at + MOST)
            more.append(at)
    return np.sort(np.concatenate([cut, more])).tolist()


def fingerprint(text: str) -> str:
    """The fingerprint of a whole text; an empty text has no sections."""
    import xxhash

    if not text:
        return _EMPTY
    data = text.encode("utf-8", "surrogatepass")
    digest, node, at = xxhash.xxh3_64_hexdigest, xxhash.xxh3_128_hexdigest, 0
    sections: list[tuple[str, str]] = []
    paragraphs: list[tuple[str, str]] = []
    leaves: list[str] = []

    def close() -> None:
        if paragraphs:
            own = node("".join(h for h, _ in paragraphs))
            sections.append((own, f"{own[:SHORT]}:" + ",".join(p for _, p in paragraphs)))
            paragraphs.clear()

    for end in leaf_ends(data):
        leaves.append(digest(data[at:end]))
        last = data[end - 1] == 10
        blank = last and end - at == 1 and len(leaves) == 1
        at = end
        if last or end == len(data):
            own = node("".join(leaves))
            paragraphs.append((own, f"{own[:SHORT]}." + "".join([x[:LEAF] for x in leaves])))
            leaves.clear()
            if blank or int(own[:8], 16) % SECTION_PARAGRAPHS == 0:
                close()
    close()
    return node("".join(h for h, _ in sections)) + "/" + ";".join(x for _, x in sections)


def leaves_of(section: str) -> list[str]:
    """The short hashes of a section's leaves."""
    out = []
    for p in section.partition(":")[2].split(","):
        own = p.partition(".")[2]
        out += [own[i : i + LEAF] for i in range(0, len(own), LEAF)]
    return out


def sections_of(mark: str) -> list[str]:
    return [x for x in mark.partition("/")[2].split(";") if x]


def likeness(a: str, b: str) -> float:
    """0 to 1: 1 for equal roots, else the share of leaves (with repeats) that the trees have in common."""
    if a.partition("/")[0] == b.partition("/")[0]:
        return 1.0
    one, two = (Counter(sections_of(f)) for f in (a, b))
    both = one & two
    shared = sum(len(leaves_of(s)) * n for s, n in both.items())
    rest = []
    total = 2 * shared
    for side in (one - both, two - both):
        own = Counter()
        for s, n in side.items():
            for leaf in leaves_of(s):
                own[leaf] += n
        rest.append(own)
        total += sum(own.values())
    shared += sum((rest[0] & rest[1]).values())
    return min(2 * shared / total, 1.0 - 1e-6) if total else 0.0


def differing_sections(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the sections of each fingerprint that the other lacks: where the edits are."""
    one, two = sections_of(a), sections_of(b)
    has_one, has_two = set(one), set(two)
    return [i for i, s in enumerate(one) if s not in has_two], [i for i, s in enumerate(two) if s not in has_one]


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by the first as many code points of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id and text's fingerprint for every row with a doc_id; a null text counts as empty."""

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t or "") for t in batch.column(1).to_pylist()])], ["doc_id", "fingerprint"])

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def edit_report(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text and the next document, in descending order of doc_id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Rows
    are cut into ranges of doc_id; the first document of a range also visits the range before it,
    so nothing needs one task for all rows. Null text counts as empty; rows that share a doc_id
    are ordered by text; a single row follows itself; an empty table gives an empty result; other
    columns are not looked at.
    """
    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = plain.select("doc_id")
    n = parts(docs, 4, 16, 20_000)
    found = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"] or []
    splits = -np.array(sorted(set(found), reverse=True), np.int64)  # range 0 has the largest ids

    def range_of(doc_id):
        return np.searchsorted(splits, -doc_id, "left").astype(np.int32)

    def ranges(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(range_of(b.column(0).to_numpy()))], ["doc_id", "at"])

    tops = {r["at"]: r["top"] for r in ids.mapInArrow(ranges, "doc_id long, at int").groupBy("at").agg(F.max("doc_id").alias("top")).collect()}  # one row per range
    order = sorted(tops)
    visits = {tops[r]: order[i - 1] for i, r in enumerate(order)}
    heads = np.array(sorted(visits), np.int64)

    def deal(batches):
        import pyarrow as pa

        for b in batches:
            doc_id = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(range_of(doc_id)), pa.array(np.zeros(len(doc_id), bool)), *b.columns], ["at", "visitor", "doc_id", "text"])
            some = np.flatnonzero(np.isin(doc_id, heads))
            if len(some):
                own = b.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([pa.array([visits[i] for i in doc_id[some]], pa.int32()), pa.array(np.ones(len(some), bool)), *own.columns], ["at", "visitor", "doc_id", "text"])

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        import pyarrow as pa

        waiting, out = None, []
        for batch in row_batches(batches, 4 << 20):
            for at, visitor, i, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if visitor and (waiting is None or waiting[0] != at):
                    continue  # a further visitor
                own = fingerprint(text)
                if waiting is not None:
                    _, j, before, mark = waiting
                    new = edited(before, text)
                    new_mark = mark if new == before else fingerprint(new)
                    out.append((j, len(before), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mark, new_mark, likeness(mark, new_mark), likeness(mark, own)))
                waiting = None if visitor else (at, i, text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []

    dealt = plain.mapInArrow(deal, "at int, visitor boolean, doc_id long, text string").repartition(n, "at").sortWithinPartitions("at", "visitor", F.desc("doc_id"), F.desc("text"))
    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
