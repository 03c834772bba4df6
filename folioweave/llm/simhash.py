"""SimHash near-duplicates: fingerprints, a binary-trie self-join and connected components.

Two fingerprints link when at most ``max_bits`` bits differ. The 64 bits are cut into more
blocks than that budget, so a linked pair agrees exactly on some of the blocks (pigeonhole).
For each choice of blocks, fingerprints that agree on it form the sub-trie below one prefix
(bits are permuted so that the chosen blocks lead). Inside a sub-trie, pairs of trie nodes are
walked together, differing bits add up, and a pair is pruned when they exceed the budget. No
list of all pairs of a group leaves a task: each task sends a spanning forest of its links.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import acos, ceil, comb, pi

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize, row_batches

MAX_BITS = 4
SHINGLE_WORDS = 4
#: A sub-trie of more fingerprints than this is cut into pairs of smaller sub-tries.
HOT_SUBTRIE = 60_000
#: Bits by which a hot sub-trie is cut.
HOT_BITS = 5
#: Fingerprints a document gets where links are checked: a pair of similarity 0.8 lies within the bits in one of them.
TRIES = 3
#: Members of a group of candidates, beside the smallest, against which the others are checked at first.
PIVOTS = 3
#: A hash that more classes than this have among their rarest links them all as candidates.
HOT_SHINGLE = 4000
#: One document in so many is looked at for frequent shingles; so often the sample must hold one; the most that are told to tasks.
FREQUENT_SHARE, FREQUENT_LEAST, FREQUENT_MOST = 64, 4, 100_000
#: Shingles in a chunk of members that are compared with those of another chunk.
CHUNK = 1 << 18


def shingle_hashes(data: bytes, words_per_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each word shingle of UTF-8 bytes, repeats included; empty if there is no word."""
    import xxhash

    words = data.lower().split()  # bytes: A-Z only, and exactly the bytes 09-0D and 20
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= words_per_shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)][words_per_shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; 0 if there is none."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        some = hashes[i : i + 8192]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def fingerprint_bytes(data: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 bytes; 0 if there is no word."""
    return majority_bits(shingle_hashes(data, words_per_shingle))


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long). Null text counts as empty; rows without doc_id are left out."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            fps = np.array([fingerprint_bytes((t or "").encode("utf-8", "surrogatepass"), words_per_shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def block_plan(n: int, max_bits: int = MAX_BITS) -> list[list[tuple[int, int, bool]]]:
    """For each choice of blocks: (shift, width, chosen) of all blocks, the chosen ones first.

    More blocks give longer shared prefixes and more copies of each fingerprint. Of the plans,
    which are all exact, the one with the least work is used: rows dealt out and, at a hundredth
    of a row each, leaves below one prefix compared.
    """
    def work(blocks: int) -> float:
        keep = blocks - max_bits
        return comb(blocks, keep) * n * (1 + 0.01 * n / 2 ** (keep * (64 // blocks)))

    blocks = min(range(max_bits + 1, max_bits + 5), key=work)
    keep = blocks - max_bits
    widths = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    shifts = [sum(widths[:i]) for i in range(blocks)]
    out = []
    for chosen in combinations(range(blocks), keep):
        order = [*chosen, *(i for i in range(blocks) if i not in chosen)]
        out.append([(shifts[i], widths[i], i in chosen) for i in order])
    return out


def _unchosen_masks(plan: list[tuple[int, int, bool]]) -> list:
    """Masks, in the moved key, of the blocks that come before the last chosen one and are not chosen."""
    last = max(shift for shift, _, chosen in plan if chosen)
    left, out = 64, []
    for shift, width, chosen in plan:
        left -= width
        if not chosen and shift < last:
            out.append(np.uint64(((1 << width) - 1) << left))
    return out


class Forest:
    """Union-find over 0..n-1 that takes arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def prefix_starts(keys: np.ndarray, lead: int) -> tuple:
    """The node pairs (u, u) of depth lead that hold more than one of the sorted keys."""
    top = keys >> np.uint64(64 - lead)
    cut = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    end = np.r_[cut[1:], len(keys)]
    big = end - cut > 1
    return lead, cut[big], end[big], cut[big], end[big], np.zeros(int(big.sum()), np.int8)


def trie_pairs(keys: np.ndarray, starts: tuple, max_bits: int, chunk: int = 400_000):
    """Walk pairs of trie nodes over sorted keys; yield arrays of linked leaves (i, j), i < j.

    ``starts``: depth, node pairs as ranges of keys, and the bits by which they differ so far.
    At most ``chunk`` node pairs are expanded at a time.
    """
    stack = [starts]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > chunk:
            stack.append((depth, alo[chunk:], ahi[chunk:], blo[chunk:], bhi[chunk:], diff[chunk:]))
            alo, ahi, blo, bhi, diff = alo[:chunk], ahi[:chunk], blo[:chunk], bhi[:chunk], diff[:chunk]
        if not len(alo):
            continue
        # few leaves on both sides: compare them at once
        na, nb = ahi - alo, bhi - blo
        small = na * nb <= 36
        if small.any():
            sa, la, sb, lb = alo[small], na[small], blo[small], nb[small]
            total = la * lb
            at = np.repeat(np.arange(len(sa)), total)
            k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            i, j = sa[at] + k // lb[at], sb[at] + k % lb[at]
            ok = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= max_bits)
            yield i[ok], j[ok]
            keep = ~small
            alo, ahi, blo, bhi, diff = alo[keep], ahi[keep], blo[keep], bhi[keep], diff[keep]
        if not len(alo):
            continue
        if depth >= 64:  # all leaves of a node have one key
            for a, b, c, d in zip(alo.tolist(), ahi.tolist(), blo.tolist(), bhi.tolist()):
                for i in range(a, b):
                    j = np.arange(max(i + 1, c), d)
                    yield np.full(len(j), i), j
            continue
        if depth not in ones:
            ones[depth] = np.r_[0, np.cumsum((keys >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)]
        count = ones[depth]
        amid, bmid = ahi - (count[ahi] - count[alo]), bhi - (count[bhi] - count[blo])
        same = alo == blo
        kids = [(alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1)]
        cross = ~same
        kids.append(tuple(x[cross] for x in (amid, ahi, blo, bmid, diff + 1)))
        new = [np.concatenate([k[i] for k in kids]) for i in range(5)]
        ok = (new[1] > new[0]) & (new[3] > new[2]) & (new[4] <= max_bits) & ~((new[0] == new[2]) & (new[1] - new[0] == 1))
        stack.append((depth + 1, *(x[ok] for x in new)))


def trie_links(keys: np.ndarray, starts: tuple, max_bits: int, forest: Forest, chunk: int = 400_000) -> None:
    """Join in forest the leaves that trie_pairs() links."""
    for a, b in trie_pairs(keys, starts, max_bits, chunk):
        forest.join(a, b)


def spanning_links(classes: DataFrame, max_bits: int = MAX_BITS, n: int | None = None, hot: int = HOT_SUBTRIE, least_ratio: float | None = None) -> DataFrame:
    """a, b: representatives whose links span every group of fingerprints.

    ``classes`` has fp (distinct) and rep. Rows of one prefix go to one task. A prefix with more
    than ``hot`` fingerprints is cut by its next bits into sub-tries, and each pair of those
    whose own bits differ by no more than the budget becomes a task of its own.

    With ``least_ratio``, classes has label and size beside, fp may repeat, and every link (not a
    spanning forest) comes once, where the labels differ and the lesser size is at least
    ``least_ratio`` of the greater.
    """
    n = classes.count() if n is None else n
    extra = [] if least_ratio is None else ["label", "size"]
    plans = block_plan(n, max_bits)
    leads = [sum(width for _, width, chosen in p if chosen) for p in plans]
    lead_of = F.get(F.array(*map(F.lit, leads)), F.col("plan"))
    n_parts = int(max(8, min(100_000, n * len(plans) / 400_000)))

    def dealt(batches):
        """Each row once per plan, with its bits moved so that the plan's chosen blocks lead."""
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for i, plan in enumerate(plans):
                key, left = np.zeros(len(fp), np.uint64), 64
                for shift, width, _ in plan:
                    left -= width
                    key |= ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)) << np.uint64(left)
                prefix = key >> np.uint64(64 - leads[i])
                moved = [pa.array(np.full(len(fp), i, np.int32)), pa.array(key.view(np.int64)), pa.array(prefix.view(np.int64))]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *moved], ["rep", *extra, "plan", "key", "prefix"])

    longs = ", ".join(f"{c} long" for c in ("rep", *extra))
    rows = classes.select("fp", "rep", *extra).repartition(n_parts, "rep").mapInArrow(dealt, f"{longs}, plan int, key long, prefix long")
    heavy = rows.groupBy("plan", "prefix").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > hot).select("plan", "prefix")
    has_heavy = n > hot and heavy.limit(1).count() > 0
    schema = "a long, b long"
    first_choice = [_unchosen_masks(p) for p in plans]

    def linked(table, order, key, plan, starts):
        """Batches of the links among the rows of table at order, whose sorted keys are key."""
        import pyarrow as pa

        rep = table["rep"].to_numpy()[order]
        if least_ratio is None:
            forest = Forest(len(order))
            if starts:
                trie_links(key, starts, max_bits, forest)
            yield batch_of(rep, forest)
            return
        label, size = table["label"].to_numpy()[order], table["size"].to_numpy()[order]
        for a, b in trie_pairs(key, starts, max_bits) if starts else ():
            ok = (label[a] != label[b]) & (np.minimum(size[a], size[b]) >= least_ratio * np.maximum(size[a], size[b]) - 1e-9)
            a, b = a[ok], b[ok]
            for mask in first_choice[plan]:  # a pair that agrees on more blocks counts in its first choice of them
                ok = (key[a] ^ key[b]) & mask != 0
                a, b = a[ok], b[ok]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(rep[a], rep[b])), pa.array(np.minimum(rep[a], rep[b]))], ["a", "b"])

    def batch_of(reps, forest):
        import pyarrow as pa

        linked = np.flatnonzero(forest.label != np.arange(len(reps)))
        return pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[forest.label[linked]])], ["a", "b"])

    def whole(batches):
        import pyarrow as pa

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        plan, key = t["plan"].to_numpy(), t["key"].to_numpy().view(np.uint64)
        for p in np.unique(plan):
            at = np.flatnonzero(plan == p)
            order = at[np.argsort(key[at])]
            yield from linked(t, order, key[order], p, prefix_starts(key[order], leads[p]))

    cold = rows.join(heavy, ["plan", "prefix"], "left_anti") if has_heavy else rows
    links = cold.repartition(n_parts, "plan", "prefix").select("rep", *extra, "plan", "key").mapInArrow(whole, schema)
    if not has_heavy:
        return links
    nodes = range(1 << HOT_BITS)
    per_node = F.array(*[F.array(*[F.struct(F.lit(min(u, v)).alias("u"), F.lit(max(u, v)).alias("v")) for v in nodes if (u ^ v).bit_count() <= max_bits]) for u in nodes])
    node = F.call_function("shiftrightunsigned", F.call_function("shiftleft", F.col("key"), lead_of), F.lit(64 - HOT_BITS)).cast("int")
    cut = rows.join(heavy, ["plan", "prefix"]).withColumn("node", node).withColumn("pair", F.explode(F.get(per_node, F.col("node"))))

    def pair_of(t):
        import pyarrow as pa

        key = t["key"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        key, n, plan, starts = key[order], len(order), t["plan"][0].as_py(), None
        u, v = t["u"][0].as_py(), t["v"][0].as_py()
        deep = leads[plan] + HOT_BITS
        mid = n if u == v else int((t["node"].to_numpy() == u).sum())
        one = lambda *x: [np.array([i]) for i in x]
        if 0 < mid and (u == v or mid < n):
            starts = (deep, *one(0, n, 0, n), np.zeros(1, np.int8)) if u == v else (deep, *one(0, mid, mid, n), np.array([(u ^ v).bit_count()], np.int8))
        return pa.Table.from_batches(list(linked(t, order, key, plan, starts)), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return links.unionByName(cut.select("rep", *extra, "plan", "key", "prefix", "node", "pair.u", "pair.v").groupBy("plan", "prefix", "u", "v").applyInArrow(pair_of, schema))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest id that each linked id reaches.

    Alternating large-star and small-star steps; each step is a group minimum joined back, so
    no node's neighbours are gathered. Steps are written to the shared folder.
    """
    edges = materialize(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        old, edges = edges, materialize(small)
        discard(old)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, words_per_shingle: int = SHINGLE_WORDS, hot: int = HOT_SUBTRIE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, for every row of docs with a doc_id.

    Empty or null text: fingerprint zero, linked like any other. Equal fingerprints form one
    class; a repeated row gets its result twice. An empty table gives an empty result.
    """
    sigs = materialize(fingerprints(docs, words_per_shingle))
    classes = materialize(sigs.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(spanning_links(classes, max_bits, hot=hot))
    named = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return sigs.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def bits_of_similarity(similarity: float) -> int:
    """Bits by which SimHash fingerprints are expected to differ at a Jaccard similarity of shingles, rounded up."""
    return ceil(64 * acos(2 * similarity / (1 + similarity)) / pi)


def frequent_shingles(docs: DataFrame, words_per_shingle: int) -> np.ndarray:
    """Sorted hashes of the shingles that a sample of documents holds most often; they order work and change no result."""

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 8 << 20):
            sets = [np.unique(shingle_hashes((t or "").encode("utf-8", "surrogatepass"), words_per_shingle)) for t in batch.column(1).to_pylist()]
            h, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(FREQUENT_SHARE)) == 0).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "h long, n long")
    found = some.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_LEAST).orderBy(F.desc("n"), "h").limit(FREQUENT_MOST).select("h").toArrow()  # a bounded list, as one column
    return np.sort(found["h"].to_numpy().astype(np.int64).view(np.uint64))


def rarest(distinct: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """The first of a set of hashes in an order that all sets share, frequent ones last.

    So many that two sets of that Jaccard similarity have one of these in common: without them
    a set is too small to hold the share of it that must lie in both.
    """
    if not len(distinct):
        return distinct
    last = frequent[np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)] == distinct if len(frequent) else np.zeros(len(distinct), bool)
    return np.r_[distinct[~last], distinct[last]][: len(distinct) - ceil(similarity * len(distinct) - 1e-6) + 1]


def signatures(docs: DataFrame, words_per_shingle: int, tries: int, similarity: float, frequent: np.ndarray) -> DataFrame:
    """doc_id, fps (``tries`` fingerprints), digest (of the set of shingles), size (of that set), rare (its rarest() hashes)."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in row_batches(batches, 8 << 20):
            fps, digests, sizes, rare = [], [], [], []
            for t in batch.column(1).to_pylist():
                hashes = shingle_hashes((t or "").encode("utf-8", "surrogatepass"), words_per_shingle)
                fps.append([np.uint64(majority_bits(remixed(hashes, i))).view(np.int64) for i in range(tries)])
                distinct = np.unique(hashes)
                digests.append(xxhash.xxh3_128_hexdigest(distinct.tobytes()))
                sizes.append(len(distinct))
                rare.append(rarest(distinct, similarity, frequent).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.list_(pa.int64())), pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), pa.array(rare, pa.list_(pa.int64()))], ["doc_id", "fps", "digest", "size", "rare"])

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fps array<long>, digest string, size long, rare array<long>")


def remixed(hashes: np.ndarray, i: int) -> np.ndarray:
    """The hashes for fingerprint i: as they are for 0, else added to, multiplied and folded."""
    if i == 0:
        return hashes
    x = (hashes + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(docs: DataFrame, nodes: DataFrame, words_per_shingle: int) -> DataFrame:
    """node, shingles (the set of hashes) of the documents in nodes; a doc_id with several texts has several sets."""

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 8 << 20):
            sets = [np.unique(shingle_hashes((t or "").encode("utf-8", "surrogatepass"), words_per_shingle)).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node", "left_semi")
    return texts.distinct().mapInArrow(run, "node long, shingles array<long>")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float, hot: int = 500) -> DataFrame:
    """The rows (a, b) of pairs whose shingle sets have that Jaccard similarity or more.

    A node with more than ``hot`` partners gets its set copied once per ``hot`` of them, so its
    pairs spread over tasks.
    """
    for key, other in ("a", "b"), ("b", "a"):
        many = pairs.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / hot).alias("salts")).where("salts > 1").withColumnRenamed(key, "node")
        copies = sets.join(many, "node", "left").select("node", F.col("shingles").alias(f"set_{key}"), F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
        spread = pairs.join(many, pairs[key] == many["node"], "left").withColumn("salt", F.pmod(F.xxhash64(other), F.coalesce("salts", F.lit(1)))).drop("node", "salts")
        pairs = spread.join(copies, (spread[key] == copies["node"]) & (spread["salt"] == copies["salt"])).drop("node", "salt")
    sizes = F.size("set_a") + F.size("set_b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    near = F.least(F.size("set_a"), F.size("set_b")) >= similarity * F.greatest(F.size("set_a"), F.size("set_b")) - 1e-9
    return pairs.where(near & (both >= similarity * (sizes - both) - 1e-9)).select("a", "b").distinct()


def _shared(batches):
    """Of rows sorted by their first column, a long, those that do not have its value alone."""
    import pyarrow as pa

    held, known = None, False  # the last row, and whether the one before it has its value
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        h = t.column(0).to_numpy()
        same = h[1:] == h[:-1]
        keep = np.r_[known, same] | np.r_[same, False]
        held, known = t.slice(len(h) - 1).to_batches()[0], bool(keep[-1])
        yield from t.slice(0, len(h) - 1).filter(pa.array(keep[:-1])).to_batches()
    if known:
        yield held


def _candidates(similarity: float, max_bits: int, hot: int, rows: int = 1 << 16, chunk: int = 1 << 20):
    """For rows (h, rep, size, fps) sorted by h: a, b, a spanning forest of the pairs of one h that may be similar."""

    def linked(h, rep, size, fps, wide):
        import pyarrow as pa

        reps, at = np.unique(rep, return_inverse=True)
        forest = Forest(len(reps))
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        n = np.diff(np.r_[first, len(h)])
        star = np.repeat((n > hot) | (h[first] == wide if wide is not None else False), n)
        forest.join(at[np.repeat(first, n)[star]], at[star])
        last = np.where(star, 0, np.repeat(first + n, n) - np.arange(len(h)) - 1)  # partners after each row
        done = np.r_[0, np.cumsum(last)]
        i = 0
        while i < len(h):
            j = max(i + 1, int(np.searchsorted(done, done[i] + chunk, "right")) - 1)
            x = np.repeat(np.arange(i, j), last[i:j])
            y = x + 1 + np.arange(len(x)) - np.repeat(done[i:j] - done[i], last[i:j])
            i = j
            ok = forest.label[at[x]] != forest.label[at[y]]
            x, y = x[ok], y[ok]
            ok = np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y]) - 1e-9
            x, y = x[ok], y[ok]
            ok = (np.bitwise_count(fps[x] ^ fps[y]) <= max_bits).any(1)
            forest.join(at[x[ok]], at[y[ok]])
        some = np.flatnonzero(forest.label != np.arange(len(reps)))
        return pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(reps[forest.label[some]])], ["a", "b"])

    def run(batches):
        held, size, wide = [], 0, None  # columns of the rows at hand; an h whose rows come in several parts

        def joined():
            return [np.concatenate(c) for c in zip(*held)]

        for batch in batches:
            if not batch.num_rows:
                continue
            h, rep, sizes = (batch.column(c).to_numpy() for c in range(3))
            held.append((h, rep, sizes, batch.column(3).flatten().to_numpy().view(np.uint64).reshape(len(h), -1)))
            size += len(h)
            if size < rows:
                continue
            cols = joined()
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            if cut:
                yield linked(*(c[:cut] for c in cols), wide)
                wide, cols = None, [c[cut:] for c in cols]
            if len(cols[0]) > hot:  # what is still to come of this h is linked with its first row
                wide = cols[0][0]
                yield linked(*cols, wide)
                cols = [c[:1] for c in cols]
            held, size = [cols], len(cols[0])
        if held:
            yield linked(*joined(), wide)

    return run


def candidate_links(sigs: DataFrame, classes: DataFrame, similarity: float, max_bits: int, hot: int = HOT_SHINGLE) -> DataFrame:
    """a, b: representatives whose links span every group of classes that may be similar.

    Linked are classes that have one of their rarest() hashes in common, sizes that allow the
    similarity, and fingerprints that differ by at most max_bits in any try. A hash that more
    than ``hot`` classes have so links them all, which joins groups and loses no pair.
    """
    entries = sigs.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi").select(F.explode("rare").alias("h"), F.col("doc_id").alias("rep"))
    n = classes.agg(F.sum("size")).first()[0] or 0
    n_parts = int(max(8, min(100_000, n * (1 - similarity) / 400_000)))
    shared = entries.repartition(n_parts, "h").sortWithinPartitions("h").mapInArrow(_shared, "h long, rep long")
    known = shared.join(classes.select("rep", "size", "fps"), "rep").select("h", "rep", "size", "fps")
    return known.repartition(n_parts, "h").sortWithinPartitions("h").mapInArrow(_candidates(similarity, max_bits, hot), "a long, b long")


def links_across(members: DataFrame, sets: DataFrame, similarity: float, chunk: int = CHUNK) -> DataFrame:
    """a, b: labels whose links span all labels of a component that similar sets connect.

    ``members`` has component, label, node and size. The members of a component are cut into
    chunks of about ``chunk`` shingles and each pair of chunks is compared whole in a task, which
    sends a spanning forest; no pair of members becomes a row. A label that fills a chunk has
    chunks of its own, which are not compared with one another.
    """
    load = F.col("size") + 256
    held = members.groupBy("component", "label").agg(F.sum(load).alias("own")).withColumn("alone", F.col("own") >= chunk)
    pooled = held.groupBy("component").agg(F.sum(F.when(~F.col("alone"), F.col("own")).otherwise(0)).alias("pooled"))
    lead, parts = F.when(F.col("alone"), F.col("label")), F.ceil(F.when(F.col("alone"), F.col("own")).otherwise(F.col("pooled")) / chunk)
    placed = held.join(pooled, "component").select("component", "label", lead.alias("lead"), parts.alias("parts"))
    name = F.concat_ws(" ", F.coalesce(F.col("lead").cast("string"), F.lit("-")), F.col("part").cast("string"))
    chunks = placed.select("component", "lead", "parts").distinct().select("component", "lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).select("component", "lead", name.alias("x"))
    other = chunks.select("component", F.col("lead").alias("lead_y"), F.col("x").alias("y"))
    pairs = chunks.join(other, "component").where("x <= y and not coalesce(lead = lead_y, false)").select("component", "x", "y")
    own = members.join(placed, ["component", "label"]).withColumn("part", F.pmod(F.xxhash64(F.when(F.col("lead").isNull(), F.col("label")).otherwise(F.col("node"))), F.col("parts"))).select("component", "label", "node", name.alias("own"))
    sides = [own.join(pairs.withColumn("own", F.col(c)), ["component", "own"]).select("component", "x", "y", F.lit(c == "y").alias("right"), "label", "node") for c in ("x", "y")]
    sent = sides[0].unionByName(sides[1].where("x != y")).join(sets, "node").select("component", "x", "y", "right", "label", "shingles")

    def compared(t):
        import pyarrow as pa

        right, size = t["right"].to_numpy(), np.array([len(x) for x in t["shingles"]], np.int64)
        names, label = np.unique(t["label"].to_numpy(), return_inverse=True)
        vocabulary, flat = np.unique(t["shingles"].combine_chunks().flatten().to_numpy(), return_inverse=True)
        start = np.cumsum(size) - size
        order = np.flatnonzero(size > 0)
        order = order[np.argsort(size[order], kind="stable")]
        two = bool(right.any())
        left, against = (order[~right[order]], order[right[order]]) if two else (order, order)
        ids = np.concatenate([flat[start[j] : start[j] + size[j]] for j in against]) if len(against) else flat[:0]
        sizes, forest, mark = size[against], Forest(len(names)), np.zeros(len(vocabulary), bool)
        begin = np.cumsum(sizes) - sizes
        for k, i in enumerate(left.tolist()):
            low = int(np.searchsorted(sizes, similarity * size[i] - 1e-6)) if two else k + 1
            high = int(np.searchsorted(sizes, size[i] / similarity + 1e-6, "right"))
            some = low + np.flatnonzero(forest.label[label[against[low:high]]] != forest.label[label[i]])
            if not len(some):
                continue
            mark[own := flat[start[i] : start[i] + size[i]]] = True
            n = sizes[some]
            at = np.cumsum(n) - n
            hits = np.add.reduceat(mark[ids[np.arange(n.sum()) + np.repeat(begin[some] - at, n)]], at, dtype=np.int64)
            mark[own] = False
            near = some[hits >= similarity * (size[i] + n - hits) - 1e-9]
            forest.join(np.full(len(near), label[i]), label[against[near]])
        linked = np.flatnonzero(forest.label != np.arange(len(names)))
        return pa.table({"a": names[linked], "b": names[forest.label[linked]]}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return sent.groupBy("component", "x", "y").applyInArrow(compared, "a long, b long")


def similar_groups(docs: DataFrame, similarity: float = 0.8, words_per_shingle: int = 5, tries: int = TRIES, max_bits: int | None = None, hot: int = HOT_SHINGLE, chunk: int = CHUNK) -> DataFrame:
    """doc_id, component_id (smallest doc_id reachable) of distinct doc_ids, over links checked against the similarity.

    Documents with equal sets of shingles form a class. Classes whose fingerprints, in any of
    ``tries``, differ by at most max_bits are candidates; a candidate pair is a link only if its
    shingle sets have the similarity, so only those are looked for that share a shingle among the
    rarest of both, as every pair of that similarity does. No group is written out as pairs: the
    members of a group of candidates are first checked against a few pivots, over and over while
    that settles a quarter of them; groups that then still hold different checked groups are
    compared whole, chunk by chunk. So every candidate pair either lies in one checked group or is checked.

    Empty or null text: the empty set, like every other such text and no text with words. Rows
    without doc_id are left out. Rows that share a doc_id form one node, with all their texts.
    """
    max_bits = bits_of_similarity(similarity) if max_bits is None else max_bits
    sigs = materialize(signatures(docs, words_per_shingle, tries, similarity, frequent_shingles(docs, words_per_shingle)))
    classes = materialize(sigs.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("fps").alias("fps"), F.first("size").alias("size")))
    found = materialize(candidate_links(sigs, classes, similarity, max_bits, hot))
    linked = components(found)
    members = materialize(linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct()))
    sets = materialize(shingle_sets(docs, members.select("node"), words_per_shingle))
    checked, open_, left, turn = [], members, members.count(), 0
    while left:
        picks = [F.expr(f"min_by(node, xxhash64(node, {turn}, {i}))") for i in range(PIVOTS)]
        pivots = open_.groupBy("component").agg(F.array_distinct(F.array(F.min("node"), *picks)).alias("p")).select("component", F.explode("p").alias("b"))
        pairs = open_.join(pivots, "component").where("node != b").select(F.col("node").alias("a"), "b")
        checked.append(materialize(similar(pairs, sets, similarity)))
        done = checked[-1].select(F.col("a").alias("node")).unionByName(pivots.select(F.col("b").alias("node"))).distinct()
        open_ = materialize(open_.join(done, "node", "left_anti"))
        before, left, turn = left, open_.count(), turn + 1
        if left > 0.75 * before:
            break
    labels = components(_union(checked)) if checked else linked
    labelled = members.join(labels.select("node", F.col("component").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = labelled.groupBy("component").agg((F.min("label") != F.max("label")).alias("many")).where("many").select("component")
    sizes = classes.groupBy("rep").agg(F.sum("size").alias("size"))
    rest = materialize(labelled.join(split, "component", "left_semi").join(sizes, F.col("node") == F.col("rep")).select("component", "label", "node", "size"))
    if rest.limit(1).count():
        checked.append(materialize(links_across(rest, sets, similarity, chunk)))
        labels = components(_union(checked))
    named = classes.select("digest", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = materialize(sigs.select("digest", "doc_id").join(named, "digest").groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    for step in (sigs, classes, members, sets, rest, found, *checked):
        discard(step)
    return out


def _union(frames: list) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def without_similar(docs: DataFrame, similarity: float = 0.8, words_per_shingle: int = 5, **options) -> DataFrame:
    """The rows of docs, as they are, that have the smallest doc_id of their group in similar_groups().

    Rows without doc_id stay. Rows that share a doc_id stay or go together.
    """
    stay = similar_groups(docs, similarity, words_per_shingle, **options).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id_"))
    known = docs.where("doc_id is not null")
    return known.join(stay, known["doc_id"] == stay["kept_id_"], "left_semi").unionByName(docs.where("doc_id is null"))


def without_near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, words_per_shingle: int = SHINGLE_WORDS, hot: int = HOT_SUBTRIE) -> DataFrame:
    """The rows of docs, as they are, that have the smallest doc_id of their group of linked fingerprints.

    Rows without doc_id stay. Rows that share a doc_id stay or go together.
    """
    stay = near_duplicates(docs, max_bits, words_per_shingle, hot).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id_")).distinct()
    known = docs.where("doc_id is not null")
    return known.join(stay, known["doc_id"] == stay["kept_id_"], "left_semi").unionByName(docs.where("doc_id is null"))
