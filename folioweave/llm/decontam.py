"""Benchmark decontamination: word pairs join texts to test items, Smith-Waterman scores them.

A text is aligned with an item by words (match 2, mismatch -1, gap -1); the score is divided by that
of the whole item. Seeds miss no leak: of n words an alignment of the least share L matches
m >= L n, in at most 2 m - 2 L n + 1 unbroken runs, since each break costs 1. So it holds at least
(2 L - 1) n - 1 neighbouring word pairs of the item, within n + 2 (1 - L) n words of the text. Texts
with so many pairs so near are aligned there. For items so short that this asks for no pair, the
L n single words are the seeds.

The seeds are joined in memory. Items travel in chunks of at most ITEM_CHARS characters, one
pass over the documents for each chunk, so a large benchmark costs passes and not memory.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import row_batches

#: Least score of a leak: the share of the item's own best score.
SCORE = 0.6
#: Characters of items that are held in memory at once.
ITEM_CHARS = 16_000_000
#: Seed hits that are held in memory at once.
HITS = 4_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_WORD = re.compile(r"\w+")


def lowered(text: str) -> str:
    """Lower case of the same length."""
    return text.replace("İ", "i").lower()


def words(text: str) -> list[str]:
    return _WORD.findall(lowered(text))


class Items:
    """Test items as word ids, and their seeds as one sorted array."""

    def __init__(self, rows, least: float = SCORE):
        self.ids, texts = [], []
        self.vocabulary: dict[str, int] = {}
        for item_id, text in rows:
            own = words(text or "")
            if own:
                self.ids.append(item_id)
                texts.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own], np.int64))
        self.texts, self.least = texts, least
        n = np.array([len(t) for t in texts], np.int64)
        self.span = n + slack_of(n, least)
        pairs = np.ceil((2 * least - 1) * n - 1 - 1e-9).astype(np.int64)
        self.single = pairs < 1
        self.need = np.where(self.single, np.maximum(1, np.ceil(least * n - 1e-9)), pairs).astype(np.int64)
        key, item, at = [], [], []
        for k, t in enumerate(texts):
            own = self.singles(t) if self.single[k] else self.pairs(t)
            key.append(own)
            item.append(np.full(len(own), k))
            at.append(np.arange(len(own)))
        key, item, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (key, item, at))
        order = np.lexsort((item, key))
        self.item, self.at = item[order], at[order]
        self.seeds, gram = np.unique(key[order], return_inverse=True)
        self.place = gram * max(len(texts), 1) + self.item  # sorted: by seed, then item

    def pairs(self, ids: np.ndarray) -> np.ndarray:
        wide = len(self.vocabulary) + 1
        return np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * wide + ids[1:], 0)

    def singles(self, ids: np.ndarray) -> np.ndarray:
        return -ids

    def found(self, texts: list[str]):
        """Word ids of all texts with gaps between them, where each starts, and (place, seed) of hits."""
        get, flat, starts = self.vocabulary.get, [], []
        for t in texts:
            starts.append(len(flat))
            flat.extend([get(w, 0) for w in words(t)])
            flat.append(0)
        ids = np.array(flat, np.int64)
        at, seed = [], []
        for key in [self.pairs(ids)] + [self.singles(ids)] * bool(self.single.any()):
            some = np.flatnonzero(key)
            k = np.searchsorted(self.seeds, key[some])
            ok = np.flatnonzero(k < len(self.seeds))
            ok = ok[self.seeds[k[ok]] == key[some[ok]]]
            at.append(some[ok])
            seed.append(k[ok])
        at, seed = np.concatenate(at), np.concatenate(seed)
        order = np.argsort(at, kind="stable")
        return ids, starts, at[order], seed[order]

    def near(self, at: np.ndarray, seed: np.ndarray, doc: np.ndarray, low: int, high: int):
        """(text's number, item, place in all texts, place in item) of the hits of items low to high that lie near enough to one another, by text and item."""
        n = max(len(self.texts), 1)
        first = np.searchsorted(self.place, seed * n + low)
        much = np.searchsorted(self.place, seed * n + high) - first
        hit = np.repeat(np.arange(len(at)), much)
        place = np.repeat(first, much) + np.arange(much.sum()) - np.repeat(np.cumsum(much) - much, much)
        key = doc[hit] * n + self.item[place]
        by = np.argsort(key, kind="stable")  # hits are in order of place
        key, where, place = key[by], at[hit[by]], place[by]
        item = self.item[place]
        last = np.arange(len(key)) + self.need[item] - 1
        ok = np.flatnonzero(last < len(key))
        ok = ok[(key[last[ok]] == key[ok]) & (where[last[ok]] - where[ok] <= self.span[item[ok]])]
        cover = np.zeros(len(key) + 1, np.int64)
        np.add.at(cover, ok, 1)
        np.add.at(cover, last[ok] + 1, -1)
        stay = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        return key[stay] // n, item[stay], where[stay], self.at[place[stay]]

    def match(self, texts: list[str]):
        """(text's number, item number, score, first word, end word) of the leaks in texts."""
        ids, starts, at, seed = self.found(texts)
        if not len(at):
            return
        n, ends = len(self.texts), [*starts[1:], len(ids)]
        doc = np.searchsorted(starts, at, "right") - 1
        much = np.searchsorted(self.place, seed * n + n) - np.searchsorted(self.place, seed * n)
        total = np.r_[0, np.cumsum(much)]
        edge = [*np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)]
        a = 0
        while a < len(edge) - 1:  # whole texts of at most HITS hits; one with more takes its items in parts
            b = a + 1
            while b < len(edge) - 1 and total[edge[b + 1]] - total[edge[a]] <= HITS:
                b += 1
            some = slice(edge[a], edge[b])
            parts = int(min(n, -(-(total[edge[b]] - total[edge[a]]) // HITS)))
            for low, high in zip(np.arange(parts) * n // parts, np.arange(1, parts + 1) * n // parts):
                d, k, where, own = self.near(at[some], seed[some], doc[some], low, high)
                cut = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (k[1:] != k[:-1])]) if len(d) else []
                for x, y in zip(cut, [*cut[1:], len(d)]):
                    start = starts[d[x]]
                    got = aligned(self.texts[k[x]], ids[start : ends[d[x]] - 1], np.unique(where[x:y] - start - own[x:y]), self.least)
                    if got:
                        yield int(d[x]), int(k[x]), *got
            a = b


def slack_of(n, least: float):
    """Words that an alignment of the least share may have beyond the n of the item."""
    return np.floor(2 * (1 - least) * n + 1e-9).astype(np.int64) + 1


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Best local score of word ids a against b, and where it ends in each (exclusive)."""
    best, ea, eb = 0, 0, 0
    steps = np.arange(len(b)) * -GAP
    row = np.zeros(len(b) + 1, np.int64)
    for i, w in enumerate(a):
        now = np.maximum(np.maximum(row[:-1] + np.where(b == w, MATCH, MISMATCH), row[1:] + GAP), 0)
        now = np.maximum.accumulate(now + steps) - steps
        k = int(now.argmax())
        if now[k] > best:
            best, ea, eb = int(now[k]), i + 1, k + 1
        row[1:] = now
    return best, ea, eb


def aligned(item: np.ndarray, text: np.ndarray, places: np.ndarray, least: float) -> tuple[float, int, int] | None:
    """Best score and span of the item in the text near the diagonals ``places`` (start of the item)."""
    slack = int(slack_of(np.int64(len(item)), least))
    low = np.sort(places) - slack
    cut = np.flatnonzero(np.r_[True, low[1:] > low[:-1] + len(item) + 2 * slack])
    best = None
    for a, b in zip(cut, [*cut[1:], len(low)]):
        x, y = max(0, int(low[a])), min(len(text), int(low[b - 1]) + len(item) + 2 * slack)
        part = text[x:y]
        if np.isin(item, part).sum() < least * len(item) - 1e-9:  # too few words of the item are there at all
            continue
        score, ei, ep = smith_waterman(item, part)
        share = score / (MATCH * len(item))
        if share >= least and (best is None or share > best[0]):
            _, _, back = smith_waterman(item[:ei][::-1], part[:ep][::-1])
            best = share, x + ep - back, x + ep
    return best


def _chunks(benchmark: DataFrame, item_chars: int):
    """The items as lists of (item_id, text), each of bounded size."""
    known = benchmark.where("item_id is not null").select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = known.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    k = -(-total // item_chars)
    for j in range(k):
        yield [(r[0], r[1]) for r in known.where(F.pmod(F.xxhash64("item_id"), F.lit(k)) == j).collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = SCORE, item_chars: int = ITEM_CHARS) -> DataFrame:
    """doc_id, item_id, score (0 to 1), first_char, end_char of every leak, one row for a text and item.

    Null texts hold nothing and null items match nothing; of equal scores the first place counts;
    a repeated row is reported twice; no items or no documents give an empty result.
    """
    schema = "doc_id long, item_id long, score double, first_char long, end_char long"
    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = docs.sparkSession.createDataFrame([], schema)
    for rows in _chunks(benchmark, item_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows, least))

        def run(batches, shared=shared):
            import pyarrow as pa

            for batch in row_batches(batches, 2 << 20):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                out, spans = [], {}
                for d, k, score, a, b in shared.value.match(texts):
                    if d not in spans:
                        spans[d] = [m.span() for m in _WORD.finditer(lowered(texts[d]))]
                    out.append((batch.column(0)[d].as_py(), shared.value.ids[k], score, spans[d][min(a, len(spans[d]) - 1)][0], spans[d][min(b, len(spans[d])) - 1][1]))
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(["doc_id", "item_id", "score", "first_char", "end_char"], zip(*out))))

        out = out.unionByName(plain.mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = SCORE, item_chars: int = ITEM_CHARS) -> DataFrame:
    """The rows of docs, as they are, whose text holds no leak (null texts stay)."""
    for rows in _chunks(benchmark, item_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows, least))
        name = "text"

        def run(batches, shared=shared):
            import pyarrow as pa

            for batch in row_batches(batches, 2 << 20, name):
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]
                bad = {d for d, *_ in shared.value.match(texts)}
                yield batch.filter(pa.array([i not in bad for i in range(len(texts))])) if bad else batch

        docs = docs.mapInArrow(run, docs.schema)
    return docs
