"""Hierarchical language identification: family first, then one-versus-one linear SVMs.

A text's features are the shares of its byte trigrams (lower-cased UTF-8, marks and digits
dropped, words apart by one space), hashed to BINS. Linear support vector machines separate the
families (one against the rest); inside a family each pair of languages has a machine of its own
and votes. All machines are weights over the same bins, so a whole text is scored by one gather
and sum per machine. Learning uses at most SAMPLE rows outside the held-out fold.
"""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import row_batches, split_of

BITS = 13
#: Rows to learn from, at most (those with the least hash of doc_id).
SAMPLE = 4_000
UNKNOWN = "und"
#: Families of ISO 639-1 codes; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "indo-aryan": ("hi", "mr", "ne", "bn", "pa", "gu", "ur"),
    "turkic": ("tr", "az", "kk", "uz"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Numbers that \w has beside letters and digits (a superscript two, a Roman eight).
_NUMBERS = frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())


def grams(text: str) -> np.ndarray:
    """Bins of all byte trigrams of the whole text; none if it has no letter."""
    plain = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not plain.isascii():
        odd = _NUMBERS.intersection(plain)
        if odd:
            plain = " ".join(plain.translate(dict.fromkeys(map(ord, odd), " ")).split())
    if not plain:
        return np.zeros(0, np.int64)
    b = np.frombuffer(f" {plain} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    return (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 25, penalty: float = 2e-4, seed: int = 5) -> np.ndarray:
    """Weights and bias of a linear SVM: averaged sub-gradient steps on the hinge loss, classes in balance."""
    rng = np.random.default_rng(seed)
    w, mean, t = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    pos, neg = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
    each = max(8, min(64, len(x) // 4))
    steps = rounds * max(1, len(x) // (2 * each))
    for t in range(1, steps + 1):
        at = np.r_[rng.choice(pos, each), rng.choice(neg, each)]
        margin = y[at] * (x[at] @ w)
        wrong = at[margin < 1]
        rate = 1 / (penalty * (t + 200))
        w *= 1 - rate * penalty
        if len(wrong):
            w += rate / len(at) * (y[wrong][:, None] * x[wrong]).sum(0)
        if t > steps // 2:
            mean += w
    return mean / max(1, steps - steps // 2)


class Model:
    """Families, their languages and the machines. ``langs`` may be any codes; one is enough."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        self.family = {c: _FAMILY.get(c, c) for c in self.langs}
        self.families = sorted(set(self.family.values()))
        columns, self.pairs = [], []
        own = np.array([self.family[c] for c in langs.tolist()])
        for f in self.families:
            if len(self.families) > 1:
                columns.append(_machine(x, np.where(own == f, 1.0, -1.0)))
        for f in self.families:
            codes = [c for c in self.langs if self.family[c] == f]
            for i, a in enumerate(codes):
                for b in codes[i + 1 :]:
                    at = (langs == a) | (langs == b)
                    self.pairs.append((a, b))
                    columns.append(_machine(x[at], np.where(langs[at] == a, 1.0, -1.0)))
        table = np.array(columns, np.float64).T if columns else np.zeros((x.shape[1] + 1, 0))
        self.weights, self.bias = np.ascontiguousarray(table[:-1]).astype(np.float32), table[-1]

    def margins(self, batch: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(g) for g in batch])
        out = np.zeros((len(batch), len(self.bias)))
        full = np.flatnonzero(sizes)
        if len(full):
            flat = np.concatenate([batch[i] for i in full])
            starts = np.cumsum(sizes[full]) - sizes[full]
            for k in range(len(self.bias)):
                out[full, k] = np.add.reduceat(self.weights[:, k][flat], starts, dtype=np.float64) * SCALE / sizes[full] + self.bias[k]
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        batch = [grams(t) for t in texts]
        m = self.margins(batch)
        codes, score = [], np.zeros(len(texts))
        sure = 1 / (1 + np.exp(-np.clip(3 * m, -30, 30)))
        n = len(self.families) if len(self.families) > 1 else 0
        for i, g in enumerate(batch):
            if not len(g) or not self.langs:
                codes.append(UNKNOWN)
                continue
            k = int(m[i, :n].argmax()) if n else 0
            family = self.families[k]
            own = [c for c in self.langs if self.family[c] == family]
            votes = dict.fromkeys(own, 0.0)
            for j, (a, b) in enumerate(self.pairs, n):
                if a in votes:
                    p = sure[i, j]
                    votes[a] += p + (p >= 0.5)
                    votes[b] += 1 - p + (p < 0.5)
            best = max(own, key=lambda c: votes[c])
            codes.append(best)
            inner = 1.0 if len(own) == 1 else votes[best] / (2 * (len(own) - 1))
            score[i] = (sure[i, k] if n else 1.0) * inner
        return codes, score


SCALE = 40.0


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows outside the held-out fold that have a text with letters and a lang.

    Each language, however many there are, gives at most its even share of ``sample`` rows (one at
    least), those with the least hash of doc_id. Two passes over the ids: counts, then the rows under
    a bound of the hash that leaves about twice the share.
    """
    rows = docs.where("doc_id is not null and text is not null and lang is not null").where(split_of() != 0)
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return Model(np.zeros((0, 1 << BITS), np.float32), np.array([]))
    share = max(1, sample // len(counts))
    spark, wide = docs.sparkSession, 1 << 40
    bound = spark.createDataFrame([(c, min(wide, int(wide * (2 * share + 50) / n))) for c, n in counts.items()], "lang_ string, bound long")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(wide))
    near = rows.select("doc_id", F.col("lang").alias("lang_"), place.alias("place")).join(F.broadcast(bound), "lang_").where("place < bound")  # one row per language
    by: dict[str, set] = {}
    for i, c, p in near.select("doc_id", "lang_", "place").collect():  # about twice the sample
        by.setdefault(c, set()).add((p, i))
    ids = spark.createDataFrame([(i, c) for c, got in by.items() for _, i in sorted(got)[:share]], T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang_", T.StringType())]))

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 2 << 20):
            out = []
            for i, t, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
                g = grams(t)
                if len(g):
                    at, n = np.unique(g, return_counts=True)
                    out.append((i, c, at.astype(np.int16 if BITS < 15 else np.int32).tobytes(), (n / len(g)).astype(np.float16).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.string(), pa.binary(), pa.binary()))], ["doc_id", "lang", "at", "share"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang_")  # at most ``sample`` ids
    got = chosen.mapInArrow(run, "doc_id long, lang string, at binary, share binary").toPandas().sort_values(["doc_id", "lang"], kind="stable")
    x = np.zeros((len(got), 1 << BITS), np.float32)
    for k, (at, share_) in enumerate(zip(got["at"], got["share"])):
        x[k, np.frombuffer(at, np.int16 if BITS < 15 else np.int32)] = np.frombuffer(share_, np.float16).astype(np.float32) * SCALE
    return Model(x, got["lang"].to_numpy())


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row with a doc_id. Null, empty and letterless texts: ``und``, 0.

    A letter has Unicode category L. A repeated row gets its result twice; of equal votes the first
    language in order counts; other columns are not looked at; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bins times machines: no larger for more documents

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 2 << 20):
            codes, score = shared.value.predict([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (split_of() == 0).alias("held_out"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
