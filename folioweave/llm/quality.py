"""Quality scores by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs (a good one over a poor one). Weights are learned by
logistic loss on the differences of the two feature vectors. A document's strength is the
weighted sum of its features. The threshold is a quantile of the strengths of all learning rows
(the share of poor ones); a logistic curve through it turns strengths into scores, with 0.3 at
the threshold.

Features are shares and rates of the whole text: letters, capitals, digits, symbols, marks at
word ends, repeated words and lines, lengths. Learning uses at most SAMPLE labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import row_batches, split_of

#: Labelled rows to learn from, at most (those with the least hash of doc_id).
SAMPLE = 20_000
#: Preference pairs drawn from them.
PAIRS = 120_000
#: Pairs whose differences are held in memory at once while learning.
PAIR_BLOCK = 4096
THRESHOLD = 0.3
NAMES = ("log_chars", "no_text", "upper", "digit", "symbol", "space", "stop", "quote", "pipe", "exclaim", "words_upper", "word_chars", "long_words",
         "repeated_next", "distinct", "top_word", "line_repeat", "line_chars", "end_symbol", "capital_start", "comma_stop", "non_ascii", "hash_like", "log_words")
_RUN = re.compile(r"[^\w\s]{2,}(?=\s|$)")
_CLASS = np.zeros(256, np.int8)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[35, 36, 37, 38, 42, 64, 94, 126, 60, 62, 123, 125, 91, 93, 92, 95, 43, 61, 96]] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[46, 59, 58, 63]] = 5
_CLASS[[34, 39, 40, 41]] = 6
_CLASS[124] = 7
_CLASS[33] = 8
_CLASS[44] = 9
_CLASS[128:] = 10


def features(text: str) -> np.ndarray:
    """The features of a whole text; an empty one has ``no_text`` set alone."""
    out = np.zeros(len(NAMES))
    words = text.split()
    if not words:
        out[1] = 1
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_CLASS[data], minlength=11) / len(data)
    n = len(words)
    known = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    repeats = sum(map(str.__eq__, words, words[1:]))
    runs = len(_RUN.findall(text))
    upper = sum(map(str.isupper, words))
    title = sum(w[0].isupper() for w in words)
    long_ = sum(len(w) > 14 for w in words)
    top = max(known.values())
    hash_like = sum(len(w) >= 16 and any(c.isdigit() for c in w) for w in words)
    out[:] = (np.log1p(len(data)) / 10, 0, kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7], kinds[8], upper / n, len(data) / n / 10, long_ / n,
              repeats / n, len(known) / n, top / n, 1 - len(set(lines)) / len(lines), min(1.0, len(data) / len(lines) / 2000), runs / n, title / n, kinds[9], kinds[10], hash_like / n, np.log1p(n) / 8)
    return out


def expanded(x: np.ndarray) -> np.ndarray:
    """Features, their roots and a few steps, so that a linear strength can bend."""
    root = np.sqrt(np.clip(x, 0, None))
    return np.concatenate([x, root, np.tanh(x * 8), x * x], axis=1)


class Model:
    def __init__(self, x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 17, penalty: float = 1e-4, rounds: int = 30):
        x = expanded(x)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        yes, no = np.flatnonzero(good), np.flatnonzero(~good)
        self.weights, self.at, self.slope = np.zeros(z.shape[1]), 0.0, 1.0
        if not len(yes) or not len(no):
            self.at = 1.0 if len(no) else -1.0  # one label only: everything gets it
            return
        better, worse = rng.choice(yes, pairs), rng.choice(no, pairs)
        w = self.weights
        for _ in range(rounds):  # Newton steps on the mean logistic loss
            grad, hess = np.zeros(len(w)), np.zeros((len(w), len(w)))
            for k in range(0, pairs, PAIR_BLOCK):
                d = z[better[k : k + PAIR_BLOCK]] - z[worse[k : k + PAIR_BLOCK]]
                p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
                grad -= p @ d
                hess += (d * (p * (1 - p))[:, None]).T @ d
            grad, hess = grad / pairs + penalty * w, hess / pairs + penalty * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            step *= min(1, 5 / (np.abs(step).max() + 1e-9))
            w = w - step
            if np.abs(step).max() < 1e-4:
                break
        self.weights = w
        strength = z @ w
        self.at = float(np.quantile(strength, len(no) / len(x)))
        # the steepness that fits the labels best
        y = good.astype(float)
        best = None
        for slope in np.geomspace(0.05, 8, 40):
            p = np.clip(self._curve(strength, slope), 1e-6, 1 - 1e-6)
            loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
            if best is None or loss < best[0]:
                best = loss, slope
        self.slope = float(best[1])

    def _curve(self, strength, slope):
        return 1 / (1 + np.exp(-np.clip(slope * (strength - self.at) + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = expanded(np.array([features(t) for t in texts]))
        return self._curve(((x - self.mean) / self.scale) @ self.weights, self.slope)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pairs: int = PAIRS) -> Model:
    """Learn from labelled rows outside the held-out fold, ``sample`` of them at most.

    Rows without doc_id or quality do not count; where a doc_id is labelled twice the lower label
    holds. Without both labels every text gets the one there is (or 0.5 and more if there is none).
    """
    chosen = labels.where("doc_id is not null and quality is not null").where(split_of() != 0).groupBy("doc_id").agg(F.min("quality").alias("label_")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label_")  # at most ``sample`` pairs of numbers

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 4 << 20):
            x = [features(t or "").tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    got = rows.mapInArrow(run, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id").combine_chunks()  # ``sample`` rows of numbers, as columns
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(got), len(NAMES))
    return Model(x, got["label"].to_numpy() > 0, pairs) if len(x) else Model(np.zeros((1, len(NAMES))), np.array([True]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row with a doc_id; a null text counts as empty."""

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 4 << 20):
            s = model.scores([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (split_of() == 0).alias("held_out"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, as they are, whose score reaches the threshold."""

    def run(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 4 << 20):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(model.scores([t or "" for t in texts]) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
