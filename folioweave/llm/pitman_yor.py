"""Language model scoring by a hierarchical Pitman-Yor model with Chinese-restaurant seating.

Each word is a context restaurant whose customers are the words that follow it in the training texts; all
of these restaurants share one parent, which holds a customer for each of their tables, and its own parent
is uniform over the known words and one unknown word. Gibbs sampling takes a customer from its table and
seats it again given all others: at a table of its dish by the table's customers less the discount, or at a
new one by strength and discount times the parent's probability. Given a dish's customers and tables, the
sizes of its tables are independent draws of one law conditioned on their sum, so they need not be stored:
the chance that a customer sits alone is a ratio of generalized Stirling numbers (exact up to 256 customers,
beyond that the ratio at the law's saddle point, off by a tenth at two tables and by under 3 % from ten on). A dish thus has two numbers however often it occurs.

Pairs (context, word) lie in a grid of cells by the hash of either, so no frequent word meets in one task.
A sweep seats all cells at once, with table totals and the parent's probabilities of the sweep before; the
tables then become the parent's customers, which are seated likewise. After a burn-in the predictive
probabilities of the samples are averaged, and each shard of documents gets those of its pairs back. No
vocabulary or model is broadcast or collected; the driver sees a few numbers a row or column of the grid.

Defined results: a null text is empty (its end is its one token); a null doc_id is scored and learned from;
repeated rows count as often as they stand there; unknown words share one probability; other columns are
ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize, parts
from .shards import arrow_schema, cut_words, dealt, dense, member, merged, mixed, numbered, packed, packed_sorted, row_of, shards, unpacked, unpacked_sorted

SPACES, END = b" \t\n\x0b\x0c\r", b"\n"
BURN_IN, SAMPLES, MOVES = 4, 4, 8  # sweeps before the samples, samples, customers of a dish that a sweep reseats
HELD_FOLD, FOLDS = 2, 7
_EXACT = 256
#: Strengths among which each sweep draws by their likelihood.
STRENGTHS = tuple(float(x) for x in np.geomspace(0.1, 1e6, 29))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series past 8."""
    x = np.array(x, float)
    shift = np.zeros_like(x)
    for _ in range(8):
        small = x < 8
        shift[small] -= np.log(x[small])
        x[small] += 1
    r = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r / 1260)) / x


class Alone:
    """Chance that one of a dish's customers sits alone, given customers c and tables t."""

    def __init__(self, d: float):
        self.d = d
        table = np.full((_EXACT + 1, _EXACT + 1), -np.inf)
        table[1, 1] = 0.0
        out = np.zeros_like(table)
        out[1, 1] = 1.0
        t = np.arange(1, _EXACT + 1)
        with np.errstate(invalid="ignore", divide="ignore"):
            for c in range(2, _EXACT + 1):
                stay = np.where(t <= c - 1, np.log(np.maximum(c - 1 - d * t, 1e-300)), -np.inf) + table[c - 1, 1:]
                table[c, 1:] = np.logaddexp(table[c - 1, :-1], stay)
                out[c, 1 : c + 1] = np.exp(table[c - 1, :c] - table[c, 1 : c + 1])
        self._exact = out
        y = np.geomspace(1e-9, 60 / (1 - d), 4000)  # -log(1 - z), z being the tilt of the law
        z, none = -np.expm1(-y), -np.expm1(-d * y)
        self._log_size = np.maximum(np.log(d * z / none) + (1 - d) * y, 0.0)
        self._single = d * z / none

    def __call__(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        out = self._exact[np.minimum(c, _EXACT), np.minimum(t, _EXACT)]
        big = np.flatnonzero(c > _EXACT)
        if len(big):
            cb, tb = c[big], t[big]
            out[big] = (tb - 1) / (cb - 1) * np.interp(np.log(cb / tb), self._log_size, self._single)
        return out


def first_tables(c: np.ndarray, b: np.ndarray, alone: Alone) -> np.ndarray:
    """Tables of each dish at which as many open as close; b: weight of a new table."""
    low, high = np.ones_like(c), c.copy()
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        q = alone(c, mid)
        up = open_ & (b * (1 - q) > q * (c - 1 - alone.d * mid))
        low, high = np.where(up, mid + 1, low), np.where(open_ & ~up, mid, high)
    return low


def reseated(c: np.ndarray, t: np.ndarray, b: np.ndarray, alone: Alone, moves: int, rng) -> np.ndarray:
    """Tables after moves steps of Gibbs sampling for every dish; one customer has one table always."""
    several = np.flatnonzero(c > 1)
    c, b, left = c[several], b[several], t.copy()
    now = left[several]
    for _ in range(moves):
        now = now - (rng.random(len(c)) < alone(c, now))
        now = now + (rng.random(len(c)) * (b + c - 1 - alone.d * now) < b)
    left[several] = now
    return left


_SHARD = "shard long, tokens binary, lengths binary, ids array<long>, held binary, words array<binary>, counts array<long>"
_CELLS = "shard long, a int, b int, tokens binary, lengths binary, ids array<long>, held binary, known binary, base binary, codes binary, counts binary"
_STATE = "a int, b int, kind string, sweep int, codes binary, x binary, y binary"
_STATS = "a int, b int, kind string, sweep int, codes binary, x binary, y binary, tables long, customers long, likelihood array<double>"
_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _encoded(batch: pa.RecordBatch, shard: int) -> dict:
    words, doc, _ = cut_words(batch.column("text"), SPACES)
    ids, vocabulary = numbered(words)
    n = batch.num_rows
    lengths = np.bincount(doc, minlength=n) + 1
    tokens = np.full(len(ids) + n, len(vocabulary), np.int64)
    tokens[np.arange(len(ids)) + doc] = ids
    held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
    counts = np.bincount(tokens[~np.repeat(held, lengths)], minlength=len(vocabulary) + 1)
    every = pa.concat_arrays([vocabulary, pa.array([END], pa.binary())])
    return {"shard": shard, "tokens": packed(tokens.astype(np.int32)), "lengths": packed(lengths.astype(np.int32)), "ids": batch.column("doc_id"), "held": packed(held.astype(np.uint8)), "words": every, "counts": counts}


def _pairs(tokens: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """Code of each token's context and word; a document's first context is an end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(lengths) - lengths] = end
    return before << 32 | tokens


def _cell_rows(side: int, total: int, distinct: int, end: int, schema: pa.Schema):
    """Shards with global numbers and base scores, and their pairs by cell; distinct is the unknown word's number."""
    def each(batches):
        for batch in batches:
            links = batch.column("links")
            for k, row in enumerate(batch.select(["shard", "tokens", "lengths", "ids", "held", "size"]).to_pylist()):
                number, count = np.full(row["size"], distinct, np.int64), np.zeros(row["size"], np.int64)
                if links[k].is_valid:
                    x = links[k].values
                    at = x.field("local").to_numpy()
                    number[at], count[at] = x.field("id").to_numpy(), x.field("c").to_numpy()
                local, lengths, held = unpacked(row["tokens"]), unpacked(row["lengths"]).astype(np.int64), unpacked(row["held"]).astype(bool)
                starts = np.cumsum(lengths) - lengths
                base = np.add.reduceat(np.log10((count + 1) / (total + distinct + 1))[local], starts)
                known = np.add.reduceat((count > 0)[local].astype(np.int32), starts, dtype=np.int32)
                tokens = number[local]
                del local, row["tokens"]
                yield row_of({"shard": row["shard"], "tokens": packed(tokens.astype(np.int32)), "lengths": row["lengths"], "ids": pa.array(row["ids"], pa.int64()), "held": row["held"], "known": packed(known), "base": base.tobytes()}, schema)
                code = _pairs(tokens, lengths, end)
                del tokens
                code, n = merged([code], [(~np.repeat(held, lengths)).astype(np.int64)])
                for p, own in dealt(mixed(code >> 32, side) * side + mixed(code & 0xFFFFFFFF, side)):
                    yield row_of({"shard": row["shard"], "a": p // side, "b": p % side, "codes": packed_sorted(code[own]), "counts": packed(n[own])}, schema)

    return each


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})


def _sums(keys: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct keys, ascending, and the sums of each list of values."""
    distinct, at = np.unique(keys, return_inverse=True)
    return [distinct, *(np.bincount(at, v, len(distinct)).astype(np.int64) for v in values)]


def _cell_start(table: pa.Table) -> pa.Table:
    """One cell: pairs of all shards with their counts, and what its contexts and words hold to begin with (one table a pair)."""
    own = [unpacked_sorted(c) for c in table["codes"].to_pylist()]
    code, n = merged(own, [unpacked(c) for c in table["counts"].to_pylist()])
    a, b = table["a"][0].as_py(), table["b"][0].as_py()
    have = n > 0
    rows = [(a, b, "pairs", None, packed_sorted(code), packed(n), None), (a, b, "tables", -1, None, packed(have.astype(np.int64)), None)]
    return _rows(_STATE, rows + _partials(a, b, -1, code, n, have.astype(np.int64)))


def _partials(a: int, b: int, sweep: int, code: np.ndarray, n: np.ndarray, t: np.ndarray) -> list[tuple]:
    u, c, tu = _sums(code >> 32, [n, t])
    w, k = _sums(code & 0xFFFFFFFF, [t])
    return [(a, b, "contexts", sweep, packed_sorted(u), packed(c), packed(tu)), (a, b, "words", sweep, packed_sorted(w), packed(k), None)]


def _context_stats(d: float):
    """One row of the grid: customers and tables of its contexts, and the likelihood of each strength."""
    def each(table: pa.Table) -> pa.Table:
        u, at = np.unique(np.concatenate([unpacked_sorted(x) for x in table["codes"].to_pylist()]), return_inverse=True)
        c, t = (np.bincount(at, np.concatenate([unpacked(v) for v in table[x].to_pylist()]), len(u)).astype(np.int64) for x in "xy")
        return _rows(_STATS, [(table["a"][0].as_py(), None, "contexts", table["sweep"][0].as_py(), packed_sorted(u), packed(c), packed(t), int(t.sum()), int(c.sum()), _likelihoods(c, t, d))])

    return each


def _likelihoods(c: np.ndarray, t: np.ndarray, d: float) -> list[float]:
    have = c > 0
    (c, cn), (t, tn) = (np.unique(x[have], return_counts=True) for x in (c, t))
    return [float((tn * (log_gamma(s / d + t) - log_gamma(np.array([s / d])))).sum() - (cn * (log_gamma(s + c) - log_gamma(np.array([s])))).sum()) for s in STRENGTHS]


def _word_stats(d: float, strength: float, tables: float, uniform: float, moves: int, seed: int):
    """One column of the grid: the parent's customers of each word, seated anew beside the tables it had."""
    alone = Alone(d)

    def each(table: pa.Table) -> pa.Table:
        b, kinds = table["b"][0].as_py(), table["kind"].to_pylist()
        codes, xs, ys = (table[c].to_pylist() for c in ("codes", "x", "y"))
        new = [i for i, k in enumerate(kinds) if k == "words"]
        w, at = np.unique(np.concatenate([unpacked_sorted(codes[i]) for i in new]), return_inverse=True)
        c = np.bincount(at, np.concatenate([unpacked(xs[i]) for i in new]), len(w)).astype(np.int64)
        weight = np.full(len(w), (strength + d * tables) * uniform)
        t = np.zeros(len(w), np.int64)
        for i in (i for i, k in enumerate(kinds) if k == "parent"):
            k, have = member(w, unpacked_sorted(codes[i]))
            t[have] = unpacked(ys[i])[k[have]]
        fresh = (t == 0) & (c > 1)
        t[fresh] = first_tables(c[fresh], weight[fresh], alone)
        t = np.clip(t, np.minimum(c, 1), c)
        t = reseated(c, t, weight, alone, moves, np.random.default_rng([seed, b]))
        sweep = max(table["sweep"].to_pylist())
        return _rows(_STATS, [(None, b, "parent", sweep, packed_sorted(w), packed(c), packed(t), int(t.sum()), int(c.sum()), _likelihoods(c.sum(keepdims=True), t.sum(keepdims=True), d))])

    return each


class _Stats:
    """Contexts and words as a cell sees them, of one sweep."""

    def __init__(self, code: np.ndarray, contexts: dict, parent: dict, p: dict):
        at = lambda x, s: member(x, unpacked_sorted(s["codes"]))[0]
        k = at(code >> 32, contexts)
        self.customers, self.tables = unpacked(contexts["x"])[k], unpacked(contexts["y"])[k]
        k = at(code & 0xFFFFFFFF, parent)
        held, t = unpacked(parent["x"])[k], unpacked(parent["y"])[k]
        d, s = p["parent_d"], p["parent_strength"]
        self.above = (held - d * t + (s + d * p["parent_tables"]) * p["uniform"]) / (s + p["parent_customers"])
        self.d, self.strength = p["d"], p["strength"]

    @property
    def weight(self) -> np.ndarray:
        """Weight of a new table for each pair's dish."""
        return (self.strength + self.d * self.tables) * self.above

    def predicted(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        return (n - self.d * t + self.weight) / (self.strength + self.customers)


def _by_kind(table: pa.Table) -> dict[str, list[dict]]:
    out: dict[str, list[dict]] = {}
    for row in table.to_pylist():
        out.setdefault(row["kind"], []).append(row)
    return out


def _sweep(p: dict, moves: int, sweep: int, seed: int):
    """One cell: every dish's customers reseated given the last sweep's table totals and parent."""
    alone = Alone(p["d"])

    def each(table: pa.Table) -> pa.Table:
        rows = _by_kind(table)
        if "pairs" not in rows:  # a cell where no pair lies
            return _rows(_STATE, [])
        pairs, a, b = rows["pairs"][0], rows["pairs"][0]["a"], rows["pairs"][0]["b"]
        code, n, t = unpacked_sorted(pairs["codes"]), unpacked(pairs["x"]), unpacked(rows["tables"][0]["x"])
        weight = _Stats(code, rows["contexts"][0], rows["parent"][0], p).weight
        if sweep == 0:
            many = n > 1
            t[many] = first_tables(n[many], weight[many], alone)
        t = reseated(n, t, weight, alone, moves, np.random.default_rng([seed, sweep, a, b]))
        return _rows(_STATE, [(a, b, "tables", sweep, None, packed(t), None), *_partials(a, b, sweep, code, n, t)])

    return each


_ANSWER = "shard long, a int, b int, codes binary"


def _answers(params: dict[int, dict]):
    """One cell: averaged predictive probabilities (log10) of the pairs of each shard."""
    def each(table: pa.Table) -> pa.Table:
        rows = _by_kind(table)
        if "pairs" not in rows:
            return _rows(_ANSWER, [])
        code, n = unpacked_sorted(rows["pairs"][0]["codes"]), unpacked(rows["pairs"][0]["x"])
        of = {(k, r["sweep"]): r for k in ("tables", "contexts", "parent") for r in rows[k]}
        mean = sum(_Stats(code, of["contexts", s], of["parent", s], p).predicted(n, unpacked(of["tables", s]["x"])) for s, p in params.items()) / len(params)
        log = np.log10(mean).astype(np.float32)
        return _rows(_ANSWER, [(r["shard"], r["a"], r["b"], packed(log[member(unpacked_sorted(r["codes"]), code)[0]].view(np.int32))) for r in rows["asked"]])

    return each


def _scored(side: int, total: int, end: int):
    """One shard: the scores of its documents from the answers of all cells."""
    def each(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["lengths"] is not None)
        answer = {(r["a"], r["b"]): r["codes"] for r in rows if r["lengths"] is None}
        tokens, lengths = unpacked(own["tokens"]).astype(np.int64), unpacked(own["lengths"]).astype(np.int64)
        code, at = np.unique(_pairs(tokens, lengths, end), return_inverse=True)
        log = np.empty(len(code))
        for p, places in dealt(mixed(code >> 32, side) * side + mixed(code & 0xFFFFFFFF, side)):
            log[places] = unpacked(answer[p // side, p % side]).view(np.float32)
        score = np.add.reduceat(log[at], np.cumsum(lengths) - lengths)
        return pa.table({
            "doc_id": pa.array(own["ids"], pa.int64()), "held_out": pa.array(unpacked(own["held"]).astype(bool)), "n_tokens": pa.array(lengths), "n_known": pa.array(unpacked(own["known"]).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(lengths), total)), "base_score": pa.array(np.frombuffer(own["base"], np.float64)), "score": pa.array(score),
        })

    return each


def _drawn(likelihood: np.ndarray, rng) -> float:
    """A strength by its likelihood (all alike beforehand on the grid)."""
    p = np.exp(likelihood - likelihood.max())
    return STRENGTHS[rng.choice(len(STRENGTHS), p=p / p.sum())]


def _discount(n1: int, n2: int) -> float:
    """From the numbers of things seen once and twice."""
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


def scores(docs: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES, moves: int = MOVES, seed: int = 1) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out documents (crc32 of doc_id as text, modulo 7, is 2) are not learned from. Scores are log10
    probabilities of the whole text with its end; base_score is that of single words with one added to counts.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))
    coded = materialize(shards(docs, _encoded, _SHARD, [F.col("text"), F.col("doc_id").cast("long").alias("doc_id"), held.alias("held")]))
    each = coded.select("shard", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "w")).select("shard", "local", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    summed = each.groupBy("word").agg(F.sum("n").alias("c")).where(F.col("c") > 0)
    numbers = materialize(summed.withColumn("id", F.monotonically_increasing_id()))
    words = dense(numbers)
    total, distinct, once, twice = numbers.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    end = words.where(F.col("word") == F.lit(END)).select("id").first()
    end = end[0] if end else distinct
    side = max(2, math.isqrt(parts(docs, 10) - 1) + 1)
    links = each.join(words, "word").groupBy("shard").agg(F.collect_list(F.struct("local", "id", "c")).alias("links"))
    rows = coded.select("shard", "tokens", "lengths", "ids", "held", F.size("words").alias("size")).join(links, "shard", "left")
    cells = materialize(rows.mapInArrow(_cell_rows(side, total, distinct, end, arrow_schema(spark, _CELLS)), _CELLS))
    discard(coded)
    asked = cells.where("a is not null").select("shard", "a", "b", "codes", "counts")
    state = materialize(asked.groupBy("a", "b").applyInArrow(_cell_start, _STATE))
    pairs, made = state.where("kind = 'pairs'"), [cells, state, numbers]
    counts = pairs.mapInArrow(_few_counts, "once long, twice long").agg(F.sum("once"), F.sum("twice")).first()
    rng = np.random.default_rng(seed)
    p = {"d": _discount(*(x or 0 for x in counts)), "parent_d": _discount(once, twice), "strength": 1.0, "parent_strength": 1.0, "parent_tables": float(distinct), "uniform": 1 / (distinct + 1)}
    kept, params, parent, last = [], {}, None, None
    spread = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    narrow = ["a", "b", "kind", "sweep", "codes", "x", "y"]
    for sweep in range(burn_in + samples + 1):
        contexts = state.where("kind = 'contexts'").groupBy("a").applyInArrow(_context_stats(p["d"]), _STATS)
        customers = state.where("kind = 'words'")
        customers = customers if parent is None else customers.unionByName(parent.select(narrow))
        seated = customers.groupBy("b").applyInArrow(_word_stats(p["parent_d"], p["parent_strength"], p["parent_tables"], p["uniform"], moves, seed * 1000 + sweep), _STATS)
        stats = materialize(contexts.unionByName(seated))
        parent = stats.where("kind = 'parent'")
        made.append(stats)
        sums = {r[0]: r[1:] for r in stats.groupBy("kind").agg(F.sum("tables"), F.sum("customers"), *[F.sum(F.col("likelihood")[i]) for i in range(len(STRENGTHS))]).collect()}
        if "parent" not in sums:
            break
        p = p | {"parent_tables": float(sums["parent"][0]), "parent_customers": float(sums["parent"][1]), "strength": _drawn(np.array(sums["contexts"][2:]), rng)}
        alone = np.array(_likelihoods(np.array([sums["parent"][1]]), np.array([sums["parent"][0]]), p["parent_d"]))
        p["parent_strength"] = _drawn(alone, rng)
        wide = _copies(stats, spread, narrow)
        if sweep > burn_in:
            params[sweep - 1] = p
            kept += [state.where("kind = 'tables'"), wide.withColumn("sweep", F.lit(sweep - 1))]
        if sweep < burn_in + samples:
            before, old = state.where("kind = 'tables'").unionByName(wide).unionByName(pairs), (state, last)
            state, last = materialize(before.groupBy("a", "b").applyInArrow(_sweep(p, moves, sweep, seed), _STATE)), stats
            made.append(state)
            for done in old:  # what neither a sample nor the next sweep reads
                if done is not None and done is not made[1] and sweep <= burn_in:
                    made.remove(done)
                    discard(done)
    if not params:
        return spark.createDataFrame([], _OUT)
    every = asked.select("shard", "a", "b", F.lit("asked").alias("kind"), F.lit(None).cast("int").alias("sweep"), "codes", F.lit(None).cast("binary").alias("x"), F.lit(None).cast("binary").alias("y"))
    for part in [pairs, *kept]:
        every = every.unionByName(part.select(F.lit(None).cast("long").alias("shard"), *narrow))
    answers = materialize(every.groupBy("a", "b").applyInArrow(_answers(params), _ANSWER))
    for done in made[1:]:
        discard(done)
    shard = cells.where("a is null").select("shard", "a", "b", "codes", "tokens", "lengths", "ids", "held", "known", "base")
    out = materialize(shard.unionByName(answers, allowMissingColumns=True).groupBy("shard").applyInArrow(_scored(side, total, end), _OUT))
    discard(cells)
    discard(answers)
    return out


def _copies(stats: DataFrame, spread, narrow: list[str]) -> DataFrame:
    """Statistics of the grid's rows and columns, a copy for each cell that they cross."""
    a = stats.where("kind = 'contexts'").drop("b").withColumn("b", spread)
    b = stats.where("kind = 'parent'").drop("a").withColumn("a", spread)
    return a.select(narrow).unionByName(b.select(narrow))


def _few_counts(batches):
    for batch in batches:
        for x in batch["x"].to_pylist():
            n = unpacked(x)
            yield pa.RecordBatch.from_pydict({"once": [int((n == 1).sum())], "twice": [int((n == 2).sum())]}, schema=pa.schema([("once", pa.int64()), ("twice", pa.int64())]))
