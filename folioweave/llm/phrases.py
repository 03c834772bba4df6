"""Phrase collocation mining by position bitmaps, depth first within shards, popcounts summed over shards.

Documents are cut into shards of a few MB. In a shard each word of a language has a bitmap of its
positions, compressed to its bytes that are not zero; an empty position parts the pieces. A phrase is
extended by shifting its bitmap by one position and ANDing it with the bitmaps of the words found there;
popcounts are its occurrences. Shards run over a batch of prefixes down to the longest phrases before
they take the next, so a batch bounds the memory.

What a phrase lacks in all shards together cannot be known in one of them, so counts are summed before a
level is extended: words over shards, then word pairs, whose frequent ones go back to the shards that
hold them. Nothing is broadcast, and all sums are of whole counts.

Defined results: a null text is empty, a null lang is ``und``; repeated rows count as often as they
stand there; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import discard, materialize, parts
from .shards import arrow_schema, cut_words, dealt, dense, member, merged, mixed, numbered, packed, packed_sorted, row_of, shards, unpacked, unpacked_sorted

SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
LEAST, FIRST, SHARE = 10, 2000, 50  # fewest occurrences; rows a language; per cent of a longer phrase
#: Bitmap bytes that are extended at once.
_BATCH = 300_000


class Bitmaps:
    """The position bitmaps of one shard's words (numbers under 0 are left out)."""

    def __init__(self, ids: np.ndarray, opens: np.ndarray):
        at = np.arange(len(ids), dtype=np.int64) + np.cumsum(opens)
        have = ids >= 0
        self.words, word = np.unique(ids[have], return_inverse=True)
        order = np.argsort(word, kind="stable")
        word, at = word[order], at[have][order]
        block = at >> 3
        first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (block[1:] != block[:-1]))) if len(word) else np.zeros(0, np.int64)
        self.word, self.block = word[first], block[first]
        bits = (1 << (at & 7)).astype(np.uint8)
        self.mask = np.bitwise_or.reduceat(bits, first) if len(first) else bits
        by = np.argsort(self.block, kind="stable")
        self._word, self._mask = self.word[by], self.mask[by]
        self._start = np.searchsorted(self.block[by], np.arange((self.block.max() if len(by) else 0) + 3))

    def extended(self, block: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shift bitmaps by one position and AND them with those of all words.

        Returns for each byte that is left: the index of the byte it comes from, the word, block and mask.
        """
        low, high = mask << 1, mask >> 7  # uint8: bits past the byte go into the next one
        a, b = np.flatnonzero(low), np.flatnonzero(high)
        src, block, mask = np.append(a, b), np.append(block[a], block[b] + 1), np.append(low[a], high[b])
        start = self._start[block]
        n = self._start[block + 1] - start
        take = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(take)) - np.repeat(np.cumsum(n) - n, n) + start[take]
        both = mask[take] & self._mask[j]
        left = np.flatnonzero(both)
        take = take[left]
        return src[take], self._word[j[left]], block[take], both[left]

    def pairs(self):
        """(first word, second word, block, mask) of all two-word phrases, in batches."""
        for i in range(0, len(self.word), _BATCH):
            src, word, block, mask = self.extended(self.block[i : i + _BATCH], self.mask[i : i + _BATCH])
            yield self.words[self.word[i + src]], self.words[word], block, mask


def pair_counts(maps: Bitmaps) -> tuple[np.ndarray, np.ndarray]:
    """Codes (first word in the high half) and popcounts of a shard's two-word phrases."""
    found = [merged([a << 32 | b], [np.bitwise_count(m).astype(np.int64)]) for a, b, _, m in maps.pairs()]
    return merged([c for c, _ in found], [n for _, n in found]) if found else (np.zeros(0, np.int64),) * 2


def triple_counts(maps: Bitmaps, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first pair in frequent, third word, popcount) of phrases both of whose pairs are frequent."""
    found = []
    for a, b, block, mask in maps.pairs():
        k, keep = member(a << 32 | b, frequent)
        keep = np.flatnonzero(keep)
        k, b, block, mask = k[keep], b[keep], block[keep], mask[keep]
        src, word, _, mask = maps.extended(block, mask)
        third = maps.words[word]
        keep = member(b[src] << 32 | third, frequent)[1]
        found.append(merged([k[src[keep]] << 32 | third[keep]], [np.bitwise_count(mask[keep]).astype(np.int64)]))
    code, n = merged([c for c, _ in found], [n for _, n in found]) if found else (np.zeros(0, np.int64),) * 2
    return code >> 32, code & 0xFFFFFFFF, n


_SHARD = "shard long, tokens binary, opens binary, words array<binary>, langs array<string>, counts array<long>"
_PAIRS = "shard long, part int, tokens binary, opens binary, codes binary, counts binary"


def _encoded(batch: pa.RecordBatch, shard: int) -> dict:
    words, doc, opens = cut_words(batch.column("text"), SPACES, BREAKS)
    ids, vocabulary = numbered(words)
    langs = batch.column("lang").dictionary_encode()
    of = langs.indices.to_numpy(zero_copy_only=False)[doc].astype(np.int64)
    seen, local, counts = np.unique(of * len(vocabulary) + ids, return_inverse=True, return_counts=True)
    width = max(1, len(vocabulary))
    return {"shard": shard, "tokens": packed(local.astype(np.int32)), "opens": packed(np.packbits(opens)), "words": vocabulary.take(pa.array(seen % width)), "langs": langs.dictionary.take(pa.array(seen // width)), "counts": counts}


def _opened(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(unpacked(b), count=n).astype(bool)


def _pair_rows(n_parts: int, schema: pa.Schema):
    def each(batches):
        for batch in batches:
            links = batch.column("known")
            for k, row in enumerate(batch.select(["shard", "tokens", "opens", "size"]).to_pylist()):
                known = np.full(row["size"], -1, np.int64)
                known[links[k].values.field("local").to_numpy()] = links[k].values.field("id").to_numpy()
                ids = known[unpacked(row["tokens"])]
                yield row_of({"shard": row["shard"], "tokens": packed(ids.astype(np.int32)), "opens": row["opens"]}, schema)
                code, n = pair_counts(Bitmaps(ids, _opened(row["opens"], len(ids))))
                for p, own in dealt(mixed(code, n_parts)):
                    yield row_of({"shard": row["shard"], "part": p, "codes": packed_sorted(code[own]), "counts": packed(n[own])}, schema)

    return each


def _frequent_rows(least: int):
    """All shards' counts of one part's pairs: the frequent ones (shard null), and those that each shard holds."""
    def each(table: pa.Table) -> pa.Table:
        own = [unpacked_sorted(c) for c in table["codes"].to_pylist()]
        code, n = merged(own, [unpacked(c) for c in table["counts"].to_pylist()])
        code, n = code[n >= least], n[n >= least]
        rows = [(None, packed_sorted(code), packed(n))] if len(code) else []
        for shard, codes in zip(table["shard"].to_pylist(), own):
            if (keep := member(codes, code)[1]).any():
                rows.append((shard, packed_sorted(codes[keep]), None))
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()), "codes": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    return each


def _unpacked_pairs(batches):
    for batch in batches:
        for codes, counts in zip(batch["codes"].to_pylist(), batch["counts"].to_pylist()):
            code = unpacked_sorted(codes)
            yield pa.RecordBatch.from_arrays([pa.array(code >> 32), pa.array(code & 0xFFFFFFFF), pa.array(unpacked(counts))], names=["u", "x", "a"])


def _triple_rows(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpacked(row["tokens"]).astype(np.int64)
            frequent = np.sort(np.concatenate([unpacked_sorted(c) for c in row["frequent"]]))
            k, third, n = triple_counts(Bitmaps(ids, _opened(row["opens"], len(ids))), frequent)
            yield pa.RecordBatch.from_arrays([pa.array(frequent[k] >> 32), pa.array(frequent[k] & 0xFFFFFFFF), pa.array(third), pa.array(n)], names=["u", "x", "y", "n"])


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Tables (id, lang, word, f), (u, x, a), (u, x, y, a) of all phrases that occur least times, and (lang, n)."""
    columns = [F.col("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")]
    coded = materialize(shards(docs, _encoded, _SHARD, columns))
    each = coded.select("shard", F.posexplode(F.arrays_zip("words", "langs", "counts")).alias("local", "w"))
    each = each.select("shard", "local", F.col("w.words").alias("word"), F.col("w.langs").alias("lang"), F.col("w.counts").alias("n"))
    sizes = coded.select(F.explode(F.arrays_zip("langs", "counts")).alias("w")).groupBy(F.col("w.langs").alias("lang")).agg(F.sum("w.counts").alias("n"))
    summed = each.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    words = materialize(dense(materialize(summed.withColumn("id", F.monotonically_increasing_id()))))
    known = each.join(words, ["lang", "word"]).groupBy("shard").agg(F.collect_list(F.struct("local", "id")).alias("known"))
    n_parts = parts(docs, 10)
    spark = docs.sparkSession
    rows = coded.select("shard", "tokens", "opens", F.size("words").alias("size")).join(known, "shard")
    paired = materialize(rows.mapInArrow(_pair_rows(n_parts, arrow_schema(spark, _PAIRS)), _PAIRS))
    parted = paired.where("part is not null").groupBy("part")
    found = materialize(parted.applyInArrow(_frequent_rows(least), "shard long, codes binary, counts binary"))
    pairs = found.where("shard is null").mapInArrow(_unpacked_pairs, "u long, x long, a long")
    own = found.where("shard is not null").groupBy("shard").agg(F.collect_list("codes").alias("frequent"))
    again = paired.where("part is null").select("shard", "tokens", "opens").join(own, "shard")
    triples = again.mapInArrow(_triple_rows, "u long, x long, y long, n long").groupBy("u", "x", "y").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    pairs, triples, sizes = materialize(pairs), materialize(triples), materialize(sizes)
    for done in (coded, paired, found):
        discard(done)
    return words, pairs, triples, sizes


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000*a*a/(l*r)) in whole numbers of up to 38 digits."""
    whole = lambda c: c.cast("decimal(16,0)")
    top = (whole(a) * whole(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    below = whole(left) * whole(right)
    return F.call_function("div", top, below)


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, share: int = SHARE) -> DataFrame:
    """The first phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    Phrases have two or three words and occur least times or more. The lowest-scoring cut counts. A phrase
    inside a longer one that has share per cent or more of its occurrences is dropped. Ties: more
    occurrences, then the smaller phrase by bytes.
    """
    words, pairs, triples, sizes = frequent_phrases(docs, least)
    word = lambda at: words.select(F.col("id").alias(at), F.col("word").cast("string").alias(f"{at}_word"), F.col("f").alias(f"{at}_f"))
    langs = words.select(F.col("id").alias("u"), "lang")
    longer = triples.select("u", "x", "a").unionByName(triples.select(F.col("x").alias("u"), F.col("y").alias("x"), "a")).groupBy("u", "x").agg(F.max("a").alias("most"))
    two = pairs.join(longer, ["u", "x"], "left").where(F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True)))
    two = two.join(word("u"), "u").join(word("x"), "x")
    two = two.select("u", F.concat_ws(" ", "u_word", "x_word").alias("phrase"), "a", F.col("u_f").alias("l"), F.col("x_f").alias("r")).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    three = triples.join(pairs.withColumnRenamed("a", "ux"), ["u", "x"]).join(pairs.select(F.col("u").alias("x"), F.col("x").alias("y"), F.col("a").alias("xy")), ["x", "y"])
    three = three.join(word("u"), "u").join(word("x"), "x").join(word("y"), "y")
    early, late = _score(F.col("a"), F.col("u_f"), F.col("xy")), _score(F.col("a"), F.col("ux"), F.col("y_f"))
    three = three.select("u", F.concat_ws(" ", "u_word", "x_word", "y_word").alias("phrase"), "a", "u_f", "xy", "ux", "y_f", early.alias("early"), late.alias("late"))
    k = F.col("early") <= F.col("late")
    three = three.select("u", "phrase", "a", F.when(k, F.col("u_f")).otherwise(F.col("ux")).alias("l"), F.when(k, F.col("xy")).otherwise(F.col("y_f")).alias("r"), F.least("early", "late").alias("score"))
    every = two.unionByName(three).join(langs, "u").drop("u")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH RECURSIVE pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, w[i] AS w1, w[i+1:i+k-1] AS after, w[i:i+k-2] AS before
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split), (VALUES (1), (2), (3)) AS t(k)
  WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f, any_value(array_to_string(after, ' ')) AS tail, any_value(array_to_string(before, ' ')) AS head,
        any_value(w1) AS first, any_value(after[-1]) AS last FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, 1 AS cut, l.f AS l, r.f AS r FROM c
    JOIN f l ON l.lang = c.lang AND l.k = 1 AND l.phrase = c.first JOIN f r ON r.lang = c.lang AND r.k = c.k - 1 AND r.phrase = c.tail
  UNION ALL
  SELECT c.lang, c.k, c.phrase, c.f, 2, l.f, r.f FROM c
    JOIN f l ON l.lang = c.lang AND l.k = 2 AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.k = 1 AND r.phrase = c.last WHERE c.k = 3),
scored AS (SELECT *, (1000000 * a * a) // (l * r) AS score FROM cuts),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, phrase, max(f) AS most FROM (SELECT lang, head AS phrase, f FROM c WHERE k = 3 UNION ALL SELECT lang, tail, f FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT l.* FROM least l LEFT JOIN longer g ON g.lang = l.lang AND g.phrase = l.phrase AND l.k = 2 WHERE g.most IS NULL OR 100 * g.most < 50 * l.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
