"""Phrases, conversation repair and language model scores against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folioweave.llm import phrases, pitman_yor, repair, shards

DOCS = "doc_id long, text string, lang string, word string, shard long, a int, n long"


def texts(seed, n):
    rng = random.Random(seed)
    out = [None, "", "  ", ".", "a", "A a, a\ta a", "ü ü ü ü. ü ü", "x " * 3000, "one\x0btwo\x0cthree\rfour one two"]
    for _ in range(n):
        out.append("".join(rng.choice(["the ", "of ", "Mill ", "der ", "é ", " b ", "\tof ", ", ", "; ", "\n", "go! "]) for _ in range(rng.randint(1, 200))))
    return [*out, out[-1], out[-1]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 5 else i, t, [None, "en", "de", "und"][i % 4], "clash", 1, 2, 3) for i, t in enumerate(texts(3, 60))]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


def plain_collocations(rows, least, first, share):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f.update((lang or "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    longest = {k: v for k, v in f.items() if len(k[1]) == 3 and v >= least}
    out = {}
    for (lang, w), a in f.items():
        if len(w) == 1 or a < least:
            continue
        if any(w in (x[:2], x[1:]) and 100 * v >= share * a for (o, x), v in longest.items() if o == lang and len(w) == 2):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, c in out.items() for i, (s, a, p, l, r) in enumerate(sorted(c)[:first])}


@pytest.mark.parametrize("least,first,share", [(10, 2000, 50), (2, 15, 80)])
def test_collocations(docs, least, first, share, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_BYTES", 3000)
    got = {tuple(r) for r in phrases.collocations(docs, least, first, share).collect()}
    expected = plain_collocations([(r.lang, r.text) for r in docs.collect()], least, first, share)
    assert got == expected and len({x[0] for x in got}) == 3
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_bitmaps_in_batches(monkeypatch):
    """Counts do not depend on where batches of prefixes end, and bits carry over the ends of bytes."""
    rng = np.random.default_rng(1)
    ids, opens = rng.integers(-1, 5, 4000), rng.random(4000) < 0.05
    pairs = Counter((a, b) for a, b, o in zip(ids[:-1], ids[1:], opens[1:]) if min(a, b) >= 0 and not o)
    three = Counter((a, b, c) for a, b, c, o, q in zip(ids[:-2], ids[1:-1], ids[2:], opens[1:-1], opens[2:]) if min(a, b, c) >= 0 and not o and not q)
    frequent = np.array(sorted((a << 32) + b for a, b in pairs), np.int64)
    for batch in (10**6, 70):
        monkeypatch.setattr(phrases, "_BATCH", batch)
        maps = phrases.Bitmaps(ids, opens)
        code, n = phrases.pair_counts(maps)
        assert {(c >> 32, c & 0xFFFFFFFF): x for c, x in zip(code.tolist(), n.tolist())} == pairs
        k, third, n = phrases.triple_counts(maps, frequent)
        assert {(int(frequent[i] >> 32), int(frequent[i] & 0xFFFFFFFF), int(t)): int(x) for i, t, x in zip(k, third, n)} == three


def test_packed():
    for a in (np.zeros(0, np.int32), np.array([5, -7, 2**31 - 1], np.int32), np.arange(0, 10**7, 37, dtype=np.int64)):
        assert (shards.unpacked(shards.packed(a)) == a).all() and shards.unpacked(shards.packed(a)).dtype == a.dtype
        assert (shards.unpacked_sorted(shards.packed_sorted(a)) == a).all()


SPACE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """The report of one conversation's (turn, role, text) by trying every edit."""
    seen, faults, damaged = set(), [], []
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
        damaged.append((role, text))
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    for choice in itertools.product("DKua", repeat=len(damaged)):
        if any(c != "D" and f in ("blank", "duplicate") for c, f in zip(choice, faults)):
            continue
        for gap in itertools.product(gaps, repeat=len(damaged) + 1):
            cost, audit, out, initials = 3 * sum(map(len, gap)), "I" * len(gap[0]), [(x, "") for x in gap[0]], gap[0]
            for (role, text), c, f, g in zip(damaged, choice, faults, gap[1:]):
                cost += 4 if c == "D" else (3 if c in "ua" else 0) + (3 if f == "truncated" else 0)
                if c != "D":
                    out.append((c if c in "ua" else role, text))
                    initials += c if c in "ua" else role[:1] or "-"
                audit += (c if c in "DK" else "R") + "I" * len(g)
                out += [(x, "") for x in g]
                initials += g
            if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(f"{ {'u': 'user', 'a': 'assistant'}.get(r, r)}:{t}" for r, t in out)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(damaged, damaged[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), *best[:2], hashlib.sha256(best[2].encode()).hexdigest())


def test_repair(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(150):
        for turn in range(rng.choice([1, 2, 2, 3, 3])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), rng.choice(["Yes.", "No?\n", "so", "", None, "Yes.", "é! ", "a.b"]), "x", 0))
    rows += [(None, 0, "user", "Who?", "x", 0), (None, 1, "assistant", "Me.", "x", 0)]
    rows.append((next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0), 0, "user", "Gone.", "x", 0))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, fault string, seen long")
    after: dict = {}
    for conv, turn, role, text, *_ in rows:
        role, text, mine = " " if role is None else role, " " if text is None else text, after.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            mine += [(turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_report(table.repartition(7)).collect()}
    assert got.keys() == after.keys() and any(not v for v in after.values())
    for conv, mine in after.items():
        if len(mine) <= 3:
            assert got[conv] == plain_repair(mine), (conv, mine)
    assert repair.repair_report(table.limit(0)).count() == 0


def test_repair_of_a_long_conversation(spark):
    """Audits that are settled on the way are those of a walk that settles nothing; a text of a million characters passes."""
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"turn {i}.", "so"]), False) for i in range(3000)] + [(2, 0, "user", "word " * 200_000 + ".", False)]
    got = {r.conv_id: r for r in repair.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, gone boolean")).collect()}
    assert got[2].audit == "KI"
    costs, seen = {"": (0, "")}, set()
    for _, _, role, text, _ in rows[:3000]:
        new = {at: (c + 4, w + "D") for at, (c, w) in costs.items()}
        if (role, text) not in seen:
            for at, (c, w) in costs.items():
                for to in "sua":
                    if to == "s" and (at or role[0] != "s"):
                        continue
                    n = (at == to == "u") or (to == "a" and at != "u")
                    way = (c + 3 * n + 3 * (role[0] != to) + 3 * (text[-1] != "."), w + "I" * n + ("K" if role[0] == to else "R"))
                    new[to] = min(new.get(to, way), way)
        seen.add((role, text))
        costs = new
    more = {"": "", "s": "II", "u": "I", "a": ""}
    assert (got[1].cost, got[1].audit) == min((c + 3 * len(more[at]), w + more[at]) for at, (c, w) in costs.items())


def stirling(c, d):
    s = [1.0]
    for n in range(1, c):
        s = [(s[t - 2] if t > 1 else 0) + ((n - d * t) * s[t - 1] if t <= n else 0) for t in range(1, n + 2)]
    return s


def test_seating():
    """Many dishes reseated for long follow the exact law of the number of tables; the closed form beyond 256 holds."""
    d, b, c = 0.6, 2.5, 9
    law = np.array([s * b**t for t, s in enumerate(stirling(c, d), 1)])
    got = pitman_yor.reseated(np.full(40_000, c), np.ones(40_000, np.int64), np.full(40_000, b), pitman_yor.Alone(d), 150, np.random.default_rng(2))
    assert np.abs(np.bincount(got, minlength=c + 1)[1:] / 40_000 - law / law.sum()).max() < 0.012
    for d in (0.1, 0.5, 0.9):
        alone, t = pitman_yor.Alone(d), np.array([2, 3, 10, 60, 150, 250])
        with pytest.MonkeyPatch.context() as m:
            exact = alone(np.full(6, 256), t)
            m.setattr(pitman_yor, "_EXACT", 0)
            assert (np.abs(alone(np.full(6, 256), t) / exact - 1) < [0.1, 0.1, 0.03, 0.02, 0.02, 0.02]).all()
        assert alone(np.array([1000]), np.array([1]))[0] == 0
        first = pitman_yor.first_tables(np.array([2, 50, 10**6]), np.array([0.5, 3.0, 40.0]), alone)
        assert (first >= 1).all() and first[2] < 2000
    x = np.array([0.1, 0.7, 1.0, 3.5, 12.0, 1e6])
    assert np.allclose(pitman_yor.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)


def base_scores(rows):
    tokens = {}
    for k, (doc_id, text) in enumerate(rows):
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        tokens[k] = (doc_id, doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2, [*words, "\n"])
    c = Counter(w for _, held, t in tokens.values() if not held for w in t)
    n = sum(c.values())
    return [(i, held, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in t)) for i, held, t in tokens.values()], c, tokens


def test_lm_counts(docs, spark, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_BYTES", 4000)
    got = sorted((tuple(r) for r in pitman_yor.scores(docs, 1, 2, 2).collect()), key=str)
    expected = sorted(base_scores([(r.doc_id, r.text) for r in docs.collect()])[0], key=str)
    assert len(got) == len(expected)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for g, e in zip(sorted(got, key=key), sorted(expected, key=key)):
        assert g[:5] == e[:5] and math.isclose(g[5], e[5], rel_tol=1e-9) and g[6] < 0 and math.isfinite(g[6])
    assert pitman_yor.scores(docs.limit(0)).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    only = spark.createDataFrame([(i, "nothing to learn from") for i in held], "doc_id long, text string")
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in pitman_yor.scores(only, 1, 1, 1).collect())


def test_lm_without_chance(spark, monkeypatch):
    """Where every word is seen once but the end, which has one table a context, the model is a closed formula."""
    monkeypatch.setattr(pitman_yor, "STRENGTHS", (1.0,))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2][:1]
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = [(ids[0], "a b c d"), (held[0], "b c x"), (held[1], "x"), (held[2], "d")]
    got = {r.doc_id: r.score for r in pitman_yor.scores(spark.createDataFrame(rows, "doc_id long, text string"), 2, 2, 3).collect()}
    d = d0 = 0.95  # every pair and every word is seen once
    v = 5
    root = lambda known: ((1 - d0 if known else 0) + (1 + d0 * v) / (v + 1)) / (1 + v)
    seen = {("\n", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "\n")}
    for i, text in rows:
        w, want = ["\n", *text.split(), "\n"], 0.0
        for u, x in zip(w, w[1:]):
            n = 1 if u != "x" else 0
            want += math.log10(((1 - d if (u, x) in seen else 0) + (1 + d * n) * root(x != "x")) / (1 + n))
        assert math.isclose(got[i], want, rel_tol=1e-5)
    total = sum(root(k) for k in (True,) * v + (False,))
    assert math.isclose(total, 1)


def test_lm_learns(spark):
    """Texts whose words depend on the word before are likelier to the model than to single words, held out ones too."""
    rng = random.Random(3)
    after = {i: [rng.randrange(60) for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(300):
        w = [rng.randrange(60)]
        for _ in range(40):
            w.append(rng.choice(after[w[-1]]))
        rows.append((i, " ".join(f"w{x}" for x in w)))
    got = pitman_yor.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    for held in (True, False):
        own = [r for r in got if r.held_out == held]
        assert len(own) > 20 and sum(r.score for r in own) > 0.5 * sum(r.base_score for r in own)
