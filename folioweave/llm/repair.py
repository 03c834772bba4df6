"""Conversation structure repair: the cheapest kept subsequence of turns that makes a legal dialogue.

A dialogue is legal if its turns' role initials read ``(s?(ua)+)?``. A dynamic programme walks over the
turns in order. Its states are the last kept role (none, s, u, a); each holds its cheapest way so far, to
which a deleted turn adds the price of deletion, so a state's running minimum over all earlier kept turns
prices the gap behind it; the pair of the last kept role and the next one says how many turns to insert.
Ties go to the ASCII-least audit. Two ways to one state have the same turns behind them and neither's audit
is the beginning of the other's, so the smaller stays smaller and one way a state is enough.

Spark deals conversations out and sorts them, spilling where it must; a task reads its rows as a stream
and holds, besides the audits it returns, only what the states differ in: what all of them share is
settled as it comes, and a state dearer by more than any detour costs is dropped. Repeated turns are found
in Spark by conversation, role and text, so a long conversation is spread there. The walk itself is
sequential, so one conversation is walked by one task, in constant memory but for its audit.

Defined results: a null text or role is one space, and so are a null conv_id or turn inside the string
``conv_id:turn``; turns of one number come by role and text (null numbers first); an empty role fits
nowhere, so its turn is reroled or deleted; a null conv_id is a conversation of its own; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shards import arrow_schema

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_SPACE = r"\x20\x09-\x0D"
_NAMES = {"u": "user", "a": "assistant"}
#: No state need cost more than the cheapest and this: two inserted turns and a deleted one lead from any to any.
_DETOUR = 2 * INSERT + DELETE
_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns after damage chosen by crc32 of ``conv_id:turn``; a dropped turn stays as a row marked gone."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    k = F.col("kind")
    mended = F.when(k == 1, F.lit("")).when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(k == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), mended.alias("text"), (k == 0).alias("gone"), copies.alias("copy")).drop("copy")


def with_faults(turns: DataFrame) -> DataFrame:
    """Adds fault: blank, duplicate, truncated or null, the first that holds."""
    seen = F.row_number().over(Window.partitionBy("gone", "conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(~F.col("text").rlike(f"[^{_SPACE}]"), "blank").when(F.col("seen") > 1, "duplicate").when(~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"), "truncated")
    return turns.withColumn("seen", seen).withColumn("fault", F.when(~F.col("gone"), fault))


class Repair:
    """The walk over one conversation's turns."""

    def __init__(self):
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.last = self.low = self.high = None
        self.settled: list[str] = []
        self.ways = {"": (0, "", None)}  # last kept role -> cost, audit behind what is settled, digest of the repaired turns

    def turn(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if fault:
            self.counts[fault] += 1
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        found: dict[str, list] = {at: [(cost + DELETE, audit + "D", digest, None)] for at, (cost, audit, digest) in self.ways.items()}
        if fault not in ("blank", "duplicate"):
            price = TRUNCATED if fault else 0
            for to in ("s", "u", "a"):
                if to == "s" and initial != "s":
                    continue
                letter, name, more = ("K", role, 0) if to == initial else ("R", _NAMES[to], REROLE)
                for at, (cost, audit, digest) in self.ways.items():
                    if to == "s" and at:
                        continue
                    gap = "" if to == "s" else self._between(at, to)
                    added = [f"{_NAMES[x]}:" for x in gap] + [f"{name}:{text}"]
                    found.setdefault(to, []).append((cost + price + more + INSERT * len(gap), audit + "I" * len(gap) + letter, digest, added))
        bound = min(w[0] for ways in found.values() for w in ways) + _DETOUR
        best = {at: min(ways, key=lambda w: w[:2]) for at, ways in found.items()}
        self.ways = {at: (c, audit, self._digest(digest, added)) for at, (c, audit, digest, added) in best.items() if c <= bound}
        shared = len(os.path.commonprefix([w[1] for w in self.ways.values()]))
        if shared > 64:
            self.settled.append(next(iter(self.ways.values()))[1][:shared])
            self.ways = {at: (c, audit[shared:], digest) for at, (c, audit, digest) in self.ways.items()}

    @staticmethod
    def _between(at: str, to: str) -> str:
        """Turns to insert between a kept role and the next one, u or a."""
        return "a" if at == to == "u" else "u" if to == "a" and at != "u" else ""

    @staticmethod
    def _digest(digest, added: list[str] | None):
        if added is None:
            return digest
        new = digest.copy() if digest else hashlib.sha256()
        new.update((("\n" if digest else "") + "\n".join(added)).encode())
        return new

    def report(self, conv_id: int | None) -> tuple:
        ends = {"": "", "s": "ua", "u": "a", "a": ""}
        cost, audit, digest, more = min(((c + INSERT * len(ends[at]), audit + "I" * len(ends[at]), digest, ends[at]) for at, (c, audit, digest) in self.ways.items()), key=lambda w: w[:2])
        digest = self._digest(digest, [f"{_NAMES[x]}:" for x in more] if more else None) or hashlib.sha256()
        gaps = self.high - self.low + 1 - self.distinct if self.high is not None else 0
        return conv_id, gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"], self.illegal, cost, "".join(self.settled) + audit, digest.hexdigest()


def _walk(schema: pa.Schema):
    def rows(batches):
        at, walk, done = None, None, []
        for batch in batches:
            for conv_id, turn, role, text, gone, fault in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault"))):
                if walk is None or conv_id != at:
                    if walk:
                        done.append(walk.report(at))
                    at, walk = conv_id, Repair()
                if not gone:
                    walk.turn(turn, role, text, fault)
            if len(done) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if walk:
            done.append(walk.report(at))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return rows


def repaired(turns: DataFrame) -> DataFrame:
    """One row a conversation: its gaps, faults, cheapest repair (cost, audit) and the digest of the repaired turns.

    turns: conv_id, turn, role, text and gone (rows that only name their conversation).
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen"]
    rows = with_faults(turns).select("conv_id", "turn", "role", "text", "gone", "fault", "seen").repartition("conv_id").sortWithinPartitions(*order)
    return rows.mapInArrow(_walk(arrow_schema(turns.sparkSession, _OUT)), _OUT)


def repair_report(conversations: DataFrame) -> DataFrame:
    """repaired() of the damaged conversations; every conv_id of the input has its row."""
    return repaired(damaged(conversations))


def _oracle() -> str:
    """The same walk as a recursive query: four structs (cost, audit, repaired), the least of the ways to each."""
    names = {"u": "user", "a": "assistant"}

    def kept(at, to, cost, letter, role):
        gap = Repair._between(at, to) if to != "s" else ""
        added = " || chr(10) || ".join([f"'{names[x]}:'" for x in gap] + [f"{role} || ':' || text"])
        before = f"w{at}.t || chr(10) || " if at else "CASE WHEN w.n THEN w.t || chr(10) ELSE '' END || ".replace("w.", "w_.")
        return f"{{'c': w{at or '_'}.c + {cost + INSERT * len(gap)} + price, 'a': w{at or '_'}.a || '{'I' * len(gap)}{letter}', 't': {before}{added}, 'n': true}}"

    def ways(to):
        out = [f"{{'c': w{to}.c + {DELETE}, 'a': w{to}.a || 'D', 't': w{to}.t, 'n': w{to}.n}}"]
        for at in ("",) if to == "s" else ("", "s", "u", "a"):
            out.append(f"CASE WHEN free AND initial = '{to}' THEN {kept(at, to, 0, 'K', 'role')} END")
            if to != "s":
                out.append(f"CASE WHEN free AND initial <> '{to}' THEN {kept(at, to, REROLE, 'R', repr(names[to]))} END")
        return f"list_sort(list_filter([{', '.join(out)}], lambda x: x IS NOT NULL))[1]"

    never = "{'c': 1000000000::BIGINT, 'a': '', 't': '', 'n': false}"
    end = lambda at, more: f"{{'c': w{at}.c + {INSERT * len(more)}, 'a': w{at}.a || '{'I' * len(more)}', 't': w{at}.t" + "".join(f" || chr(10) || '{names[x]}:'" for x in more) + "}"
    return rf"""
WITH RECURSIVE t(t) AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hit AS (
  SELECT keyed.*, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM keyed, t),
turns AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit) WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen, left(role, 1) AS initial FROM turns),
faults AS (
  SELECT *, row_number() OVER o AS i, lag(initial) OVER o || initial AS pair,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault
  FROM numbered WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen)),
priced AS (SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS free, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS price FROM faults),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': '', 'n': false}} AS w_, {never} AS ws, {never} AS wu, {never} AS wa FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT walk.conv_id, priced.i, {{'c': w_.c + {DELETE}, 'a': w_.a || 'D', 't': '', 'n': false}}, {ways('s')}, {ways('u')}, {ways('a')}
  FROM walk JOIN priced ON priced.conv_id IS NOT DISTINCT FROM walk.conv_id AND priced.i = walk.i + 1),
ends AS (
  SELECT conv_id, list_sort([{end('_', '')}, {end('s', 'ua')}, {end('u', 'a')}, {end('a', '')}])[1] AS w FROM walk QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  w.c AS cost, w.a AS audit, sha256(w.t) AS repaired_sha256
FROM ends LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


ORACLE = _oracle()
