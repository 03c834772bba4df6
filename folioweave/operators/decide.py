"""Deletion decisions and handling of model payloads, as Column builders."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, functions as F

from ..functions.text import ascii_digits, collapse, group, stamp

# Markers of failures worth another try, and words that labels hold.
RETRYABLE = ("429", "rate limit", "rate_limit", "temporarily unavailable", "timeout", "timed out", "connection", "server error", "service unavailable", "too many requests")
FRAGMENTS = ("निर्वाचक", "निवाचक", "मतदाता", "elector", "name", "पिता", "पति", "गृह", "house", "उम्र", "आयु", "लिंग", "gender")
PHRASES = ("निर्वाचक का", "निवाचक का", "पिता का", "पति का")


def serial_stage(box: Column, left: Column, right: Column, visual_q: Column) -> Column:
    """struct<level, score, q_detected> from the stamped texts of the serial box and its two sides."""
    texts = lambda a: F.transform(a, lambda t: ascii_digits(stamp(t)))
    number = lambda a: F.exists(texts(a), lambda t: t.rlike("^[0-9]{1,4}$"))
    numbered_q = F.exists(texts(box), lambda t: t.rlike("^Q[0-9]{1,4}$"))
    bare = F.exists(F.concat(texts(box), texts(left)), lambda t: t == "Q")
    like = F.exists(texts(left), lambda t: t.isin("Q", "9", "0"))
    strong = numbered_q | ((like | visual_q) & number(right)) | (bare & number(box))
    medium = bare | like | visual_q
    level = F.when(strong, "strong").when(medium, "medium").otherwise("none")
    return F.struct(level.alias("level"), F.when(strong, 0.95).when(medium, 0.65).otherwise(0.0).alias("score"), (strong | medium).alias("q_detected"))


def geometry_level(width_ratio: Column, height_ratio: Column, letters: Column) -> Column:
    return F.when((width_ratio >= 0.18) & (height_ratio >= 0.03) & (letters >= 3), "strong").when((width_ratio >= 0.12) & (height_ratio >= 0.025) & (letters >= 2), "medium").otherwise("none")


def decision(serial: Column, geometry: Column, watermark: Column) -> Column:
    """struct<deleted, confidence, rule>; each argument is none, medium or strong. The first rule that holds counts."""
    q, g, w = serial != "none", geometry != "none", watermark != "none"
    rule = lambda deleted, confidence, name: F.struct(F.lit(deleted).alias("deleted"), confidence.alias("confidence"), F.lit(name).alias("rule"))
    sure = lambda level, yes: F.when(level == "strong", yes).otherwise(0.9)
    return (
        F.when(q & g, rule(True, sure(serial, 0.96), "rule_1_q_and_geometry"))
        .when(w & g, rule(True, sure(watermark, 0.97), "rule_2_watermark_ocr_and_geometry"))
        .when(q & ~g, rule(False, F.lit(0.3), "rule_5_q_without_watermark"))
        .when(g & ~w & ~q, rule(False, F.lit(0.2), "rule_4_geometry_without_ocr"))
        .otherwise(rule(False, F.lit(0.0), "normal"))
    )


def similarity(tokens: Column, word: str = "DELETED") -> Column:
    """Greatest Ratcliff/Obershelp ratio of an array of tokens to a word (an Arrow-batched function)."""
    @F.pandas_udf("double")
    def ratio(batch: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        known: dict[str, float] = {}
        score = lambda t: known.setdefault(t, SequenceMatcher(None, t, word).ratio())
        return batch.map(lambda ts: max([0.0, *(score(t) for t in ts)]) if ts is not None else 0.0)

    return ratio(tokens)


def watermark_level(exact: Column, ratio: Column) -> Column:
    return F.when(exact | (ratio >= 0.82), "strong").when(ratio >= 0.65, "medium").otherwise("none")


def retryable(message: Column) -> Column:
    low = F.lower(message)
    return reduce(or_, [F.contains(low, F.lit(m)) for m in RETRYABLE])


_HINT = re.compile(r"try again in\s*(\d+(?:\.\d+)?)s", re.I)


def wait_seconds(message: str, attempt: int) -> float:
    """The time a provider names and half a second more, at least one; else doubling from one to thirty."""
    hint = _HINT.search(message)
    return max(float(hint[1]) + 0.5, 1.0) if hint else float(min(2 ** min(max(attempt - 1, 0), 5), 30))


def retry_delay(message: Column, attempt: Column) -> Column:
    """wait_seconds() of columns."""
    hint = group(message, f"(?i){_HINT.pattern}").cast("double")
    doubling = F.pow(F.lit(2.0), F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(5)).cast("double"))
    return F.when(hint.isNotNull(), F.greatest(hint + 0.5, F.lit(1.0))).otherwise(F.least(doubling, F.lit(30.0)))


def carved_json(text: Column) -> Column:
    """The JSON object in a model's answer: all of it, a fenced block, or from the first { to the last }."""
    t = F.regexp_replace(text, r"^(?U)\s+|(?U)\s+$", "")
    return F.when(F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}")), t).otherwise(F.coalesce(group(t, r"(?s)```(?:json)?\s*(\{.*?\})\s*```"), group(t, r"(?s)(\{.*\})")))


def optional(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text.cast("string"), r"^(?U)\s+|(?U)\s+$", ""), F.lit(""))


def labelled_line(value: Column) -> Column:
    low = F.lower(collapse(value))
    some = reduce(or_, [F.contains(low, F.lit(x)) for x in FRAGMENTS])
    phrase = reduce(or_, [F.contains(low, F.lit(x)) for x in PHRASES])
    return F.contains(low, F.lit(":")) | ((F.size(F.split(low, " ")) >= 4) & some) | phrase


def quality_issue(p: dict[str, Column]) -> Column:
    """Why a payload is too weak to trust; null if it is not. p: columns by field name."""
    o = {k: optional(v) for k, v in p.items()}
    second = sum((o[k].isNotNull().cast("int") for k in ("epic_number", "relation_name", "house_number", "gender")), p["age"].isNotNull().cast("int"))
    return (
        F.when(o["serial_number"].isNull() & (second < 3), "serial_number is missing")
        .when(o["elector_name"].isNull(), "elector_name is missing")
        .when(labelled_line(o["elector_name"]), "elector_name still contains labels or non-name text")
        .when(labelled_line(o["relation_name"]), "relation_name still contains labels or non-name text")
        .when(second == 0, "all secondary fields are missing")
    )


def completeness(p: dict[str, Column]) -> Column:
    names = ("serial_number", "epic_number", "elector_name", "relation_name", "house_number", "age", "gender")
    return sum((optional(p[k]).isNotNull().cast("int") for k in names), F.lit(0))
