"""OCR lines to records, and records to validation reports, as Column builders.

Lines are arrays of struct<text,confidence,x,y,height> (x, y: least of the polygon, 0 without one).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import EDGE_L, EDGE_R, ascii_digits, clean, collapse, filled, first_of, group, let, normal

# Labels, aliases and letters that OCR confuses.
FATHER = ("father", "fathers name", "father name", "पिता का नाम", "पिता का नाभ", "पिता का नाय", "पिता का नाम :", "पिता का नाम-")
HUSBAND = ("husband", "husbands name", "husband name", "पति का नाम", "पति का नाभ", "पति का नाय", "पति का नाम :", "पति का नाम-")
NAME = ("elector name", "निर्वाचक का नाम", "निवाचक का नाम", "नवाचक का नाम", "मतदाता का नाम", "name")
HOUSE = ("house no", "house number", "house no.", "मकान संख्या", "मकान सं", "घर संख्या", "गृह संख्या", "गृह संखया", "गृह संक्या")
AGE = ("age", "उम्र", "आयु")
GENDER = ("gender", "sex", "लिंग", "िलंग")
MALE = ("male", "पुरुष", "mle", "maie", "पुरष", "पुरूष", "पुंरंष")
FEMALE = ("female", "महिला", "मिहला", "femaie", "femaje", "fe male")
OTHER = ("other", "अन्य")
BANNED = ("MALE", "FEMALE", "OTHER", "उम्र", "लिंग", "गृह", "EPIC", "PHOTO")
LETTERS = ("0124568AH", "OIZASGBRR")
DIGITS = ("ABDEGILOQSTUZ", "4805611005702")
_SEP = r"\s*[:\-–—]?\s*"


def placed(ocr: Column) -> Column:
    """Recognised lines (text, confidence, bounding_box) as lines of a card; a line without a box lies at the top left."""

    def one(l):
        at = lambda side, best: F.coalesce(best(F.transform(l["bounding_box"], lambda p: p[side])), F.lit(0.0))
        top = at("y", F.array_min)
        return F.struct(l["text"].alias("text"), l["confidence"].alias("confidence"), at("x", F.array_min).alias("x"), top.alias("y"), (at("y", F.array_max) - top).alias("height"))

    return F.transform(ocr, one)


def sorted_lines(lines: Column) -> Column:
    """By y, then x; equal places keep their order."""
    key = F.transform(lines, lambda l, i: F.struct(l["y"].alias("y"), l["x"].alias("x"), i.alias("i"), l.alias("l")))
    return F.transform(F.array_sort(key), lambda k: k["l"])


def line_texts(lines: Column) -> Column:
    return F.filter(F.transform(lines, lambda l: clean(l["text"])), lambda t: t != "")


def row_texts(lines: Column) -> Column:
    """Fragments on one visual row, left to right, as one text. Only the last row is open."""
    member = "struct<x:double,i:int,text:string>"
    start = F.struct(F.lit([]).cast(f"array<array<{member}>>").alias("done"), F.lit([]).cast(f"array<{member}>").alias("now"), F.lit(0.0).alias("mid"), F.lit(0.0).alias("tall"), F.lit(0).alias("i"))

    def step(a, l):
        mid, n = l["y"] + l["height"] / 2.0, F.size(a["now"])
        one = F.array(F.struct(l["x"].cast("double").alias("x"), a["i"].alias("i"), l["text"].alias("text")))
        near = (n > 0) & (F.abs(mid - a["mid"]) <= F.greatest(a["tall"] * 0.8, l["height"] * 0.8, F.lit(18.0)))
        done = F.when(near | (n == 0), a["done"]).otherwise(F.array_append(a["done"], a["now"]))
        return F.struct(
            done.alias("done"), F.when(near, F.concat(a["now"], one)).otherwise(one).alias("now"),
            F.when(near, (a["mid"] * n + mid) / (n + 1)).otherwise(mid).alias("mid"),
            F.when(near, F.greatest(a["tall"], l["height"])).otherwise(l["height"]).cast("double").alias("tall"), (a["i"] + 1).alias("i"),
        )

    some = F.filter(F.transform(lines, lambda l: F.struct(l["x"].cast("double").alias("x"), l["y"].cast("double").alias("y"), l["height"].cast("double").alias("height"), clean(l["text"]).alias("text"))), lambda l: l["text"] != "")
    rows = F.aggregate(some, start, step, lambda a: F.when(F.size(a["now"]) > 0, F.array_append(a["done"], a["now"])).otherwise(a["done"]))
    return F.transform(rows, lambda r: clean(F.array_join(F.transform(F.array_sort(r), lambda m: m["text"]), " ")))


def _stripped(value: Column) -> Column:
    return let(value, lambda v: F.coalesce(filled(F.ltrim(v, F.lit("0"))), F.when(v.isNotNull(), F.lit("0"))))


def serial_number(normals: Column) -> Column:
    """Of texts in their normal form, as epic_number and age take them."""

    def one(n):
        found = F.coalesce(
            group(n, rf"(?:serial|क्रमांक|क्रमांक संख्या|मतदाता क्रमांक){_SEP}([A-Z0-9]{{1,6}})"),
            group(n, rf"{EDGE_L}Q\s*([0-9]{{1,4}}){EDGE_R}"), group(n, rf"^\D{{0,3}}([0-9]{{1,4}}){EDGE_R}"),
        )
        return _stripped(found)

    return first_of(normals, one)


def repaired_epic(token: Column) -> Column:
    """A card number of three letters and seven digits out of a noisy token; null if there is none."""

    def windows(s):
        n = F.length(s)
        sizes = F.when(n >= 10, F.sequence(F.least(n, F.lit(12)), F.lit(10), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda at: F.substr(s, at, k))))

    def fit(w):
        plain = lambda t: F.when(F.length(t) >= 10, F.concat(F.translate(F.substring(t, 1, 3), *LETTERS), F.translate(F.substring(t, 4, 7), *DIGITS)))
        return let(let(F.replace(w, F.lit("?"), F.lit("")), plain), lambda out: F.when(out.rlike("^[A-Z]{3}[0-9]{7}$"), out))

    return first_of(let(F.regexp_replace(F.upper(ascii_digits(token)), "[^A-Z0-9?]", ""), windows), fit)


def epic_number(normals: Column) -> Column:
    def one(n):
        exact = group(n, rf"{EDGE_L}([A-Z]{{3}}[0-9]{{7}}){EDGE_R}")
        label = repaired_epic(group(n, rf"(?:epic|photo identity card number|पहचान पत्र संख्या){_SEP}([A-Z0-9?]+)"))
        return F.coalesce(exact, label, first_of(F.regexp_extract_all(n, F.lit("([A-Z0-9?]{8,12})")), repaired_epic))

    return first_of(normals, one)


def field_value(value: Column) -> Column:
    v = F.trim(F.regexp_replace(value, r"(?U)\s+", " "), F.lit(" :-"))
    v = F.trim(v, F.lit(" ?!.,;/"))
    words = "name|age|gender|sex|house no|house number|elector name|photo identity card number|epic"
    return filled(F.regexp_replace(v, rf"(?i){EDGE_L}(?:{words}){EDGE_R}{_SEP.removesuffix(chr(92) + 's*')}", ""))


def _any_of(labels) -> str:
    """A pattern for texts that hold one of the labels; those that hold another label need no branch."""
    upper = dict.fromkeys(x.upper() for x in labels)
    return "|".join(re.escape(x).replace("\\ ", " ") for x in upper if not any(y != x and y in x for y in upper))


def looks_like_label(normal_text: Column) -> Column:
    return normal_text.rlike(_any_of((*FATHER, *HUSBAND, *NAME, *HOUSE, *AGE, *GENDER)))


def _patterns(labels) -> Column:
    """array<struct<label, spaced, joined>>: each label in upper case, and the patterns of what follows it, as data."""
    text = lambda t: "r'" + t.replace("'", "[\u0027]") + "'"
    rows = []
    for label in labels:
        own = re.escape(label).replace("\\ ", " ")
        rows.append(f"named_struct('label', {text(label.upper())}, 'spaced', {text(rf'(?iu){own}(?:\s*[:\-–—]\s*|\s+)(.+)$')}, 'joined', {text(rf'(?iu){own}\s*(.+)$')})")
    return F.expr(f"array({', '.join(rows)})")


def _after(text: Column, label: Column) -> Column:
    got = lambda p: filled(F.call_function("regexp_extract", text, p, F.lit(1)))
    return field_value(F.coalesce(got(label["spaced"]), got(label["joined"])))


def prepared(texts: Column) -> Column:
    """For labelled(): each text with its normal form and value, whether the next one is a label, and the next one's value."""
    known = F.transform(texts, lambda t: let(normal(t), lambda n: F.struct(t.alias("t"), n.alias("n"), looks_like_label(n).alias("like"), field_value(t).alias("v"))))
    both = lambda ks: F.transform(ks, lambda k, i: let(F.get(ks, i + 1), lambda n: F.struct(k["t"].alias("t"), k["n"].alias("n"), k["v"].alias("v"), (n["like"] == F.lit(False)).alias("open"), n["v"].alias("below"))))
    return let(known, both)


def labelled(rows: Column, lines: Column, labels) -> Column:
    """The value after the first label found, in rows and then in lines (both prepared).

    A label with nothing after it takes the next line's value, unless that looks like a label too;
    then the text's other labels, and later texts, are looked at. One pattern passes over the texts
    without any label; the labels of the others are tried one by one until one settles the field.
    """
    none = F.lit(None).cast("struct<v:string>")

    def one(s):
        held = F.filter(_patterns(labels), lambda l: F.contains(s["n"], l["label"]))
        own = lambda l: let(_after(s["t"], l), lambda a: F.when(a.isNotNull() | F.coalesce(s["open"], F.lit(False)), F.struct(F.coalesce(a, s["below"]).alias("v"))))
        return F.when(s["n"].rlike(_any_of(labels)), F.aggregate(held, none, lambda acc, l: F.coalesce(acc, own(l))))

    found = F.aggregate(F.concat(rows, lines), none, lambda acc, s: F.coalesce(acc, one(s)))
    return found["v"]


def age(normals: Column) -> Column:
    def one(n):
        some = F.contains(n, F.lit(AGE[1])) | F.contains(n, F.lit(AGE[2]))
        return F.coalesce(group(n, rf"(?:age|उम्र|आयु){_SEP}([0-9]{{1,3}})"), F.when(some, group(n, rf"{EDGE_L}([1-9][0-9]){EDGE_R}")))

    return first_of(normals, one).cast("int")


def gender(normals: Column) -> Column:
    def one(t):
        return let(F.replace(t, F.lit("0"), F.lit("O")), lambda n: F.when(n.rlike("|".join(MALE)), "male").when(n.rlike("|".join(FEMALE)), "female").when(n.rlike("|".join(OTHER)), "other"))

    return first_of(normals, one)


def name_fallback(values: Column, relation_name: Column) -> Column:
    """The first of the texts' values (field_value) that may be a name."""

    def one(v):
        def bad(n):
            short_number = n.rlike(rf"{EDGE_L}[0-9]{{1,4}}{EDGE_R}") & (F.size(F.split(collapse(v), " ")) <= 2)
            return F.coalesce(v == relation_name, F.lit(False)) | n.rlike("|".join(BANNED)) | short_number | looks_like_label(n) | (F.char_length(v) <= 2)

        return F.when(v.isNotNull() & ~let(normal(v), bad) & repaired_epic(v).isNull(), v)

    return first_of(values, one)


def records(df: DataFrame, lines: str = "lines") -> DataFrame:
    """df with the fields of a record parsed from its array of lines."""
    ordered = df.withColumn("lines_", sorted_lines(F.col(lines))).withColumn("low_", line_texts(F.col("lines_"))).withColumn("rows_", row_texts(F.col("lines_")))
    normals = F.col("normals_")
    some = F.when(F.size("rows_") > 0, F.col("rows_")).otherwise(F.col("low_"))
    r, l = F.col("rows_p_"), F.col("low_p_")
    out = ordered.withColumn("rows_p_", prepared(F.col("rows_"))).withColumn("low_p_", prepared(F.col("low_")))
    out = out.withColumn("normals_", F.transform(F.concat("rows_p_", "low_p_"), lambda s: s["n"]))
    out = out.withColumns({"father_": labelled(r, l, FATHER), "husband_": labelled(r, l, HUSBAND), "name_": labelled(r, l, NAME), "house_number": labelled(r, l, HOUSE)})
    return out.select(
        *df.columns,
        serial_number(normals).alias("serial_number"), epic_number(normals).alias("epic_number"),
        F.coalesce("name_", name_fallback(F.transform(F.when(F.size("rows_") > 0, F.col("rows_p_")).otherwise(F.col("low_p_")), lambda s: s["v"]), F.coalesce("father_", "husband_"))).alias("elector_name"),
        F.when(F.col("father_").isNotNull(), "father").when(F.col("husband_").isNotNull(), "husband").alias("relation_type"),
        F.coalesce("father_", "husband_").alias("relation_name"),
        "house_number", age(normals).alias("age"), gender(normals).alias("gender"), filled(F.array_join(some, "\n")).alias("raw_text"),
    )


def sought(lines: Column) -> Column:
    """For field_confidence(): the lines' texts in upper case, with their confidence."""
    return F.transform(lines, lambda l: F.struct(F.upper(collapse(l["text"])).alias("t"), l["confidence"].alias("c")))


def field_confidence(value: Column, own: Column) -> Column:
    """Greatest confidence of a line (sought) that holds the value, or that the value holds."""
    v = F.upper(collapse(value.cast("string")))
    return let(filled(v), lambda t: F.array_max(F.transform(F.filter(own, lambda l: F.contains(l["t"], t) | F.contains(t, l["t"])), lambda l: l["c"])))


def reports(df: DataFrame, threshold: float = 0.8, lines: str = "lines") -> DataFrame:
    """df (records with their lines and, if there, deleted, deleted_confidence) with is_valid, issues, retry_fields."""
    c = F.col
    blank = lambda n: c(n).isNull() | (collapse(c(n)) == "")
    fields = ("epic_number", "age", "gender", "house_number", "relation_type", "relation_name")
    columns = df.columns
    df = df.withColumn("sought_", sought(c(lines))).withColumns({f"conf_{n}_": field_confidence(c(n), c("sought_")) for n in fields})
    conf = {n: c(f"conf_{n}_") for n in fields}

    def issue(name, code, message, when, confidence=None):
        return F.when(when, F.struct(F.lit(name).alias("field_name"), F.lit(code).alias("issue_code"), F.lit(message).alias("message"), (c(name).cast("string") if name in df.columns else F.lit(None).cast("string")).alias("value"), (conf.get(name, F.lit(None).cast("double")) if confidence is None else confidence).alias("confidence")))

    issues = [
        F.coalesce(issue("epic_number", "missing_epic_number", "EPIC number is missing.", c("epic_number").isNull()), issue("epic_number", "invalid_epic_format", "EPIC number has an invalid format.", ~F.upper("epic_number").rlike("^[A-Z]{3}[0-9]{7}$"))),
        F.coalesce(issue("age", "missing_age", "Age is missing.", c("age").isNull()), issue("age", "invalid_age_range", "Age is outside 18 to 120.", ~c("age").between(18, 120))),
        F.coalesce(issue("gender", "missing_gender", "Gender is missing.", c("gender").isNull()), issue("gender", "invalid_gender_value", "Gender is not a known value.", ~c("gender").isin("पुरुष", "महिला", "male", "female"))),
        issue("house_number", "empty_house_number", "House number is empty.", blank("house_number")),
        F.coalesce(issue("relation_type", "missing_relation_type", "Relation type is missing.", c("relation_type").isNull()), issue("relation_type", "invalid_relation_type", "Relation type is not a known value.", ~c("relation_type").isin("Father", "Husband", "father", "husband"))),
        issue("relation_name", "missing_relation_name", "Relation name is missing.", blank("relation_name")),
    ]
    if "deleted_confidence" in df.columns:
        d = c("deleted_confidence")
        issues.append(F.coalesce(issue("deleted_detection", "invalid_deleted_confidence", "Confidence is outside 0 to 1.", ~d.between(0, 1), d), issue("deleted_detection", "weak_deleted_confidence", "Deleted with low confidence.", c("deleted") & (d < 0.5), d)))
    retry = [F.when(conf[n] < threshold, F.struct(F.lit(n).alias("field_name"), conf[n].alias("confidence"), F.format_string("OCR confidence %.2f is below threshold %.2f.", conf[n], F.lit(threshold)).alias("reason"))) for n in fields]
    out = df.withColumns({"issues": F.array_compact(F.array(*issues)), "retry_fields": F.array_compact(F.array(*retry))})
    return out.select(*columns, "issues", "retry_fields", (F.size("issues") == 0).alias("is_valid"))
