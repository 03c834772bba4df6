"""The registered queries, one or more per operator, and their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import decide as D, fields as P, geometry as G, recognition as O, records as R, regions as W
from . import fixtures as X

FLAGSHIP = "v9_report"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- sources and names


@query("SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'document') AS name FROM pages")
def s3_normalize_name(spark, d):
    return X.table(spark, d, "pages").select("page_id", T.directory_name(F.col("url")).alias("name"))


@query("WITH p AS (SELECT o_custkey AS roll, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS source_page, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT roll, source_page::BIGINT AS source_page, (source_page - 2)::BIGINT AS page FROM p WHERE n > 3 AND source_page BETWEEN 3 AND n - 1")
def s4_page_prune(spark, d):
    from pyspark.sql import Window

    from ..sources.pages import inner_pages

    w = Window.partitionBy("roll")
    p = X.table(spark, d, "orders").select(F.col("o_custkey").alias("roll"), "o_orderkey")
    p = p.select("roll", F.row_number().over(w.orderBy("o_orderkey")).cast("long").alias("source_page"), F.count(F.lit(1)).over(w).alias("n"))
    return inner_pages(p, F.col("n")).select("roll", "source_page", "page")


@query(f"SELECT o_orderkey AS k, CAST(regexp_extract(c, '(?i)page_([0-9]+)_entry_([0-9]+)\\.png$', 1) AS INT) AS page, CAST(regexp_extract(c, '(?i)page_([0-9]+)_entry_([0-9]+)\\.png$', 2) AS INT) AS entry_index FROM (SELECT o_orderkey, {X.CROP} AS c FROM orders)")
def s7_crop_key(spark, d):
    from ..sources.crops import crop_key

    c = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.expr(X.CROP).alias("path"))
    return c.select("k", *crop_key(F.col("path")))


@query("SELECT key AS header, min(event_id) AS first_row FROM (SELECT event_id, unnest(json_keys(props)) AS key FROM events) WHERE key <> 'raw_text' GROUP BY key")
def k4_headers(spark, d):
    from ..sinks.spreadsheet import headers

    return headers(X.table(spark, d, "events"), "event_id", "props").select("header", "first_row")


# ---- rectangles

_CELL = "width BETWEEN CAST(900 * 0.15 AS INT) AND CAST(900 * 0.4 AS INT) AND height BETWEEN CAST(1200 * 0.05 AS INT) AND CAST(1200 * 0.2 AS INT) AND x > 0 AND y > 0 AND x + width < 900 AND y + height < 1200 AND width / greatest(height, 1)::DOUBLE BETWEEN 1.2 AND 4.5"


@query(f"SELECT page, line, x, y, width, height FROM ({X.RECTS_SQL}) WHERE {_CELL}")
def g6_valid_rect(spark, d):
    r = X.rectangles(spark, d)
    return r.where(G.is_cell(F.struct("x", "y", "width", "height"), F.lit(900), F.lit(1200)))


_IOU = "CASE WHEN least(a.x + a.width, b.x + b.width) <= greatest(a.x, b.x) OR least(a.y + a.height, b.y + b.height) <= greatest(a.y, b.y) THEN 0 ELSE (least(a.x + a.width, b.x + b.width) - greatest(a.x, b.x)) * (least(a.y + a.height, b.y + b.height) - greatest(a.y, b.y))::DOUBLE / (a.width * a.height + b.width * b.height - (least(a.x + a.width, b.x + b.width) - greatest(a.x, b.x)) * (least(a.y + a.height, b.y + b.height) - greatest(a.y, b.y))) END"


@query(f"WITH r AS ({X.RECTS_SQL}) SELECT a.page, a.line, round({_IOU}, 4) AS iou FROM r a JOIN r b ON a.page = b.page AND b.line = a.line + 1")
def g9_iou(spark, d):
    r = X.rectangles(spark, d)
    a = r.select("page", "line", F.struct("x", "y", "width", "height").alias("a"))
    b = r.select("page", (F.col("line") - 1).alias("line"), F.struct("x", "y", "width", "height").alias("b"))
    return a.join(b, ["page", "line"]).select("page", "line", F.round(G.overlap(F.col("a"), F.col("b")), 4).alias("iou"))


def _flat(df, rects):
    return df.select("page", F.posexplode(rects).alias("pos", "r")).select("page", (F.col("pos") + 1).alias("entry_index"), "r.*")


@query(f"WITH r AS ({X.RECTS_SQL}), m AS (SELECT page, count(*) AS n, median(width) AS mw, median(height) AS mh FROM r GROUP BY page), j AS (SELECT r.*, n, width BETWEEN mw * 0.55 AND mw * 1.65 AND height BETWEEN mh * 0.55 AND mh * 1.65 AS ok FROM r JOIN m USING (page)), k AS (SELECT *, sum(ok::INT) OVER (PARTITION BY page) AS kept FROM j) SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY line, x, y, width, height) AS INT) AS entry_index, x, y, width, height FROM k WHERE n < 4 OR kept = 0 OR ok")
def g11_outliers(spark, d):
    return _flat(X.page_rectangles(spark, d), G.without_outliers(F.col("rects")))


def _listed(order: str) -> str:
    return f"SELECT page, list({{'x': x, 'y': y, 'width': width, 'height': height}} ORDER BY {order}) AS rects, median(height) AS mid FROM ({X.RECTS_SQL}) GROUP BY page"


def _folded(order: str, first: str, step: str, then: str = "a") -> str:
    """SQL that folds a page's rectangles: ``first`` makes a list of one of a rectangle r, ``step`` joins such a list b to what there is, a."""
    fold = f"SELECT page, list_reduce(list_transform(rects, lambda r: {first}), lambda a, b: {step}) AS a FROM (SELECT page, rects, greatest(10, floor(floor(mid) / 2)) AS near FROM ({_listed(order)}))"
    return f"SELECT page, i::INT AS entry_index, a[i].x AS x, a[i].y AS y, a[i].width AS width, a[i].height AS height FROM (SELECT page, a, unnest(range(1, len(a) + 1)) AS i FROM (SELECT page, {then} AS a FROM ({fold})))"


_PLACE = "y, x, -width * height, width, height"
_ROW = "{{'row': {row}, 'x': {r}.x, 'y': {r}.y, 'width': {r}.width, 'height': {r}.height, 'start': {start}}}"
_NEAR = "abs(b[1].y - a[-1].start) <= near"


@query(_folded(_PLACE, "[" + _ROW.format(row=1, r="r", start="r.y") + "]", "a || [" + _ROW.format(row=f"CASE WHEN {_NEAR} THEN a[-1].row ELSE a[-1].row + 1 END", r="b[1]", start=f"CASE WHEN {_NEAR} THEN a[-1].start ELSE b[1].y END") + "]", "list_transform(list_sort(a), lambda r: {'x': r.x, 'y': r.y, 'width': r.width, 'height': r.height})"))
def g12_row_sort(spark, d):
    return _flat(X.page_rectangles(spark, d), G.in_rows(F.col("rects")))


@query(_folded("line, x, y, width, height", "[r]", "CASE WHEN len(list_filter(a, lambda k: abs(k.x - b[1].x) <= 4 AND abs(k.y - b[1].y) <= 4 AND abs(k.width - b[1].width) <= 6 AND abs(k.height - b[1].height) <= 6)) > 0 THEN a ELSE a || b END"))
def g7_near_dup(spark, d):
    return _flat(X.page_rectangles(spark, d), G.without_similar(F.col("rects")))


_W2, _H2 = "(least(k.x + k.width, b[1].x + b[1].width) - greatest(k.x, b[1].x))", "(least(k.y + k.height, b[1].y + b[1].height) - greatest(k.y, b[1].y))"
_COVERS = f"({_W2} > 0 AND {_H2} > 0 AND {_W2} * {_H2} >= 0.9 * (k.width * k.height + b[1].width * b[1].height - {_W2} * {_H2}))"


@query(_folded(_PLACE, "[r]", f"CASE WHEN len(list_filter(a, lambda k: {_COVERS})) = 0 THEN a || b ELSE list_transform(a, lambda k, i: CASE WHEN i = list_position(list_transform(a, lambda k: {_COVERS}), true) AND b[1].width * b[1].height > k.width * k.height THEN b[1] ELSE k END) END"))
def g8_iou_dedup(spark, d):
    return _flat(X.page_rectangles(spark, d), G.without_overlaps(F.col("rects")))


_MEAN = "list_sum(list_transform(g, lambda r: r.y + r.height / 2)) / len(g)"
_LEVEL = f"list_position(list_transform(a, lambda g: abs(b[1][1].y + b[1][1].height / 2 - {_MEAN}) <= 96), true)"
_HULL = "{'x': list_min(list_transform(g, lambda r: r.x)), 'y': list_min(list_transform(g, lambda r: r.y)), 'width': list_max(list_transform(g, lambda r: r.x + r.width)) - list_min(list_transform(g, lambda r: r.x)), 'height': list_max(list_transform(g, lambda r: r.y + r.height)) - list_min(list_transform(g, lambda r: r.y))}"


@query(_folded("y, x, line, width, height", "[[r]]", f"CASE WHEN coalesce({_LEVEL}, 0) = 0 THEN a || b ELSE list_transform(a, lambda g, i: CASE WHEN i = {_LEVEL} THEN g || b[1] ELSE g END) END", f"list_reduce(list_transform(flatten(list_transform(a, lambda g: CASE WHEN len(g) > 1 THEN g || [{_HULL}] ELSE g END)), lambda r: [r]), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE a || b END)"))
def d14_group_boxes(spark, d):
    from ..operators.watermark import banded

    return _flat(X.page_rectangles(spark, d).withColumn("rects", banded(F.col("rects"), 1200)), F.col("rects"))


@query(f"SELECT page, line, greatest(x - 40, 0) AS cx, greatest(y - 40, 0) AS cy, least(width, 500 - greatest(x - 40, 0)) AS cw, least(height, 300 - greatest(y - 40, 0)) AS ch, printf('page_%03d_entry_%03d.png', page % 1000, line) AS name FROM ({X.RECTS_SQL}) WHERE greatest(x - 40, 0) < 500 AND greatest(y - 40, 0) < 300 AND least(width, 500 - greatest(x - 40, 0)) >= 40 AND least(height, 300 - greatest(y - 40, 0)) >= 40")
def c1_clamp(spark, d):
    r = X.rectangles(spark, d)
    box = F.struct((F.col("x") - 40).alias("x"), (F.col("y") - 40).alias("y"), "width", "height")
    c = r.select("page", "line", G.clamped(box, F.lit(500), F.lit(300)).alias("c")).where("c is not null")
    return c.select("page", "line", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"), F.col("c.width").alias("cw"), F.col("c.height").alias("ch"), F.format_string("page_%03d_entry_%03d.png", F.col("page") % 1000, "line").alias("name"))


# ---- OCR lines to records

_TOP = "(SELECT *, upper(translate(t0 || ' ' || t1, '०१२३४५६७८९', '0123456789')) AS top FROM (" + X.CARD_SQL + "))"
_SERIAL = r"coalesce(nullif(regexp_extract(top, 'क्रमांक\s*[:\-–—]?\s*([A-Z0-9]{1,6})', 1), ''), nullif(regexp_extract(top, '\bQ\s*([0-9]{1,4})\b', 1), ''), nullif(regexp_extract(top, '^\D{0,3}([0-9]{1,4})\b', 1), ''))"
_SERIAL = f"coalesce(nullif(ltrim({_SERIAL}, '0'), ''), CASE WHEN {_SERIAL} IS NOT NULL THEN '0' END)"
_EPIC = r"coalesce(nullif(regexp_extract(top, '\b([A-Z]{3}[0-9]{7})\b', 1), ''), translate(substr(t1, 1, 3), '0124568AH', 'OIZASGBRR') || translate(substr(t1, 4, 7), 'ABDEGILOQSTUZ', '4805611005702'))"
_RECORD = {
    "serial_number": _SERIAL,
    "epic_number": _EPIC,
    "elector_name": r"nullif(regexp_extract(t2, 'का नाम\s*[:\-–—]\s*(.+)$', 1), '')",
    "relation_type": "CASE WHEN contains(t3, 'पिता') THEN 'father' ELSE 'husband' END",
    "relation_name": r"nullif(regexp_extract(t3, 'का नाम\s*[:\-–—]\s*(.+)$', 1), '')",
    "house_number": r"nullif(regexp_extract(t4, 'संख्या\s*[:\-–—]\s*(.+)$', 1), '')",
    "age": r"TRY_CAST(nullif(regexp_extract(t5, 'उम्र\s*[:\-–—]?\s*([0-9]{1,3})', 1), '') AS INT)",
    "gender": "CASE WHEN contains(t5, 'पुरुष') THEN 'male' WHEN contains(t5, 'महिला') THEN 'female' END",
    "raw_text": "array_to_string(list_filter([t0 || ' ' || t1, t2, t3, t4, t5], lambda t: t <> ''), chr(10))",
}
RECORD_SQL = "SELECT k, " + ", ".join(f"{e} AS {n}" for n, e in _RECORD.items()) + f" FROM {_TOP}"


def _records(spark, d):
    return R.records(X.cards(spark, d))


def _one(name, *fields):
    def f(spark, d):
        return _records(spark, d).select("k", *fields)

    f.__name__ = name
    query(f"SELECT k, {', '.join(fields)} FROM ({RECORD_SQL})")(f)


_one("x7_record", *_RECORD)
_one("x8_serial", "serial_number")
_one("x9_epic", "epic_number")
_one("x11_labelled", "elector_name", "house_number")
_one("x14_relation", "relation_type", "relation_name")
_one("x16_age", "age")
_one("x17_gender", "gender")


@query(f"SELECT k, array_to_string(list_filter([t0 || ' ' || t1, t2, t3, t4, t5], lambda t: t <> ''), '|') AS row_texts FROM {_TOP}")
def x5_row_group(spark, d):
    return X.cards(spark, d).select("k", F.array_join(R.row_texts(R.sorted_lines(F.col("lines"))), "|").alias("row_texts"))


@query(f"SELECT k, array_to_string(list_filter([t0, t1, t2, t3, t4, t5], lambda t: t <> ''), '|') AS line_texts FROM {_TOP}")
def x3_line_sort(spark, d):
    return X.cards(spark, d).select("k", F.array_join(R.line_texts(R.sorted_lines(F.reverse("lines"))), "|").alias("line_texts"))


@query("SELECT p_partkey AS k, CASE WHEN regexp_matches(r, '^[A-Z]{3}[0-9]{7}$') THEN r END AS epic FROM (SELECT p_partkey, translate(substr(c, 1, 3), '0124568AH', 'OIZASGBRR') || translate(substr(c, 4, 7), 'ABDEGILOQSTUZ', '4805611005702') AS r FROM (SELECT p_partkey, 'H' || substr('DRKMPA', p_partkey % 5 + 1, 2) || translate(lpad(CAST(p_partkey AS STRING), 7, '0'), '058', 'OSB') AS c FROM part))")
def x10_repair(spark, d):
    token = F.expr("concat('H', substr('DRKMPA', CAST(p_partkey % 5 AS INT) + 1, 2), translate(lpad(CAST(p_partkey AS STRING), 7, '0'), '058', 'OSB'))")
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), R.repaired_epic(token).alias("epic"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS elector_name FROM part")
def x18_name(spark, d):
    texts = F.array(F.lit("Age 34"), F.lit("AB"), F.lit("लिंग: x"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("Ab 12"))
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), R.name_fallback(F.transform(texts, R.field_value), F.lit("zz")).alias("elector_name"))


_NOISY_FIELDS = ("serial_number", "epic_number", "elector_name", "relation_type", "relation_name", "house_number", "age", "gender")
_NOISY = ", ".join(f"CASE c_custkey % {len(X.NOISY)} " + " ".join(f"WHEN {i} THEN {want[n]}" for i, (_, want) in enumerate(X.NOISY)) + f" END AS {n}" for n in _NOISY_FIELDS)


@query(f"SELECT c_custkey AS k, {_NOISY} FROM customer")
def x6_noisy_cards(spark, d):
    """Labels with their value on the next line or beside them, misspelt labels, noisy numbers, competing digits, no labels at all."""
    return R.records(X.noisy_cards(spark, d)).select("k", *_NOISY_FIELDS)


# ---- validation

_LINES = f"({X.LINES_SQL})"
_CONF = "SELECT r.k, max(CASE WHEN {f} IS NOT NULL AND trim(CAST({f} AS STRING)) <> '' AND (contains(upper(trim(l.text)), upper(CAST({f} AS STRING))) OR contains(upper(CAST({f} AS STRING)), upper(trim(l.text)))) THEN confidence END) AS {a}"
_FIELDS = ("epic_number", "age", "gender", "house_number", "relation_type", "relation_name")
_CONFS = "SELECT r.k, " + ", ".join(_CONF.format(f=f"r.{n}", a=f"c_{n}").removeprefix("SELECT r.k, ") for n in _FIELDS) + f" FROM ({RECORD_SQL}) r JOIN {_LINES} l ON r.k = l.k GROUP BY r.k"


@query(f"SELECT k, round(c_epic_number, 4) AS epic_number, round(c_age, 4) AS age, round(c_house_number, 4) AS house_number, round(c_relation_name, 4) AS relation_name FROM ({_CONFS})")
def v8_confidence(spark, d):
    r = _records(spark, d).withColumn("sought", R.sought(F.col("lines")))
    return r.select("k", *[F.round(R.field_confidence(F.col(n), F.col("sought")), 4).alias(n) for n in ("epic_number", "age", "house_number", "relation_name")])


_ISSUES = {
    "epic": "CASE WHEN epic_number IS NULL THEN 'missing_epic_number' WHEN NOT regexp_full_match(upper(epic_number), '[A-Z]{3}[0-9]{7}') THEN 'invalid_epic_format' END",
    "age": "CASE WHEN age IS NULL THEN 'missing_age' WHEN age NOT BETWEEN 18 AND 120 THEN 'invalid_age_range' END",
    "gender": "CASE WHEN gender IS NULL THEN 'missing_gender' WHEN gender NOT IN ('पुरुष', 'महिला', 'male', 'female') THEN 'invalid_gender_value' END",
    "house": "CASE WHEN house_number IS NULL OR trim(house_number) = '' THEN 'empty_house_number' END",
    "type": "CASE WHEN relation_type IS NULL THEN 'missing_relation_type' WHEN relation_type NOT IN ('Father', 'Husband', 'father', 'husband') THEN 'invalid_relation_type' END",
    "relation": "CASE WHEN relation_name IS NULL OR trim(relation_name) = '' THEN 'missing_relation_name' END",
    "deleted": "CASE WHEN NOT (k % 10 / 8.0) BETWEEN 0 AND 1 THEN 'invalid_deleted_confidence' WHEN k % 3 = 0 AND k % 10 / 8.0 < 0.5 THEN 'weak_deleted_confidence' END",
}
_REPORT = f"SELECT r.k, concat_ws(',', {', '.join(_ISSUES.values())}) AS issues, concat_ws(',', " + ", ".join(f"CASE WHEN c_{n} < 0.8 THEN '{n}' END" for n in _FIELDS) + f") AS retry_fields FROM ({RECORD_SQL}) r JOIN (SELECT k AS ck, * EXCLUDE (k) FROM ({_CONFS})) c ON r.k = c.ck"


def _reports(spark, d):
    r = _records(spark, d).withColumn("deleted", F.col("k") % 3 == 0).withColumn("deleted_confidence", F.col("k") % 10 / 8.0)
    return R.reports(r)


@query(f"SELECT k, issues = '' AS is_valid, issues, retry_fields FROM ({_REPORT})")
def v9_report(spark, d):
    join = lambda a, f: F.array_join(F.transform(a, lambda i: i[f]), ",")
    return _reports(spark, d).select("k", "is_valid", join("issues", "issue_code").alias("issues"), join("retry_fields", "field_name").alias("retry_fields"))


@query(f"SELECT floor(k / 30 + 1)::INT AS page, code AS issue_code, count(*) AS n FROM (SELECT k, unnest(string_split(issues, ',')) AS code FROM ({_REPORT})) WHERE code <> '' GROUP BY 1, 2")
def d_level_rollup(spark, d):
    return _reports(spark, d).select("page", F.explode_outer("issues.issue_code").alias("issue_code")).where("issue_code is not null").groupBy("page", "issue_code").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT k, count(*) AS n_retry, round(sum(c), 4) AS confidence FROM (SELECT k, unnest([{', '.join(f'c_{n}' for n in _FIELDS)}]) AS c FROM ({_CONFS})) WHERE c < 0.8 GROUP BY k")
def v7_retry(spark, d):
    r = _reports(spark, d).select("k", F.explode_outer("retry_fields").alias("f")).where("f is not null")
    return r.groupBy("k").agg(F.count(F.lit(1)).alias("n_retry"), F.round(F.sum("f.confidence"), 4).alias("confidence"))


# ---- decisions

_LEVELS = "SELECT p_partkey AS k, " + ", ".join(f"{e} AS {n}" for n, e in X.LEVEL_EXPRS.items()) + " FROM part"


@query(f"SELECT k, s.deleted AS deleted, s.confidence AS confidence, s.rule AS rule FROM (SELECT k, CASE WHEN serial <> 'none' AND geometry <> 'none' THEN {{'deleted': true, 'confidence': CASE WHEN serial = 'strong' THEN 0.96 ELSE 0.9 END::DOUBLE, 'rule': 'rule_1_q_and_geometry'}} WHEN watermark <> 'none' AND geometry <> 'none' THEN {{'deleted': true, 'confidence': CASE WHEN watermark = 'strong' THEN 0.97 ELSE 0.9 END::DOUBLE, 'rule': 'rule_2_watermark_ocr_and_geometry'}} WHEN serial <> 'none' THEN {{'deleted': false, 'confidence': 0.3::DOUBLE, 'rule': 'rule_5_q_without_watermark'}} WHEN geometry <> 'none' THEN {{'deleted': false, 'confidence': 0.2::DOUBLE, 'rule': 'rule_4_geometry_without_ocr'}} ELSE {{'deleted': false, 'confidence': 0.0::DOUBLE, 'rule': 'normal'}} END AS s FROM ({_LEVELS}))")
def d23_decision(spark, d):
    p = X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), *[F.expr(e).alias(n) for n, e in X.LEVEL_EXPRS.items()])
    return p.select("k", D.decision(F.col("serial"), F.col("geometry"), F.col("watermark")).alias("s")).select("k", "s.*")


@query("SELECT p_partkey AS k, CASE WHEN p_size / 100.0 >= 0.18 AND p_size / 500.0 >= 0.03 AND p_partkey % 6 >= 3 THEN 'strong' WHEN p_size / 100.0 >= 0.12 AND p_size / 500.0 >= 0.025 AND p_partkey % 6 >= 2 THEN 'medium' ELSE 'none' END AS level FROM part")
def d16_level(spark, d):
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), D.geometry_level(F.col("p_size") / 100.0, F.col("p_size") / 500.0, F.col("p_partkey") % 6).alias("level"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 OR ((p_partkey % 5 = 1 OR p_partkey % 7 = 0) AND p_partkey % 2 = 0) THEN 'strong' WHEN p_partkey % 5 = 1 OR p_partkey % 7 = 0 THEN 'medium' ELSE 'none' END AS level FROM part")
def d3_serial_stage(spark, d):
    k = F.col("p_partkey")
    box = F.array(F.when(k % 5 == 0, F.concat(F.lit("q-"), (k % 1000).cast("string"))).otherwise(F.lit("--")))
    left = F.array(F.when(k % 5 == 1, "q").otherwise("x"))
    right = F.array(F.when(k % 2 == 0, (k % 1000).cast("string")).otherwise("abc"))
    return X.table(spark, d, "part").select(k.alias("k"), D.serial_stage(box, left, right, k % 7 == 0)["level"].alias("level"))


#: Words and their ratio to the watermark's (twice the matched letters over all letters).
_WORDS = {"DELETED": "1.0", "DELETFD": "0.8571", "DELETFXQ": "0.6667", "DLTD": "0.7273", "DETELED": "0.7143", "XQZ": "0.0"}


@query("SELECT k, ratio, CASE WHEN ratio >= 0.82 THEN 'strong' WHEN ratio >= 0.65 THEN 'medium' ELSE 'none' END AS level FROM (SELECT p_partkey AS k, CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN {r}" for i, r in enumerate(_WORDS.values())) + " END::DOUBLE AS ratio FROM part)")
def d22_similarity(spark, d):
    words = F.array(*map(F.lit, _WORDS))
    p = X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.array(F.lit("XQ"), F.get(words, (F.col("p_partkey") % 6).cast("int"))).alias("tokens"))
    r = p.withColumn("ratio", F.round(D.similarity(F.col("tokens")), 4))
    return r.select("k", "ratio", D.watermark_level(F.array_contains("tokens", "DELETED"), F.col("ratio")).alias("level"))


@query("SELECT p_partkey AS k, regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') AS token FROM part")
def d4_normalize_text(spark, d):
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), T.stamp(F.col("p_name")).alias("token"))


@query("SELECT p_partkey AS k, greatest(1, p_size) + CASE WHEN greatest(1, p_size) % 2 = 0 THEN 1 ELSE 0 END AS odd FROM part")
def i7_odd(spark, d):
    from ..operators.images import odd

    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), odd(F.col("p_size")).alias("odd"))


@query("SELECT l_orderkey AS k, count(DISTINCT l_linenumber) <= 4 AS is_binary FROM lineitem GROUP BY 1")
def i10_binary(spark, d):
    import numpy as np

    from ..operators.images import few_levels

    @F.pandas_udf("boolean")
    def few(levels: pd.Series) -> pd.Series:
        return levels.map(lambda v: bool(few_levels(np.array([v], np.uint8))))

    pixels = X.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.col("l_linenumber") * 30).alias("pixels"))
    return pixels.select("k", few("pixels").alias("is_binary"))


# ---- model payloads


@query(f"SELECT event_id, regexp_matches(lower({X.MESSAGE}), '429|rate limit|rate_limit|temporarily unavailable|timeout|timed out|connection|server error|service unavailable|too many requests') AS retry FROM events")
def l4_retryable(spark, d):
    return X.table(spark, d, "events").select("event_id", D.retryable(F.expr(X.MESSAGE)).alias("retry"))


@query(f"SELECT event_id, (CASE WHEN hint IS NULL THEN least(pow(2.0, greatest(event_id % 9 - 1, 0)), 30.0) ELSE greatest(hint + 0.5, 1.0) END)::DOUBLE AS delay FROM (SELECT event_id, TRY_CAST(nullif(regexp_extract({X.MESSAGE}, '(?i)try again in\\s*([0-9]+(?:\\.[0-9]+)?)s', 1), '') AS DOUBLE) AS hint FROM events)")
def l5_delay(spark, d):
    return X.table(spark, d, "events").select("event_id", D.retry_delay(F.expr(X.MESSAGE), F.col("event_id") % 9).alias("delay"))


@query("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN props END AS body FROM events")
def l7_carve(spark, d):
    return X.table(spark, d, "events").select("event_id", D.carved_json(F.expr(X.ANSWER)).alias("body"))


def _payloads(spark, d):
    return X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), *[F.expr(e).alias(n) for n, e in X.PAYLOAD_EXPRS.items()])


_SECOND = "(epic_number IS NOT NULL)::INT + (relation_name IS NOT NULL)::INT + (house_number IS NOT NULL)::INT + (gender IS NOT NULL)::INT + (age IS NOT NULL)::INT"
_LABELLED = "(contains({v}, ':') OR (len(string_split({v}, ' ')) >= 4 AND regexp_matches(lower({v}), 'elector|name|house|gender')) OR contains({v}, 'पिता का'))"


@query(f"SELECT k, CASE WHEN serial_number IS NULL AND {_SECOND} < 3 THEN 'serial_number is missing' WHEN trim(elector_name) = '' THEN 'elector_name is missing' WHEN {_LABELLED.format(v='elector_name')} THEN 'elector_name still contains labels or non-name text' WHEN {_LABELLED.format(v='relation_name')} THEN 'relation_name still contains labels or non-name text' WHEN {_SECOND} = 0 THEN 'all secondary fields are missing' END AS issue FROM ({X.PAYLOAD_SQL})")
def l8_quality(spark, d):
    return _payloads(spark, d).select("k", D.quality_issue({n: F.col(n) for n in X.PAYLOAD_EXPRS}).alias("issue"))


_SCORE = "(serial_number IS NOT NULL)::INT + (trim(elector_name) <> '')::INT + " + _SECOND


@query(f"SELECT floor(k / 2)::BIGINT AS card, min(k) AS k, max(score) AS score FROM (SELECT k, floor(k / 2) AS c, {_SCORE} AS score, max({_SCORE}) OVER (PARTITION BY floor(k / 2)) AS top FROM ({X.PAYLOAD_SQL})) WHERE score = top GROUP BY 1")
def l11_better(spark, d):
    p = _payloads(spark, d).select("k", F.floor(F.col("k") / 2).alias("card"), D.completeness({n: F.col(n) for n in X.PAYLOAD_EXPRS}).alias("score"))
    best = p.groupBy("card").agg(F.max(F.struct("score", (-F.col("k")).alias("first"))).alias("b"))
    return best.select("card", (-F.col("b.first")).alias("k"), "b.score")


@query("SELECT doc_id, CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || '...' ELSE t END AS preview FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)")
def l14_preview(spark, d):
    return X.table(spark, d, "documents").select("doc_id", T.preview(F.col("text")).alias("preview"))


# ---- sinks


@query(f"SELECT k, CASE WHEN k % 3 = 0 THEN true END AS deleted, CASE WHEN gender = 'male' THEN 'पुरुष' WHEN gender = 'female' THEN 'महिला' ELSE gender END AS gender, CASE relation_type WHEN 'father' THEN 'पिता' WHEN 'husband' THEN 'पति' ELSE relation_type END AS relation_type FROM ({RECORD_SQL})")
def k6_display(spark, d):
    from ..sinks.spreadsheet import shown

    r = _records(spark, d).withColumn("deleted", F.col("k") % 3 == 0)
    return r.select("k", *[shown(n, F.col(n)).alias(n) for n in ("deleted", "gender", "relation_type")])


@query("SELECT o_orderkey AS k, concat('page_', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), chr(9), 'deleted=', CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END, chr(9), 'page=', CAST(o_orderkey % 1000 AS STRING), chr(9), 'entry=', CAST(o_custkey % 100 AS STRING), chr(9), 'error_type=RuntimeError', chr(9), 'reason=', o_orderpriority) AS line FROM orders")
def k2_failures(spark, d):
    from ..sinks.text import failure_line

    o = X.table(spark, d, "orders")
    page = F.col("o_orderkey") % 1000
    return o.select(F.col("o_orderkey").alias("k"), failure_line(F.concat(F.lit("page_"), F.lpad(page.cast("string"), 3, "0")), F.col("o_orderstatus") == "F", page, F.col("o_custkey") % 100, F.lit("RuntimeError"), F.col("o_orderpriority")).alias("line"))


@query("SELECT o_orderkey % 1000 AS page, o_custkey % 100 AS entry_index, o_orderkey AS k, o_orderstatus = 'F' AS deleted FROM orders")
def p_order_union(spark, d):
    o = X.table(spark, d, "orders").select((F.col("o_orderkey") % 1000).alias("page"), (F.col("o_custkey") % 100).alias("entry_index"), F.col("o_orderkey").alias("k"), "o_orderstatus")
    from ..run import in_order

    gone, kept = o.where("o_orderstatus = 'F'").withColumn("deleted", F.lit(True)), o.where("o_orderstatus <> 'F'").withColumn("deleted", F.lit(False))
    return in_order(kept.unionByName(gone).drop("o_orderstatus").withColumn("name", F.col("k").cast("string"))).drop("name")


# ---- regions, recognised lines, typed fields

_W, _H = "(400 + p_partkey % 211)", "(200 + p_partkey % 97)"
_FOUND = {"x": "CAST(p_partkey % 301 AS INT)", "y": "CAST(p_partkey % 149 AS INT)", "width": "CAST(20 + p_partkey % 180 AS INT)", "height": "CAST(8 + p_partkey % 60 AS INT)"}
_FOUND_SQL = f"(SELECT p_partkey AS k, {_W} AS w, {_H} AS h, (p_partkey % 7 - 3) * 10 AS angle, " + ", ".join(f"{e} AS {n}" for n, e in _FOUND.items()) + " FROM part)"


def _found(spark, d):
    part = X.table(spark, d, "part")
    return part.select(F.col("p_partkey").alias("k"), F.expr(_W).cast("int").alias("w"), F.expr(_H).cast("int").alias("h"), ((F.col("p_partkey") % 7 - 3) * 10).alias("angle"), F.struct(*[F.expr(e).alias(n) for n, e in _FOUND.items()]).alias("box"))


@query(f"SELECT k, trunc(w * 0.1::DOUBLE)::INT AS x, trunc(h * 0.2::DOUBLE)::INT AS y, least(w, trunc(w * 0.55::DOUBLE)::INT)::INT - trunc(w * 0.1::DOUBLE)::INT AS width, least(h, trunc(h * 1.2::DOUBLE)::INT)::INT - trunc(h * 0.2::DOUBLE)::INT AS height FROM {_FOUND_SQL}")
def d2_region(spark, d):
    return _found(spark, d).select("k", W.region(F.col("w"), F.col("h"), (0.1, 0.2, 0.55, 1.2)).alias("r")).select("k", "r.*")


@query(f"SELECT k, l::INT AS x, t::INT AS y, greatest(r - l, 0)::INT AS width, greatest(b - t, 0)::INT AS height FROM (SELECT k, greatest(0, x - greatest(10, width // 18)) AS l, greatest(0, y - greatest(8, height // 3)) AS t, least(w, x + width + greatest(10, width // 18)) AS r, least(h, y + height + greatest(8, height // 3)) AS b FROM {_FOUND_SQL})")
def d21_band(spark, d):
    return _found(spark, d).select("k", W.band(F.col("box"), F.col("w"), F.col("h")).alias("r")).select("k", "r.*")


def _corner(right: int, low: int) -> str:
    dx, dy = f"(x + {right} * width - w / 2)", f"(y + {low} * height - h / 2)"
    cut = lambda v, size: f"trunc(least(greatest({v}, 0.0::DOUBLE), {size} - 1.0::DOUBLE))::INT"
    return cut(f"{dx} * cos(radians(angle)) - {dy} * sin(radians(angle)) + w / 2", "w") + f" AS x{right}{low}, " + cut(f"{dx} * sin(radians(angle)) + {dy} * cos(radians(angle)) + h / 2", "h") + f" AS y{right}{low}"


_CORNERS = ((0, 0), (1, 0), (1, 1), (0, 1))
_TURNED = f"(SELECT *, {', '.join(_corner(*c) for c in _CORNERS)} FROM {_FOUND_SQL})"
_AXIS = "least(greatest({v}) + 1, trunc({s} * 0.65::DOUBLE)) > greatest(least({v}), trunc({s} * 0.35::DOUBLE))"


@query(f"SELECT k, {' || chr(32) || '.join(f'x{a}{b} || chr(44) || y{a}{b}' for a, b in _CORNERS)} AS corners, {_AXIS.format(v='x00, x10, x11, x01', s='w')} AND {_AXIS.format(v='y00, y10, y11, y01', s='h')} AS central FROM {_TURNED}")
def d17_d18_turned_back(spark, d):
    f = _found(spark, d).withColumn("polygon", W.turned_back(F.col("box"), F.col("angle"), F.col("w"), F.col("h")))
    text = F.array_join(F.transform("polygon", lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string"))), " ")
    return f.select("k", text.alias("corners"), W.crosses_centre(F.col("polygon"), F.col("w"), F.col("h")).alias("central"))


@query("SELECT k, angle, score FROM (SELECT p_partkey AS k, unnest([0, -10, 10]) AS angle, unnest([(p_partkey % 3) * 0.29::DOUBLE, (p_partkey % 2) * 0.58::DOUBLE, (p_partkey % 5 // 4) * 0.8::DOUBLE]) AS score, unnest([1, 2, 3]) AS pos FROM part) WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, pos) = 1")
def d20_best_angle(spark, d):
    scores = (0, "(p_partkey % 3) * 0.29D"), (-10, "(p_partkey % 2) * 0.58D"), (10, "floor(p_partkey % 5 / 4) * 0.8D")
    found = F.array(*[F.struct(F.lit(a).alias("angle"), F.expr(e).alias("score")) for a, e in scores])
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), W.best_of(found).alias("b")).where("b is not null").select("k", "b.*")


_ANSWER = "concat('[[[[[', CAST(p_partkey AS STRING), ',1],[2,3],[7],\"x\"],[\"', p_name, '\",0.', CAST(1 + p_partkey % 9 AS STRING), ']],[1],7,[[],[\"only\"]]],', CASE WHEN p_partkey % 2 = 0 THEN 'null' ELSE '[[null,[\"Q\",1]]]' END, ']')"


@query("SELECT p_partkey AS k, p_name || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '|Q' END AS texts, (1 + p_partkey % 9) / 10.0::DOUBLE AS confidence, p_partkey::DOUBLE AS x, 2::INT AS n_points FROM part")
def o2_o3_lines(spark, d):
    p = X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), O.lines(F.expr(_ANSWER), "hi").alias("l"))
    first = F.col("l")[0]
    return p.select("k", F.array_join(F.transform("l", lambda x: x["text"]), "|").alias("texts"), first["confidence"].alias("confidence"), first["bounding_box"][0]["x"].alias("x"), F.size(first["bounding_box"]).alias("n_points"))


_FIELD_EXPRS = {
    "relation_type": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' Father ' WHEN 2 THEN 'husband' WHEN 3 THEN '' ELSE 'uncle' END",
    "age": "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' 34 ' WHEN 2 THEN '34.5' ELSE CAST(c_custkey % 90 AS STRING) END",
    "gender": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'MALE' WHEN 2 THEN 'महिला' WHEN 3 THEN ' ' WHEN 4 THEN 'other' ELSE 'पुरुष' END",
}
_FIELDS_SQL = "SELECT c_custkey AS k, " + ", ".join(f"{e} AS {n}" for n, e in _FIELD_EXPRS.items()) + " FROM customer"


@query(f"SELECT k, CASE lower(trim(relation_type)) WHEN 'father' THEN 'father' WHEN 'husband' THEN 'husband' END AS relation_type, TRY_CAST(CASE WHEN regexp_full_match(trim(age), '[0-9]+') THEN trim(age) END AS INT) AS age, CASE WHEN lower(trim(gender)) IN ('male', 'पुरुष') THEN 'male' WHEN lower(trim(gender)) IN ('female', 'महिला') THEN 'female' END AS gender, CASE WHEN relation_type = 'uncle' THEN 'Invalid relation_type: uncle' WHEN age = '34.5' THEN 'Invalid age: 34.5' WHEN gender = 'other' THEN 'Invalid gender: other' END AS error FROM ({_FIELDS_SQL})")
def l12_normalize(spark, d):
    c = X.table(spark, d, "customer")
    names = ("serial_number", "epic_number", "elector_name", "relation_name", "house_number")
    p = {n: F.lit(None).cast("string") for n in names} | {n: F.expr(e) for n, e in _FIELD_EXPRS.items()}
    return c.select(F.col("c_custkey").alias("k"), P.typed(p).alias("r")).select("k", "r.relation_type", "r.age", "r.gender", "r.error")


@query("SELECT doc_id, 'data:image/png;base64,' || to_base64(encode(text)) AS address FROM documents")
def l13_data_address(spark, d):
    return X.table(spark, d, "documents").select("doc_id", P.data_address(F.col("text").cast("binary")).alias("address"))


# ---- model calls with a fallback


def _stub_client():
    """A model of fixed answers: an image is ``k``; ``small`` misses names of two thirds of the cards, ``big`` of one third."""
    import json

    def send(image: bytes, model: str, prompt: str) -> str:
        k = int(image)
        name = f"N{k}" if k % 3 == 0 or (k % 3 == 1 and model == "big") else None
        house = str(k % 90) if model == "small" else None
        serial = str(k) if k % 5 or "Read only" in prompt else None
        return json.dumps({"serial_number": serial, "epic_number": "ABC1234567", "elector_name": name, "relation_name": "R", "house_number": house, "gender": "female", "age": 20 + k % 60})

    return send


@query("SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 1 THEN 'big' WHEN 0 THEN 'small' END AS model, CASE WHEN c_custkey % 3 < 2 THEN CAST(c_custkey AS VARCHAR) END AS serial_number, CASE WHEN c_custkey % 3 < 2 THEN 'N' || c_custkey END AS elector_name, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 90 AS VARCHAR) END AS house_number, CASE WHEN c_custkey % 3 < 2 THEN CAST(20 + c_custkey % 60 AS INT) END AS age, CASE WHEN c_custkey % 3 = 2 THEN 'ValueError: Low-quality extraction: elector_name is missing' END AS error FROM customer")
def l2_l10_fallback(spark, d):
    """A third of the cards is sound, a third is so with the second model, a third is weak in both and fails."""
    from ..operators.models import extracted

    c = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").cast("binary").alias("png"))
    return extracted(c, _stub_client, "small", "big", rounds=1, tries=1, key=("k",)).select("k", "model", "serial_number", "elector_name", "house_number", "age", "error")


def _patient_client():
    """A model that fails in a way of its own for each card and round; an image is ``k`` and tells no round, so a card's rounds are counted."""
    import json

    asked: dict[int, int] = {}

    def send(image: bytes, model: str, prompt: str) -> str:
        k = int(image)
        asked[k] = asked.get(k, 0) + 1
        if k % 4 == 1:
            raise ValueError(f"refused {asked[k]}")
        name = None if k % 4 == 2 or (k % 4 == 3 and k % 8 == 3) else f"N{k}"
        return json.dumps({"serial_number": str(k), "epic_number": "ABC1234567", "elector_name": name, "relation_name": "R", "house_number": None, "gender": "female", "age": 40})

    return send


@query("SELECT k, attempt::INT AS attempt, CASE WHEN k % 4 = 1 THEN 'ValueError: refused 1' WHEN k % 4 = 2 OR k % 8 = 3 THEN 'ValueError: Low-quality extraction: elector_name is missing' END AS error FROM (SELECT c_custkey AS k FROM customer), range(1, 4) AS t(attempt) WHERE attempt = 1 OR k % 4 IN (1, 2) OR k % 8 = 3")
def l1_attempts(spark, d):
    """Every attempt of three rounds: settled cards have one, cards that fail or stay weak three."""
    from .. import scratch
    from ..operators import models

    folder = scratch.new_folder(spark)
    c = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").cast("binary").alias("png"))
    models.best_payloads(c, _patient_client, "m", rounds=3, tries=1, patience=0.0, key=("k",), folder=folder)
    return models.attempts(spark, folder).select("k", "attempt", "error")


@query("SELECT p_partkey AS k, least(power(2, greatest(p_size - 1, 0)), 30)::DOUBLE AS seconds FROM part")
def l5_backoff(spark, d):
    p = X.table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("k"), D.retry_delay(F.lit("timeout"), F.col("p_size")).alias("seconds"))


def _candidates(spark, d):
    """k and watermark bands of a 600 by 400 crop that a part's numbers give."""
    of = lambda i: F.struct(F.lit((25, -45, 40)[i]).alias("angle"), (F.col("p_partkey") % (90 + i) + 150).cast("int").alias("x"), (F.col("p_partkey") % 80 + 140).cast("int").alias("y"), (F.col("p_size") * 3 + 40 * i + 30).cast("int").alias("width"), (F.col("p_size") % 30 + 8).cast("int").alias("height"), (F.col("p_partkey") % 5).cast("int").alias("letters"), (F.col("p_partkey") % 160 + 95).cast("double").alias("mean"))
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.array(of(0), of(1), of(2)).alias("found"))


_FOUND3 = " UNION ALL ".join(f"SELECT p_partkey AS k, {i} AS i, 600 AS w, 400 AS h, {a} AS angle, p_partkey % {90 + i} + 150 AS x, p_partkey % 80 + 140 AS y, p_size * 3 + {40 * i + 30} AS width, p_size % 30 + 8 AS height, p_partkey % 5 AS letters, p_partkey % 160 + 95 AS mean FROM part" for i, a in enumerate((25, -45, 40)))
_GEOMETRY = f"SELECT *, CASE WHEN NOT (mean BETWEEN 105 AND 240 AND {_AXIS.format(v='x00, x10, x11, x01', s='w')} AND {_AXIS.format(v='y00, y10, y11, y01', s='h')}) THEN 0 WHEN width / 600 >= 0.18 AND height / 400 >= 0.03 AND letters >= 3 THEN 0.8 WHEN width / 600 >= 0.12 AND height / 400 >= 0.025 AND letters >= 2 THEN 0.58 ELSE 0 END::DOUBLE AS score FROM (SELECT *, {', '.join(_corner(*c) for c in _CORNERS)} FROM ({_FOUND3}))"


@query(f"SELECT k, CASE score WHEN 0.8 THEN 'strong' WHEN 0.58 THEN 'medium' ELSE 'none' END AS level, score, CASE WHEN score > 0 THEN angle END::INT AS angle, CASE WHEN score > 0 THEN width END::INT AS width FROM ({_GEOMETRY}) QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, i) = 1")
def d19_d20_geometry(spark, d):
    """The best band of each crop."""
    from ..operators.watermark import geometry

    best = _candidates(spark, d).withColumn("g", geometry(F.col("found"), F.lit(600), F.lit(400)))
    return best.select("k", F.coalesce("g.level", F.lit("none")).alias("level"), F.coalesce("g.score", F.lit(0.0)).alias("score"), "g.angle", F.col("g.box.width").alias("width"))


# ---- the model first, recognised text where it fails


@query(f"WITH r AS ({RECORD_SQL}) SELECT k, CASE WHEN k % 4 <> 0 AND k % 5 <> 0 THEN 'm' END AS model, CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN r.serial_number ELSE CAST(k AS STRING) END AS serial_number, CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN r.elector_name ELSE 'N' END AS elector_name, CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN r.relation_type ELSE 'father' END AS relation_type, CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN r.age ELSE 30 END AS age, CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN r.gender ELSE 'female' END AS gender FROM r")
def x1_x2_model_first(spark, d):
    """Every fourth card is one that the model cannot read; of every fifth its answer is weak. Both are parsed from text."""
    from ..operators.extraction import extracted

    def client():
        import json

        def send(image: bytes, model: str, prompt: str) -> str:
            if int(image) % 4 == 0:
                raise ValueError("unreadable")
            return json.dumps({"serial_number": image.decode(), "epic_number": "ABC1234567", "elector_name": "N" if int(image) % 5 else None, "relation_type": "Father", "relation_name": "R", "house_number": "1", "gender": "female", "age": 30})

        return send

    cards = X.cards(spark, d).withColumn("png", F.col("k").cast("string").cast("binary"))
    return extracted(cards, " Auto ", client, "m", rounds=1, tries=1, key=("k",)).select("k", "model", "serial_number", "elector_name", "relation_type", "age", "gender")


@query(f"SELECT k, serial_number, epic_number, raw_text FROM ({RECORD_SQL})")
def x1_text_only(spark, d):
    from ..operators.extraction import extracted

    return extracted(X.cards(spark, d), "auto").select("k", "serial_number", "epic_number", "raw_text")


# ---- rasters on tiles: pages drawn by rows of the tables


def _segments(spark, d, name: str, key: str, other: str, per_page: int, width: int, height: int):
    """page, y, x: each row draws a line across (even) or down (odd), cut at the page's edge."""
    k, o, at = F.col(key), F.col(other), F.col("i")
    rows = X.table(spark, d, name).select(k, o, F.explode(F.sequence(F.lit(0), (k % 40 + 4).cast("int"))).alias("i"))
    across = o % 2 == 0
    y, x = (k * 7919) % height, (k * 31 + o * 17) % width
    drawn = rows.select(F.expr(f"{key} div {per_page}").alias("page"), (y + F.when(across, 0).otherwise(at)).alias("y"), (x + F.when(across, at).otherwise(0)).alias("x"))
    return drawn.where((F.col("y") < height) & (F.col("x") < width))


def _segments_sql(name: str, key: str, other: str, per_page: int, width: int, height: int) -> str:
    """The whole grid of the same pages with v 1 where a line runs."""
    at = f"SELECT {key} // {per_page} AS page, ({key} * 7919) % {height} + CASE WHEN {other} % 2 = 0 THEN 0 ELSE i END AS y, ({key} * 31 + {other} * 17) % {width} + CASE WHEN {other} % 2 = 0 THEN i ELSE 0 END AS x FROM (SELECT {key}, {other}, unnest(range(0, {key} % 40 + 5)) AS i FROM {name})"
    dark = f"SELECT DISTINCT page, y, x FROM ({at}) WHERE y < {height} AND x < {width}"
    return f"SELECT g.page, g.y, g.x, (d.page IS NOT NULL)::INT AS v FROM (SELECT page, y, x FROM (SELECT DISTINCT page FROM ({dark})), range({height}) AS r(y), range({width}) AS c(x)) g LEFT JOIN ({dark}) d ON d.page = g.page AND d.y = g.y AND d.x = g.x"


def _slid(inner: str, every: bool, w: int, h: int) -> str:
    """Erosion (every) or dilation of a grid by a window of w by h."""
    for axis, along, k in (("y", "x", w), ("x", "y", h)):
        if k > 1:
            inner = f"SELECT page, y, x, {'min' if every else 'max'}(v) OVER (PARTITION BY page, {axis} ORDER BY {along} ROWS BETWEEN {k // 2} PRECEDING AND {k - 1 - k // 2} FOLLOWING) AS v FROM ({inner})"
    return inner


_PAGE = (160, 128)
_DRAWN = _segments_sql("orders", "o_orderkey", "o_custkey", 600, *_PAGE)
_ACROSS = _slid(_slid(_slid("SELECT * FROM drawn", True, 10, 1), False, 10, 1), False, 3, 3)
_DOWN = _slid(_slid(_slid("SELECT * FROM drawn", True, 1, 10), False, 1, 10), False, 3, 3)
_LINES = f"WITH drawn AS ({_DRAWN}), lines AS (SELECT a.page, a.y, a.x, greatest(a.v, d.v) AS v FROM ({_ACROSS}) a JOIN ({_DOWN}) d USING (page, y, x)) "


@query(f"{_LINES} SELECT page, y, x FROM ({_slid(_slid('SELECT * FROM lines', False, 5, 5), True, 5, 5)}) WHERE v = 1")
def g2_g4_line_masks(spark, d):
    """The pixels of long lines, joined, of pages that orders draw, worked on in tiles."""
    from ..operators import tiles

    ink = tiles.drawn(_segments(spark, d, "orders", "o_orderkey", "o_custkey", 600, *_PAGE), *_PAGE, size=64)
    return tiles.pixels_of(tiles.grid_masks(ink, *_PAGE, size=64, ink=True), size=64)


_SMALL = (96, 64)
_LABELLED = f"""
WITH RECURSIVE drawn AS ({_segments_sql('customer', 'c_custkey', 'c_nationkey', 60, *_SMALL)}),
labels(page, y, x, v, l) USING KEY (page, y, x) AS (
  SELECT page, y, x, v, y * 96 + x FROM drawn
  UNION
  SELECT n.page, n.y, n.x, n.v, min(t.l)
  FROM (SELECT page, v, l, y + dy AS y, x + dx AS x FROM labels, (VALUES (-1), (0), (1)) AS a(dy), (VALUES (-1), (0), (1)) AS b(dx) WHERE v = 1 OR dy = 0 OR dx = 0) t
    JOIN recurring.labels n ON n.page = t.page AND n.y = t.y AND n.x = t.x AND n.v = t.v
  WHERE t.l < n.l GROUP BY ALL),
parts AS (SELECT page, v, l, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1, count(*) AS area FROM labels GROUP BY page, v, l),
shown AS (SELECT *, v = 1 OR (x0 > 0 AND y0 > 0 AND x1 < 95 AND y1 < 63) AS closed FROM parts)
"""
_BOX = """page, x0 - (v = 0)::BIGINT AS x, y0 - (v = 0)::BIGINT AS y, x1 - x0 + 1 + 2 * (v = 0)::BIGINT AS width, y1 - y0 + 1 + 2 * (v = 0)::BIGINT AS height, area, v = 0 AS hole"""


@query(f"{_LABELLED} SELECT s.l::BIGINT AS contour, {_BOX.replace('page,', 's.page,', 1).replace('v = 0', 's.v = 0').replace('x0', 's.x0').replace('x1', 's.x1').replace('y0', 's.y0').replace('y1', 's.y1').replace('area,', 's.area,')}, coalesce(CASE WHEN o.closed THEN o.l END, -1)::BIGINT AS parent FROM shown s LEFT JOIN labels b ON b.page = s.page AND s.l % 96 > 0 AND b.y = s.l // 96 AND b.x = s.l % 96 - 1 LEFT JOIN shown o ON o.page = b.page AND o.v = b.v AND o.l = b.l WHERE s.closed")
def g5_contour_tree(spark, d):
    """Outlines of lines and of the holes in them with what encloses each, joined over tiles of pages that customers draw."""
    from ..operators import tiles

    ink = tiles.drawn(_segments(spark, d, "customer", "c_custkey", "c_nationkey", 60, *_SMALL), *_SMALL, size=32)
    return tiles.contours(ink, size=32).withColumn("parent", F.coalesce("parent", F.lit(-1).cast("long")))


@query(f"{_LABELLED} SELECT {_BOX} FROM shown WHERE closed")
def g5_cell_boxes(spark, d):
    """Boxes and areas of connected lines, and of the holes in them, joined over the tiles of pages that customers draw."""
    from ..operators import tiles

    ink = tiles.drawn(_segments(spark, d, "customer", "c_custkey", "c_nationkey", 60, *_SMALL), *_SMALL, size=32)
    return tiles.cell_boxes(ink, size=32)


@query("SELECT k, place, CASE k % 5 WHEN 0 THEN (v >> 7) * 255 WHEN 1 THEN (v >> 6) * 85 WHEN 2 THEN (v >> 4) * 17 ELSE v END::INT AS level FROM (SELECT c_custkey AS k, place::INT AS place, (c_custkey * (place + 3) * 37) % 256 AS v FROM customer, range(54) AS r(place))")
def s5_raster_forms(spark, d):
    """Pixels of a small picture a customer, written as PNG of five bit depths, every other one interlaced, and read again."""
    import numpy as np

    from ..functions import png

    @F.pandas_udf("binary")
    def drawn(keys: pd.Series) -> pd.Series:
        at = np.arange(54).reshape(6, 9)
        return keys.map(lambda k: png.encode((k * (at + 3) * 37 % 256).astype(np.uint8), (1, 2, 4, 8, 16)[k % 5], k % 2 == 1))

    @F.pandas_udf("array<int>")
    def read(pictures: pd.Series) -> pd.Series:
        return pictures.map(lambda p: png.decode(p).ravel().astype(int).tolist())

    c = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return c.select("k", F.posexplode(read(drawn("k"))).alias("place", "level"))


@query("SELECT (row_number() OVER (ORDER BY c_nationkey % 3, c_custkey) - 1)::INT AS place, c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment FROM customer")
def k1_growing_list(spark, d):
    """Customers appended to a JSON list in three batches, one of them sent twice, and read again."""
    from .. import scratch
    from ..sinks.json_list import append_json_list
    from ..sources.json_records import read_records

    path = scratch.new_folder(spark).removeprefix("file://").removeprefix("file:") + "/list.json"
    c = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"), (F.col("c_nationkey") % 3).alias("batch"))
    for batch in (0, 1, 1, 2):
        append_json_list(c.where(F.col("batch") == batch), path, ["k"], ("batch",), batch)
    value = lambda name: F.get_json_object("json", f"$.{name}")
    return read_records(spark, f"file://{path}").select(F.col("row").alias("place"), value("k").cast("long").alias("k"), value("name").alias("name"), value("segment").alias("segment"))


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 8 <= 2 THEN 'plain' WHEN c_custkey % 8 = 3 THEN 'open' WHEN c_custkey % 8 <= 5 THEN 'locked' WHEN c_custkey % 8 = 6 THEN 'damaged' ELSE 'no pdf' END AS state FROM customer")
def s1_document_state(spark, d):
    """What a document of each customer is; documents come in eight forms."""
    from ..sources import pdf_state

    @F.pandas_udf("binary")
    def document(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: X.pdf(k % 8, k))

    return pdf_state.with_state(X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), document("c_custkey").alias("content"))).select("k", "state")


@query("SELECT (row_number() OVER (ORDER BY c_custkey) + 1)::INT AS row, c_custkey::BIGINT AS serial_number, concat(c_name, ' <&> ', chr(233)) AS elector_name, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 90)::INT END AS age, CASE c_custkey % 4 WHEN 0 THEN 'पुरुष' WHEN 1 THEN 'महिला' WHEN 2 THEN 'other' END AS gender, CASE WHEN c_custkey % 5 = 0 THEN true END AS deleted, concat(CASE WHEN c_custkey % 3 <> 0 THEN 'number' ELSE '-' END, CASE WHEN c_custkey % 5 = 0 THEN ' bool' ELSE '' END) AS kinds FROM customer")
def k7_k9_workbook(spark, d):
    """Customers as a sheet, read again as a table with the kinds of two of its cells."""
    from .. import scratch
    from ..sinks import spreadsheet
    from ..sources.workbook import read_workbook, value_of

    k = F.col("c_custkey")
    gender = F.when(k % 4 == 0, "Male ").when(k % 4 == 1, "female").when(k % 4 == 2, "other")
    c = X.table(spark, d, "customer").select(k.alias("serial_number"), F.concat("c_name", F.lit(" <&> \u00e9")).alias("elector_name"), F.when(k % 3 != 0, (k % 90).cast("int")).alias("age"), gender.alias("gender"), (k % 5 == 0).alias("deleted"), F.lit("x").alias("raw_text"))
    path = scratch.new_folder(spark).removeprefix("file://").removeprefix("file:") + "/book.xlsx"
    spreadsheet.write_sheet(c, path, ["serial_number"])
    rows = read_workbook(spark, path, "Records", header=True)
    kind = lambda name: F.get(F.filter("cells", lambda c: c["name"] == name), F.lit(0))["kind"]
    kinds = F.concat(F.coalesce(kind("Age"), F.lit("-")), F.coalesce(F.concat(F.lit(" "), kind("Deleted")), F.lit("")))
    types = {"serial_number": "long", "elector_name": "string", "age": "int", "gender": "string", "deleted": "boolean"}
    return rows.select("row", *[value_of(spreadsheet.header(n), t).alias(n) for n, t in types.items()], kinds.alias("kinds"))


# ---- raster steps on a small picture a customer


def _pictures(spark, d):
    """k and the PNG of a picture of 6 rows and 9 columns."""
    import numpy as np

    from ..functions import png

    @F.pandas_udf("binary")
    def drawn(keys: pd.Series) -> pd.Series:
        at = np.arange(54).reshape(6, 9)
        return keys.map(lambda k: png.encode((k * (at + 3) * 37 % 256).astype(np.uint8)))

    return X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), drawn("c_custkey").alias("png"))


def _pixel_sql(dy: int = 0, dx: int = 0) -> str:
    y, x = f"greatest(0, least(5, y + {dy}))", f"greatest(0, least(8, x + {dx}))"
    return f"(c_custkey * ({y} * 9 + {x} + 3) * 37) % 256"


_AROUND = ", ".join(_pixel_sql(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1))


@query(f"SELECT c_custkey AS k, (y * 9 + x)::INT AS place, (list_sort([{_AROUND}])[5])::INT AS median, (CASE WHEN y < 2 OR y > 3 OR x < 2 OR x > 6 THEN 255 ELSE {_pixel_sql()} END)::INT AS bordered FROM customer, range(6) AS r(y), range(9) AS c(x)")
def i3_i6_raster_steps(spark, d):
    """Each pixel after the median of its surroundings, and after a margin of two is whitened."""
    from ..functions import png
    from ..operators import images as I

    @F.pandas_udf("array<struct<median:int,bordered:int>>")
    def stepped(pictures: pd.Series) -> pd.Series:
        both = lambda a: zip(I.median_blur(a, 3).ravel().tolist(), I.cleaned_border(a, 2).ravel().tolist())
        return pictures.map(lambda p: [{"median": m, "bordered": b} for m, b in both(I.gray(png.decode(p)))])

    return _pictures(spark, d).select("k", F.posexplode(stepped("png")).alias("place", "s")).select("k", "place", "s.median", "s.bordered")


@query(f"WITH px AS (SELECT c_custkey AS k, {_pixel_sql()} AS v FROM customer, range(6) AS r(y), range(9) AS c(x)), cuts AS (SELECT k, t, sum((v <= t)::INT)::DOUBLE AS w, sum(CASE WHEN v <= t THEN v ELSE 0 END)::DOUBLE AS m, sum(v)::DOUBLE AS mean FROM px, range(256) AS r(t) GROUP BY k, t), between_ AS (SELECT k, t, (mean * w / 54 - m) * (mean * w / 54 - m) / (w * (54 - w)) AS b FROM cuts WHERE w > 0 AND w < 54) SELECT k, t::INT AS threshold FROM between_ QUALIFY row_number() OVER (PARTITION BY k ORDER BY b DESC, t) = 1")
def d7_otsu(spark, d):
    """The threshold that parts each picture's levels best; pictures of one level have none."""
    from ..functions import png
    from ..operators import images as I

    @F.pandas_udf("int")
    def threshold(pictures: pd.Series) -> pd.Series:
        found = [I.gray(png.decode(p)) for p in pictures]
        return pd.Series([I.otsu(a) if a.min() < a.max() else None for a in found], dtype="Int32")

    return _pictures(spark, d).select("k", threshold("png").alias("threshold")).where("threshold is not null")


@query("SELECT c_custkey AS k, 8 < x AND 8 < y AND x + w < 292 AND y + h < 192 AND w * h / 60000.0 < 0.14 AND w / 300.0 >= 0.1 AND h / 200.0 >= 0.02 AS fits FROM (SELECT c_custkey, c_custkey % 200 AS x, c_custkey % 130 AS y, 20 + c_custkey % 150 AS w, 2 + c_custkey % 83 AS h FROM customer)")
def d13_plausible(spark, d):
    """Whether a box may be a watermark's in a crop of 300 by 200."""
    from ..operators import watermark

    @F.pandas_udf("boolean")
    def fits(k: pd.Series) -> pd.Series:
        return k.map(lambda k: watermark.plausible((k % 200, k % 130, 20 + k % 150, 2 + k % 83), 300, 200))

    return X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), fits("c_custkey").alias("fits"))
