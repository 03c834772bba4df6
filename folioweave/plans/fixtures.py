"""Cards, rectangles and payloads derived from the driver's tables, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Texts of a card's lines, with x and y; the expressions hold in both engines.
CARD_LINES = (
    ("CASE WHEN c_custkey % 7 = 0 THEN concat('Q ', CAST(c_custkey % 1000 AS STRING)) WHEN c_custkey % 3 = 0 THEN translate(CAST(c_custkey % 10000 AS STRING), '0123456789', '०१२३४५६७८९') ELSE concat('क्रमांक: ', CAST(c_custkey % 10000 AS STRING)) END", 10, 10),
    ("CASE WHEN c_custkey % 5 = 0 THEN concat('ABC', replace(lpad(CAST(c_custkey AS STRING), 7, '0'), '0', 'O')) ELSE concat('XYZ', lpad(CAST(c_custkey AS STRING), 7, '0')) END", 420, 12),
    ("concat('निर्वाचक का नाम: Ravi ', c_mktsegment)", 10, 40),
    ("CASE WHEN c_custkey % 2 = 0 THEN concat('पिता का नाम: Mohan ', CAST(c_nationkey AS STRING)) ELSE 'पति का नाम - Sohan' END", 10, 70),
    ("CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('गृह संख्या : ', CAST(c_custkey % 97 AS STRING)) END", 10, 100),
    ("concat('उम्र: ', CAST(15 + c_custkey % 70 AS STRING), CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN ' लिंग: पुरुष' ELSE ' लिंग: महिला' END)", 10, 130),
)


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, page, entry_index, lines: one card per customer; a narrow projection."""
    lines = [F.struct(F.expr(text).alias("text"), (0.6 + (F.col("c_custkey") + i) % 40 / 100.0).alias("confidence"), F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), F.lit(20.0).alias("height")) for i, (text, x, y) in enumerate(CARD_LINES)]
    k = F.col("c_custkey")
    return spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")).select(k.alias("k"), F.floor(k / 30 + 1).cast("int").alias("page"), (k % 30 + 1).cast("int").alias("entry_index"), F.array(*lines).alias("lines"))


_K, _HOUSE, _LONG = "c_custkey", "CAST(c_custkey % 97 + 1 AS STRING)", "lpad(CAST(c_custkey AS STRING), 7, '0')"
_NONE = dict.fromkeys(("serial_number", "epic_number", "elector_name", "relation_type", "relation_name", "house_number", "gender"), "CAST(NULL AS STRING)") | {"age": "CAST(NULL AS INT)"}
#: Cards that records must be read from, as (text, x, y) of their lines and the fields expected.
NOISY = (
    (
        ((f"concat(CAST(100 + {_K} % 800 AS STRING), ' ABC', {_LONG})", 10, 10), ("'Name: Suresh Kumar'", 10, 40), (f"concat('पिता का नाम: Ramesh ', {_HOUSE})", 10, 70), (f"concat('House No: ', {_HOUSE}, '/A')", 10, 100), ("'Age: 34 Gender: Male'", 10, 130)),
        _NONE | {"serial_number": f"CAST(100 + {_K} % 800 AS STRING)", "epic_number": f"concat('ABC', {_LONG})", "elector_name": "'Suresh Kumar'", "relation_type": "'father'", "relation_name": f"concat('Ramesh ', {_HOUSE})", "house_number": f"concat({_HOUSE}, '/A')"},
    ),
    (
        (("'Serial 56'", 10, 10), (f"concat('EPIC: DEF', {_LONG})", 10, 40), ("'निर्वाचक का नाम'", 10, 70), ("'Geeta Bai'", 10, 95), ("'पति का नाम'", 10, 120), ("'Raju'", 10, 145), ("'House Number'", 10, 170), (f"concat({_HOUSE}, '-C')", 10, 195)),
        _NONE | {"serial_number": _HOUSE, "epic_number": f"concat('DEF', {_LONG})", "elector_name": "'Geeta Bai'", "relation_type": "'husband'", "relation_name": "'Raju'", "house_number": f"concat({_HOUSE}, '-C')"},
    ),
    (
        (("'३१'", 30, 10), ("'HDR2OTOB4E'", 420, 12), ("'निवाचक का नाम'", 10, 60), ("'गीता देवी'", 180, 62), ("'पति का नाम'", 10, 98), ("'कैलाश'", 165, 100), ("'गृह संख्या'", 10, 136), (_HOUSE, 160, 138), ("'उम्र'", 10, 174), (f"CAST(20 + {_K} % 70 AS STRING)", 80, 174), ("'लिंग'", 130, 174), ("'महिला'", 190, 174)),
        {"serial_number": "'31'", "epic_number": "'RDR2070845'", "elector_name": "'गीता देवी'", "relation_type": "'husband'", "relation_name": "'कैलाश'", "house_number": _HOUSE, "age": f"CAST(20 + {_K} % 70 AS INT)", "gender": "'female'"},
    ),
    ((("'Unclear entry text only'", 10, 10),), _NONE | {"elector_name": "'Unclear entry text only'"}),
)


def noisy_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, lines: one card of NOISY per customer."""
    line = lambda text, x, y: F.struct(F.expr(text).alias("text"), F.lit(0.9).alias("confidence"), F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), F.lit(20.0).alias("height"))
    cards_ = F.lit(None)
    for i, (lines, _) in enumerate(NOISY):
        cards_ = F.when(F.col("c_custkey") % len(NOISY) == i, F.array(*[line(*x) for x in lines])).otherwise(cards_)
    return spread(table(spark, sf_dir, "customer").select("c_custkey")).select(F.col("c_custkey").alias("k"), cards_.alias("lines"))


LINES_SQL = " UNION ALL ".join(f"SELECT c_custkey AS k, {i} AS pos, {text} AS text, 0.6 + (c_custkey + {i}) % 40 / 100.0::DOUBLE AS confidence FROM customer" for i, (text, _, _) in enumerate(CARD_LINES))
#: One row per card: t0 to t5 and the first visual row, ``top``.
CARD_SQL = "SELECT c_custkey AS k, " + ", ".join(f"{text} AS t{i}" for i, (text, _, _) in enumerate(CARD_LINES)) + " FROM customer"

RECT_EXPRS = {
    "x": "CAST((l_linenumber % 2) * 300 + l_partkey % 5 + 1 AS INT)",
    "y": "CAST(floor(l_linenumber / 4) * 200 + l_suppkey % 7 + 1 AS INT)",
    "width": "CAST(270 + l_partkey % 7 * 3 AS INT)",
    "height": "CAST(150 + l_suppkey % 11 * 4 AS INT)",
}


def rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, line, x, y, width, height: one rectangle per order line."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line"), *[F.expr(e).alias(n) for n, e in RECT_EXPRS.items()])


def page_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, rects in order of line. A page holds few rectangles."""
    by = rectangles(spark, sf_dir).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("line", F.struct("x", "y", "width", "height").alias("r")))).alias("ls"))
    return by.select("page", F.transform("ls", lambda l: l["r"]).alias("rects"))


RECTS_SQL = "SELECT l_orderkey AS page, l_linenumber AS line, " + ", ".join(f"{e} AS {n}" for n, e in RECT_EXPRS.items()) + " FROM lineitem"

PAYLOAD_EXPRS = {
    "serial_number": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END",
    "epic_number": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('ABC', lpad(CAST(c_custkey AS STRING), 7, '0')) END",
    "elector_name": "CASE WHEN c_custkey % 17 = 0 THEN ' ' WHEN c_custkey % 19 = 0 THEN concat('Name: ', c_name) WHEN c_custkey % 23 = 0 THEN 'the elector of this card' ELSE c_mktsegment END",
    "relation_name": "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'पिता का नाम' ELSE c_name END",
    "house_number": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END",
    "gender": "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'male' END",
    "age": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(18 + c_custkey % 60 AS INT) END",
}
PAYLOAD_SQL = "SELECT c_custkey AS k, " + ", ".join(f"{e} AS {n}" for n, e in PAYLOAD_EXPRS.items()) + " FROM customer"
MESSAGE = "CASE event_id % 5 WHEN 0 THEN 'Rate limit reached, Try again in 2.5s' WHEN 1 THEN 'Connection reset by peer' WHEN 2 THEN 'bad request' WHEN 3 THEN 'HTTP 429' ELSE 'try again in 0.1s' END"
ANSWER = "CASE event_id % 4 WHEN 0 THEN concat(' ', props, ' ') WHEN 1 THEN concat('Here: ```json\n', props, '\n``` done') WHEN 2 THEN concat('answer ', props, ' end') ELSE 'none' END"
LEVELS = ("none", "medium", "strong")
LEVEL_EXPRS = {n: f"CASE CAST(floor(p_partkey / {d}) AS INT) % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'medium' ELSE 'strong' END" for n, d in (("serial", 1), ("geometry", 3), ("watermark", 9))}
CROP = "concat('normal/roll/Page_', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), '_entry_', lpad(CAST(o_custkey % 100 AS STRING), 3, '0'), '.PNG')"


def pdf(kind: int, key: int) -> bytes:
    """A small PDF with a number in its text: 0 plain with a table of references, 1 the same with ``/Encrypt`` in its text,
    2 with a stream of references, 3 encrypted for the empty password, 4 for another one, 5 the same as 2 and encrypted,
    6 cut off, 7 a text file."""
    import zlib

    from ..sources import pdf_state

    if kind == 7:
        return b"number %d, trailer << /Encrypt 4 0 R >>" % key
    said = b"BT (%d) Tj ET" % key if kind != 1 else b"BT (trailer << /Encrypt 4 0 R >> %d) Tj ET" % key
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [] /Count 0 >>", b"<< /Length %d >>\nstream\n%s\nendstream" % (len(said), said)]
    ident, locked = b"%016d" % key, kind in (4, 5)
    trailer = b"/Root 1 0 R /ID [<%s> <%s>]" % (ident.hex().encode(), ident.hex().encode())
    if kind in (3, 4, 5):
        how = {"Filter": "Standard", "V": 2, "R": 3, "Length": 128, "P": -44, "O": bytes(range(40, 72)), "U": bytes(32)}
        u = bytes(32) if locked else pdf_state.user_entry(how, ident) + bytes(16)
        objects.append(b"<< /Filter /Standard /V 2 /R 3 /Length 128 /P -44 /O <%s> /U <%s> >>" % (how["O"].hex().encode(), u.hex().encode()))
        trailer += b" /Encrypt 4 0 R"
    out, places = b"%PDF-1.5\n", []
    for n, own in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, own)
    start = len(out)
    if kind in (2, 5):  # rows of one, four and one bytes, each less the row above
        rows = [bytes(6), *(b"\x01" + p.to_bytes(4) + b"\0" for p in [*places, start])]
        up = b"".join(b"\x02" + bytes((a - b) & 255 for a, b in zip(row, before)) for row, before in zip(rows, [bytes(6), *rows]))
        packed = zlib.compress(up)
        out += b"%d 0 obj\n<< /Type /XRef /Size %d /W [1 4 1] /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 6 >> /Length %d %s >>\nstream\n%s\nendstream\nendobj\n" % (len(objects) + 1, len(rows), len(packed), trailer, packed)
    else:
        out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
        out += b"trailer\n<< /Size %d %s >>\n" % (len(objects) + 1, trailer)
    out += b"startxref\n%d\n%%%%EOF\n" % start
    return out[: start + 20] if kind == 6 else out
