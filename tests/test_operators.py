import itertools
import json
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioweave.operators import decide as D, geometry as G, images as I, records as R, watermark as W
from folioweave.sinks import spreadsheet, text as sink
from folioweave.sources import crops

LINE = "array<struct<text:string,confidence:double,x:double,y:double,height:double>>"


def parse(spark, lines):
    rows = [([(t, 0.9, float(x), float(y), 20.0) for t, x, y in lines],)]
    return R.records(spark.createDataFrame(rows, f"lines {LINE}")).first().asDict()


def test_fragmented_rows(spark):
    r = parse(spark, [("३१", 30, 10), ("HDR2OTOB4E", 420, 12), ("निवाचक का नाम", 10, 60), ("गीता देवी", 180, 62), ("पति का नाम", 10, 98), ("कैलाश", 165, 100), ("गृह संख्या", 10, 136), ("8", 160, 138), ("उम्र", 10, 174), ("56", 80, 174), ("लिंग", 130, 174), ("महिला", 190, 174)])
    got = [r[k] for k in ("serial_number", "epic_number", "elector_name", "relation_type", "relation_name", "house_number", "age", "gender")]
    assert got == ["31", "RDR2070845", "गीता देवी", "husband", "कैलाश", "8", 56, "female"]


def test_labels_and_values(spark):
    r = parse(spark, [("123 ABC1234567", 10, 10), ("Name: Suresh Kumar", 10, 40), ("पिता का नाम: Ramesh Kumar", 10, 70), ("House No: 42/A", 10, 100), ("Age: 34 Gender: Male", 10, 130)])
    assert (r["serial_number"], r["epic_number"], r["elector_name"], r["relation_type"], r["relation_name"], r["house_number"]) == ("123", "ABC1234567", "Suresh Kumar", "father", "Ramesh Kumar", "42/A")
    assert r["age"] is None and r["gender"] is None  # Latin labels are matched in lower case against upper-case text


def test_no_lines(spark):
    r = parse(spark, [])
    assert all(r[k] is None for k in ("serial_number", "epic_number", "elector_name", "relation_type", "house_number", "age", "gender", "raw_text"))


def test_report(spark):
    rows = [("12", "AB1234567", "Rita", "father", "Mohan", "", 17, "female", [("AB1234567", 0.63), ("Age: 17", 0.71), ("Gender: female", 0.69), ("Father Name: Mohan", 0.74)])]
    df = spark.createDataFrame(rows, "serial_number string, epic_number string, elector_name string, relation_type string, relation_name string, house_number string, age int, gender string, lines array<struct<text:string,confidence:double>>")
    r = R.reports(df).first()
    assert [i.issue_code for i in r.issues] == ["invalid_epic_format", "invalid_age_range", "empty_house_number"] and not r.is_valid
    assert [i.field_name for i in r.retry_fields] == ["epic_number", "age", "gender", "relation_type", "relation_name"]
    assert r.retry_fields[0].reason == "OCR confidence 0.63 is below threshold 0.80."


def fold(spark, rects, column):
    return [tuple(r) for r in spark.createDataFrame([(rects,)], f"rects {G.RECTS}").select(column(F.col("rects")).alias("o")).first().o]


def test_overlaps(spark):
    rects = [(112, 228, 1561, 634), (122, 235, 1540, 617), (1695, 228, 1561, 634), (1705, 235, 1541, 617), (3282, 228, 1558, 634), (3289, 235, 1541, 617)]
    assert sorted(fold(spark, rects, G.without_overlaps)) == rects[::2]


def test_folds_match_plain_loops(spark):
    rng = random.Random(4)
    for _ in range(6):
        rects = [(rng.choice((0, 200)) + rng.randrange(8), rng.choice((0, 90)) + rng.randrange(8), 100 + rng.randrange(12), 60 + rng.randrange(12)) for _ in range(rng.randrange(1, 14))]
        kept = []
        for r in rects:
            if not any(all(abs(a - b) <= t for a, b, t in zip(k, r, (4, 4, 6, 6))) for k in kept):
                kept.append(r)
        assert fold(spark, rects, G.without_similar) == kept
        near = max(10, int(np.median([r[3] for r in rects])) // 2)
        rows, y = [], None
        for r in sorted(rects, key=lambda r: (r[1], r[0], -r[2] * r[3])):
            if y is None or abs(r[1] - y) > near:
                rows.append([])
                y = r[1]
            rows[-1].append(r)
        assert [r[:1] for r in fold(spark, rects, G.in_rows)] == [r[:1] for row in rows for r in sorted(row)]
        groups = []
        for r in sorted(rects, key=lambda r: (r[1], r[0])):
            mid = lambda b: b[1] + b[3] / 2
            g = next((g for g in groups if abs(mid(r) - sum(map(mid, g)) / len(g)) <= 24), None)
            g.append(r) if g else groups.append([r])
        hulls = [(min(r[0] for r in g), min(r[1] for r in g)) for g in groups if len(g) > 1]
        got = fold(spark, rects, lambda c: W.banded(c, 200))
        assert {r[:2] for r in got} == {r[:2] for r in rects} | set(hulls)


def test_decision_table(spark):
    levels = ("none", "medium", "strong")
    rows = list(itertools.product(levels, repeat=3))
    df = spark.createDataFrame(rows, "s string, g string, w string")
    for r in df.select("*", D.decision(F.col("s"), F.col("g"), F.col("w")).alias("d")).collect():
        assert r.d.deleted == (r.g != "none" and (r.s != "none" or r.w != "none"))
    assert df.select(D.decision(F.lit("strong"), F.lit("medium"), F.lit("none")).alias("d")).first().d.confidence == 0.96


def test_clamp_and_names(spark):
    c = spark.range(1).select(G.clamped(F.struct(F.lit(100).alias("x"), F.lit(100).alias("y"), F.lit(90).alias("width"), F.lit(90).alias("height")), F.lit(150), F.lit(150)).alias("c")).first().c
    assert tuple(c) == (100, 100, 50, 50)


def test_payloads(spark):
    df = spark.createDataFrame([('x ```json\n{"a": 1}\n``` y',), ('{"b": 2}',), ("so {1} and {2}",), ("none",)], "t string")
    assert [r[0] for r in df.select(D.carved_json(F.col("t"))).collect()] == ['{"a": 1}', '{"b": 2}', "{1} and {2}", None]


def test_images():
    page = np.full((240, 360), 255, np.uint8)
    for y in (20, 90, 160):
        page[y : y + 3, 20:323] = 0
    for x in (20, 120, 220, 320):
        page[20:163, x : x + 3] = 0
    boxes = [c for c in I.cells(I.grid_mask(page)) if c[2] < 200]
    assert len([c for c in boxes if 80 < c[2] < 110 and 50 < c[3] < 80]) == 6
    frame = I.cleaned_border(np.pad(np.full((38, 38), 255, np.uint8), 1), 2)
    assert (frame[:2] == 255).all() and (frame[:, -2:] == 255).all()
    assert I.components(np.array([[1, 0, 1], [0, 1, 0]], bool)) == [(0, 0, 3, 2, 3)]
    assert I.few_levels(page) and I.median_blur(page).shape == page.shape and I.equalized(page).shape == page.shape
    assert (I.rotated(page, 0) == page).all()


def test_extraction_backends(spark):
    from folioweave.operators.extraction import chosen_backend, extracted

    assert chosen_backend(" OCR ", None, None) == "ocr" and chosen_backend("auto", None, "m") == "ocr" and chosen_backend("llm", print, "m") == "llm"
    with pytest.raises(ValueError):
        chosen_backend("other", None, None)
    with pytest.raises(RuntimeError):
        chosen_backend("llm", print, None)

    def client():
        def send(image, model, prompt):
            raise ValueError("down")

        return send

    line = "struct<text:string,confidence:double,x:double,y:double,height:double>"
    crops_ = spark.createDataFrame([(1, b"1", [("Q 87", 0.9, 10.0, 10.0, 20.0)], True)], f"k int, png binary, lines array<{line}>, deleted boolean")
    how = {"rounds": 1, "tries": 1}
    llm = extracted(crops_, "llm", client, "m", **how).first()
    assert llm.error == "ValueError: down" and llm.serial_number is None and llm.deleted
    auto = extracted(crops_, "auto", client, "m", **how).first()
    assert auto.error is None and auto.model is None and auto.serial_number == "87" and auto.raw_text == "Q 87" and auto.deleted
    ocr = spark.createDataFrame([([("a", 0.5, [(3.0, 4.0), (1.0, 9.0)]), ("b", 0.5, [])],)], "o array<struct<text:string,confidence:double,bounding_box:array<struct<x:double,y:double>>>>")
    assert [tuple(l) for l in ocr.select(R.placed(F.col("o")).alias("l")).first().l] == [("a", 0.5, 1.0, 4.0, 5.0), ("b", 0.5, 0.0, 0.0, 0.0)]


def test_reading_copy():
    rng = np.random.default_rng(3)
    flat = np.full((40, 60), 120, np.uint8)
    flat[:, 30:] = 220
    noisy = np.clip(flat + rng.normal(0, 4, flat.shape), 0, 255).astype(np.uint8)
    out = I.for_reading(noisy)
    assert np.abs(out.astype(int) - flat).mean() < np.abs(noisy.astype(int) - flat).mean() * 0.6 and (I.for_reading(flat) == flat).all()

    def plain(image, y, x, r=10, p=3, strength=7):  # one pixel, patch by patch
        big = np.pad(image.astype(float), r + p, mode="reflect")
        own = big[y + r : y + r + 2 * p + 1, x + r : x + r + 2 * p + 1]
        total = weights = 0.0
        for a in range(2 * r + 1):
            for b in range(2 * r + 1):
                part = big[y + a : y + a + 2 * p + 1, x + b : x + b + 2 * p + 1]
                w = np.exp(-((part - own) ** 2).mean() / strength**2)
                weights, total = weights + w, total + w * part[p, p]
        return round(total / weights)

    assert all(abs(int(out[y, x]) - plain(noisy, y, x)) <= 1 for y, x in ((0, 0), (5, 29), (20, 31), (39, 59)))


def test_small_crops_and_json_roots(spark, tmp_path):
    from folioweave.sources.json_records import read_records

    box = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(50).alias("width"), F.lit(30).alias("height"))
    of = lambda w, h: spark.range(1).select(G.clamped(box, F.lit(99), F.lit(99), w, h).alias("c")).first().c
    assert of(40, 40) is None and of(40, 20) is not None and of(60, 20) is None
    for text, want in (('[{"b": 1, "a": 2}, {"c": true}]', 2), ('{"x": []}', 1), ("[]", 0)):
        (tmp_path / "r.json").write_text(text)
        rows = read_records(spark, str(tmp_path / "r.json"))
        assert rows.count() == want
    for text in ("3", "[1]", "nothing"):
        (tmp_path / "r.json").write_text(text)
        with pytest.raises(ValueError):
            read_records(spark, str(tmp_path / "r.json"))


def test_sinks_and_scan(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", None, True), (1, "ä", "male", False)], "k int, name string, gender string, deleted boolean")
    assert sink.write_json_list(rows, str(tmp_path / "a.json"), ["k"]) == 2
    assert [r["k"] for r in json.loads((tmp_path / "a.json").read_text())] == [1, 2]
    assert sink.write_json_list(rows.where("k > 9"), str(tmp_path / "e.json"), ["k"]) == 0 and json.loads((tmp_path / "e.json").read_text()) == []
    spreadsheet.write_sheet(rows, str(tmp_path / "a.xlsx"), ["k"])
    xml = zipfile.ZipFile(tmp_path / "a.xlsx").read("xl/worksheets/sheet1.xml").decode()
    assert "पुरुष" in xml and xml.index("ä") < xml.index(">b<") and '<c r="D3" t="b"><v>1</v></c>' in xml and '<c r="D2"/>' in xml
    assert [spreadsheet.column_name(n) for n in (1, 26, 27, 28, 702, 703)] == ["A", "Z", "AA", "AB", "ZZ", "AAA"]
    for kind, page, entry in (("normal", 1, 1), ("normal", 1, 5), ("normal", 2, 1), ("deleted", 1, 6)):
        where = tmp_path / kind / "roll"
        where.mkdir(parents=True, exist_ok=True)
        (where / f"page_{page:03d}_entry_{entry:03d}.png").write_bytes(b"x")
    got = crops.scan_crops(spark, str(tmp_path / "normal"), str(tmp_path / "deleted"), "roll").select("page", "entry_index", "deleted").collect()
    assert [tuple(r) for r in got] == [(1, 1, False), (1, 5, False), (1, 6, True), (2, 1, False)]
    assert crops.scan_crops(spark, str(tmp_path / "no"), str(tmp_path / "none"), "roll").count() == 0


def test_recognition(spark):
    from folioweave.operators.recognition import recognized

    def engine():
        def read(data):
            if data == b"bad":
                raise RuntimeError("no text")
            return [[[[[0, 1], [2, 3]], (data.decode(), 0.5)], [None, ["no box", 1]], ["short"]]] if data else None

        return read

    def broken():
        raise ImportError("no engine")

    crops_ = spark.createDataFrame([(1, b"ab", "x"), (2, b"bad", "x"), (3, b"", "x"), (4, None, "x")], "k int, png binary, extra string")
    got = {r["k"]: r for r in recognized(crops_, engine).collect()}
    assert [(l["text"], l["confidence"], len(l["bounding_box"])) for l in got[1]["ocr"]] == [("ab", 0.5, 2), ("no box", 1.0, 0)]
    assert got[2]["ocr"] == [] and got[2]["ocr_error"] == "RuntimeError: no text" and got[1]["ocr_error"] is None
    assert got[3]["ocr"] == [] and got[4]["ocr"] == [] and got[1]["extra"] == "x"
    assert all(r["ocr_error"] == "ImportError: no engine" for r in recognized(crops_, broken).collect())
    assert recognized(crops_.where("k > 9"), engine).count() == 0
