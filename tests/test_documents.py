import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioweave import logs, run, settings as S
from folioweave.functions import png
from folioweave.operators import classify, debug, engines, images as I, models as M, preprocess as P, tiles as T, watermark as W
from folioweave.plans import fixtures
from folioweave.sinks import files, image_sheets as sheets, json_list, spreadsheet, text as text_sink
from folioweave.sources import pages as source, pdf_state, workbook
from folioweave.streaming import crops as stream

CARD = {"serial_number": "7", "epic_number": "ABC1234567", "elector_name": "Ravi", "relation_type": "father", "relation_name": "Mohan", "house_number": "12", "age": 34, "gender": "male"}


def page(cols=3, rows=8, cell=(300, 140)):
    out = np.full((1240, 1000), 255, np.uint8)
    for r in range(rows):
        for c in range(cols):
            x, y = 40 + c * (cell[0] + 8), 40 + r * (cell[1] + 8)
            out[y : y + cell[1], x : x + 3] = out[y : y + cell[1], x + cell[0] - 3 : x + cell[0]] = 0
            out[y : y + 3, x : x + cell[0]] = out[y + cell[1] - 3 : y + cell[1], x : x + cell[0]] = 0
    return out


def rasterize(path, number, dpi):
    return png.encode(np.full((number, 4), dpi % 256, np.uint8))


def count(path):
    return 6


def test_png():
    rng = np.random.default_rng(1)
    for a in (rng.integers(0, 256, (5, 7), np.uint8), rng.integers(0, 256, (4, 3, 3), np.uint8)):
        assert (png.decode(png.encode(a)) == a).all() and png.size(png.encode(a)) == (a.shape[1], a.shape[0])
    with pytest.raises(ValueError):
        png.decode(b"text")
    # filters: sub, up, average and Paeth against their definitions
    raw, step = rng.integers(0, 256, (5, 12), np.uint8), 3
    filtered = np.zeros_like(raw)
    for y in range(5):
        for i in range(12):
            a, b, c = int(raw[y, i - step]) if i >= step else 0, int(raw[y - 1, i]) if y else 0, int(raw[y - 1, i - step]) if y and i >= step else 0
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = (0, a, b, (a + b) // 2, a if pa <= pb and pa <= pc else b if pb <= pc else c)[y]
            filtered[y, i] = (int(raw[y, i]) - guess) % 256
    assert (png._unfiltered(filtered, np.arange(5), step) == raw).all()


def _png(width, height, depth, colour, passes, chunks=b"", interlaced=0):
    """A PNG image of given rows a pass: lists of lists of samples, written bit by bit with filters 0 and 2 in turn."""
    import struct
    import zlib

    body = b""
    for rows in passes:
        above = None
        for y, row in enumerate(rows):
            bits = "".join(format(v, f"0{depth}b") for v in row)
            line = bytes(int(bits[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(bits), 8))
            body += bytes([2 * (y % 2)]) + (bytes((a - b) & 255 for a, b in zip(line, above)) if y % 2 else line)
            above = line
    part = lambda kind, inner: struct.pack(">I", len(inner)) + kind + inner + struct.pack(">I", zlib.crc32(kind + inner))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, interlaced)) + b"".join(part(k, v) for k, v in chunks or []) + part(b"IDAT", zlib.compress(body)) + part(b"IEND", b"")


def test_png_forms():
    """Depths of 1 to 16 bits, palettes, transparency and interlacing give the pixels of plain copies; broken streams raise."""
    rng = np.random.default_rng(8)
    for (w, h), interlaced in [((s, i)) for s in ((9, 6), (1, 1), (5, 3), (16, 17)) for i in (0, 1)]:
        def passes(a):
            if not interlaced:
                return [a.reshape(h, -1).tolist()]
            order = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]
            return [p.reshape(p.shape[0], -1).tolist() for x, y, dx, dy in order if (p := a[y::dy, x::dx]).size]

        for depth in (1, 2, 4, 8, 16):
            a = rng.integers(0, 1 << depth, (h, w))
            plain = (a >> 8 if depth == 16 else a * (255 // ((1 << depth) - 1))).astype(np.uint8)
            got = png.decode(_png(w, h, depth, 0, passes(a), interlaced=interlaced))
            assert got.dtype == np.uint8 and (got == plain).all()
            key = int(a[0, 0])
            both = png.decode(_png(w, h, depth, 0, passes(a), [(b"tRNS", key.to_bytes(2, "big"))], interlaced), alpha=True)
            assert (both[..., 0] == plain).all() and (both[..., 1] == np.where(a == key, 0, 255)).all()
            if depth < 16:
                colours = rng.integers(0, 256, (1 << depth, 3), np.uint8)
                data = _png(w, h, depth, 3, passes(a), [(b"PLTE", colours.tobytes()), (b"tRNS", b"\x07")], interlaced)
                assert (png.decode(data) == colours[a][..., ::-1]).all() and (png.decode(data, alpha=True)[..., 3] == np.where(a == 0, 7, 255)).all()
            assert (png.decode(png.encode(plain, depth, bool(interlaced))) == plain).all()
        for depth, colour, n in ((8, 2, 3), (16, 2, 3), (8, 6, 4), (16, 6, 4), (8, 4, 2), (16, 4, 2)):
            a = rng.integers(0, 1 << depth, (h, w, n))
            plain = (a >> (depth - 8)).astype(np.uint8)
            got = png.decode(_png(w, h, depth, colour, passes(a), interlaced=interlaced), alpha=True)
            assert (got[..., -1] == (plain[..., -1] if colour != 2 else 255)).all()
            assert (got[..., :-1] == plain[..., : n - (colour != 2)][..., ::-1]).all()
    good = png.encode(np.arange(60, dtype=np.uint8).reshape(6, 10))
    damaged = bytearray(good)
    damaged[45] ^= 1
    short = _png(4, 4, 8, 0, [[[1, 2, 3, 4]]])
    for bad in (good[:50], bytes(damaged), short, _png(2, 1, 8, 3, [[[0, 1]]], [(b"PLTE", b"abc")]), _png(2, 1, 2, 2, [[[0] * 6]]), _png(2, 1, 8, 0, []), b"", b"\x89PNG"):
        with pytest.raises(ValueError):
            png.decode(bad)


def test_deskew_and_chain(spark):
    flat = np.full((300, 400), 255, np.uint8)
    flat[100:200, 80:320] = 0
    assert P.skew(flat == 0) == 0 and P.skew(flat > 255) == 0
    for degrees in (-7, 3, 12):
        turned = I.rotated(flat, -degrees)
        assert abs(P.skew(turned < 128) - degrees) < 0.7
        assert abs(P.skew(P.deskewed(turned) < 128)) < 0.7
    out, seen = P.prepared(flat, P.Options(steps=("threshold",)))
    assert set(np.unique(out)) <= {0, 255} and list(seen) == ["original", *P.STEPS]
    rows = spark.createDataFrame([(1, png.encode(flat)), (2, b"bad"), (3, None)], "page int, png binary")
    got = {r["page"]: r for r in P.clean_pages(rows, debug=True).collect()}
    assert got[1]["width"] == 400 and set(got[1]["steps"]) == {"original", *P.STEPS} and got[1]["clean_error"] is None
    assert got[2]["clean"] is None and got[2]["clean_error"] and got[3]["clean_error"]


def test_watermark_parts(spark):
    g = np.zeros((400, 600), np.uint8)
    m = W.masked(g)
    assert (m[:10] == 255).all() and (m[20:60, 20:200] == 255).all() and (m[100:300, 450:570] == 255).all() and m[200, 300] == 0
    assert W.plausible((50, 50, 100, 40), 600, 400) and not W.plausible((5, 50, 100, 40), 600, 400) and not W.plausible((50, 50, 30, 40), 600, 400)
    assert W.bands([(0, 0, 10, 10), (20, 4, 10, 10), (0, 200, 5, 5), (0, 0, 10, 10)], 400) == [(0, 0, 10, 10), (20, 4, 10, 10), (0, 0, 30, 14), (0, 200, 5, 5)]
    assert W.bands([], 400) == []
    mask = np.zeros((100, 100), bool)
    mask[0:10, 0:10] = mask[50:60, 50:60] = mask[90, 90] = True
    assert W.letters(mask, (0, 0, 100, 100)) == 2
    c = lambda a, w, n, mean: (a, 300 - w // 2, 185, w, 30, n, mean)
    rows = spark.createDataFrame([(1, [c(-45, 80, 2, 150.0), c(25, 150, 3, 150.0), c(30, 160, 4, 150.0)]), (2, [c(25, 150, 3, 20.0)]), (3, []), (4, None)], f"k int, f array<{W.CANDIDATE}>")
    from pyspark.sql import functions as F

    got = {r["k"]: r["g"] for r in rows.select("k", W.geometry(F.col("f"), F.lit(600), F.lit(400)).alias("g")).collect()}
    assert got[1]["level"] == "strong" and got[1]["angle"] == 25 and got[2] is None and got[3] is None and got[4] is None


def test_grid_to_crops_to_classes(spark, tmp_path):
    p = page()
    raw = spark.createDataFrame([(1, png.encode(p)), (2, b"bad")], "page int, png binary")
    clean = P.clean_pages(raw, P.Options(steps=("threshold",)))
    cut = classify.crops(classify.grids(clean)).collect()
    assert [(r["page"], r["entry_index"]) for r in cut] == [(1, i + 1) for i in range(24)]
    assert cut[0]["name"] == "page_001_entry_001.png" and abs(png.size(cut[0]["png"])[0] - 300) < 8

    def reader():
        def read(data):
            w, _ = png.size(data)
            return [[[None, ("Q 12" if w > 80 else "", 0.9)]]]

        return read

    crops = spark.createDataFrame([(1, 1, "a", cut[0]["png"]), (1, 2, "b", b"bad")], "page int, entry_index int, name string, png binary")
    got = {r["name"]: r for r in classify.classified(crops, reader).collect()}
    assert got["a"]["status"] == "ok" and got["a"]["deleted"] is False and got["a"]["serial"]["level"] == "strong" and got["a"]["rule"] == "rule_5_q_without_watermark"
    done = classify.classified(crops, reader).cache()
    files.archive_crops(done, "roll", str(tmp_path))
    files.archive_crops(done, "roll", str(tmp_path))
    assert [p.name for p in (tmp_path / "normal" / "roll").iterdir()] == ["a"] and not (tmp_path / "deleted" / "roll").exists()
    files.write_files(debug.decision_files(done), str(tmp_path / "debug"))
    seen = {p.name for p in (tmp_path / "debug" / "a").iterdir()}
    assert seen == {"original.png", "serial.png", "masked.png", "turned.png", "letters.png", "bands.png", "decision.json"}
    assert json.loads((tmp_path / "debug" / "a" / "decision.json").read_text())["rule"] == "rule_5_q_without_watermark"
    done.unpersist()
    files.write_files(debug.grid_overlays(classify.grids(clean)), str(tmp_path / "grid"))
    shown = png.decode((tmp_path / "grid" / "page_0001_entries.png").read_bytes())
    assert (shown == (0, 255, 0)).all(axis=2).any() and [p.name for p in (tmp_path / "grid").iterdir()] == ["page_0001_entries.png"]
    assert debug.drawn(np.zeros((5, 5), np.uint8), [(-3, -3, 40, 40), (9, 9, 2, 2)]).shape == (5, 5, 3)
    assert got["b"]["status"] == "failed" and got["b"]["deleted"] is None and got["b"]["error"]


def test_time_limit():
    import time

    with pytest.raises(classify.TimedOut), classify.time_limit(0.05):
        time.sleep(2)
    with classify.time_limit(0):
        pass


def test_model_calls(spark, tmp_path):
    mark = str(tmp_path / "asked")

    def client():
        calls = {}

        def send(data, model, prompt):
            kind = data.decode()
            n = calls[kind, model, prompt] = calls.get((kind, model, prompt), 0) + 1
            if kind == "flaky" and n < 2:
                raise RuntimeError("429, try again in 0.1s")
            if kind == "broken":
                raise RuntimeError("bad request")
            if kind == "again" and not os.path.exists(mark):
                open(mark, "w").close()
                return "no object"
            if kind == "noserial":
                return json.dumps({"serial_number": "55"} if prompt == M.SERIAL_PROMPT else CARD | {"serial_number": None})
            if kind == "weak":
                return json.dumps(CARD if model == "big" else CARD | {"elector_name": None})
            if kind == "both":
                return json.dumps(CARD | {"elector_name": None, "house_number": None} if model == "small" else CARD | {"elector_name": " "})
            if kind == "odd":
                return json.dumps(CARD | {"gender": "x"})
            return "```json\n" + json.dumps(CARD) + "\n```"

        return send

    kinds = ["plain", "flaky", "broken", "again", "noserial", "weak", "both", "odd"]
    rows = spark.createDataFrame([(k, k.encode()) for k in kinds], "k string, png binary").coalesce(1)
    got = {r["k"]: r for r in M.extracted(rows, client, "small", "big", tries=2, rounds=2, patience=0.01).collect()}
    assert got["plain"]["age"] == 34 and got["plain"]["gender"] == "male" and got["plain"]["model"] == "small" and json.loads(got["plain"]["raw_text"])["elector_name"] == "Ravi"
    assert got["flaky"]["error"] is None and got["again"]["error"] is None and "bad request" in got["broken"]["error"] and got["broken"]["model"] is None
    assert got["noserial"]["serial_number"] == "55" and got["weak"]["model"] == "big"
    assert got["both"]["error"] == "ValueError: Low-quality extraction: elector_name is missing" and got["both"]["model"] is None and got["both"]["house_number"] is None
    assert got["odd"]["error"] == "Invalid gender: x"
    assert M.extracted(rows.where("k = 'no'"), client, "small").count() == 0
    folder = str(tmp_path / "attempts")
    for _ in range(2):  # the second run finds all rounds written and asks nothing
        M.best_payloads(rows, client, "small", "big", tries=2, rounds=3, patience=0.01, key=("k",), folder=folder)
    tried = M.attempts(spark, folder)
    assert {r["k"]: r["n"] for r in tried.groupBy("k").agg(F.count("*").alias("n")).collect()} == {k: 3 if k in ("broken", "both") else 1 for k in kinds}
    assert tried.where("error is not null and due is null").count() == 0
    assert M.base_address("http://a/") == "http://a/v1" == M.base_address("http://a/v1/")
    assert M.answer_text({"choices": [{"message": {"content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}}]}) == "a\nb"
    for bad in ({}, {"choices": [{"message": {}}]}):
        with pytest.raises(ValueError):
            M.answer_text(bad)
    with pytest.raises(ValueError):
        M.chat_client("", "")


def test_page_source(spark, tmp_path):
    path = tmp_path / "a.pdf"
    path.write_bytes(b"%PDF-1.4\n")
    how = "tests.test_documents:rasterize", "tests.test_documents:count"
    assert [tuple(r)[:3] for r in source.read_pages(spark, str(path), *how, cover=False).orderBy("page").collect()] == [(1, 3, "page_0001.png"), (2, 4, "page_0002.png"), (3, 5, "page_0003.png")]
    assert source.read_pages(spark, str(path), *how).count() == 6
    with pytest.raises(FileNotFoundError):
        source.check_document(str(tmp_path / "no.pdf"))
    (tmp_path / "b.pdf").write_bytes(b"text")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4\ntrailer << /Encrypt 5 0 R >>")
    with pytest.raises(ValueError):
        source.check_document(str(tmp_path / "b.pdf"))
    with pytest.raises(PermissionError):
        source.check_document(str(tmp_path / "c.pdf"))


def test_clean_files(spark, tmp_path):
    image = np.random.default_rng(3).integers(0, 256, (40, 30)).astype(np.uint8)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.b.png").write_bytes(png.encode(image))
    (tmp_path / "in" / "bad.PNG").write_bytes(b"no picture")
    (tmp_path / "in" / "a.b_clean.png").write_bytes(b"of an earlier run")
    how = P.Options(steps=("denoise", "threshold"))
    got = {r["name"]: r for r in P.clean_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), how, str(tmp_path / "debug")).collect()}
    want, seen = P.prepared(image, how)
    assert set(got) == {"a.b.png", "bad.PNG"} and os.listdir(tmp_path / "out") == ["a.b_clean.png"]
    assert tuple(got["a.b.png"])[1:4] == ("a.b_clean.png", 30, 40) and got["bad.PNG"].clean_name is None and got["bad.PNG"].clean_error
    assert (png.decode((tmp_path / "out" / "a.b_clean.png").read_bytes()) == want).all()
    assert sorted(got["a.b.png"].debug_names) == sorted(f"a.b/{s}.png" for s in seen) and got["bad.PNG"].debug_names == []
    for step, picture in seen.items():
        assert (png.decode((tmp_path / "debug" / "a.b" / f"{step}.png").read_bytes()) == picture).all()
    plain = P.clean_files(spark, str(tmp_path / "in"), str(tmp_path / "in"), how).collect()
    assert all(r.debug_names == [] for r in plain) and (tmp_path / "in" / "a.b_clean.png").read_bytes() != b"of an earlier run"


def test_document_states(spark, tmp_path):
    want = ["plain", "plain", "plain", "open", "locked", "locked", "damaged", "no pdf"]
    files = [fixtures.pdf(k, 31) for k in range(8)]
    assert [pdf_state.state_of(f) for f in files] == want
    for k, f in enumerate(files):
        (tmp_path / f"{k}.{'PDF' if k % 2 else 'pdf'}").write_bytes(f)
    found = {r.path[-5]: (r.length, r.state) for r in pdf_state.scan_documents(spark, str(tmp_path)).collect()}
    assert found == {str(k): (len(f), w) for k, (f, w) in enumerate(zip(files, want))}
    for k, error in ((4, PermissionError), (5, PermissionError), (7, ValueError)):
        with pytest.raises(error):
            source.check_document(str(tmp_path / f"{k}.{'PDF' if k % 2 else 'pdf'}"))
    for k in (0, 1, 2, 3, 6):
        source.check_document(str(tmp_path / f"{k}.{'PDF' if k % 2 else 'pdf'}"))
    with pytest.raises(ValueError):
        source.check_document(str(tmp_path / "6.pdf"), strict=True)
    assert pdf_state._rc4(b"Key", b"Plaintext").hex() == "bbf316e8d940af0ad3"
    older = files[4] + files[0][: files[0].index(b"xref")]  # an update that ends too early
    assert pdf_state.state_of(older) == "locked" and pdf_state.state_of(b"") == "no pdf" and pdf_state.state_of(b"%PDF-1.7") == "damaged"
    loop = b"%PDF-1.4\nxref\n0 1\n0000000000 65535 f \ntrailer << /Root 1 0 R /Prev 9 >>\nstartxref\n9\n%%EOF"
    assert pdf_state.state_of(loop) == "damaged" and pdf_state.state_of(b"%PDF-1.4\ntrailer " + b"[" * 5000 + b"\nstartxref\n9") == "damaged"
    assert pdf_state.parsed(rb"<< /A (x\(y\)(z)\101) /B [1 -2.5 3 0 R <4 1 4>] % note" + b"\n/C null /D true >>", 0)[0] == {"A": b"x(y)(z)A", "B": [1, -2.5, pdf_state.Ref(3, 0), b"A@"], "C": None, "D": True}


def test_workbook_source(spark, tmp_path):
    one, two = str(tmp_path / "one.xlsx"), str(tmp_path / "two.xlsx")
    spreadsheet.write_package(one, ["age", "elector_name"], [[3, "a <b>"], [None, True], [2.5, {"k": [1]}], [None, " "]], "A & B")
    main, doc = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(two, "w") as z:  # as other programs write: shared strings in runs, cells without references, a chart
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{doc}"><sheets><sheet name="X" r:id="a"/><sheet name="Chart" r:id="c"/><sheet name="Y" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="a" Type="{doc}/worksheet" Target="/xl/worksheets/s1.xml"/><Relationship Id="b" Type="{doc}/worksheet" Target="worksheets/s2.xml"/><Relationship Id="c" Type="{doc}/chartsheet" Target="c.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>one</t></si><si><r><t>tw</t></r><r><t>o</t></r><rPh><t>no</t></rPh></si></sst>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><cols><col/></cols><sheetData><row><c t="s"><v>1</v></c><c t="e"><v>#N/A</v></c></row><row r="5"><c r="AB5" t="str"><f>A1</f><v>s</v></c><c><v>7</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
    assert [n for n, _ in workbook.sheets_of(two)] == ["X", "Y"]
    rows = workbook.read_workbook(spark, two)
    assert rows.rdd.getNumPartitions() == 2
    assert [(r.sheet, r.place, r.row, [tuple(c) for c in r.cells]) for r in rows.orderBy("row").collect()] == [("X", 1, 1, [("A", "text", "two"), ("B", "error", "#N/A")]), ("X", 1, 5, [("AB", "text", "s"), ("AC", "number", "7")])]
    got = workbook.read_workbook(spark, one, "A & B", header=True).orderBy("row").select("row", workbook.value_of("Age", "double").alias("a"), workbook.value_of("Elector Name").alias("e"), workbook.value_of("Elector Name", "boolean").alias("b"))
    assert [tuple(r) for r in got.collect()] == [(2, 3.0, "a <b>", None), (3, None, "true", True), (4, 2.5, '{"k": [1]}', None), (5, None, " ", None)]
    assert workbook.read_workbook(spark, str(tmp_path / "*.xlsx")).select("path", "sheet").distinct().count() == 2
    with zipfile.ZipFile(one) as z:
        assert {"xl/styles.xml", "docProps/app.xml", "docProps/core.xml"} < set(z.namelist())
    (tmp_path / "three.xlsx").write_text("x")
    for how in ((str(tmp_path / "three.xlsx"), None), (one, "Z"), (str(tmp_path / "no*.xlsx"), None)):
        with pytest.raises(Exception):
            workbook.read_workbook(spark, *how).count()


def test_image_sheets(tmp_path):
    book = str(tmp_path / "a.xlsx")
    spreadsheet.write_package(book, ["age"], [[3]], "Records")
    image = png.encode(np.zeros((4, 6), np.uint8))
    assert sheets.add_image_sheets(book, ("First Page", image), ("records", image)) == ["First Page", "Records", "records_2"]
    parts = sheets.read_package(book)
    assert parts["xl/media/image2.png"] == image and b'cx="57150" cy="38100"' in parts["xl/drawings/drawing1.xml"]
    assert parts["[Content_Types].xml"].count(b'Extension="png"') == 1 and zipfile.ZipFile(book).testzip() is None
    assert sheets.add_image_sheets(book, ("First Page", image), ("Z", image))[:3] == ["First Page_2", "First Page", "Z"]
    assert sheets.safe_name(" a/b ") == "a-b" and sheets.safe_name("") == "Sheet" and len(sheets.unused_name("x" * 31, ["X" * 31])) <= 31
    with pytest.raises(FileNotFoundError):
        sheets.read_package(str(tmp_path / "no.xlsx"))


def test_settings_and_logs(tmp_path, spark):
    (tmp_path / ".env").write_text("# note\nCROP_MIN_WIDTH=50\nexport LOG_LEVEL='DEBUG'\n")
    got = S.load({"PREPROCESSING_ENABLE_DENOISE": "false", "crop_min_height": "9"}, tmp_path / ".env")
    assert got.crop_min_width == 50 and got.log_level == "DEBUG" and got.crop_min_height == 9 and "denoise" not in got.preprocessing().steps
    with pytest.raises(ValueError):
        S.load({"LOG_TO_FILE": "perhaps"}, tmp_path / "none")
    log = logs.set_up("INFO", str(tmp_path / "logs"), "try")
    log.info("done", extra={"b": 2, "a": 1})
    assert next((tmp_path / "logs").iterdir()).read_text().strip().endswith("done | a=1 b=2")


def test_tiles_equal_whole_pages(spark):
    """Masks, boxes, areas and holes of pages cut into tiles are those of the whole pages, whatever the seams cut."""
    rng = np.random.default_rng(4)
    spiral = np.zeros((200, 230), bool)
    for k in range(0, 90, 6):
        spiral[k : 200 - k, k] = spiral[k, max(0, k - 6) : 230 - k] = spiral[k : 200 - k, 229 - k] = spiral[199 - k, k + 6 : 230 - k] = True
    noise = rng.random((150, 311)) < 0.3
    pages = [page(), np.where(noise, 0, 255).astype(np.uint8), np.where(spiral, 120, 255).astype(np.uint8), np.full((40, 50), 255, np.uint8)]
    df = spark.createDataFrame([(i, png.encode(a)) for i, a in enumerate(pages)] + [(9, b"bad"), (10, None)], "page long, png binary")
    whole = lambda f: {(i, int(y), int(x)) for i, a in enumerate(pages) for y, x in zip(*np.nonzero(f(a)))}
    seen = lambda t, n: {tuple(r) for r in T.pixels_of(t, n).collect()}
    n = 70
    masks = T.grid_masks(T.tiled(df, size=n), 1000, 1240, size=n)
    assert seen(masks, n) == whole(I.grid_mask) and seen(T.tiled(df, size=n), n) == whole(lambda a: a)
    assert seen(T.watermark_masks(T.tiled(df, size=n), n), n) == whole(lambda a: I.watermark_masks(a)[1])
    with pytest.raises(ValueError):
        T.grid_masks(T.tiled(df, size=16), 1000, 1240, size=16)
    dark = [(i, int(y), int(x)) for i, a in enumerate(pages) for y, x in zip(*np.nonzero(a < 200))]
    for i, (h, w) in ((1, pages[1].shape), (2, pages[2].shape)):
        ink = T.drawn(spark.createDataFrame([p for p in dark if p[0] == i], "page long, y int, x int"), w, h, 40)
        for eight in (True, False):
            got = sorted(tuple(r)[1:6] for r in T.parts(ink, eight, size=40).collect())
            assert got == sorted(I.components(pages[i] < 200, eight))
        tree = [r.asDict() for r in T.contours(ink, 40).collect()]
        assert {r["contour"]: tuple(r.values())[1:] for r in tree} == {c["contour"]: tuple(c.values()) for c in I.contours(pages[i] < 200)}
        assert sorted((r["x"], r["y"], r["width"], r["height"]) for r in tree) == sorted(I.cells(pages[i] < 200))


def test_contour_tree():
    """Parents of nested frames, dots and random masks are those that flooding each part and hole from outside finds."""
    rng = np.random.default_rng(6)
    nested = np.zeros((40, 60), bool)
    for k in range(0, 18, 3):
        nested[k, k : 60 - k] = nested[39 - k, k : 60 - k] = nested[k : 40 - k, k] = nested[k : 40 - k, 59 - k] = True
    dots = np.zeros((21, 21), bool)
    dots[2:19, 2:19] = True
    dots[4:9, 4:9] = dots[11:17, 4:17] = False
    dots[6, 6] = dots[13, 8] = dots[14, 9] = True
    for mask in (nested, dots, rng.random((24, 31)) < 0.45, rng.random((24, 31)) < 0.6, np.ones((3, 3), bool), np.zeros((3, 3), bool)):
        h, w = mask.shape
        part, number = -np.ones((h, w), int), 0
        inside = {}
        for y in range(h):
            for x in range(w):
                if part[y, x] < 0:
                    todo, seen = [(y, x)], {(y, x)}
                    while todo:
                        b, a = todo.pop()
                        for dy in (-1, 0, 1):
                            for dx in (-1, 0, 1):
                                q = b + dy, a + dx
                                if (mask[y, x] or not dy or not dx) and 0 <= q[0] < h and 0 <= q[1] < w and q not in seen and mask[q] == mask[y, x]:
                                    seen.add(q)
                                    todo.append(q)
                    for q in seen:
                        part[q] = number
                    inside[number] = y * w + x, bool(mask[y, x]), any(q[0] in (0, h - 1) or q[1] in (0, w - 1) for q in seen), seen
                    number += 1
        expected = {}
        for at, dark, open_, seen in inside.values():
            if not dark and open_:
                continue
            # what is left of the page after this part is taken out, flooded from the edge, shows which parts it encloses;
            # its parent is the one among its neighbours that encloses it
            around = {part[y + dy, x + dx] for y, x in seen for dy in (-1, 0, 1) for dx in (-1, 0, 1) if 0 <= y + dy < h and 0 <= x + dx < w and (not dark or not dy or not dx)} - {part[next(iter(seen))]}
            low = min(y for y, _ in seen)
            outer = [k for k in around if inside[k][1] != dark and (min(y for y, _ in inside[k][3]) < low or (not inside[k][1] and inside[k][2]))]
            parents = {inside[k][0] for k in outer if inside[k][1] or not inside[k][2]}
            expected[at] = parents
        got = {c["contour"]: c["parent"] for c in I.contours(mask)}
        assert got.keys() == expected.keys()
        for at, parent in got.items():
            assert expected[at] == ({parent} if parent is not None else set()), (at, parent, expected[at])


def test_growing_json_list(spark, tmp_path):
    """The list is whole after each commit, equal to one written at once, and a failed or repeated run adds nothing."""
    path = str(tmp_path / "a" / "list.json")
    rows = spark.createDataFrame([(i, f"é{i}" if i % 3 else None, [i] if i % 2 else None) for i in range(50)], "k int, name string, more array<int>").repartition(7)
    assert json_list.append_json_list(rows.where("k < 0"), path, ["k"]) == 0 and json.load(open(path)) == []
    for k, (low, high) in enumerate([(0, 1), (1, 1), (1, 20), (20, 50)]):
        assert json_list.append_json_list(rows.where(f"k >= {low} and k < {high}"), path, ["k"], batch=k) == high
        assert [r["k"] for r in json.load(open(path))] == list(range(high))
    whole = str(tmp_path / "whole.json")
    text_sink.write_json_list(rows, whole, ["k"])
    assert open(path).read() == open(whole).read()
    assert json_list.append_json_list(rows, path, ["k"], batch=3) == 50
    before = open(path).read()
    with pytest.raises(Exception):  # noqa: B017 - a task that fails aborts the write
        json_list.append_json_list(rows.withColumn("bad", F.raise_error(F.lit("stop"))), path, ["k"])
    assert open(path).read() == before and not any((tmp_path / "a" / "list.json.parts").glob("*"))
    with open(path, "r+b") as f:  # an append that the driver did not live to finish
        f.seek(-2, 2)
        f.write(b",\n  {half")
    assert json_list.append_json_list(rows.where("k = 0"), path, ["k"]) == 51
    assert [r["k"] for r in json.load(open(path))] == [*range(50), 0]
    with pytest.raises(Exception):  # noqa: B017 - a foreign file is left alone
        json_list.append_json_list(rows, whole, ["k"])
    assert open(whole).read() == before
    assert json_list.append_json_list(rows.where("k < 3"), path, ["k"], ("more",), mode="overwrite") == 3 and json.load(open(path))[0] == {"k": 0, "name": None}


def test_engine_per_worker(spark, tmp_path):
    """An engine is made once a worker over many tasks, a failure too; a broken one gives an empty run and no failed job."""
    made, failed = str(tmp_path / "made"), str(tmp_path / "failed")

    def engine():
        with open(f"{made}.{os.getpid()}", "a") as f:
            f.write("x")
        return lambda data: None

    def broken():
        with open(f"{failed}.{os.getpid()}", "a") as f:
            f.write("x")
        raise RuntimeError("no engine here")

    image = png.encode(np.full((60, 90), 255, np.uint8))
    crops_ = spark.createDataFrame([(1, i, f"n{i}", image) for i in range(40)], "page int, entry_index int, name string, png binary").repartition(20)
    good = engines.per_worker(engine)
    for _ in range(2):
        assert classify.classified(crops_, good).where("status = 'ok'").count() == 40
    counts = [len(p.read_text()) for p in tmp_path.glob("made.*")]
    assert counts and set(counts) == {1}
    bad = classify.classified(crops_, broken).collect()
    assert {(r["status"], r["error"]) for r in bad} == {("failed", "RuntimeError: no engine here")}
    assert {len(p.read_text()) for p in tmp_path.glob("failed.*")} == {1}
    assert engines.probe(spark, good)[1] == [] and engines.probe(spark, broken) == (0, ["RuntimeError: no engine here"])
    pages = spark.createDataFrame([(1, png.encode(page()))], "page int, png binary")
    own = S.Settings(preprocessing_enable_denoise=False, preprocessing_enable_contrast=False)
    assert run.classify_document(pages, "roll", broken, str(tmp_path / "out"), own).count() == 0


def test_engine_sees_prepared_crops(spark):
    """Classification hands the engine the same grey copies without noise that recognition does."""
    rng = np.random.default_rng(1)
    crop = np.clip(200 + rng.normal(0, 3, (100, 240)), 0, 255).astype(np.uint8)
    h, w = crop.shape
    left, top, right, low = W.SERIAL_BOX
    box = crop[int(h * top) : int(h * low), int(w * left) : int(w * right)]
    expected = png.encode(I.for_reading(box))

    def engine():
        return lambda data: [[[None, ("Q 12" if data == expected else "", 0.9)]]]

    rows = spark.createDataFrame([(1, 1, "a", png.encode(crop))], "page int, entry_index int, name string, png binary")
    assert not np.array_equal(I.for_reading(box), box) and classify.classified(rows, engine, 0).first()["serial"]["level"] == "strong"


def test_document_run_and_stream(spark, tmp_path):
    def engine():
        return lambda data: None

    def client():
        return lambda data, model, prompt: json.dumps(CARD)

    pages = spark.createDataFrame([(1, png.encode(page())), (2, b"bad")], "page int, png binary")
    own = S.Settings(preprocessing_enable_denoise=False, preprocessing_enable_contrast=False)
    image = png.encode(np.zeros((4, 6), np.uint8))
    found = run.run_document(pages, "roll", engine, client, "m", str(tmp_path), own=own, covers=(image, image), tries=1, rounds=1)
    again = run.classify_document(pages.where("page = 2"), "roll", engine, str(tmp_path / "other"), own)
    assert again.count() == 0 and run.classify_document(pages.where("page = 1"), "roll", engine, str(tmp_path / "other"), own).count() == 24
    assert found.count() == 24 and len(json.loads((tmp_path / "roll.json").read_text())) == 24
    assert "xl/media/image2.png" in sheets.read_package(str(tmp_path / "roll.xlsx"))
    other = run.sheet_of_json(spark, str(tmp_path / "roll.json"), str(tmp_path / "b.xlsx"))
    assert "Elector Name" in sheets.read_package(other)["xl/worksheets/sheet1.xml"].decode()
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"page_001_entry_{i:03d}.png").write_bytes(image)
    (folder / "other.png").write_bytes(image)
    for _ in range(2):
        q = stream.grow_table(stream.crop_stream(spark, str(folder), 2), lambda d: d.drop("png"), str(tmp_path / "table"), str(tmp_path / "check"), once=True)
        assert q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3
