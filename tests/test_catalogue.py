import os

import pytest

import __spark_entry__ as entry
from folioweave.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ["s3_normalize_name", "s4_page_prune", "g6_valid_rect", "g11_outliers", "x5_row_group", "x10_repair", "d23_decision", "l8_quality", "l11_better", "v9_report", "d2_region", "d21_band", "d17_d18_turned_back", "d20_best_angle", "o2_o3_lines", "l12_normalize", "l13_data_address", "g2_g4_line_masks", "g5_cell_boxes", "g5_contour_tree", "d7_otsu", "d13_plausible", "i3_i6_raster_steps", "k1_growing_list", "k7_k9_workbook", "s1_document_state", "s5_raster_forms", "l1_attempts", "l2_l10_fallback", "l5_backoff", "l5_delay", "g7_near_dup", "g8_iou_dedup", "g12_row_sort", "d14_group_boxes", "d19_d20_geometry", "d22_similarity", "i10_binary", "k4_headers", "k6_display", "p_order_union", "x1_x2_model_first", "x1_text_only", "x6_noisy_cards"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    assert got == sorted(map(repr, con.execute(f"SELECT {', '.join(cols)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()))


def test_entry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert catalogue.FLAGSHIP in entry.queries()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_geometry_against_a_loop(spark):
    from math import cos, radians, sin

    want = {}
    for row in catalogue._candidates(spark, DATA).collect():
        best = ("none", 0.0, None, None)
        for c in row["found"]:
            t, xs, ys = radians(c["angle"]), [], []
            for a, b in ((0, 0), (1, 0), (1, 1), (0, 1)):
                dx, dy = c["x"] + a * c["width"] - 300, c["y"] + b * c["height"] - 200
                xs.append(int(min(max(dx * cos(t) - dy * sin(t) + 300, 0), 599)))
                ys.append(int(min(max(dx * sin(t) + dy * cos(t) + 200, 0), 399)))
            crosses = min(max(xs) + 1, 390) > max(min(xs), 210) and min(max(ys) + 1, 260) > max(min(ys), 140)
            wide, high, n = c["width"] / 600, c["height"] / 400, c["letters"]
            score, level = (0.8, "strong") if wide >= 0.18 and high >= 0.03 and n >= 3 else (0.58, "medium") if wide >= 0.12 and high >= 0.025 and n >= 2 else (0.0, "none")
            if crosses and 105 <= c["mean"] <= 240 and score > best[1]:
                best = (level, score, c["angle"], c["width"])
        want[row["k"]] = best
    got = {r["k"]: tuple(r)[1:] for r in catalogue.QUERIES["d19_d20_geometry"](spark, DATA).select("k", "level", "score", "angle", "width").collect()}
    assert got == want and len({v[0] for v in want.values()}) == 3


def test_delay_values(spark):
    from pyspark.sql import functions as F

    from folioweave.operators.decide import retry_delay

    rows = spark.createDataFrame([("timeout", 1), ("timeout", 4), ("timeout", 9), ("Try again in 2.5s", 9), ("try again in 0.1s", 3)], "m string, n int")
    assert [r[0] for r in rows.coalesce(1).select(retry_delay(F.col("m"), F.col("n"))).collect()] == [1.0, 8.0, 30.0, 3.0, 1.0]
