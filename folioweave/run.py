"""A document from its pages to classified crops, records, logs and a workbook."""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators import classify, engines, extraction, models, preprocess, recognition, records
from .settings import Settings, settings
from .sinks import files, image_sheets, spreadsheet, text
from .sources.json_records import read_records

log = logging.getLogger("folioweave")
CLASSES = "classified_crops"


def in_order(rows: DataFrame) -> DataFrame:
    """By page, place on the page and, of equal ones, the file's name in lower case."""
    return rows.orderBy("page", "entry_index", F.lower("name"))


def classify_document(pages: DataFrame, document: str, engine: Callable, out: str, own: Settings | None = None) -> DataFrame:
    """Writes a document's crops by class below ``out`` and returns them as read back.

    Earlier crops of this document are replaced, those of others stay. Boxes come from the clean
    page and crops from the raw one, so deskew (which would move them) is left out. A page or a
    crop that fails leaves its error in status and error, and the others go on; timed-out crops
    are also logged by name. An engine that no worker can start is logged, and the document has no crops.
    """
    own, engine = own or settings(), engines.per_worker(engine)
    options = own.preprocessing()
    options = preprocess.Options(tuple(s for s in options.steps if s != "deskew"), options.kernel, options.clip, options.tiles, options.block, options.c, options.margin)
    clean = preprocess.clean_pages(pages, options)
    cut = classify.crops(classify.grids(clean), least_width=own.crop_min_width, least_height=own.crop_min_height)
    started, failures = engines.probe(pages.sparkSession, engine)
    for failure in failures:
        log.error("the recognition engine did not start", extra={"document": document, "error": failure, "workers_with_engine": started})
    if not started:
        cut = cut.where("false")
    done = classify.classified(cut.repartition(max(8, pages.sparkSession.sparkContext.defaultParallelism)), engine, own.entry_timeout_seconds)
    where = f"{out}/{CLASSES}/document={document}"
    done.write.mode("overwrite").parquet(where)
    got = pages.sparkSession.read.parquet(where)
    files.archive_crops(got, document, f"{out}/crops_by_class")
    text.write_lines(in_order(got.where("status = 'timed_out'")).coalesce(1), "name", f"{out}/timed_out_entries/{document}")
    return got


def extract_document(crops: DataFrame, client: Callable, model: str, out: str, document: str, fallback: str | None = None, own: Settings | None = None, engine: Callable | None = None, done: Callable | None = None, **how) -> DataFrame:
    """Records of the classified crops as Parquet, failures as lines of text. Returns the records.

    The backend of the settings decides who reads a crop. An ``engine`` gives lines to parse where
    no model answers; without one there are none. ``done`` is called on the driver with each record,
    in order, as they are read back.
    """
    own = own or settings()
    how = {"tries": own.model_max_retries, "rounds": own.model_quality_retries} | how
    good = crops.where("status = 'ok'").select("page", "entry_index", "name", "png", "deleted")
    backend = extraction.chosen_backend(own.extraction_backend, client, model)
    read = None
    if engine and backend != "llm":
        make = engines.per_worker(engine)
        read = lambda c: recognition.recognized(c, make, own.ocr_language).withColumn("lines", records.placed(F.coalesce("ocr", F.array()))).drop("ocr", "ocr_error")
    else:
        good = good.withColumn("lines", F.expr("cast(array() as array<struct<text:string,confidence:double,x:double,y:double,height:double>>)"))
        backend = "llm" if backend == "auto" else backend
    how = {"key": ("page", "entry_index")} | how
    asked = extraction.extracted(good, backend, client, model, fallback, read=read, **how).drop("lines")
    where = f"{out}/extracted/{document}"
    asked.drop("png").write.mode("overwrite").parquet(where)  # calls are not made again for each reader
    got = crops.sparkSession.read.parquet(where)
    bad = in_order(got.where("error is not null"))
    kind, told = F.substring_index("error", ":", 1), F.col("error")
    text.write_lines(bad.coalesce(1).select(text.failure_line(F.col("name"), F.col("deleted"), F.col("page"), F.col("entry_index"), kind, told).alias("line")), "line", f"{out}/failed_cases/{document}")
    found = in_order(got.where("error is null"))
    for row in found.drop("png").toLocalIterator() if done else ():
        done(row)
    return found


def run_document(pages: DataFrame, document: str, engine: Callable, client: Callable, model: str, out: str, fallback: str | None = None, own: Settings | None = None, covers: tuple[bytes, bytes] | None = None, **how) -> DataFrame:
    """The whole way: crops, records, <document>.json and <document>.xlsx, with the cover images if given."""
    crops = classify_document(pages, document, engine, out, own)
    log.info("classified", extra={"document": document, "crops": crops.count()})
    found = extract_document(crops, client, model, out, document, fallback, own, engine, **how)
    shown = found.select("page", "entry_index", *models.FIELDS, "deleted", "raw_text")
    n = text.write_json_list(shown, f"{out}/{document}.json", ["page", "entry_index"], ("page", "entry_index"))
    book = f"{out}/{document}.xlsx"
    spreadsheet.write_sheet(shown, book, ["page", "entry_index"])
    if covers:
        image_sheets.add_image_sheets(book, ("First Page", covers[0]), ("Last Page", covers[1]))
    log.info("extracted", extra={"document": document, "records": n})
    return found


def sheet_of_json(spark: SparkSession, source: str, target: str | None = None) -> str:
    """A JSON list (or one object) of records as a workbook beside it, or at ``target``."""
    import json

    rows = read_records(spark, source)
    names = [r["header"] for r in spreadsheet.headers(rows, "row", "json").orderBy("first_row", "place_").collect()]
    target = target or os.path.splitext(source)[0] + ".xlsx"
    found = (json.loads(r["json"]) for r in rows.orderBy("row").toLocalIterator())
    spreadsheet.write_package(target, names, ([spreadsheet.plain(n, r.get(n)) for n in names] for r in found))
    return target


def main(arguments: list[str] | None = None) -> None:
    from importlib import import_module

    from . import logs
    from .sources.pages import read_pages

    named = lambda text_: getattr(import_module(text_.partition(":")[0]), text_.partition(":")[2])
    p = argparse.ArgumentParser(prog="python -m folioweave", description="Scanned documents to records, or records to a workbook.")
    commands = p.add_subparsers(dest="command", required=True)
    one = commands.add_parser("run", help="a document to records")
    one.add_argument("document")
    for name in ("rasterizer", "counter", "engine"):
        one.add_argument(f"--{name}", required=True, help="module:function")
    one.add_argument("--out", default="outputs")
    two = commands.add_parser("sheet", help="a JSON list to a workbook")
    two.add_argument("source")
    two.add_argument("target", nargs="?")
    a, own = p.parse_args(arguments), settings()
    logs.set_up(own.log_level, own.log_dir if own.log_to_file else None, max_bytes=own.log_max_bytes, backups=own.log_backup_count)
    spark = SparkSession.builder.appName("folioweave").getOrCreate()
    if a.command == "sheet":
        print(sheet_of_json(spark, a.source, a.target))
        return
    name = os.path.splitext(os.path.basename(a.document))[0]
    client = models.chat_client(own.model_base_url, own.model_api_key, own.model_timeout_seconds, own.model_temperature, own.model_max_tokens)
    draw, last = named(a.rasterizer), named(a.counter)(a.document)
    covers = draw(a.document, 1, 144), draw(a.document, last, 144)
    run_document(read_pages(spark, a.document, a.rasterizer, a.counter, cover=False), name, named(a.engine), client, own.model_id, a.out, own.model_fallback_id or None, own, covers)
