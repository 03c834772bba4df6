"""Documents as tables of page images: a data source with one input partition per page.

The rasterizer is injected as ``module:function``; it takes (path, page from 1, dpi) and returns
PNG bytes, and ``module:function`` of option ``counter`` takes a path and returns the page count.
"""

from __future__ import annotations

import os
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import pdf_state

DPI = 600


def check_document(path: str, strict: bool = False) -> None:
    """Raises FileNotFoundError for no file, ValueError for no PDF, PermissionError for one that asks for a password.

    A damaged file passes, since a rasterizer may mend it; under ``strict`` it is a ValueError.
    """
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no such document: {path}")
    state = pdf_state.file_state(path)
    if state == pdf_state.OTHER:
        raise ValueError(f"not a PDF document: {path}")
    if state == pdf_state.LOCKED:
        raise PermissionError(f"encrypted document: {path}")
    if strict and state == pdf_state.DAMAGED:
        raise ValueError(f"damaged document: {path}")


def _named(name: str):
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


class _Page(InputPartition):
    def __init__(self, source_page: int, page: int):
        super().__init__((source_page, page))
        self.source_page, self.page = source_page, page


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.rasterize, self.count = options["path"], options["rasterizer"], options["counter"]
        self.first, self.drop_last, self.dpi = int(options.get("firstpage", 1)), int(options.get("droplast", 0)), int(options.get("dpi", DPI))

    def partitions(self):
        check_document(self.path)
        last = _named(self.count)(self.path) - self.drop_last
        if last < self.first:
            raise ValueError(f"no pages left of {self.path}")
        return [_Page(n, n - self.first + 1) for n in range(self.first, last + 1)]

    def read(self, partition):
        yield partition.page, partition.source_page, f"page_{partition.page:04d}.png", _named(self.rasterize)(self.path, partition.source_page, self.dpi)


class PagesSource(DataSource):
    """Options: path, rasterizer, counter; firstPage (1), dropLast (0), dpi (600)."""

    @classmethod
    def name(cls):
        return "document_pages"

    def schema(self):
        return "page int, source_page int, name string, png binary"

    def reader(self, schema):
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_pages(spark: SparkSession, path: str, rasterizer: str, counter: str, cover: bool = True, dpi: int = DPI) -> DataFrame:
    """page, source_page, name, png of a document; without ``cover``, pages 1 and 2 and the last are left out and the rest counted from 1."""
    spark.dataSource.register(PagesSource)
    chosen = {} if cover else {"firstPage": 3, "dropLast": 1}
    return spark.read.format("document_pages").options(path=path, rasterizer=rasterizer, counter=counter, dpi=dpi, **chosen).load()


def inner_pages(pages: DataFrame, count: Column) -> DataFrame:
    """Of pages with source_page and their document's ``count``: those between the covers, with page counted from 1.

    Documents of three pages or fewer have none.
    """
    kept = pages.where((count > 3) & F.col("source_page").between(3, count - 1))
    return kept.withColumn("page", F.col("source_page") - 2)


def document_images(folder_glob: str, spark: SparkSession) -> DataFrame:
    """page, name, png of page images already on disk (page_0001.png, ...)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(folder_glob)
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(F.regexp_extract(name, r"page_(\d+)\.png$", 1).try_cast("int").alias("page"), name.alias("name"), F.col("content").alias("png"))
