"""Workbooks as tables: a data source with one input partition a sheet, whose rows are streamed.

A row is its sheet's name and place, its number and its cells, each with its column's letters, what it is
(text, number, bool, error) and its value as text. Empty cells are left out. A sheet is never held as a whole;
what workbooks share among sheets (their table of strings) is held by each task that reads one. Paths are
those of a disk that the driver and all executors share.
"""

from __future__ import annotations

import os
import posixpath
import re
import zipfile
from collections.abc import Iterator
from glob import glob
from string import ascii_uppercase
from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CELL = "struct<name:string,kind:string,value:string>"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _tag(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _text(e: ET.Element) -> str:
    """The text of a string that may come in runs; readings above it do not count."""
    return "".join((c.text or "") if _tag(c) == "t" else _text(c) for c in e if _tag(c) in ("t", "r", "is"))


def sheets_of(path: str) -> list[tuple[str, str]]:
    """(name, part) of the sheets of a workbook in its order; sheets of another kind than cells are left out."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no such workbook: {path}")
    try:
        with zipfile.ZipFile(path) as z:
            links = {e.get("Id"): (e.get("Target", ""), e.get("Type", "")) for e in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
            named = [(e.get("name", ""), links[e.get(_LINK)]) for e in ET.fromstring(z.read("xl/workbook.xml")).iter() if _tag(e) == "sheet"]
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        raise ValueError(f"not a workbook: {path}") from e
    return [(name, posixpath.normpath(posixpath.join("/xl", target)).lstrip("/")) for name, (target, kind) in named if kind.endswith("/worksheet")]


def column_number(letters: str) -> int:
    """A is 1, AA is 27."""
    out = 0
    for c in letters:
        out = out * 26 + ascii_uppercase.index(c) + 1
    return out


def _shared(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    with z.open("xl/sharedStrings.xml") as f:
        out = []
        for _, e in ET.iterparse(f):
            if _tag(e) == "si":
                out.append(_text(e))
                e.clear()
        return out


def _cell(e: ET.Element, strings: list[str]) -> tuple[str, str] | None:
    kind = e.get("t", "n")
    if kind == "inlineStr":
        return "text", "".join(_text(c) for c in e if _tag(c) == "is")
    value = next((c.text for c in e if _tag(c) == "v"), None)
    if value is None:
        return None
    if kind == "s":
        return "text", strings[int(value)]
    if kind == "b":
        return "bool", "true" if value.strip() == "1" else "false"
    return {"n": "number", "e": "error"}.get(kind, "text"), value


def rows_of(path: str, part: str) -> Iterator[tuple[int, list[tuple[str, str, str]]]]:
    """(number, cells) of each row of a sheet; rows and cells without a reference follow the one before."""
    from ..sinks.spreadsheet import column_name

    with zipfile.ZipFile(path) as z:
        strings = _shared(z)
        with z.open(part) as f:
            number, top = 0, None
            for event, e in ET.iterparse(f, ("start", "end")):
                if event == "start":
                    top = e if _tag(e) == "sheetData" else top
                elif _tag(e) == "row" and top is not None:
                    number = int(e.get("r") or number + 1)
                    cells, at = [], 0
                    for c in e:
                        m = re.match(r"[A-Z]+", c.get("r", ""))
                        at = column_number(m[0]) if m else at + 1
                        found = _cell(c, strings)
                        if found:
                            cells.append((column_name(at), *found))
                    yield number, cells
                    top.clear()


class _Sheet(InputPartition):
    def __init__(self, path: str, name: str, place: int, part: str):
        super().__init__((path, place))
        self.path, self.sheet, self.place, self.part = path, name, place, part


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.only, self.header = options["path"], options.get("sheet"), options.get("header", "false").lower() == "true"

    def partitions(self):
        paths = sorted(glob(self.path)) if re.search(r"[*?\[]", self.path) and not os.path.exists(self.path) else [self.path]
        if not paths:
            raise FileNotFoundError(f"no workbooks: {self.path}")
        found = [_Sheet(p, name, k, part) for p in paths for k, (name, part) in enumerate(sheets_of(p), 1) if self.only in (None, name)]
        if self.only is not None and not found:
            raise ValueError(f"no sheet {self.only} in {self.path}")
        return found  # without any, Spark reads one partition that is None

    def read(self, partition):
        labels = None
        for number, cells in rows_of(partition.path, partition.part) if partition else ():
            if self.header and labels is None:
                labels = {name: value for name, _, value in cells}
                continue
            yield partition.path, partition.sheet, partition.place, number, [((labels or {}).get(name, name), kind, value) for name, kind, value in cells]


class WorkbookSource(DataSource):
    """Options: path (a pattern may name many), sheet (its name; all without), header (false): cells go by the labels of the first row."""

    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        return f"path string, sheet string, place int, row int, cells array<{CELL}>"

    def reader(self, schema):
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None, header: bool = False) -> DataFrame:
    """path, sheet, place, row, cells of workbooks."""
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").options(path=path, header=str(header).lower(), **({"sheet": sheet} if sheet is not None else {})).load()


def value_of(name: str, kind: str = "string", cells: str = "cells") -> Column:
    """The value of the first cell of a row under a label (or column's letters), null if it is empty or not of that type."""
    first = F.get(F.filter(cells, lambda c: c["name"] == name), F.lit(0))
    return first["value"].try_cast(kind)
