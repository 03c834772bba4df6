"""Sheets with one page image each, added to a spreadsheet package (a driver-side utility: a workbook is one file)."""

from __future__ import annotations

import os
import re
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree as ET

from ..functions import png

# Namespaces and types of the package format, English Metric Units in a pixel, the preview's grid.
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DRAW = "http://schemas.openxmlformats.org/drawingml/2006"
_SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"
_DRAWING_TYPE = "application/vnd.openxmlformats-officedocument.drawing+xml"
EMU = 9525
COLUMNS, ROWS = 20, 120
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def read_package(path: str) -> dict[str, bytes]:
    """All parts of a package by name."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no such workbook: {path}")
    with zipfile.ZipFile(path) as z:
        return {i.filename: z.read(i) for i in z.infolist()}


def safe_name(name: str, fallback: str = "Sheet") -> str:
    """At most 31 characters, none of them forbidden in a sheet's name."""
    return re.sub(r"[\[\]:*?/\\]", "-", (name or "").strip() or fallback)[:31] or fallback


def unused_name(name: str, used: Iterable[str]) -> str:
    """name, or its first 28 characters with the first free number; letters' case does not count."""
    taken = {u.lower() for u in used}
    number, out = 2, name
    while out.lower() in taken:
        out = f"{name[:28] or 'Sheet'}_{number}"[:31]
        number += 1
    return out


def next_number(names: Iterable[str], pattern: str) -> int:
    """One more than the greatest number that the pattern's group finds; 1 if none does."""
    return max((int(m[1]) for n in names if (m := re.fullmatch(pattern, n))), default=0) + 1


def _sheet_xml() -> str:
    columns = "".join(f'<col min="{i}" max="{i}" width="14" customWidth="1"/>' for i in range(1, COLUMNS + 1))
    rows = "".join(f'<row r="{i}" ht="20" customHeight="1"/>' for i in range(1, ROWS + 1))
    view = '<sheetViews><sheetView workbookViewId="0" showGridLines="0"/></sheetViews><sheetFormatPr defaultRowHeight="20"/>'
    return f'{_HEAD}<worksheet xmlns="{_MAIN}" xmlns:r="{_DOC}">{view}<cols>{columns}</cols><sheetData>{rows}</sheetData><drawing r:id="rId1"/></worksheet>'


def _drawing_xml(width: int, height: int) -> str:
    extent = f'cx="{width * EMU}" cy="{height * EMU}"'
    place = "<xdr:from><xdr:col>0</xdr:col><xdr:colOff>0</xdr:colOff><xdr:row>0</xdr:row><xdr:rowOff>0</xdr:rowOff></xdr:from>"
    shape = f'<xdr:spPr><a:xfrm><a:off x="0" y="0"/><a:ext {extent}/></a:xfrm><a:prstGeom prst="rect"><a:avLst/></a:prstGeom></xdr:spPr>'
    picture = f'<xdr:pic><xdr:nvPicPr><xdr:cNvPr id="1" name="Page"/><xdr:cNvPicPr/></xdr:nvPicPr><xdr:blipFill><a:blip r:embed="rId1"/><a:stretch><a:fillRect/></a:stretch></xdr:blipFill>{shape}</xdr:pic>'
    return f'{_HEAD}<xdr:wsDr xmlns:xdr="{_DRAW}/spreadsheetDrawing" xmlns:a="{_DRAW}/main" xmlns:r="{_DOC}"><xdr:oneCellAnchor>{place}<xdr:ext {extent}/>{picture}<xdr:clientData/></xdr:oneCellAnchor></xdr:wsDr>'


def _relations_xml(kind: str, target: str) -> str:
    return f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_DOC}/{kind}" Target="{target}"/></Relationships>'


def _put_type(types: ET.Element, kind: str, key: str, value: str, content: str) -> None:
    """Adds a Default or an Override unless there is one."""
    tag = f"{{{_PACKAGE}/content-types}}{kind}"
    if all(e.get(key) != value for e in types.findall(tag)):
        ET.SubElement(types, tag, {key: value, "ContentType": content})


def _retitle(parts: dict[str, bytes], titles: list[str]) -> None:
    """The titles of docProps/app.xml, where it lists titles at all."""
    if "docProps/app.xml" not in parts:
        return
    root = ET.fromstring(parts["docProps/app.xml"])
    own, types = root.tag.rpartition("}")[0] + "}", "{http://schemas.openxmlformats.org/officeDocument/2006/docPropsVTypes}"
    counts, names = root.find(f"{own}HeadingPairs//{types}i4"), root.find(f"{own}TitlesOfParts/{types}vector")
    if counts is None or names is None:
        return
    counts.text = str(len(titles))
    for child in list(names):
        names.remove(child)
    for title in titles:
        ET.SubElement(names, f"{types}lpstr").text = title
    names.set("size", str(len(titles)))
    parts["docProps/app.xml"] = ET.tostring(root, encoding="utf-8", xml_declaration=True)


def add_image_sheets(path: str, first: tuple[str, bytes], last: tuple[str, bytes], out: str | None = None) -> list[str]:
    """Writes a workbook with two more sheets, each (name, PNG): first, the sheet that led, last, then the rest.

    Returns the sheets' names in their new order. Without ``out`` the workbook is replaced.
    """
    parts = read_package(path)
    book, links, types = (ET.fromstring(parts[n]) for n in ("xl/workbook.xml", "xl/_rels/workbook.xml.rels", "[Content_Types].xml"))
    sheets = book.find(f"{{{_MAIN}}}sheets")
    if sheets is None or not len(sheets):
        raise ValueError("the workbook has no sheets")
    _put_type(types, "Default", "Extension", "png", "image/png")
    added = []
    for name, image in (first, last):
        name = unused_name(name, [s.get("name", "") for s in sheets])
        n, d, m = (next_number(parts, p) for p in (r"xl/worksheets/sheet(\d+)\.xml", r"xl/drawings/drawing(\d+)\.xml", r"xl/media/image(\d+)\.png"))
        link = f"rId{next_number([e.get('Id', '') for e in links], r'rId(\d+)')}"
        ET.SubElement(links, f"{{{_PACKAGE}/relationships}}Relationship", {"Id": link, "Type": f"{_DOC}/worksheet", "Target": f"worksheets/sheet{n}.xml"})
        number = next_number([s.get("sheetId", "") for s in sheets], r"(\d+)")
        added.append(ET.SubElement(sheets, f"{{{_MAIN}}}sheet", {"name": name, "sheetId": str(number), f"{{{_DOC}}}id": link}))
        _put_type(types, "Override", "PartName", f"/xl/worksheets/sheet{n}.xml", _SHEET_TYPE)
        _put_type(types, "Override", "PartName", f"/xl/drawings/drawing{d}.xml", _DRAWING_TYPE)
        texts = {
            f"xl/worksheets/sheet{n}.xml": _sheet_xml(),
            f"xl/worksheets/_rels/sheet{n}.xml.rels": _relations_xml("drawing", f"../drawings/drawing{d}.xml"),
            f"xl/drawings/drawing{d}.xml": _drawing_xml(*png.size(image)),
            f"xl/drawings/_rels/drawing{d}.xml.rels": _relations_xml("image", f"../media/image{m}.png"),
        }
        parts |= {k: v.encode() for k, v in texts.items()} | {f"xl/media/image{m}.png": image}
    old = [s for s in sheets if s not in added]
    order = [added[0], old[0], added[1], *old[1:]]
    for s in list(sheets):
        sheets.remove(s)
    sheets.extend(order)
    titles = [s.get("name", "") for s in order]
    _retitle(parts, titles)
    for uri, prefix in ((_MAIN, ""), (_DOC, "r")):
        ET.register_namespace(prefix, uri)
    for name, root in (("xl/workbook.xml", book), ("xl/_rels/workbook.xml.rels", links), ("[Content_Types].xml", types)):
        parts[name] = ET.tostring(root, encoding="utf-8", xml_declaration=True)
    with zipfile.ZipFile(out or path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in parts.items():
            z.writestr(name, data)
    return titles
