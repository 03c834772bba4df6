"""What a PDF file is before anything reads its pages: plain, open (encrypted, but without a password to
ask for), locked, damaged, or no PDF at all.

The file's end names its cross references, a table or a compressed stream; their trailer says whether the
file is encrypted and where its catalogue lies. ``/Encrypt`` in a page's text is thus no encryption. Where the
references do not hold, the file is damaged; all trailers that can be found then say whether it is locked.
The empty password is tried for revisions 2 to 5; files of revision 6 (AES-256 of PDF 2.0) count as locked.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import re
import struct
import zlib
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

PLAIN, OPEN, LOCKED, DAMAGED, OTHER = "plain", "open", "locked", "damaged", "no pdf"
#: Fixed value: the padding of passwords that the format prescribes.
PADDING = bytes.fromhex("28BF4E5E4E758A4164004E56FFFA01082E2E00B6D0683E802F0CA9FE6453697A")
#: Bytes at a file's end in which its last reference is looked for, and at its start for the header.
TAIL, HEAD = 2048, 1024
_DEPTH = 64
_SPACE = re.compile(rb"(?:[\x00\t\n\f\r ]|%[^\r\n]*)*")
_REF = re.compile(rb"(\d{1,10})[\x00\t\n\f\r ]+(\d{1,5})[\x00\t\n\f\r ]+R(?![A-Za-z0-9])")
_NUMBER = re.compile(rb"[+-]?(?:\d+\.?\d*|\.\d+)")
_NAME = re.compile(rb"/([^\x00\t\n\f\r ()<>\[\]{}/%]*)")
_WORD = re.compile(rb"true|false|null")
_OBJECT = re.compile(rb"[\x00\t\n\f\r ]*(\d{1,10})[\x00\t\n\f\r ]+(\d{1,5})[\x00\t\n\f\r ]+obj")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Ref(NamedTuple):
    number: int
    generation: int


class Damaged(ValueError):
    pass


def _literal(data, at: int) -> tuple[bytes, int]:
    """A string in parentheses from just behind the first; inner ones nest."""
    out, open_ = bytearray(), 1
    while at < len(data):
        c = data[at : at + 1]
        at += 1
        if c == b"\\":
            octal = re.compile(rb"[0-7]{1,3}").match(data, at)
            if octal:
                out.append(int(octal[0], 8) & 255)
                at = octal.end()
            else:
                c = data[at : at + 1]
                at += 2 if data[at : at + 2] == b"\r\n" else 1
                out += b"" if c in b"\r\n" else _ESCAPES.get(c, c)
            continue
        open_ += (c == b"(") - (c == b")")
        if not open_:
            return bytes(out), at
        out += c
    raise Damaged("a string has no end")


def parsed(data, at: int, depth: int = 0):
    """The object at a place, and the place behind it: dict, list, bytes, str (a name), number, Ref, bool or None."""
    if depth > _DEPTH:
        raise Damaged("objects nest too deep")
    at = _SPACE.match(data, at).end()
    if data[at : at + 2] == b"<<":
        out, at = {}, _SPACE.match(data, at + 2).end()
        while data[at : at + 2] != b">>":
            key = _NAME.match(data, at)
            if not key:
                raise Damaged("a dictionary's key is no name")
            out[key[1].decode("latin-1")], at = parsed(data, key.end(), depth + 1)
            at = _SPACE.match(data, at).end()
        return out, at + 2
    first = data[at : at + 1]
    if first == b"[":
        items, at = [], _SPACE.match(data, at + 1).end()
        while data[at : at + 1] != b"]":
            item, at = parsed(data, at, depth + 1)
            items.append(item)
            at = _SPACE.match(data, at).end()
        return items, at + 1
    if first == b"(":
        return _literal(data, at + 1)
    if first == b"<":
        end = data.find(b">", at)
        digits = re.sub(rb"\s", b"", data[at + 1 : end])
        if end < 0 or not re.fullmatch(rb"[0-9A-Fa-f]*", digits):
            raise Damaged("a string of digits is broken")
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()), end + 1
    if m := _NAME.match(data, at):
        return m[1].decode("latin-1"), m.end()
    if m := _REF.match(data, at):
        return Ref(int(m[1]), int(m[2])), m.end()
    if m := _NUMBER.match(data, at):
        return float(m[0]) if b"." in m[0] else int(m[0]), m.end()
    if m := _WORD.match(data, at):
        return {b"true": True, b"false": False, b"null": None}[m[0]], m.end()
    raise Damaged("no object where one is named")


def _stream(data, own: dict, at: int) -> bytes:
    """The bytes of a cross-reference stream whose dictionary ends at a place."""
    m = re.compile(rb"\s*stream(?:\r\n|\n|\r)").match(data, at)
    if not m:
        raise Damaged("a stream is missing")
    length = own.get("Length")
    end = m.end() + length if isinstance(length, int) else data.find(b"endstream", m.end())
    if end < m.end() or end > len(data):
        raise Damaged("a stream has no end")
    raw = bytes(data[m.end() : end])
    kind = own.get("Filter")
    if kind in ("FlateDecode", ["FlateDecode"]):
        try:
            raw = zlib.decompressobj().decompress(raw)
        except zlib.error as e:
            raise Damaged(f"a stream does not unpack: {e}") from e
    elif kind not in (None, []):
        raise Damaged(f"a stream of cross references is packed by {kind}")
    how = own.get("DecodeParms") or {}
    how = how[0] if isinstance(how, list) else how
    if how.get("Predictor", 1) < 10:
        return raw
    width, out, before = how.get("Columns", 1), bytearray(), bytes(how.get("Columns", 1))
    for k in range(0, len(raw) - width, width + 1):
        line, kind = bytearray(raw[k + 1 : k + 1 + width]), raw[k]
        for i in range(width):
            left, up, corner = (line[i - 1] if i else 0), before[i], (before[i - 1] if i else 0)
            near = min((left, up, corner), key=lambda v: abs(left + up - corner - v))
            line[i] = line[i] + (0, left, up, (left + up) // 2, near)[kind if kind < 5 else 0] & 255
        out += line
        before = line
    return bytes(out)


def _section(data, at: int):
    """The trailer of the cross references at a place, and a function from an object's number to its place (or None)."""
    table = re.compile(rb"[\x00\t\n\f\r ]*xref[\x00\t\n\f\r ]+").match(data, at)
    if table:
        at, runs = table.end(), []
        while m := re.compile(rb"(\d+) (\d+)[ \r\n]+").match(data, at):
            first, n = int(m[1]), int(m[2])
            runs.append((first, n, m.end()))
            at = _SPACE.match(data, m.end() + 20 * n).end()
        if data[at : at + 7] != b"trailer":
            raise Damaged("a table of cross references has no trailer")
        trailer, _ = parsed(data, at + 7)

        def place(number):
            for first, n, start in runs:
                if first <= number < first + n:
                    own = start + 20 * (number - first)  # lines of a table are 20 bytes long
                    line = data[own : own + 18]
                    return int(line[:10]) if line[17:18] == b"n" and line[:10].isdigit() else None

    else:
        m = _OBJECT.match(data, at)
        if not m:
            raise Damaged("no cross references where the file's end names them")
        trailer, end = parsed(data, m.end())
        if not isinstance(trailer, dict) or trailer.get("Type") != "XRef":
            raise Damaged("no cross references where the file's end names them")
        rows, widths = _stream(data, trailer, end), trailer.get("W") or []
        if len(widths) != 3 or not all(isinstance(w, int) and 0 <= w <= 8 for w in widths) or not sum(widths):
            raise Damaged("widths of cross references are broken")
        index = trailer.get("Index") or [0, trailer.get("Size", 0)]

        def place(number):
            before = 0
            for first, n in zip(index[::2], index[1::2]):
                if first <= number < first + n:
                    row = rows[(before + number - first) * sum(widths) :][: sum(widths)]
                    kind = int.from_bytes(row[: widths[0]]) if widths[0] else 1
                    return int.from_bytes(row[widths[0] : widths[0] + widths[1]]) if kind == 1 and len(row) == sum(widths) else None
                before += n

    if not isinstance(trailer, dict):
        raise Damaged("a trailer is no dictionary")
    return trailer, place


def _rc4(key: bytes, text: bytes) -> bytes:
    s, j = list(range(256)), 0
    for i in range(256):
        j = (j + s[i] + key[i % len(key)]) & 255
        s[i], s[j] = s[j], s[i]
    out, i, j = bytearray(), 0, 0
    for c in text:
        i = (i + 1) & 255
        j = (j + s[i]) & 255
        s[i], s[j] = s[j], s[i]
        out.append(c ^ s[(s[i] + s[j]) & 255])
    return bytes(out)


def user_entry(how: dict, ident: bytes) -> bytes | None:
    """What an encryption dictionary's U begins with if the user's password is empty; None where that is not known."""
    r, o, u, p = (how.get(k) for k in "ROUP")
    if how.get("Filter") != "Standard" or not isinstance(o, bytes) or not isinstance(u, bytes) or not isinstance(p, int):
        return None
    if r == 5:
        return hashlib.sha256(u[32:40]).digest()
    if r not in (2, 3, 4):
        return None
    n = 5 if r == 2 else 16 if how.get("V") == 4 else min(16, max(5, (how.get("Length") or 40) // 8))
    clear = b"\xff" * 4 if r == 4 and how.get("EncryptMetadata") is False else b""
    key = hashlib.md5(PADDING + o[:32] + struct.pack("<I", p & 0xFFFFFFFF) + ident + clear).digest()
    for _ in range(50 if r > 2 else 0):
        key = hashlib.md5(key[:n]).digest()
    if r == 2:
        return _rc4(key[:n], PADDING)
    out = hashlib.md5(PADDING + ident).digest()
    for i in range(20):
        out = _rc4(bytes(b ^ i for b in key[:n]), out)
    return out


def _encryption(data, trailers: list, find) -> str:
    """PLAIN, OPEN or LOCKED, by the trailers of a file."""
    named = [t for t in trailers if t.get("Encrypt") is not None]
    if not named:
        return PLAIN
    how, ident = named[0]["Encrypt"], next((t["ID"] for t in trailers if t.get("ID")), [b""])
    if isinstance(how, Ref):
        at = find(how.number)
        m = _OBJECT.match(data, at) if at is not None else None
        try:
            how = parsed(data, m.end())[0] if m and int(m[1]) == how.number else None
        except Damaged:
            how = None
    first = ident[0] if isinstance(ident, list) and ident and isinstance(ident[0], bytes) else b""
    entry = user_entry(how, first) if isinstance(how, dict) else None
    return OPEN if entry and how["U"].startswith(entry) else LOCKED


def state_of(data) -> str:
    """The state of a file's bytes (or of its mapping into memory)."""
    if data[:HEAD].find(b"%PDF-") < 0:
        return OTHER
    try:
        end = data.rfind(b"startxref", max(0, len(data) - TAIL))
        m = re.compile(rb"startxref\s+(\d{1,12})").match(data, end) if end >= 0 else None
        if not m:
            raise Damaged("the file's end names no cross references")
        at, seen, sections = int(m[1]), set(), []
        while isinstance(at, int) and at not in seen and at < len(data):
            seen.add(at)
            sections.append(_section(data, at))
            at = sections[-1][0].get("Prev")

        def find(number):
            return next((p for p in (place(number) for _, place in sections) if p is not None), None)

        if not sections or not isinstance(sections[0][0].get("Root"), Ref):
            raise Damaged("no catalogue is named")
        root = sections[0][0]["Root"].number
        at = find(root)
        packed = at is None and any(t.get("Type") == "XRef" for t, _ in sections)  # the catalogue lies in a stream of objects
        m = _OBJECT.match(data, at) if at is not None and at < len(data) else None
        if not packed and not (m and int(m[1]) == root):
            raise Damaged("the catalogue is not where the file says")
        return _encryption(data, [t for t, _ in sections], find)
    except (Damaged, TypeError, OverflowError, AttributeError, IndexError):
        return LOCKED if _encryption(data, _all_trailers(data), lambda n: _last_place(data, n)) == LOCKED else DAMAGED


def _all_trailers(data) -> list[dict]:
    """The trailers of a damaged file that can still be read, the last first."""
    found = []
    for m in re.compile(rb"(?:^|[\r\n])trailer(?=[\s<])|(?:^|[\r\n])\d+ \d+ obj(?=[\s<]{0,4}<<[^>]{0,400}/XRef)").finditer(data):
        try:
            own, _ = parsed(data, m.end())
            found += [own] if isinstance(own, dict) else []
        except Damaged:
            pass
    return found[::-1]


def _last_place(data, number: int) -> int | None:
    return max((m.end(1) for m in re.compile(rb"(^|[\r\n])%d \d+ obj" % number).finditer(data)), default=None)


def file_state(path: str) -> str:
    """The state of a file, which is mapped and not read as a whole."""
    if not os.path.getsize(path):
        return OTHER
    with open(path, "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as data:
        return state_of(data)


def with_state(docs: DataFrame, content: str = "content") -> DataFrame:
    """docs with a column state for their bytes; null bytes have none. Documents with such a column lose theirs."""
    names = [c for c in docs.columns if c != "state"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [None if v is None else state_of(v) for v in (x.as_py() for x in batch.column(batch.schema.get_field_index(content)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "state"])

    kept = docs.select(*names)
    return kept.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", state string")


def scan_documents(spark: SparkSession, folder: str) -> DataFrame:
    """path, length and state of every file ending in .pdf below a folder, which any file system of Spark may hold."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", "true").load(folder)
    return with_state(found.select("path", "length", "content")).drop("content")
