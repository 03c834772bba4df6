"""A JSON list in one file that grows by commits: tasks write parts, the driver appends them in order.

The list is never rewritten. Beside it stands a small note of how many bytes and records are committed and
of the last batch; it is replaced at once when an append is complete. What a failed append left behind that
mark is cut off by the next one, so a run that fails adds nothing, and a batch that comes again is passed over.
Parts of task attempts that were not committed are never read. The list lies on a disk of the driver and the
parts in a folder that the executors share with it.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def _note(path: str) -> dict:
    """Bytes of the list without its closing bracket, its records and the last batch."""
    if os.path.exists(path) and os.path.exists(f"{path}.committed"):
        with open(f"{path}.committed", encoding="utf-8") as f:
            return json.load(f)
    return {"bytes": 1, "records": 0, "batch": None}


def _noted(path: str, **note) -> None:
    with open(f"{path}.committed.new", "w", encoding="utf-8") as f:
        json.dump(note, f)
    os.replace(f"{path}.committed.new", f"{path}.committed")


def append_parts(path: str, parts: list[str], records: int, batch: int | None = None) -> None:
    """Appends files of indented records, each led by a comma and a line break, to the list at path.

    A file that this module did not write (there is no note beside it) raises ValueError.
    """
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    if not os.path.exists(path):
        _noted(path, bytes=1, records=0, batch=None)
    elif not os.path.exists(f"{path}.committed"):
        raise ValueError(f"a file that is no growing list is there: {path}")
    note = _note(path)
    with open(path, "r+b" if os.path.exists(path) else "w+b") as out:
        if note["bytes"] == 1:
            out.write(b"[")
        out.seek(note["bytes"])
        out.truncate()
        first = not note["records"]
        for part in parts:
            with open(part, "rb") as f:
                f.seek(1 if first else 0)  # the first record of all has no comma before it
                first = first and not os.path.getsize(part)
                shutil.copyfileobj(f, out)
        end = out.tell()
        out.write(b"\n]" if note["records"] + records else b"]")
        out.flush()
        os.fsync(out.fileno())
    _noted(path, bytes=end, records=note["records"] + records, batch=note["batch"] if batch is None else batch)


@dataclass
class _Part(WriterCommitMessage):
    number: int
    path: str
    records: int


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.batch, self.overwrite = options["path"], options.get("batch"), overwrite
        self.staging = f"{options.get('staging') or self.path + '.parts'}/{uuid.uuid4().hex}"

    def write(self, iterator):
        from pyspark import TaskContext

        number, records = TaskContext.get().partitionId(), 0
        os.makedirs(self.staging, exist_ok=True)
        part = f"{self.staging}/{number:08d}-{uuid.uuid4().hex}"
        with open(part, "w", encoding="utf-8") as out:
            for row in iterator:
                out.write(",\n  " + json.dumps(json.loads(row[0]), ensure_ascii=False, indent=2).replace("\n", "\n  "))
                records += 1
        return _Part(number, part, records)

    def commit(self, messages):
        done = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        if self.overwrite:
            for old in (self.path, f"{self.path}.committed"):
                if os.path.exists(old):
                    os.remove(old)
        append_parts(self.path, [m.path for m in done], sum(m.records for m in done), None if self.batch is None else int(self.batch))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages):
        shutil.rmtree(self.staging, ignore_errors=True)


class JsonListSink(DataSource):
    """Options: path, staging (a shared folder; beside the list if not given), batch (a number)."""

    @classmethod
    def name(cls):
        return "json_list"

    def writer(self, schema, overwrite):
        return _Writer({k.lower(): v for k, v in self.options.items()}, overwrite)


def append_json_list(df: DataFrame, path: str, order: list[str], drop: tuple[str, ...] = (), batch: int | None = None, staging: str | None = None, mode: str = "append") -> int:
    """Adds df's rows in order to the JSON list at path, nulls kept; returns how many records it has now.

    With ``batch`` a number that the list has already, or a smaller one, adds nothing.
    """
    last = _note(path)["batch"]
    if mode == "append" and batch is not None and last is not None and batch <= last:
        return _note(path)["records"]
    df.sparkSession.dataSource.register(JsonListSink)
    ordered = df.orderBy(*order).drop(*drop)
    lines = ordered.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in ordered.columns)), {"ignoreNullFields": "false"}).alias("json"))
    options = {"path": path} | ({} if batch is None else {"batch": batch}) | ({"staging": staging} if staging else {})
    lines.write.format("json_list").mode(mode).options(**options).save()
    return _note(path)["records"]
