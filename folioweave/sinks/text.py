"""Failure and timeout logs, and ordered JSON lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def failure_line(name: Column, deleted: Column, page: Column, entry: Column, error_type: Column, reason: Column) -> Column:
    flag = F.when(deleted, "True").otherwise("False")
    part = lambda label, value: F.concat(F.lit(f"{label}="), value.cast("string"))
    return F.concat_ws("\t", name, part("deleted", flag), part("page", page), part("entry", entry), part("error_type", error_type), part("reason", reason))


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One text file per partition; an earlier run's files are replaced."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    """JSON lines that keep nulls, written where the rows are."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_list(df: DataFrame, path: str, order: list[str], drop: tuple[str, ...] = ()) -> int:
    """A single file with a JSON list in order, as the document exporter reads it.

    Rows stream through the driver one partition at a time; use write_json_rows for a corpus.
    """
    import json

    ordered = df.orderBy(*order).drop(*drop)
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write("[")
        for row in ordered.select(F.to_json(F.struct(*ordered.columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            text = json.dumps(json.loads(row["j"]), ensure_ascii=False, indent=2).replace("\n", "\n  ")
            out.write((",\n  " if n else "\n  ") + text)
            n += 1
        out.write("\n]" if n else "]")
    return n
