"""Text normalisers as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Python's \b and \s as Java patterns.
EDGE_L, EDGE_R, SPACE = r"(?<![\p{L}\p{M}\p{N}_])", r"(?![\p{L}\p{M}\p{N}_])", r"(?U)\s+"
#: Runs of white space that are not one space already.
_UNEVEN = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}|[\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, body) -> Column:
    """body(value), with the value evaluated once however often the body reads it.

    The greatest of one item is the item; taking it by its index would derive the nested type anew for every row.
    """
    return F.array_max(F.transform(F.array(value), body))


def filled(text: Column) -> Column:
    """The text; null if it is empty."""
    return let(text, lambda t: F.when(t != "", t))


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, _UNEVEN, " "))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, "०१२३४५६७८९", "0123456789")


def clean(text: Column) -> Column:
    return F.replace(collapse(text), F.lit("|"), F.lit("I"))


def normal(text: Column, keep_digits: bool = True) -> Column:
    """For matching: collapsed, ASCII digits, upper case; 0 becomes O unless digits are kept."""
    out = F.upper(ascii_digits(collapse(text)))
    return out if keep_digits else F.replace(out, F.lit("0"), F.lit("O"))


def stamp(text: Column) -> Column:
    """Upper case, and only A-Z and 0-9 of it."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def group(text: Column, pattern: str, number: int = 1) -> Column:
    """A group of the first match; null where nothing matches or it is empty."""
    return filled(F.regexp_extract(text, pattern, number))


def first_of(items: Column, what) -> Column:
    """The first text that ``what`` gives over an array and that is not null; later items are not looked at."""
    return F.aggregate(items, F.lit(None).cast("string"), lambda found, item: F.coalesce(found, what(item)))


def spread(df: DataFrame, mb_each: int = 16) -> DataFrame:
    """df's rows over all cores if its input is too small for that many splits; larger inputs stay as they are.

    For work that is heavy for each row; the size is Spark's own statistic, so no job runs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * mb_each << 20 else df


def preview(text: Column, size: int = 300) -> Column:
    out = collapse(text)
    return F.when(F.char_length(out) > size, F.concat(F.substring(out, 1, size), F.lit("..."))).otherwise(out)


def directory_name(stem: Column) -> Column:
    """A document's stem as a directory name."""
    safe = F.regexp_replace(stem, "[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(safe, r"^[._]+|[._]+$", ""), F.lit("")), F.lit("document"))
