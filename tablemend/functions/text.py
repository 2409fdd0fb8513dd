"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TO_END = 2**31 - 1


def cut(c: Column, start: int, stop: int | None = None) -> Column:
    """Characters from `start` up to, not including, `stop`, counted from zero."""
    return F.substring(c, start + 1, _TO_END if stop is None else stop - start)


def left_trim(c: Column) -> Column:
    return F.ltrim(c)


def first_upper(c: Column) -> Column:
    """First character in upper case; null for empty text."""
    return F.upper(F.nullif(F.substring(c, 1, 1), F.lit("")))


def strip_leading(c: Column, prefix: str) -> Column:
    """Text without the prefix where it has one."""
    return F.when(F.startswith(c, F.lit(prefix)), cut(c, len(prefix))).otherwise(c)


def last_chars(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def join_text(*parts: Column) -> Column:
    """Concatenation; null when a part is null."""
    return F.concat(*parts)


def comma_list(c: Column) -> Column:
    """Array of names as one comma-joined text."""
    return F.array_join(c, ",")


def blank_to_null(c: Column) -> Column:
    """Trimmed text; blank and the printed missing time become null."""
    trimmed = F.trim(c)
    return F.when(trimmed.isin("", "NaT"), None).otherwise(c)
