"""Row conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemend.functions.times import day_last_second, day_start, ntz, shift_date_text
from tablemend.functions.windows import TimeWindow


def in_window(column: str, window: TimeWindow) -> Column:
    return window.holds(F.col(column))


def in_half_open(column: str, window: TimeWindow) -> Column:
    return window.holds_half_open(F.col(column))


def from_instant(column: str, instant: str) -> Column:
    return F.col(column) >= ntz(instant)


def either_in_window(columns: list[str], window: TimeWindow) -> Column:
    """At least one of the columns lies in the window."""
    return reduce(lambda a, b: a | b, [in_window(c, window) for c in columns])


def date_text_in(column: str, start: str, end: str, shift: int = 0) -> Column:
    """`yyyyMMdd` text between two days, both moved by `shift` days."""
    lo, hi = (shift_date_text(F.lit(d), shift) for d in (start, end))
    return F.col(column).between(lo, hi)


def compact_text_in(column: str, window: TimeWindow) -> Column:
    """`yyyyMMddHHmmss` text in a window."""
    lo, hi = (F.lit("".join(ch for ch in bound if ch.isdigit())) for bound in (window.lo, window.hi))
    return F.col(column).between(lo, hi)


def flagged_and_due(flag: str, due: str, start: str, end: str, shift: int = 1, yes: str = "Y") -> Column:
    """Flag set and the due day (`yyyyMMdd` text) in the moved range."""
    return (F.col(flag) == yes) & date_text_in(due, start, end, shift)


def loaded_on(column: str, as_of: str) -> Column:
    """Load time within the day of `as_of`, up to its last second."""
    day = ntz(as_of)
    return F.col(column).between(day_start(day), day_last_second(day))


def keys_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def name_selected(column: str, contains: str, not_ending: list[str]) -> Column:
    """Name contains a text and ends with none of the suffixes."""
    return reduce(lambda a, suffix: a & ~F.col(column).endswith(suffix), not_ending, F.col(column).contains(contains))


def matches_parameter(column: str, value: str | None) -> Column:
    """Equal, or missing on both sides; empty text counts as missing."""
    return F.nullif(F.col(column), F.lit("")).eqNullSafe(F.lit(value or None))


def is_error(column: str = "st", code: str = "ER") -> Column:
    return F.col(column) == code


def change_kind(created: str, changed: str) -> Column:
    """`I` where created and changed agree, `U` where they differ, else null."""
    return F.when(F.col(created) == F.col(changed), "I").when(F.col(created) != F.col(changed), "U")
