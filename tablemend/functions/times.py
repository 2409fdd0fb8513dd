"""Wall-clock time functions.

All times are TIMESTAMP_NTZ. Arithmetic goes through NTZ subtraction, whose
result does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ORIGIN = "0001-01-01"


def ntz(value: str) -> Column:
    """Literal wall-clock time; folds to a constant, so filters on it push down."""
    return F.lit(str(value)).cast("timestamp_ntz")


def compact_text(c: Column) -> Column:
    """Time as `yyyyMMddHHmmss`."""
    return F.translate(F.substring(c.cast("string"), 1, 19), "-: ", "")


def parse_compact(c: Column) -> Column:
    """`yyyyMMddHHmmss` text as a time; bad text becomes null."""
    spaced = F.regexp_replace(c, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    return F.when(F.length(c) == 14, spaced.try_cast("timestamp_ntz"))


def iso_text(c: Column) -> Column:
    """ISO text with the fraction, six digits long, only where there is one."""
    return F.replace(plain_text(c), F.lit(" "), F.lit("T"))


def plain_text(c: Column) -> Column:
    """As `iso_text`, with a space before the clock time."""
    text = c.cast("string")
    fraction = F.substring(text, 21, 6)
    whole = F.substring(text, 1, 19)
    return F.when(fraction == "", whole).otherwise(F.concat(whole, F.lit("."), F.rpad(fraction, 6, "0")))


def date_text(c: Column) -> Column:
    """Day as `yyyyMMdd`."""
    return F.translate(c.cast("date").cast("string"), "-", "")


def parse_date(c: Column) -> Column:
    """`yyyyMMdd` text as a date; bad text becomes null."""
    dashed = F.regexp_replace(c, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3")
    return F.when(F.length(c) == 8, dashed.try_cast("date"))


def shift_date_text(c: Column, days: int) -> Column:
    """`yyyyMMdd` text moved by whole days."""
    return date_text(F.date_add(parse_date(c), days))


def _second_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def whole_second(c: Column) -> Column:
    """Time cut to its second."""
    return day_start(c) + _second_of_day(c) * F.expr("INTERVAL '1' SECOND")


def second_index(c: Column) -> Column:
    """Number of second boundaries before the time, as a long."""
    days = F.date_diff(c.cast("date"), F.lit(_ORIGIN).cast("date"))
    return days.cast("long") * 86400 + _second_of_day(c)


def _part(unit: str, c: Column) -> Column:
    return F.extract(F.lit(unit), c)


def wall_as_instant(c: Column) -> Column:
    """Wall-clock time as the instant that shows it in UTC; watermarks need instants."""
    second = _part("SECOND", c)
    return F.timestamp_seconds(second_index(c) - second_index(ntz("1970-01-01 00:00:00")) + second - F.floor(second))


def instant_as_wall(c: Column) -> Column:
    """Inverse of `wall_as_instant` for whole seconds."""
    return ntz("1970-01-01 00:00:00") + F.make_dt_interval(secs=F.unix_seconds(c).cast("decimal(18,6)"))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end (0.9 s to 1.1 s crosses one)."""
    return second_index(end) - second_index(start)


def run_seconds(start: Column, end: Column) -> Column:
    """Elapsed seconds with two decimals."""
    span = end - start
    exact = (
        _part("DAY", span).cast("decimal(12,6)") * 86400
        + _part("HOUR", span) * 3600
        + _part("MINUTE", span) * 60
        + _part("SECOND", span)
    )
    return F.round(exact, 2).cast("decimal(18,2)")


def day_start(c: Column) -> Column:
    """Midnight of the day."""
    return c.cast("date").cast("timestamp_ntz")


def day_last_second(c: Column) -> Column:
    """23:59:59 of the day."""
    return day_start(c) + F.expr("INTERVAL '0 23:59:59' DAY TO SECOND")


def year_month(c: Column) -> Column:
    """First six characters of a `yyyyMMdd` text."""
    return F.substring(c, 1, 6)


def day_of_text(c: Column) -> Column:
    """Day part of a `yyyyMMdd` text."""
    return F.substring(c, 7, 2)
