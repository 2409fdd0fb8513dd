"""Time windows and calendar conditions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemend.functions.times import ntz


@dataclass(frozen=True)
class TimeWindow:
    """Bounds as wall-clock text; a missing `hi` leaves the window open."""

    lo: str
    hi: str | None = None

    @property
    def start(self) -> Column:
        return ntz(self.lo)

    @property
    def end(self) -> Column:
        if self.hi is None:
            raise ValueError("the window has no end")
        return ntz(self.hi)

    def holds(self, c: Column) -> Column:
        """Both ends included."""
        return c >= self.start if self.hi is None else c.between(self.start, self.end)

    def holds_half_open(self, c: Column) -> Column:
        """Start included, end excluded."""
        return (c >= self.start) & (c < self.end)

    def from_end(self, c: Column) -> Column:
        """At or after the end."""
        return c >= self.end


def make_window(
    start: str, end: str, lo_shift: int = 0, hi_shift: int = 0, day_start: str = "00:00:00"
) -> TimeWindow:
    """Window over `yyyyMMdd` days.

    It runs from `day_start` of the first day to one second before `day_start`
    following the last day; each end can move by whole days.
    """
    clock = dt.timedelta(**dict(zip(("hours", "minutes", "seconds"), map(int, day_start.split(":")))))
    first = dt.datetime.strptime(start, "%Y%m%d") + dt.timedelta(days=lo_shift) + clock
    last = dt.datetime.strptime(end, "%Y%m%d") + dt.timedelta(days=hi_shift + 1, seconds=-1) + clock
    return TimeWindow(first.isoformat(" "), last.isoformat(" "))


def with_offset_windows(df, code: str, start: str, end: str):
    """Recompute windows from codes such as `F015` or `D028`.

    `F`: the start moves back by the number, the end stays, the offset is 0.
    `D` and `M`: both ends move back and the number is the offset.
    Adds `window_start`, `window_end` (dates) and `day_offset`; a code of
    another form is an error.
    """
    kind = F.substring(code, 1, 1)
    days = F.substring(code, 2, 3).cast("int")
    checked = F.when(kind.isin("F", "D", "M"), days).otherwise(
        F.raise_error(F.concat(F.lit("unknown window code "), F.coalesce(F.col(code), F.lit("null")))).cast("int")
    )
    moved = F.when(kind == "F", F.lit(0)).otherwise(F.col("__days"))
    return (
        df.withColumn("__days", checked)
        .withColumn("window_start", F.date_sub(F.col(start).cast("date"), F.col("__days")))
        .withColumn("window_end", F.date_sub(F.col(end).cast("date"), moved))
        .withColumn("day_offset", moved)
        .drop("__days")
    )


def calendar_flag(day: Column) -> Column:
    """Which monthly work a day selects; null on ordinary days.

    The last day is tested after the first, so the labels never overlap.
    """
    number = F.dayofmonth(day)
    return (
        F.when(number == 1, "first")
        .when(F.last_day(day) == day.cast("date"), "last")
        .when(number == 2, "second")
        .when(number == 3, "third")
        .when(number == 14, "fourteenth")
    )
