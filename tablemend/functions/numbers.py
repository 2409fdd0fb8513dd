"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def nan_as_null(c: Column) -> Column:
    return F.when(F.isnan(c), None).otherwise(c)


def exact_sum(field: T.StructField) -> Column:
    """Column sum as DECIMAL(38,6), rounded once after the sum, so it does not depend on the order of the rows.

    NaN counts as missing. Decimals are summed in their own scale; with more
    than 32 digits before the point, the result keeps fewer behind it.
    Floating-point values are summed as whole numbers, millionths and millionths
    of those apart, all integers and far cheaper than a decimal per value; below
    1e-12 a value is rounded. From 1e15 on, a double has hardly a fraction left,
    and goes in as a decimal.
    """
    c = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType):
        left = field.dataType.precision - field.dataType.scale
        return F.sum(c).cast(f"decimal(38,{min(6, 38 - left)})")
    if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.sum(c.cast("decimal(20,0)")).cast("decimal(38,6)")
    value = nan_as_null(c).cast("double")
    fine = F.abs(value) < 1e15
    whole = F.when(fine, F.floor(value).cast("decimal(20,0)")).otherwise(value.cast("decimal(38,6)"))
    scaled = (value - F.floor(value)) * 1e6
    coarse = F.when(fine, F.floor(scaled)).otherwise(F.when(value.isNotNull(), 0))
    rest = F.when(fine, F.floor((scaled - F.floor(scaled)) * 1e6 + 0.5)).otherwise(F.when(value.isNotNull(), 0))
    million = F.lit(1000000).cast("decimal(7,0)")
    units = F.sum(coarse).cast("decimal(20,0)") + F.sum(rest).cast("decimal(20,0)") / million
    return (F.sum(whole) + (units / million).cast("decimal(38,12)")).cast("decimal(38,6)")


def round_sum(c: Column, digits: int = 3) -> Column:
    """Null as zero, rounded half up on decimals."""
    return F.round(F.coalesce(c, F.lit(0).cast("decimal(1,0)")), digits).cast(f"decimal(38,{digits})")


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    """`part / whole * 100`, zero when `whole` is not positive."""
    ratio = part.cast("decimal(20,0)") * 100 / F.when(whole > 0, whole.cast("decimal(20,0)"))
    return F.coalesce(ratio, F.lit(0).cast("decimal(1,0)")).cast(f"decimal(28,{digits})")
