"""Export from warehouse tables back to operational ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from tablemend.operators.convert import numbers_to_decimal
from tablemend.operators.upsert import upsert
from tablemend.sinks.files import truncate_insert


def export_rows(
    source: DataFrame, columns: list[str], condition: Column, precision: int = 38, scale: int = 6
) -> DataFrame:
    """Selected rows and columns with floating-point numbers as decimals."""
    return numbers_to_decimal(source.where(condition).select(*columns), precision, scale)


def reverse_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], condition: Column
) -> DataFrame:
    """Operational table after merging the exported rows.

    The result is written as a whole, so a failed export leaves the table as it was.
    """
    return upsert(target, export_rows(source, columns, condition), keys, columns)


def stage_reverse(
    source: DataFrame, columns: list[str], condition: Column, staging: str | Mapping[str, str]
) -> None:
    """Empty the staging table and load the exported rows."""
    truncate_insert(export_rows(source, columns, condition), staging)
