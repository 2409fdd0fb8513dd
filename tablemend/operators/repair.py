"""From logged differences to repair events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.operators.pairs import rows_for_keys


def diff_log(differences: DataFrame, batch_id: str, verify_date: str) -> DataFrame:
    """Differences with the batch they belong to."""
    return differences.select(
        F.lit(batch_id).alias("batch_id"), *differences.columns, F.lit(verify_date).alias("verifi_date")
    )


def repair_events(source: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Full source rows as queued updates.

    The log position fields are `0`, since the rows come from the table and not
    from a change log, and the keys are repeated under a `pk_` prefix.
    """
    zero = F.lit("0")
    return rows_for_keys(source, wanted, keys).select(
        F.lit("U").alias("op"),
        zero.alias("transact_id"),
        zero.alias("file_name"),
        zero.alias("file_offset"),
        *[F.col(k).alias(f"pk_{k}") for k in keys],
        *source.columns,
    )
