"""Key matching shared by the comparison and upsert operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.functions.predicates import keys_present

# Bytes a row takes in memory beside its values.
_ROW_BYTES = 16


def spread(df: DataFrame, keys: list[str]) -> Column:
    """Zero for a complete key, a hash of the row for a key with a null part.

    Joined along with the keys, it changes no match, since keys with a null
    part match nothing; it only keeps those rows from meeting in one shuffle
    partition. The zero is a remainder by one: as a plain literal the optimizer
    would take it out of the join keys again. Kept there, it also makes each
    side shuffle for the join itself, the form in which adaptive execution can
    split a large partition.
    """
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    return F.when(keys_present(keys), zero).otherwise(F.xxhash64(*df.columns))


def rows_with_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `left` whose key occurs in `right`.

    Null parts match nothing and are left out before the join, which then
    costs one exchange a side, none for a side bucketed by the keys.
    """
    known = right.select(*keys).where(keys_present(keys))
    return left.where(keys_present(keys)).join(known, keys, "left_semi").select(*left.columns)


def rows_without_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `left` whose key does not occur in `right`; null keys match nothing.

    Rows of `left` without a complete key take no part in the join and are
    added again, so they never meet in one partition.
    """
    known = right.select(*keys).where(keys_present(keys))
    there = left.where(keys_present(keys)).join(known, keys, "left_anti").select(*left.columns)
    return there.unionByName(left.where(~keys_present(keys)))


def rows_not_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """SQL `(keys) NOT IN (SELECT keys FROM right)`, nulls included.

    A row is dropped when some key of `right` could equal it, a null part on
    either side standing for any value. Complete keys meet complete keys in one
    anti join. Only rows and keys that hold a null, where there are any, go
    through the joins by sets of null columns.
    """
    whole = keys_present(keys)
    holed = right.select(*keys).where(~whole)
    found = rows_without_key(left.where(whole), right, keys)
    if not holed.isEmpty():
        found = _not_in_by_nulls(found, holed, keys)
    partial = left.where(~whole)
    if partial.isEmpty():
        return found
    return found.unionByName(_not_in_by_nulls(partial, right, keys))


def _not_in_by_nulls(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """NOT IN with an equality join for every set of columns that hold a null on one of the sides.

    The join is on the columns that are left, so the condition never turns into
    a comparison of all pairs.
    """
    bits = {k: 1 << i for i, k in enumerate(keys)}

    def null_mask(prefix: str = "") -> Column:
        return reduce(
            lambda a, b: a + b,
            [F.when(F.col(prefix + k).isNull(), F.lit(bit)).otherwise(F.lit(0)) for k, bit in bits.items()],
        )

    rows = left.withColumn("__mask", null_mask())
    known = right.select(*keys).withColumn("__known_mask", null_mask()).distinct()
    for missing in range(1 << len(keys)):
        compared = [k for k, bit in bits.items() if not missing & bit]
        side = (
            known.where(F.col("__known_mask").bitwiseAND(F.lit(missing)) == F.col("__known_mask"))
            .select(*[F.col(k).alias(f"__known_{k}") for k in compared], "__known_mask")
            .distinct()
        )
        # Only masks that together make up `missing` belong to this step.
        pairs = side.withColumn(
            "__mask_needed",
            F.explode(F.array(*[F.lit(m) for m in range(1 << len(keys)) if m & ~missing == 0])),
        ).where(F.col("__known_mask").bitwiseOR(F.col("__mask_needed")) == missing)
        pairs = pairs.drop("__known_mask").distinct()
        if not compared:
            # At most one row per set of null columns, whatever the size of `right`.
            pairs = F.broadcast(pairs)
        on = F.col("__mask") == F.col("__mask_needed")
        for k in compared:
            on = on & (F.col(k) == F.col(f"__known_{k}"))
        rows = rows.join(pairs, on, "left_anti")
    return rows.drop("__mask")


def measured_bytes(df: DataFrame) -> int:
    """Size in memory of rows that are written already, from their number and the length of their values."""
    fixed, varying = _ROW_BYTES, []
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.sum(F.octet_length(F.col(field.name))))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            varying.append(F.sum(F.octet_length(F.to_json(F.struct(F.col(field.name))))))
        else:
            fixed += 16
    total = df.agg(F.count("*"), *[F.coalesce(c, F.lit(0)) for c in varying]).first()
    return total[0] * (fixed + 8 * len(varying)) + sum(total[1:])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether rows that are written already are small enough to be sent to every executor."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return limit > 0 and measured_bytes(df) <= limit


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's estimate of the size of files, where the session shows it."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_short(df: DataFrame, rows: int) -> DataFrame:
    """Mark for broadcast after counting, at most to the bound, that there are no more rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
