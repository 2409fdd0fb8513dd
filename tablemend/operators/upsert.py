"""Upserts and deletes by primary key.

Parquet has no MERGE, so the result is the new content of the target. Write it
to a new folder or to another table, never over the files being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.predicates import keys_present
from tablemend.operators.dedupe import latest_per_key
from tablemend.operators.keys import fits_broadcast, rows_with_key, rows_without_key, spread
from tablemend.session import materialize

_NEW = "__new_"
_THERE, _GONE = "__in_source", "__removed"


def _merge(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], removes: Column) -> DataFrame:
    """Target after writing the source rows, or removing their keys where `removes` holds.

    The change set is written once and measured: one small enough to broadcast
    leaves the target unshuffled, a larger one meets it in one full outer join.
    """
    listed = materialize(source.select(*columns, removes.alias(_GONE)), "changes")
    incoming = listed.select(*[F.col(c).alias(_NEW + c) for c in columns], F.lit(True).alias(_THERE), _GONE)
    on = [F.col(k) == F.col(_NEW + k) for k in keys]
    stays = ~F.coalesce(F.col(_GONE), F.lit(False))
    if not fits_broadcast(listed):
        incoming = incoming.withColumn("__new_spread", spread(incoming, [_NEW + k for k in keys]))
        on.append(F.col("__spread") == F.col("__new_spread"))
        marked = target.withColumn("__spread", spread(target, keys))
        merged = marked.join(incoming, on, "full_outer").where(stays)
        return merged.select(*_written(target, keys, columns))
    merged = target.join(F.broadcast(incoming), on, "left").where(stays).select(*_written(target, keys, columns))
    # Keys of the change set that the target holds: no more of them than changes.
    held = target.select(*keys).join(F.broadcast(listed.select(*keys)), keys, "left_semi").distinct()
    inserted = rows_without_key(listed, held, keys).where(~F.col(_GONE))
    types = {f.name: f.dataType for f in target.schema}
    return merged.unionByName(
        inserted.select(
            *[(F.col(c) if c in columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns]
        )
    )


def repeated_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Complete keys that occur more than once, with their number `n`."""
    return source.where(keys_present(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def _written(target: DataFrame, keys: list[str], columns: list[str]) -> list[Column]:
    """Target columns after the join: listed ones from the source where it has the key."""
    written = []
    for field in target.schema:
        name = field.name
        old = F.col(name)
        if name in columns:
            new = F.col(_NEW + name).cast(field.dataType)
            old = F.coalesce(old, new) if name in keys else F.when(F.col(_THERE), new).otherwise(old)
        written.append(old.alias(name))
    return written


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """Update the listed columns of matching rows and insert the others.

    Columns outside the list keep the target's values, and are null in inserted
    rows. Null keys never match: such target rows stay, such source rows are
    inserted. The source holds each key once, see `dedupe_upsert`: a key that it
    repeats would repeat the target's row. `strict` looks for such keys first
    and raises ValueError.
    """
    if strict and not repeated_keys(source, keys).isEmpty():
        raise ValueError("the source holds a key more than once")
    columns = list(dict.fromkeys([*keys, *(columns or [c for c in source.columns if c in target.columns])]))
    return _merge(target, source, keys, columns, F.lit(False))


def upsert_bucketed(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """The rows of `upsert` for a target bucketed by its keys, see `write_bucketed`.

    The join is on the keys alone, so that only the change set is shuffled, to the target's buckets, whatever its size.
    Rows without a complete key match nothing and are added on both sides.
    """
    columns = list(dict.fromkeys([*keys, *(columns or [c for c in source.columns if c in target.columns])]))
    named = [F.col(c).alias(_NEW + c) for c in columns]
    whole = source.where(keys_present(keys)).select(*named, F.lit(True).alias(_THERE))
    on = [F.col(k) == F.col(_NEW + k) for k in keys]
    merged = target.where(keys_present(keys)).join(whole.hint("merge"), on, "full_outer").select(*_written(target, keys, columns))
    types = {f.name: f.dataType for f in target.schema}
    loose = source.where(~keys_present(keys)).select(
        *[(F.col(c) if c in columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns]
    )
    return merged.unionByName(target.where(~keys_present(keys))).unionByName(loose)


def dedupe_upsert(
    target: DataFrame, staged: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Keep the latest staged row per key, then upsert."""
    return upsert(target, latest_per_key(staged, keys, order), keys, columns)


def sync_deletes(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the keys gone from the source; rows without a key stay."""
    return rows_with_key(target, source, keys).unionByName(target.where(~keys_present(keys)))


def apply_changes(
    target: DataFrame, events: DataFrame, keys: list[str], order: list[str], op: str = "op"
) -> DataFrame:
    """Apply insert, update and delete events; the last event of a key decides.

    Inserts and updates both write the event's columns; an event without a
    complete key addresses no row and is left out.
    """
    columns = [c for c in target.columns if c in events.columns]
    addressed = events.where(keys_present(keys) & F.col(op).isin("I", "U", "D"))
    return _merge(target, latest_per_key(addressed, keys, order), keys, columns, F.col(op) == "D")


_SET, _LAST, _RESET = "__set_", "__last", "__reset"


def fold_partial_events(
    events: DataFrame, keys: list[str], order: list[str], columns: list[str], op: str = "op", sets: str = "sets"
) -> DataFrame:
    """What a queue of events leaves of each key: its last operation, whether it was deleted, and for every column the
    last value set since the last delete.

    `sets` names the columns an event carries, which may be null on purpose. A delete counts as an event that clears
    every column, so each column's winner is a maximum, and maps merge a key's events before the shuffle however many
    there are. Events of equal order are ordered by operation and values; those without a complete key or a known
    operation address no row.
    """
    known = events.where(keys_present(keys) & F.col(op).isin("I", "U", "D"))
    place = F.struct(*order, op, *columns)
    gone = F.col(op) == "D"
    winners = [
        F.max_by(
            F.struct(gone.alias("cleared"), F.when(~gone, F.col(c)).alias("value")),
            F.when(gone | F.array_contains(sets, c), place),
        ).alias(_SET + c)
        for c in columns
    ]
    return known.groupBy(*keys).agg(F.max_by(op, place).alias(_LAST), F.bool_or(gone).alias(_RESET), *winners)


def apply_partial_events(
    target: DataFrame,
    events: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    op: str = "op",
    sets: str = "sets",
) -> DataFrame:
    """Target after events that carry some columns each, in order.

    A column keeps the target's value until an event sets it. After a delete a key begins anew: its columns are null
    but for those set since. A key whose last event is a delete goes; one the target lacks is inserted.
    """
    folded = materialize(fold_partial_events(events, keys, order, columns, op, sets), "folded")
    small = fits_broadcast(folded)
    marked = folded.withColumn(_THERE, F.lit(True))
    joined = target.join(F.broadcast(marked) if small else marked, keys, "left")
    stays = ~F.coalesce(F.col(_LAST) == "D", F.lit(False))
    reset = F.coalesce(F.col(_RESET), F.lit(False))

    def value(field, old: Column) -> Column:
        if field.name in keys:
            return F.col(field.name)
        kept = F.when(~reset, old)
        if field.name not in columns:
            return kept.alias(field.name)
        winner = F.col(_SET + field.name)
        new = F.when(~winner["cleared"], winner["value"].cast(field.dataType))
        return F.when(winner.isNotNull(), new).otherwise(kept).alias(field.name)

    updated = joined.where(stays).select(*[value(f, F.col(f.name)) for f in target.schema])
    held = target.select(*keys)
    if small:
        held = held.join(F.broadcast(folded.select(*keys)), keys, "left_semi").distinct()
    inserted = rows_without_key(folded, held, keys).where(F.col(_LAST) != "D")
    return updated.unionByName(inserted.select(*[value(f, F.lit(None).cast(f.dataType)) for f in target.schema]))
