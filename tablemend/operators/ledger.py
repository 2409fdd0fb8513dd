"""Comparison of two copies of a table by key and change time.

Source keys, target keys and pending events are laid on top of each other and
grouped by key once. Each input is scanned once as a slim projection, copies of
a key are merged before the shuffle, and every comparison is a filter on the
grouped rows, so all of them together cost one exchange.

Keys identify a row on either side. Should a key repeat, its latest change time
in the window stands for it. Keys with a null part match nothing: every such
row stays a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.predicates import keys_present
from tablemend.functions.times import whole_second
from tablemend.functions.windows import TimeWindow
from tablemend.operators.keys import rows_not_in

SOURCE_TIME = "src_chg_dtm"
TARGET_TIME = "tgt_chg_dtm"
_SIDE = "__null_side"
_COUNTS = ("src_rows", "tgt_rows")


def latest_time(df: DataFrame, ts: str) -> Column:
    """Scalar subquery for the latest change time of a whole table."""
    return df.agg(F.max(ts)).scalar()


def max_time(df: DataFrame, ts: str) -> DataFrame:
    """One row with the latest change time."""
    return df.agg(F.max(ts).alias("max_chg_dtm"))


def _facts(df: DataFrame, keys: list[str], side: str, **facts: Column) -> DataFrame:
    # The number tells rows of one side apart; it decides nothing else.
    number = F.concat(F.lit(side), F.monotonically_increasing_id().cast("string"))
    null_side = F.when(keys_present(keys), F.lit("")).otherwise(number)
    return df.select(*keys, null_side.alias(_SIDE), *[c.alias(name) for name, c in facts.items()])


def key_ledger(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    ts: str,
    window: TimeWindow,
    events: DataFrame | None = None,
    op: str = "op",
    whole_target: bool = False,
) -> DataFrame:
    """One row per key with what is known of it on each side.

    Source times are kept to the second, as the source states them. With an
    open window there is no "after the window". `whole_target` also notes
    target keys outside the window.
    """
    changed, one, yes = F.col(ts), F.lit(1), F.lit(True)
    inside = window.holds(changed)
    source_facts = {SOURCE_TIME: whole_second(changed), "src_rows": one}
    if window.hi is not None:
        source_facts = {name: F.when(inside, c) for name, c in source_facts.items()}
        source_facts["src_after"] = F.when(window.from_end(changed), yes)
    target_facts = {TARGET_TIME: changed, "tgt_rows": one}
    if whole_target:
        target_facts = {name: F.when(inside, c) for name, c in target_facts.items()}
        target_facts["tgt_known"] = yes
    parts = [
        _facts(source.where(changed >= window.start), keys, "source", **source_facts),
        _facts(target if whole_target else target.where(inside), keys, "target", **target_facts),
    ]
    if events is not None:
        is_delete, is_insert = F.col(op) == "D", F.col(op) == "I"
        event_facts = {"deleted": is_delete}
        if ts in events.columns:
            newest = latest_time(target, ts)
            event_facts["delete_after"] = is_delete & (changed > newest)
            event_facts["delete_from"] = is_delete & (changed >= newest)
            event_facts["insert_from"] = is_insert & (changed >= newest)
        parts.append(_facts(events.where(F.col(op).isin("D", "I")), keys, "event", **event_facts))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    facts = [c for c in stacked.columns if c not in {*keys, _SIDE}]
    merged = [(F.sum if c in _COUNTS else F.max)(c).alias(c) for c in facts]
    return stacked.groupBy(*keys, _SIDE).agg(*merged)


def _unset(ledger: DataFrame, flag: str) -> Column:
    """The flag is false, null or was never noted."""
    return ~F.coalesce(F.col(flag), F.lit(False)) if flag in ledger.columns else F.lit(True)


def _is_changed(ledger: DataFrame, newest: Column, deleted: str) -> Column:
    """Times differ by a second or more, not newer than the target, not deleted."""
    return (
        (F.col(SOURCE_TIME) != whole_second(F.col(TARGET_TIME)))
        & (F.col(SOURCE_TIME) <= newest)
        & _unset(ledger, deleted)
    )


def _is_source_only(newest: Column) -> Column:
    return F.col(SOURCE_TIME).isNotNull() & F.col(TARGET_TIME).isNull() & (F.col(SOURCE_TIME) < newest)


def _is_target_only(ledger: DataFrame) -> Column:
    return F.col(TARGET_TIME).isNotNull() & F.col(SOURCE_TIME).isNull() & _unset(ledger, "src_after")


def diff_changed(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, window: TimeWindow, deletes: DataFrame | None = None
) -> DataFrame:
    """Keys on both sides of the window whose change seconds differ."""
    ledger = key_ledger(source, target, keys, ts, window, deletes)
    return ledger.where(_is_changed(ledger, latest_time(target, ts), "deleted")).select(*keys, SOURCE_TIME, TARGET_TIME)


def source_only(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, window: TimeWindow, null_aware: bool = False
) -> DataFrame:
    """Source keys of the window that the target window lacks.

    `null_aware` follows SQL `NOT IN` instead: a null key part may equal anything.
    """
    newest = latest_time(target, ts)
    if null_aware:
        found = rows_not_in(_staged(source, keys, ts, window), target.where(window.holds(F.col(ts))), keys)
        return found.where(F.col(SOURCE_TIME) < newest)
    ledger = key_ledger(source, target, keys, ts, window)
    return ledger.where(_is_source_only(newest)).select(*keys, SOURCE_TIME)


def target_only(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, window: TimeWindow, null_aware: bool = False
) -> DataFrame:
    """Target keys of the window found neither in nor after the source window.

    `null_aware` follows SQL `NOT IN` instead: a null key part may equal anything.
    """
    if null_aware:
        known = source.where(F.col(ts) >= window.start)
        return rows_not_in(target.where(window.holds(F.col(ts))), known, keys).select(
            *keys, F.col(ts).alias(TARGET_TIME)
        )
    ledger = key_ledger(source, target, keys, ts, window)
    return ledger.where(_is_target_only(ledger)).select(*keys, TARGET_TIME)


def _staged(source: DataFrame, keys: list[str], ts: str, window: TimeWindow) -> DataFrame:
    return source.where(window.holds(F.col(ts))).select(*keys, whole_second(F.col(ts)).alias(SOURCE_TIME))


def diff_changed_pending(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, start: str, events: DataFrame, op: str = "op"
) -> DataFrame:
    """Changed keys since `start`, without those a newer pending delete explains."""
    ledger = key_ledger(source, target, keys, ts, TimeWindow(start), events, op)
    return ledger.where(_is_changed(ledger, latest_time(target, ts), "delete_after")).select(*keys, SOURCE_TIME, TARGET_TIME)


def source_only_pending(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, start: str, events: DataFrame, op: str = "op"
) -> DataFrame:
    """Source keys since `start` that the whole target lacks.

    Bounded by the newest time in the queue and without keys whose insert waits there.
    """
    ledger = key_ledger(source, target, keys, ts, TimeWindow(start), events, op, whole_target=True)
    missing = F.col(SOURCE_TIME).isNotNull() & _unset(ledger, "tgt_known") & (F.col(SOURCE_TIME) < latest_time(events, ts))
    return ledger.where(missing & _unset(ledger, "insert_from")).select(*keys, SOURCE_TIME)


def target_only_pending(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, start: str, events: DataFrame, op: str = "op"
) -> DataFrame:
    """Target keys since `start` that the source lacks, without those whose delete waits in the queue."""
    ledger = key_ledger(source, target, keys, ts, TimeWindow(start), events, op)
    return ledger.where(_is_target_only(ledger) & _unset(ledger, "delete_from")).select(*keys, TARGET_TIME)


def all_differences(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    ts: str,
    window: TimeWindow,
    deletes: DataFrame | None = None,
    newest: Column | None = None,
) -> DataFrame:
    """Changed, source-only and target-only keys in one pass, told apart by `kind`.

    `newest` is the latest time of the whole target, where only a part of it is compared.
    """
    ledger = key_ledger(source, target, keys, ts, window, deletes)
    newest = latest_time(target, ts) if newest is None else newest
    kind = (
        F.when(_is_changed(ledger, newest, "deleted"), "changed")
        .when(_is_source_only(newest), "source_only")
        .when(_is_target_only(ledger), "target_only")
    )
    return (
        ledger.withColumn("kind", kind).where(F.col("kind").isNotNull()).select("kind", *keys, SOURCE_TIME, TARGET_TIME)
    )


def difference_counts(
    source: DataFrame, target: DataFrame, keys: list[str], ts: str, window: TimeWindow, deletes: DataFrame | None = None
) -> DataFrame:
    """One row: window totals, the three difference counts and the latest source time."""
    ledger = key_ledger(source, target, keys, ts, window, deletes)
    newest = latest_time(target, ts)

    def rows(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    return ledger.agg(
        rows("src_rows").alias("source_total_count"),
        rows("tgt_rows").alias("target_total_count"),
        F.count_if(_is_changed(ledger, newest, "deleted")).alias("chg_dtm_diff_count"),
        F.count_if(_is_source_only(newest)).alias("source_only_count"),
        F.count_if(_is_target_only(ledger)).alias("target_only_count"),
        F.max(SOURCE_TIME).alias("temp_max_chg_dtm"),
    )
