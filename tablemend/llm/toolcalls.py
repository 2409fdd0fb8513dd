"""Chat formatting: tool calls are linked with their results, ordered, validated and written as canonical JSON.

Only DataFrame functions are used. Calls and results meet in a join on conversation and call id. A call may name calls
whose results it uses; it must come after them. Arguments are checked against the schema of the called tool, which is a
table of its fields, and every message becomes one JSON line with sorted keys. A conversation is never gathered: its
lines are rows with a place, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.session import materialize, scratch_path

# Kinds of arguments a schema may ask for, and how such a value is written in JSON.
KINDS = {
    "string": r'^".*"$',
    "integer": r"^-?(0|[1-9][0-9]*)$",
    "number": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false)$",
}


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (conv_id, call_id, turn, name, arguments, uses) with their results (conv_id, call_id, turn, content).

    Of several calls or results with one id the one with the earliest turn counts, ties falling to the others' columns;
    `repeats` tells how many more there were. Result columns are `result_turn` and `content`, `status` is `linked`,
    `no_result` or, for a result without a call, `no_call`. Rows without conversation or id are left out.
    """
    there = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    ids = ["conv_id", "call_id"]
    call = calls.where(there).groupBy(*ids).agg(
        F.min(F.struct("turn", "name", "arguments", "uses")).alias("call"), (F.count("*") - 1).alias("more_calls")
    )
    result = results.where(there).groupBy(*ids).agg(
        F.min(F.struct(F.col("turn").alias("result_turn"), "content")).alias("result"),
        (F.count("*") - 1).alias("more_results"),
    )
    joined = call.join(result.hint("shuffle_hash"), ids, "full_outer")
    status = (
        F.when(F.col("call").isNull(), "no_call").when(F.col("result").isNull(), "no_result").otherwise("linked")
    )
    return joined.select(
        *ids,
        "call.*",
        "result.*",
        status.alias("status"),
        (F.coalesce("more_calls", F.lit(0)) + F.coalesce("more_results", F.lit(0))).alias("repeats"),
    )


_IDS = ["conv_id", "call_id"]


def _hops(edges: DataFrame, calls: DataFrame) -> DataFrame:
    """Calls that use one other each, led on to the first call that uses none or several: conv_id, call_id, `ptr`, and
    `add` and `base`, by which the place is the greater of base and the place of ptr plus add. Those without such an end
    wait for a cycle and are left out.

    Every round doubles the steps taken, so there are as many as the longest chain's length has binary digits.
    """
    used_once = edges.groupBy(*_IDS).agg(F.count("*").alias("n"), F.min("used").alias("ptr")).where("n = 1").drop("n")
    hops = materialize(
        used_once.join(calls, _IDS).select(*_IDS, "ptr", F.lit(1).cast("long").alias("add"), F.col("place").alias("base")), "hops"
    )
    # More steps than there are calls go round a cycle.
    for _ in range(hops.count().bit_length() + 1):
        ahead = hops.select(
            "conv_id", F.col("call_id").alias("ptr"), F.col("ptr").alias("next"), F.col("add").alias("more"), F.col("base").alias("floor")
        )
        if hops.join(ahead, ["conv_id", "ptr"], "left_semi").isEmpty():
            break
        hops = materialize(
            hops.join(ahead, ["conv_id", "ptr"], "left").select(
                *_IDS,
                F.coalesce("next", "ptr").alias("ptr"),
                (F.col("add") + F.coalesce("more", F.lit(0))).alias("add"),
                F.greatest("base", F.coalesce(F.col("floor") + F.col("add"), "base")).alias("base"),
            ),
            "hops",
        )
    ends = hops.select("conv_id", F.col("call_id").alias("ptr"))
    return hops.join(ends, ["conv_id", "ptr"], "left_anti").select(*hops.columns)


def ordered(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Links with `place`, by which every call comes after the calls whose results it uses, and `order`.

    `order` is `as_given` where the turns are such an order already, `moved` where a call had to wait for what it uses,
    `missing` where it uses an id that has no call, and `cycle` for calls that wait for each other, or for such calls; these
    keep their turn. Chains of calls that use one other each are passed by doubled steps, however long they are. The
    others are placed once all calls they use are: in each round those whose last used call was placed in the round
    before, until a round places none, which takes as many rounds as there are calls with several uses on one path. What
    is left then waits for a cycle, in its own conversation only. `rounds` bounds nothing any more; callers may still
    name it.
    """
    turn = F.coalesce("turn", "result_turn", F.lit(0)).cast("long")
    given = materialize(links.withColumn("turn_", turn), "links")
    edges = given.select(*_IDS, F.explode("uses").alias("used")).where(F.col("used").isNotNull()).distinct()
    edges = materialize(edges, "uses")
    calls = given.where("status <> 'no_call'").select(*_IDS, F.col("turn_").alias("place"))
    named = calls.select("conv_id", F.col("call_id").alias("used"))
    unknown = edges.join(named, ["conv_id", "used"], "left_anti").select(*_IDS).distinct().withColumn("gap", F.lit(True))
    # Only uses of calls that there are can be waited for.
    edges = materialize(edges.join(named, ["conv_id", "used"], "left_semi"), "known")
    hops = materialize(_hops(edges, calls), "chains")
    several = edges.groupBy(*_IDS).agg(F.count("*").alias("open")).where("open > 1")
    led = hops.select("conv_id", F.col("call_id").alias("used"), "ptr", "add", "base")
    needs = edges.join(several.select(*_IDS), _IDS, "left_semi").join(led, ["conv_id", "used"], "left")
    needs = materialize(
        needs.select(
            *_IDS,
            F.coalesce("ptr", "used").alias("used"),
            (F.coalesce("add", F.lit(0)) + 1).alias("weight"),
            (F.col("base") + 1).alias("floor"),
        ),
        "needs",
    )
    floors = needs.groupBy(*_IDS).agg(F.max("floor").alias("floor"))
    fresh = materialize(calls.join(edges.select(*_IDS), _IDS, "left_anti"), "placed")
    waiting = materialize(
        calls.join(several, _IDS)
        .join(floors, _IDS)
        .select(*_IDS, F.greatest("place", F.coalesce("floor", "place")).alias("place"), F.col("open").cast("long").alias("open")),
        "waiting",
    )
    # One folder holds the calls of all rounds, so the plan does not grow with them.
    folder, done = scratch_path(links.sparkSession, "settled"), 0
    fresh.write.parquet(f"{folder}/round=0")
    while not fresh.isEmpty() and not waiting.isEmpty():
        used = fresh.select("conv_id", F.col("call_id").alias("used"), F.col("place").alias("after"))
        met = (
            needs.join(used, ["conv_id", "used"])
            .groupBy(*_IDS)
            .agg(F.max(F.col("after") + F.col("weight")).alias("after"), F.count("*").alias("met"))
        )
        state = waiting.join(met, _IDS, "left").select(
            *_IDS,
            F.greatest("place", F.coalesce("after", "place")).alias("place"),
            (F.col("open") - F.coalesce("met", F.lit(0))).alias("open"),
        )
        state = materialize(state, "waiting")
        fresh = state.where("open = 0").drop("open")
        waiting = state.where("open > 0")
        done += 1
        fresh.write.parquet(f"{folder}/round={done}")
    ends = links.sparkSession.read.schema(fresh.schema).parquet(folder).select(*fresh.columns)
    after = ends.select("conv_id", F.col("call_id").alias("ptr"), F.col("place").alias("after"))
    chained = hops.join(after, ["conv_id", "ptr"]).select(
        *_IDS, F.greatest("base", F.col("after") + F.col("add")).alias("place")
    )
    placed = ends.unionByName(chained).withColumn("settled", F.lit(True))
    order = (
        F.when((F.col("status") != "no_call") & F.col("settled").isNull(), "cycle")
        .when(F.coalesce("gap", F.lit(False)), "missing")
        .when(F.col("place") > F.col("turn_"), "moved")
        .otherwise("as_given")
    )
    joined = given.join(placed, _IDS, "left").withColumn("place", F.coalesce("place", "turn_")).join(unknown, _IDS, "left")
    return joined.withColumn("order", order).drop("turn_", "gap", "settled")


def validated(links: DataFrame, schemas: DataFrame) -> DataFrame:
    """Links with `problems`, the sorted list of what is wrong with a call's arguments.

    `schemas` has a row for each field of a tool (tool, field, kind, required); the tools are few, so their fields are
    gathered by tool. Problems: `unknown_tool`, `not_json`, `missing:field`, `unknown:field` and `kind:field`. A field
    whose value is null counts as missing where it is required.
    """
    fields = schemas.groupBy("tool").agg(
        F.sort_array(F.collect_set(F.struct("field", "kind", "required"))).alias("fields")
    )
    joined = links.join(fields, F.col("name") == F.col("tool"), "left")
    given = F.json_object_keys("arguments")
    values = raw_values("arguments")

    def value(field: Column) -> Column:
        return F.try_element_at(values, field)

    missing = F.transform(
        F.filter("fields", lambda f: f["required"] & (F.coalesce(value(f["field"]), F.lit("null")) == "null")),
        lambda f: F.concat(F.lit("missing:"), f["field"]),
    )
    pattern = F.create_map(*[x for k, v in KINDS.items() for x in (F.lit(k), F.lit(v))])
    wrong = F.transform(
        F.filter(
            "fields",
            lambda f: (F.coalesce(value(f["field"]), F.lit("null")) != "null")
            & ~F.coalesce(F.rlike(value(f["field"]), F.try_element_at(pattern, f["kind"])), F.lit(False)),
        ),
        lambda f: F.concat(F.lit("kind:"), f["field"]),
    )
    allowed = F.transform("fields", lambda f: f["field"])
    extra = F.transform(F.array_except(given, allowed), lambda k: F.concat(F.lit("unknown:"), k))
    problems = (
        F.when(F.col("status") == "no_call", F.array().cast("array<string>"))
        .when(F.col("fields").isNull(), F.array(F.lit("unknown_tool")))
        .when(given.isNull(), F.array(F.lit("not_json")))
        .otherwise(F.sort_array(F.concat(missing, wrong, extra)))
    )
    return joined.withColumn("problems", problems).drop("tool", "fields")


def raw_values(arguments: str | Column) -> Column:
    """Top-level values of a JSON object as they are written, by field; null for anything but an object."""
    parsed = F.try_parse_json(arguments)
    return F.transform_values(
        F.try_variant_get(parsed, "$", "map<string,variant>"), lambda _, v: F.to_json(v)
    )


def canonical(fields: Column) -> Column:
    """A JSON object with sorted keys and no spaces from a map of already written values."""
    pairs = F.transform(
        F.array_sort(F.map_entries(fields)),
        lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def quoted(text: str | Column) -> Column:
    """A JSON string."""
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def messages(links: DataFrame) -> DataFrame:
    """One row a message: conv_id, place, part (0 for a call, 1 for its result), call_id and `line`, canonical JSON.

    Results stand right behind their calls. Arguments that are no JSON object are written as a string.
    """
    arguments = F.coalesce(canonical(raw_values("arguments")), quoted(F.coalesce("arguments", F.lit(""))))
    call = F.create_map(
        F.lit("role"), F.lit('"assistant"'), F.lit("call_id"), quoted("call_id"),
        F.lit("name"), quoted(F.coalesce("name", F.lit(""))), F.lit("arguments"), arguments,
    )
    result = F.create_map(
        F.lit("role"), F.lit('"tool"'), F.lit("call_id"), quoted("call_id"),
        F.lit("content"), quoted(F.coalesce("content", F.lit(""))),
    )
    base = ["conv_id", "place", "call_id", "status", "order", "problems"]
    calls = links.where("status <> 'no_call'").select(*base, F.lit(0).alias("part"), canonical(call).alias("line"))
    results = links.where("status <> 'no_result'").select(*base, F.lit(1).alias("part"), canonical(result).alias("line"))
    return calls.unionByName(results)


def plain_messages(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) that are no part of a call, in the columns of `messages` with part 2.

    Null texts are empty; other columns are left out.
    """
    fields = F.create_map(
        F.lit("role"), quoted(F.coalesce("role", F.lit(""))), F.lit("content"), quoted(F.coalesce("text", F.lit("")))
    )
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("place"),
        F.lit(None).cast("string").alias("call_id"),
        F.lit("plain").alias("status"),
        F.lit("as_given").alias("order"),
        F.array().cast("array<string>").alias("problems"),
        F.lit(2).alias("part"),
        canonical(fields).alias("line"),
    )
