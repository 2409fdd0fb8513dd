"""CSV records that span lines, read in the splits of the files.

Whether a line break ends a record depends on the quotes before it, so each line is a function of the state at its
start, outside or inside a quoted field, to the state at its end. There are four such functions, and they compose: each
split sums its own up, a window over the splits of a file gives the state at the start of each, and the lines of a split
then follow from the last one that decides alone and the number of swaps since. Only the lines of records that span
lines are grouped; all others stay where they are.

A quoted field begins at the start of a field and ends before a comma or the end of a line. If the next line with a quote
cannot end an open field, or if there is none, the quote was never closed: its record is left out, and the lines behind
it are records of their own again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What is inside a quoted field, a quoted field, any field, and a field left open at the end of a line.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_QUOTED = f'"{_INSIDE}"'
_FIELD = rf'(?:{_QUOTED}|(?:[^",][^,]*+)?+)'
_OPEN = f'"{_INSIDE}'
_OPENS = f"^(?:{_FIELD},)*+{_OPEN}$"
_STAYS = f"^{_INSIDE}$"
_CLOSES = f'^{_INSIDE}"(?:,{_FIELD})*+$'
_REOPENS = f'^{_INSIDE}",(?:{_FIELD},)*+{_OPEN}$'
_SPLIT = ["file", "block"]


def _stated(lines: DataFrame) -> DataFrame:
    """Lines with `valid`, whether a line with quotes can go on an open field, and the state up to it within the split:
    `swaps` counted, and `code`, the state after the last line that decides alone, less the swaps up to there."""
    quoted = F.contains("value", F.lit('"'))
    value = F.col("value")
    outside = F.when(quoted & value.rlike(_OPENS), 1).otherwise(0)
    closes = value.rlike(_CLOSES)
    stays = value.rlike(_STAYS) | value.rlike(_REOPENS)
    inside = F.when(~quoted, 1).when(closes, 0).when(stays, 1).otherwise(F.col("outside"))
    so_far = Window.partitionBy(*_SPLIT).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swap = F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0)
    decides = F.col("outside") == F.col("inside")
    return (
        lines.withColumns({"quoted": quoted, "outside": outside})
        .withColumns({"inside": inside, "valid": F.when(quoted, closes | stays)})
        .withColumn("swaps", F.sum(swap).over(so_far))
        .withColumn("code", F.last(F.when(decides, (F.col("outside") + F.col("swaps")) % 2), ignorenulls=True).over(so_far))
    )


def _splits(stated: DataFrame) -> DataFrame:
    """One row a split: the state at its start, and whether the next line with quotes behind it can go on an open field."""
    summed = stated.groupBy(*_SPLIT).agg(
        F.max_by(F.struct("swaps", "code"), "n").alias("end"),
        F.min_by(F.col("valid"), F.when(F.col("quoted"), F.col("n"))).alias("first_valid"),
    )
    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    # Rows behind are taken in falling order: a frame that ends with the partition is gone through anew for every row.
    after = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    through = F.sum("end.swaps").over(by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The state at the end of a split that decides alone, less the swaps up to there.
    code = (F.col("end.code") + F.col("end.swaps") + F.col("through")) % 2
    return (
        summed.withColumn("through", through)
        .withColumn("code", F.when(F.col("end.code").isNotNull(), code))
        .withColumn("known", F.last("code", ignorenulls=True).over(before))
        .select(
            F.col("file").alias("in_file"),
            F.col("block").alias("in_block"),
            ((F.coalesce("known", F.lit(0)) + F.col("through") - F.col("end.swaps")) % 2).alias("begun"),
            F.coalesce(F.last("first_valid", ignorenulls=True).over(after), F.lit(False)).alias("later_valid"),
        )
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of headerless CSV files as one column `value`, line breaks within them as line feeds.

    Blank lines between records stay as they are. A quoted field never closed costs its own record and no other. Files
    are split as any text; a file's splits meet as one row each. A split is sorted by one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
        "value",
    )
    stated = _stated(lines)
    same = (F.col("file") == F.col("in_file")) & (F.col("block") == F.col("in_block"))
    joined = stated.join(_splits(stated), same).drop("in_file", "in_block")
    in_order = Window.partitionBy(*_SPLIT).orderBy("n")
    ahead = Window.partitionBy(*_SPLIT).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    after = F.when(F.col("code").isNotNull(), (F.col("code") + F.col("swaps")) % 2).otherwise(
        (F.col("begun") + F.col("swaps")) % 2
    )
    told = (
        joined.withColumn("after", after)
        .withColumn("before", F.coalesce(F.lag("after").over(in_order), F.col("begun")))
        .withColumn("closed", F.coalesce(F.last("valid", ignorenulls=True).over(ahead), F.col("later_valid")))
    )
    held = F.col("before") == 1
    starts = ~held | (F.col("quoted") & ~F.col("valid")) | (~F.col("quoted") & ~F.col("closed"))
    opens = F.col("quoted") & (F.col("after") == 1)
    told = told.withColumns({"starts": starts, "opens": opens})
    single = told.where("starts AND NOT opens").select("value")
    spanning = told.where("NOT starts OR opens").where("NOT (starts AND NOT closed)")
    return single.unionByName(_joined_lines(spanning))


def _joined_lines(lines: DataFrame) -> DataFrame:
    """Records of several lines, without those left open in the end.

    These lines are few, and those of a file are dealt by the record they belong to: the number of the last line that
    starts one, found within the split or, for the first lines of a split, among the splits before.
    """
    so_far = Window.partitionBy(*_SPLIT).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct("block", "n")
    marked = lines.withColumn("head", F.last(F.when(F.col("starts"), place), ignorenulls=True).over(so_far))
    heads = marked.where("starts").groupBy("file", "block").agg(F.max("head").alias("head"))
    blocks = lines.select("file", "block").distinct().join(heads, _SPLIT, "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        F.col("file").alias("in_file"), F.col("block").alias("in_block"), F.last("head", ignorenulls=True).over(before).alias("carried")
    )
    same = (F.col("file") == F.col("in_file")) & (F.col("block") == F.col("in_block"))
    owned = marked.join(carried, same).withColumn("head", F.coalesce("head", "carried"))
    parts = F.sort_array(F.collect_list(F.struct("block", "n", "value")))
    return (
        owned.groupBy("file", "head")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"), F.bool_or(F.expr("opens AND NOT closed")).alias("left_open"))
        .where("NOT left_open")
        .select("value")
    )
