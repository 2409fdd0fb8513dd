"""Upserts and error counts over file streams.

Both jobs write every micro-batch to its own folder, `batch=<id>`, replacing
it if the batch is run again. A batch that failed halfway therefore leaves no
trace, and readers combine the folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tablemend.functions.predicates import is_error
from tablemend.functions.times import instant_as_wall, wall_as_instant
from tablemend.operators.dedupe import latest_per_key
from tablemend.operators.upsert import dedupe_upsert


def _started(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Run to the end of the files at hand, or go on in the given rhythm."""
    rhythm = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**rhythm).start()


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as they arrive under a landing prefix."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_upsert(
    landing: DataFrame, keys: list[str], order: list[str], changes: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Collect the latest rows per key of every micro-batch in the change folder.

    The target is not rewritten per batch: `current_table` reads it together
    with the changes, and `compact_changes` now and then folds them in.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, keys, order).write.mode("overwrite").parquet(_batch_folder(changes, batch_id))

    return _started(landing.writeStream.foreachBatch(write), checkpoint, every)


def newest_versions(landing: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest version of every key a stream has shown so far; ties fall to the other columns.

    The stream's state holds one row a key, and a micro-batch gives the keys it touched. A version older than one seen
    before changes nothing, whenever it comes.
    """
    rest = [c for c in landing.columns if c not in {*keys, *order}]
    newest = landing.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("version"))
    return newest.select(*[c if c in keys else F.col(f"version.`{c}`").alias(c) for c in landing.columns])


def stream_newest(
    landing: DataFrame, keys: list[str], order: list[str], changes: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Collect the newest version of the keys of every micro-batch in the change folder.

    Unlike `stream_upsert`, a late older version never undoes a newer one, not even one folded into the target already.
    The price is a state of one row a key; with many keys set `spark.sql.streaming.stateStore.providerClass` to the
    RocksDB provider.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(changes, batch_id))

    newest = newest_versions(landing, keys, order)
    return _started(newest.writeStream.outputMode("update").foreachBatch(write), checkpoint, every)


def current_table(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target with the collected changes, equal to one batch upsert of all landed rows."""
    return dedupe_upsert(target, changes.select(*target.columns), keys, order)


def compact_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], path: str
) -> int | None:
    """Write the target with all batches at hand to a new folder; the last batch folded, None if there was none.

    From then on the folder is the target, and `changes_after` leaves out what
    it holds, so the number of batches to read does not grow for ever. A batch
    that comes later must hold no older version of a key, which `stream_newest`
    makes sure of.
    """
    last = changes.agg(F.max("batch")).first()[0]
    held = changes.where(F.col("batch") <= F.lit(last))
    (target if last is None else current_table(target, held, keys, order)).write.mode("overwrite").parquet(path)
    return last


def changes_after(changes: DataFrame, last: int | None) -> DataFrame:
    """Batches not folded yet; the folders of the others are not read."""
    return changes if last is None else changes.where(F.col("batch") > last)


def error_counts(events: DataFrame, ts: str, width: str, lateness: str | None = None, status: str = "st") -> DataFrame:
    """Failed runs per job and half-open time window; each row falls in one window.

    Windows start at midnight of the wall clock. A stream also states how late
    its rows may be.
    """
    failed = events.where(is_error(status)).withColumn("at", wall_as_instant(F.col(ts)))
    if lateness is not None:
        failed = failed.withWatermark("at", lateness)
    return (
        failed.groupBy(F.window("at", width).alias("w"), "pgmid")
        .agg(F.count("*").alias("error_count"))
        .select(
            instant_as_wall(F.col("w.start")).alias("window_start"),
            instant_as_wall(F.col("w.end")).alias("window_end"),
            "pgmid",
            "error_count",
        )
    )


def stream_error_counts(
    events: DataFrame,
    ts: str,
    width: str,
    lateness: str,
    counts: str,
    checkpoint: str,
    status: str = "st",
    every: str | None = None,
) -> StreamingQuery:
    """Error counts of a stream; every micro-batch writes the windows it changed.

    Rows later than `lateness` behind the newest one may be left out, the state
    of their window being gone.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(counts, batch_id))

    counted = error_counts(events, ts, width, lateness, status)
    return _started(counted.writeStream.outputMode("update").foreachBatch(write), checkpoint, every)


def final_counts(counts: DataFrame) -> DataFrame:
    """The last written count of every window and job."""
    return latest_per_key(counts, ["window_start", "window_end", "pgmid"], ["batch"]).drop("batch")


def _error_windows(events: DataFrame, ts: str, width: str, status: str) -> DataFrame:
    at = wall_as_instant(F.col(ts))
    return events.where(is_error(status)).withColumn("__window", F.window(at, width)).withColumn("__at", at)


def stream_late_log(
    events: DataFrame,
    ts: str,
    width: str,
    lateness: str,
    folder: str,
    checkpoint: str,
    status: str = "st",
    every: str | None = None,
) -> StreamingQuery:
    """Error counts of a stream, with the rows that came too late in a folder of their own.

    The mark is `lateness` behind the newest failed run of all batches before; a row is late if its window has ended by
    then. Every micro-batch writes its counts, its late rows and its newest time to `folder`, replacing them if it is
    run again. There is no state but those times: counts add up over batches, see `counted_windows`. Rows without a time
    fall in no window and are kept with the late ones.
    """
    spark = events.sparkSession
    newest = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("batch", T.LongType())])
    spark.createDataFrame([], newest).drop("batch").write.mode("overwrite").parquet(_batch_folder(f"{folder}/newest", -1))

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.sparkSession.read.schema(newest).parquet(f"{folder}/newest")
        # One time, whatever the number of batches.
        mark = known.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        held = batch.persist()
        try:
            timed = held.where(is_error(status) & F.col(ts).isNotNull())
            windows = _error_windows(timed, ts, width, status)
            behind = F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
            late = F.lit(False) if mark is None else F.col("__window.end") <= behind
            unplaced = held.where(is_error(status) & F.col(ts).isNull())
            log = windows.where(late).select(*batch.columns).unionByName(unplaced)
            log.write.mode("overwrite").parquet(_batch_folder(f"{folder}/late", batch_id))
            counts = windows.where(~late).groupBy("__window", "pgmid").agg(F.count("*").alias("error_count"))
            counts.select(
                instant_as_wall(F.col("__window.start")).alias("window_start"),
                instant_as_wall(F.col("__window.end")).alias("window_end"),
                "pgmid",
                "error_count",
            ).write.mode("overwrite").parquet(_batch_folder(f"{folder}/counts", batch_id))
            top = windows.agg(F.max("__at").alias("newest"))
            top.write.mode("overwrite").parquet(_batch_folder(f"{folder}/newest", batch_id))
        finally:
            held.unpersist()

    return _started(events.writeStream.foreachBatch(write), checkpoint, every)


def counted_windows(counts: DataFrame) -> DataFrame:
    """Error counts of `stream_late_log` over all batches."""
    summed = counts.groupBy("window_start", "window_end", "pgmid").agg(F.sum("error_count").alias("error_count"))
    return summed
