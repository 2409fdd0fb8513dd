"""Key ranges with about as many rows each, and streams that go on after the last key read."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


def key_ranges(source: DataFrame, key: str, n: int, accuracy: int = 10_000) -> list[str]:
    """About n SQL conditions on a key, each true for about as many rows, exactly one of them for every row.

    Cut points come from a quantile sketch of the key, a number, date or time. The first range is open below and the
    last one above, so keys outside the sketch fall in them, and null keys have a range of their own if there are any.
    A value that many rows share is one range; no cut divides it. An empty table has one range that holds everything.
    """
    points = [i / n for i in range(1, n)]
    found = source.agg(
        F.percentile_approx(key, points, accuracy).alias("cuts") if points else F.lit(None).alias("cuts"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).first()
    cuts = [_literal(c) for c in sorted(set(found["cuts"] or []))]
    name = f"`{key}`"
    if not cuts:
        return ["true"] if not found["nulls"] else [f"{name} IS NOT NULL", f"{name} IS NULL"]
    inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:])]
    ranges = [f"{name} <= {cuts[0]}", *inner, f"{name} > {cuts[-1]}"]
    return [*ranges, f"{name} IS NULL"]


def _literal(value: object) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    return str(value)


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, ranges: list[str], options: Mapping[str, str]) -> DataFrame:
    """Whole database table through a connection for each of the ranges."""
    return spark.read.jdbc(url, table, predicates=ranges, properties=dict(options))


class _KeyReader(DataSourceStreamReader):
    """Offsets are keys: a batch holds the rows beyond the last key, up to the greatest there is when it begins."""

    def __init__(self, options: Mapping[str, str], names: list[str]) -> None:
        # A local folder is opened by its plain name, however its scheme is written.
        self._path, self._key, self._names = re.sub("^file:/+", "/", options["path"]), options["key"], names
        self._splits = int(options.get("splits", "8"))

    def _files(self):
        import pyarrow.dataset as ds

        return ds.dataset(self._path, format="parquet")

    def initialOffset(self) -> dict:
        return {"after": None}

    def latestOffset(self) -> dict:
        # From the statistics in the files' footers; rows are not read here.
        groups = [g for f in self._files().get_fragments() for g in f.row_groups if g.num_rows]
        tops = [g.statistics[self._key]["max"] for g in groups if self._key in (g.statistics or {})]
        if len(tops) < len(groups):
            raise ValueError(f"a file has no statistics of {self._key}, or no value of it")
        return {"after": max(tops, default=None)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["after"] is None:
            return []
        files = sorted(self._files().files)
        dealt = [files[i :: self._splits] for i in range(min(self._splits, len(files)))]
        return [InputPartition(json.dumps([part, start["after"], end["after"]])) for part in dealt]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        files, after, upto = json.loads(partition.value)
        chosen = pc.field(self._key) <= upto
        if after is not None:
            chosen = chosen & (pc.field(self._key) > after)
        yield from ds.dataset(files, format="parquet").to_batches(columns=self._names, filter=chosen)

    def commit(self, end: dict) -> None:
        """The checkpoint of the stream keeps the offset; nothing else does."""


class KeyOrderedFiles(DataSource):
    """Parquet files read as a stream in the order of a whole-number key: `path`, `key`, and `splits` for the tasks.

    The offset of a batch is the last key read, kept in the stream's checkpoint, so a run goes on where the last one
    ended, in files written meanwhile as well. Keys must grow: a row added with a key already passed is not read, nor is
    a row without a key. Every run looks at the keys of all files. The path must be one that the workers can open.
    """

    @classmethod
    def name(cls) -> str:
        return "key_ordered"

    def schema(self):
        raise ValueError("state the schema of the rows")

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _KeyReader(self.options, schema.names)


def stream_after_key(spark: SparkSession, path: str, schema: str, key: str, splits: int = 8) -> DataFrame:
    """Rows beyond the last key read, as a stream."""
    spark.dataSource.register(KeyOrderedFiles)
    reader = spark.readStream.format("key_ordered").schema(schema)
    return reader.option("key", key).option("splits", str(splits)).load(path)
