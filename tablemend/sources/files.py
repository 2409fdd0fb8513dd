"""File readers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.operators.keys import broadcast_if_short
from tablemend.session import materialize
from tablemend.sources.records import csv_records

# Encodings tried in this order; the last one reads any bytes.
ENCODINGS = ("utf-8", "euc-kr", "cp949", "latin1")
# A file name and its encoding take well under a kilobyte.
_BROADCAST_FILES = 10_000
_SALTS = 32
_LINE_END = "\x03end of line\x03"


def read_parquet_prefix(spark: SparkSession, path: str) -> DataFrame:
    """Every parquet file under a prefix, in subfolders too."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def count_files(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows of all parquet files under a prefix, counted from the file footers."""
    return read_parquet_prefix(spark, path).agg(F.lit(table).alias("table_name"), F.count("*").alias("row_count"))


def read_csv_stage(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Quoted CSV with one header line."""
    return spark.read.schema(schema).option("header", "true").option("quote", '"').csv(path)


def _fields(lines: DataFrame, line: str, schema: T.StructType) -> DataFrame:
    """Typed fields of the lines that have no more of them than the schema.

    A mark is put behind every line as one field more. Where it is found among
    the fields, the line is short enough; elsewhere it has too many fields.
    Missing, empty and unreadable values become null. A quote within a quoted
    field is doubled.
    """
    names = [f"_{i}" for i in range(len(schema) + 1)]
    marked = F.concat(line, F.lit(f",{_LINE_END}"))
    parsed = F.from_csv(marked, ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE", "escape": '"'})
    rows = lines.where(F.trim(line) != "").select(parsed.alias("r")).select("r.*")
    found = rows.where(F.array_contains(F.array(*names), _LINE_END))
    value = {n: F.nullif(F.nullif(F.col(n), F.lit(_LINE_END)), F.lit("")) for n in names}
    return found.select(*[value[n].try_cast(f.dataType).alias(f.name) for n, f in zip(names, schema)])


def read_csv_skip_bad(spark: SparkSession, path: str, schema: T.StructType, breaks: bool = False) -> DataFrame:
    """Headerless CSV without the records that have too many fields; short records end in nulls.

    A record is a line. With `breaks`, quoted fields may hold line breaks; files are split all the same, see
    `records.csv_records`. A field that is opened by a quote and never closed costs its own record, with or without.
    """
    rows = csv_records(spark, path) if breaks else spark.read.text(path)
    return _fields(rows, "value", schema)


@F.pandas_udf(T.StringType())
def _decode_foreign(values: pd.Series) -> pd.Series:
    """Each binary value in the first encoding after UTF-8 that reads it."""

    def decode(value: bytes | None) -> str | None:
        if value is None:
            return None
        for encoding in ENCODINGS[1:]:
            try:
                return value.decode(encoding)
            except UnicodeDecodeError:
                continue

    return values.map(decode)


def decode_with_fallback(value: str | Column) -> Column:
    """Each binary value in the first encoding that reads it; only what is not UTF-8 is sent to Python."""
    value = F.col(value) if isinstance(value, str) else value
    text = value.cast("string")
    valid = F.is_valid_utf8(text)
    return F.when(valid, text).otherwise(_decode_foreign(F.when(~valid, value)))


@F.pandas_udf(T.IntegerType())
def _readable_mask(values: pd.Series) -> pd.Series:
    """One bit per encoding that reads the line."""

    def mask(value: bytes) -> int:
        bits = 0
        for i, encoding in enumerate(ENCODINGS):
            try:
                value.decode(encoding)
                bits |= 1 << i
            except UnicodeDecodeError:
                pass
        return bits

    return values.map(mask)


@F.pandas_udf(T.StringType())
def _decode_as(values: pd.Series, encodings: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else v.decode(e) for v, e in zip(values, encodings)], dtype="object")


def _first_readable(mask: Column) -> Column:
    chosen = F.lit(ENCODINGS[-1])
    for i in reversed(range(len(ENCODINGS))):
        chosen = F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, ENCODINGS[i]).otherwise(chosen)
    return chosen


def read_text_with_fallback(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, each file in the first encoding that reads all of it.

    The encodings keep line breaks in single bytes, so large files are split
    and a file's verdict is the common one of its lines.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), "value", F.col("value").cast("binary").alias("raw")
    )
    # Files that are UTF-8 throughout are known without Python and stay as they are.
    foreign = materialize(
        lines.where(~F.is_valid_utf8("value")).select(F.col("path").alias("foreign_path")).distinct(), "foreign"
    )
    found = lines.where(F.col("value").rlike(r"[^\x00-\x7F]")).join(
        broadcast_if_short(foreign, _BROADCAST_FILES), F.col("path") == F.col("foreign_path")
    )
    verdict = materialize(
        found.groupBy("path")
        .agg(F.bit_and(_readable_mask("raw")).alias("mask"))
        .select("path", _first_readable(F.col("mask")).alias("encoding")),
        "encodings",
    )
    short = broadcast_if_short(verdict, _BROADCAST_FILES)
    if short is not verdict:
        joined = lines.join(short, "path", "left")
    else:
        salted = lines.withColumn("salt", F.pmod(F.xxhash64("raw"), F.lit(_SALTS)).cast("int"))
        spread = verdict.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        joined = salted.join(spread, ["path", "salt"], "left")
    decoded = _decode_as(F.when(F.col("encoding").isNotNull(), F.col("raw")), "encoding")
    return joined.select("path", F.coalesce(decoded, "value").alias("line"))


def read_log_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headerless CSV in an unknown encoding, without the lines that have too many fields."""
    return _fields(read_text_with_fallback(spark, path), "line", schema)
