"""Projections and row conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.functions.numbers import nan_as_null
from tablemend.functions.predicates import change_kind
from tablemend.functions.text import blank_to_null, cut, first_upper, left_trim, strip_leading
from tablemend.functions.times import iso_text, ntz, plain_text

# Customer grade letters and their codes; other letters have none.
GRADE_CODES = {
    "F": "1001",
    "FC": "1001",
    "A": "2001",
    "M": "3001",
    "I": "4001",
    "L": "5001",
    "Y": "6001",
    "T": "7001",
}
# Columns of the raw call log, before its three unused ones.
CALL_LOG_COLUMNS = (
    "proc_time",
    "tred",
    "call_id",
    "mesg",
    "q_wait_time",
    "ston",
    "vdn_dial_no",
    "ucid",
    "in_call_no",
)


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def _of_type(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def timestamps_to_string(df: DataFrame, columns: list[str] | None = None, plain: bool = False) -> DataFrame:
    """Time columns as text, missing and blank ones as null.

    Without a list all time columns are converted. Named text columns are only
    cleaned. `plain` writes a space where ISO text has a T.
    """
    times = set(_of_type(df, T.TimestampNTZType, T.TimestampType))
    chosen = [c for c in df.columns if c in (times if columns is None else columns)]
    write = plain_text if plain else iso_text
    return df.withColumns({c: write(F.col(c)) if c in times else blank_to_null(F.col(c)) for c in chosen})


def numbers_to_decimal(
    df: DataFrame, precision: int = 38, scale: int = 6, columns: list[str] | None = None
) -> DataFrame:
    """Floating-point columns as decimals, NaN as null."""
    chosen = _of_type(df, T.DoubleType, T.FloatType) if columns is None else columns
    return df.withColumns({c: nan_as_null(F.col(c)).cast(f"decimal({precision},{scale})") for c in chosen})


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: nan_as_null(F.col(c)) for c in _of_type(df, T.DoubleType, T.FloatType)})


def mask_columns(df: DataFrame, columns: list[str], mask: str = "XXXX") -> DataFrame:
    """Overwrite personal columns; names the table does not have are ignored."""
    return df.withColumns({c: F.lit(mask) for c in columns if c in df.columns})


def decode_map(c: Column, codes: dict[str, str]) -> Column:
    """Code for a value; null for values without one."""
    pairs = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.try_element_at(pairs, c)


def reshape(df: DataFrame, layout: dict[str, str | Column]) -> DataFrame:
    """New column layout; text names a source column, a Column is an expression or constant."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in layout.items()])


def audit_columns(user: str, address: str, at: str | Column) -> dict[str, Column]:
    """Who created and last changed a row, and when."""
    when = ntz(at) if isinstance(at, str) else at
    return {
        "rgst_id": F.lit(user),
        "rgst_ip": F.lit(address),
        "reg_dtm": when,
        "chgp_id": F.lit(user),
        "chgp_ip": F.lit(address),
        "chg_dtm": when,
    }


def reshape_grades(df: DataFrame, month: str, user: str, address: str, at: str) -> DataFrame:
    """Customer grades in the layout of the operational grade table."""
    # Names of the operational table's columns, here and in `audit_columns`.
    return reshape(
        df,
        {
            "bsic_ym": F.lit(month),
            "cust_no": "cust_no",
            "itnt_grd_gbcd": decode_map(F.col("cust_grd_gbcd"), GRADE_CODES),
            "blog_cnt": "item_eval_cnt",
            "ord_cnt": "rord_cnt",
            "ord_amt": "rord_amt",
            "rcnt_11_mths_eval_cnt": "m11_item_eval_cnt",
            "rcnt_11_mths_ord_cnt": "m11_rord_cnt",
            "rcnt_11_mths_ord_amt": "m11_rord_amt",
            "grd_retn_mths": "grd_retn_mths",
            **audit_columns(user, address, at),
        },
    )


def stamp_load_time(df: DataFrame, at: str) -> DataFrame:
    """Add `etl_dtm`; the time is given, so a repeated load writes the same rows."""
    return df.withColumn("etl_dtm", ntz(at))


def drop_trailing(df: DataFrame, n: int, names: list[str]) -> DataFrame:
    """Drop the last n columns and name the others by position."""
    return df.select(*df.columns[: len(df.columns) - n]).toDF(*names)


def drop_helper(df: DataFrame, *columns: str) -> DataFrame:
    """Drop helper columns such as row numbers."""
    return df.drop(*columns)


def concat_keys(df: DataFrame, keys: list[str], name: str = "keys") -> DataFrame:
    """Add the comma-joined key text; null parts are skipped."""
    return df.withColumn(name, F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))


def parse_call_log(df: DataFrame, site: str, day: str, loaded_at: str) -> DataFrame:
    """Call-log fields cut to their payload, with site, `yyMMdd` day and load time."""
    col = F.col
    return df.select(
        cut(col("ucid"), 1, 21).alias("ucid"),
        F.lit(site).alias("acd"),
        F.lit(day).alias("proc_date"),
        cut(left_trim(col("proc_time")), 0, 12).alias("proc_time"),
        "tred",
        cut(col("call_id"), 1, 6).alias("call_id"),
        "mesg",
        strip_leading(col("q_wait_time"), "Q").alias("q_wait_time"),
        cut(col("ston"), 1, 5).alias("ston"),
        first_upper(col("vdn_dial_no")).alias("vdn_dial_dvcd"),
        cut(col("vdn_dial_no"), 1).alias("vdn_dial_no"),
        cut(col("in_call_no"), 1).alias("in_call_no"),
        F.lit(loaded_at).alias("etl_dtm"),
    )


def site_logs(logs: dict[str, DataFrame], day: str, loaded_at: str) -> DataFrame:
    """Logs of several sites in one table, told apart by their site code."""
    parsed = [parse_call_log(log, site, day, loaded_at) for site, log in logs.items()]
    stacked = parsed[0]
    for log in parsed[1:]:
        stacked = stacked.unionByName(log)
    return stacked


def classified_changes(df: DataFrame, created: str, changed: str) -> DataFrame:
    """Rows marked insert or update in one pass, with the change time as `transact_id`.

    Rows whose times cannot be compared are neither, and left out.
    """
    return df.select(change_kind(created, changed).alias("op"), "*", F.col(changed).alias("transact_id")).where(F.col("op").isNotNull())
