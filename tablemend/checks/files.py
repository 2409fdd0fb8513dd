"""Readers and writers, by way of files derived from the tables in the scratch folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.checks import fixtures as X
from tablemend.checks.registry import query
from tablemend.session import scratch_path
from tablemend.sinks import files as K
from tablemend.sources import files as S


def _orders(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F'
 UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'F'"""
)
def landing_roundtrip(spark, sf_dir):
    """Two runs of a day, the first of them repeated."""
    base = scratch_path(spark, "landing")
    rows = _orders(spark, sf_dir)
    first, second = (dt.datetime(2024, 1, 2, hour) for hour in (3, 4))
    for part, run_at in (("= 'F'", first), ("= 'F'", first), ("<> 'F'", second)):
        K.write_landing(rows.where(f"o_orderstatus {part}"), base, "sales", "orders", run_at)
    return S.read_parquet_prefix(spark, f"{base}/sales/orders")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year,
 CAST(month(o_orderdate) AS INTEGER) AS month FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' UNION ALL
 SELECT o_orderkey, 'X', o_totalprice, o_orderdate, CAST(year(o_orderdate) AS INTEGER),
 CAST(month(o_orderdate) AS INTEGER) FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'"""
)
def landing_by_day(spark, sf_dir):
    """Month ends as days, to keep the number of folders of the check small; some are written twice."""
    base = scratch_path(spark, "by-day")
    rows = _orders(spark, sf_dir).withColumn("landed", F.last_day("o_orderdate"))
    K.write_landing_by_day(rows, base, "sales", "orders", "landed")
    again = rows.where("o_orderdate >= '1999-01-01'").withColumn("o_orderstatus", F.lit("X"))
    back = spark.read.parquet(K.write_landing_by_day(again, base, "sales", "orders", "landed"))
    return back.drop("landed", "day")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def chunked_files(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    K.write_chunks(_orders(spark, sf_dir), path, 2000)
    return S.read_parquet_prefix(spark, path)


@query("SELECT 'orders' AS table_name, count(*) AS row_count FROM orders")
def count_files(spark, sf_dir):
    path = scratch_path(spark, "counted")
    K.replace_prefix(_orders(spark, sf_dir), f"{path}/2024/01")
    K.replace_prefix(_orders(spark, sf_dir).limit(0), f"{path}/2024/02")
    return S.count_files(spark, path, "orders")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F'")
def replaced_prefix(spark, sf_dir):
    path = scratch_path(spark, "replaced")
    K.replace_prefix(_orders(spark, sf_dir), path)
    K.replace_prefix(_orders(spark, sf_dir).where("o_orderstatus = 'F'"), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders")
def appended_batches(spark, sf_dir):
    path = scratch_path(spark, "appended")
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    K.append_batches(rows, path)
    K.append_batches(rows, path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def truncate_insert(spark, sf_dir):
    path = scratch_path(spark, "emptied")
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    K.truncate_insert(rows, path)
    K.truncate_insert(rows.where("o_orderstatus = 'O'"), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus FROM orders")
def rewrite_published(spark, sf_dir):
    path = scratch_path(spark, "published")
    K.replace_prefix(_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus"), path)
    K.rewrite_published(
        spark, path, scratch_path(spark, "rewritten"), lambda df: df.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    )
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_name || ', \"' || c_mktsegment || '\"' AS c_label, c_acctbal FROM customer")
def csv_stage(spark, sf_dir):
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    rows = X.table(spark, sf_dir, "customer").select("c_custkey", label.alias("c_label"), "c_acctbal")
    path = scratch_path(spark, "stage")
    K.write_csv(rows, path)
    return S.read_csv_stage(spark, path, rows.schema)


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey
 FROM customer WHERE c_custkey % 5 <> 0"""
)
def csv_skip_bad(spark, sf_dir):
    """Every fifth line has a field too many, every third one too few."""
    n = F.col("c_custkey")
    line = (
        F.when(n % 5 == 0, F.concat_ws(",", n, "c_name", "c_nationkey", F.lit("more")))
        .when(n % 3 == 0, F.concat_ws(",", n, "c_name"))
        .otherwise(F.concat_ws(",", n, "c_name", "c_nationkey"))
    )
    path = scratch_path(spark, "lines")
    X.table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    return S.read_csv_skip_bad(spark, path, T._parse_datatype_string("c_custkey long, c_name string, c_nationkey int"))


_KOREAN = "가나다"


@query(f"SELECT c_custkey, '{_KOREAN}' || c_name AS c_name FROM customer")
def read_log_csv(spark, sf_dir):
    """Half of the rows in a UTF-8 file, half in one of a legacy Korean encoding."""
    name = F.concat(F.lit(_KOREAN), "c_name")
    lines = X.table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(",", "c_custkey", name).alias("value"))
    base = scratch_path(spark, "logs")
    lines.where("c_custkey % 2 = 0").select("value").write.text(f"{base}/utf8")
    lines.where("c_custkey % 2 = 1").select("value").write.option("encoding", "EUC-KR").text(f"{base}/legacy")
    schema = T._parse_datatype_string("c_custkey long, c_name string")
    return S.read_log_csv(spark, f"{base}/*", schema)


@query("SELECT doc_id, text FROM documents")
def decode_with_fallback(spark, sf_dir):
    """Whole texts as bytes; they are all valid UTF-8, so they come back unchanged."""
    docs = X.table(spark, sf_dir, "documents")
    return docs.select("doc_id", S.decode_with_fallback(F.col("text").cast("binary")).alias("text"))


@query("SELECT c_custkey, c_name FROM customer")
def csv_without_header(spark, sf_dir):
    path = scratch_path(spark, "plain-csv")
    rows = X.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    K.write_csv(rows, path, header=False)
    return S.read_csv_skip_bad(spark, path, rows.schema)
