"""Readers, writers and streams on small files."""

import pytest
from frames import at, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.operators.upsert import dedupe_upsert
from tablemend.plans import load
from tablemend.session import scratch_path
from tablemend.sinks import files as K
from tablemend.sources import files as S
from tablemend.sources import scans
from tablemend.streaming import jobs

TEXT = "가나다"
# This syllable is in cp949 but not in euc-kr.
RARE = "똠"


def put(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)


def test_each_file_in_its_first_readable_encoding(spark, tmp_path):
    folder = tmp_path / "logs"
    put(folder, "a", f"plain\n{TEXT}\n".encode("utf-8"))
    put(folder, "b", f"plain\n{TEXT}\n".encode("euc-kr"))
    put(folder, "c", f"{TEXT}\n{RARE}\n".encode("cp949"))
    put(folder, "d", b"caf\xe9\n")
    put(folder, "e", b"ascii only\n")
    got = rows(S.read_text_with_fallback(spark, str(folder)), F.substring_index("path", "/", -1), "line")
    assert got == sorted(
        [("a", "plain"), ("a", TEXT), ("b", "plain"), ("b", TEXT), ("c", TEXT), ("c", RARE), ("d", "café"), ("e", "ascii only")],
        key=repr,
    )


def test_many_files_take_the_salted_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "_BROADCAST_FILES", 0)
    test_each_file_in_its_first_readable_encoding(spark, tmp_path)


def test_values_in_their_first_readable_encoding(spark):
    data = [(TEXT.encode("utf-8"),), (TEXT.encode("euc-kr"),), (RARE.encode("cp949"),), (b"\xff",), (None,)]
    got = spark.createDataFrame(data, "b binary").select(S.decode_with_fallback("b")).collect()
    assert [r[0] for r in got] == [TEXT, TEXT, RARE, "ÿ", None]


def test_csv_skips_long_lines_only(spark, tmp_path):
    put(tmp_path / "csv", "x", b'1,"a,b",2\n2,b\n3,c,3,4\n4,d,5,\n\n5,"",x\n')
    schema = T._parse_datatype_string("n int, t string, m int")
    want = [(1, "a,b", 2), (2, "b", None), (5, None, None)]
    assert rows(S.read_csv_skip_bad(spark, str(tmp_path / "csv"), schema)) == want
    assert rows(S.read_log_csv(spark, str(tmp_path / "csv"), schema)) == want


def test_periods_are_replaced_in_a_partitioned_table(spark):
    spark.sql("DROP TABLE IF EXISTS periods")
    path = scratch_path(spark, "periods")
    old = spark.createDataFrame([(1, "202401"), (2, "202402"), (3, "202403"), (4, "202404")], "v int, ym string")
    old.write.partitionBy("ym").option("path", path).saveAsTable("periods")
    new = spark.createDataFrame([(9, "202403"), (8, "202404")], "v int, ym string")
    K.delete_window_insert(spark, "periods", new, "ym", "202402", "202403")
    try:
        assert rows(spark.table("periods")) == [(1, "202401"), (4, "202404"), (8, "202404"), (9, "202403")]
    finally:
        spark.sql("DROP TABLE periods")


def test_replace_periods_keeps_rows_without_period(spark):
    old = spark.createDataFrame([(1, "202401"), (2, None)], "v int, ym string")
    got = K.replace_periods(old, old.limit(0), "ym", "202401", "202401")
    assert rows(got) == [(2, None)]


def test_short_copy_is_not_published(spark):
    path = scratch_path(spark, "kept")
    spark.range(10).write.parquet(path)
    with pytest.raises(ValueError, match="9 rows"):
        K.rewrite_published(spark, path, scratch_path(spark, "copy"), lambda df: df.where("id < 9"))
    assert spark.read.parquet(path).count() == 10


def test_key_marks_go_on_without_loss(spark):
    df = spark.range(100).selectExpr("id % 10 as a", "id as b")
    mark, seen = None, 0
    for upper in (3, 6, 9):
        part = scans.read_after_key(df.where(f"a <= {upper}"), ["a", "b"], mark)
        seen += part.count()
        mark = scans.next_mark(part, ["a", "b"])
    assert seen == 100


def test_database_options(spark):
    """Options only: no database is opened."""
    with pytest.raises(Exception, match="(?i)driver|suitable"):
        scans.read_jdbc_partitioned(spark, {"url": "jdbc:none:x", "dbtable": "t"}, "k", 1, 100, 4)


def test_stream_equals_batch_after_restart(spark):
    schema = "k long, v string, t timestamp_ntz"
    land, changes, state = (scratch_path(spark, n) for n in ("s-land", "s-changes", "s-state"))
    first = spark.createDataFrame([(1, "a", at("2024-01-02")), (1, "b", at("2024-01-03"))], schema)
    second = spark.createDataFrame([(1, "old", at("2024-01-01")), (2, "c", at("2024-01-04"))], schema)
    for part in (first, second):
        part.write.mode("append").parquet(land)
        stream = jobs.landing_stream(spark, land, part.schema)
        jobs.stream_upsert(stream, ["k"], ["t"], changes, state).awaitTermination()
    target = spark.createDataFrame([(1, "z", at("2023-01-01")), (3, "q", at("2023-01-01"))], schema)
    got = jobs.current_table(target, spark.read.parquet(changes), ["k"], ["t"])
    assert rows(got) == rows(dedupe_upsert(target, first.union(second), ["k"], ["t"]))


def test_error_windows_are_half_open(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:09:59.9", "2024-01-01 00:10:00"]
    runs = spark.createDataFrame([("P", "ER", at(t)) for t in times], "pgmid string, st string, t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = rows(jobs.error_counts(runs, "t", "1 hour"), "window_start", "error_count")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(at("2024-01-01 00:00:00"), 3)]
    assert rows(jobs.error_counts(runs, "t", "10 minutes"), "error_count") == [(1,), (2,)]


@pytest.mark.parametrize("listed", [10_000, 0])
def test_only_touched_partitions_are_rewritten(spark, listed, monkeypatch):
    monkeypatch.setattr(load, "_LISTED_PARTITIONS", listed)
    schema = "k int, v string, day string"
    old = spark.createDataFrame([(1, "a", "20240101"), (2, "b", "20240102"), (3, "c", "20240103"), (6, "f", None)], schema)
    new = spark.createDataFrame([(2, "B", "20240102"), (4, "d", "20240102"), (5, "e", "20240104"), (7, "g", None)], schema)
    path = scratch_path(spark, "parted")
    old.write.partitionBy("day").parquet(path)

    def files(day):
        return {f for f in spark.read.parquet(path).inputFiles() if f"day={day}" in f}

    before = {day: files(day) for day in ("20240101", "20240102", "20240103")}
    load.upsert_partitions(spark, path, new, ["k"], "day", scratch_path(spark, "parted-staging"))
    got = rows(spark.read.schema(schema).parquet(path), "k", "v", "day")
    assert got == [
        (1, "a", "20240101"),
        (2, "B", "20240102"),
        (3, "c", "20240103"),
        (4, "d", "20240102"),
        (5, "e", "20240104"),
        (6, "f", None),
        (7, "g", None),
    ]
    assert files("20240101") == before["20240101"] and files("20240103") == before["20240103"]
    assert files("20240102") != before["20240102"]
