"""Counts, sums, numbering, column lists and job runs."""

from decimal import Decimal

import pytest
from frames import at, rows
from pyspark.sql import functions as F

from tablemend.functions.numbers import exact_sum, round_sum
from tablemend.functions.times import run_seconds, second_index, seconds_between, whole_second
from tablemend.functions.windows import calendar_flag, make_window, with_offset_windows
from tablemend.operators import counts as C
from tablemend.operators import runs as R
from tablemend.operators import schemas as S
from tablemend.operators.numbering import numbered, row_range


def total(spark, kind, *values):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return df.agg(exact_sum(df.schema["x"]).alias("s")).collect()[0]["s"]


def test_sums_are_exact(spark):
    assert total(spark, "double", 0.1, 0.2, -0.3, None) == 0
    assert total(spark, "double", -0.5, -0.25, float("nan")) == Decimal("-0.75")
    assert total(spark, "double", 3e18, 0.125) == Decimal("3000000000000000000.125")
    assert total(spark, "decimal(20,3)", Decimal("12345678901234567.891"), Decimal("0.109")) == Decimal("12345678901234568")
    assert total(spark, "long", 2**62, 2**62) == 2**63
    assert total(spark, "double", None) is None


def test_sums_round_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.0625"),), (Decimal("2.0005"),), (None,)], "x decimal(10,4)")
    got = [r[0] for r in df.select(round_sum(F.col("x"))).collect()]
    assert got == [Decimal("0.063"), Decimal("2.001"), Decimal("0.000")]


def test_counts_with_empty_and_missing_tables(spark):
    source = C.table_profiles({"a": spark.range(0), "b": spark.range(4), "only": spark.range(2)})
    target = C.table_profiles({"a": spark.range(3), "b": spark.range(3)})
    got = {r["table_name"]: r for r in C.compare_counts(source, target).collect()}
    assert (got["a"]["source_minus_target_cnt"], got["a"]["diff_range"]) == (-3, 0)
    assert (got["b"]["source_minus_target_cnt"], got["b"]["diff_range"]) == (1, 25)
    assert (got["only"]["target_cnt"], got["only"]["source_minus_target_cnt"]) == (None, 2)


def test_load_day_leaves_out_its_last_second(spark):
    times = ["2024-01-09 23:59:59", "2024-01-10", "2024-01-10 23:59:58.999", "2024-01-10 23:59:59"]
    df = spark.createDataFrame([(at(t),) for t in times], "t timestamp_ntz")
    assert C.on_load_day(df, "t", "2024-01-10 12:00:00").count() == 2


def test_second_arithmetic(spark):
    pairs = [("2024-01-01 00:00:00.900000", "2024-01-01 00:00:01.100000"), ("1969-12-31 23:59:59.500000", "1970-01-01")]
    df = spark.createDataFrame([(at(a), at(b)) for a, b in pairs], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(seconds_between(F.col("a"), F.col("b")), run_seconds(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1, Decimal("0.20")), (1, Decimal("0.50"))]
    cut = df.select(whole_second(F.col("a")).alias("w"), (second_index(F.col("a")) % 60).alias("s")).collect()
    assert [tuple(r) for r in cut] == [(at("2024-01-01 00:00:00"), 0), (at("1969-12-31 23:59:59"), 59)]


def test_second_arithmetic_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(at("2024-03-10 02:30:00.5"), at("2024-03-10 03:30:00"))], "a timestamp_ntz, b timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(seconds_between(F.col("a"), F.col("b")), whole_second(F.col("a"))).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (3600, at("2024-03-10 02:30:00"))


def test_windows(spark):
    assert make_window("20240228", "20240229", 1, 1) == make_window("20240229", "20240301")
    day = make_window("20240101", "20240101", day_start="06:00:00")
    assert (day.lo, day.hi) == ("2024-01-01 06:00:00", "2024-01-02 05:59:59")


def test_offset_windows_and_bad_codes(spark):
    df = spark.createDataFrame([("F015",), ("D028",), ("M001",)], "code string")
    day = F.lit("2024-03-01").cast("date")
    got = with_offset_windows(df.withColumns({"s": day, "e": day}), "code", "s", "e")
    texts = rows(got, "code", F.col("window_start").cast("string"), F.col("window_end").cast("string"), "day_offset")
    assert texts == [
        ("D028", "2024-02-02", "2024-02-02", 28),
        ("F015", "2024-02-15", "2024-03-01", 0),
        ("M001", "2024-02-29", "2024-02-29", 1),
    ]
    bad = spark.createDataFrame([("X001",)], "code string").withColumns({"s": day, "e": day})
    with pytest.raises(Exception, match="unknown window code"):
        with_offset_windows(bad, "code", "s", "e").collect()


def test_calendar_flag(spark):
    days = ["2024-02-01", "2024-02-29", "2023-02-28", "2024-02-28", "2024-05-02", "2024-05-03", "2024-05-14", "2024-05-15"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    assert [r[0] for r in df.select(calendar_flag(F.col("d"))).collect()] == [
        "first", "last", "last", None, "second", "third", "fourteenth", None,
    ]


def test_numbers_follow_a_large_group_across_partitions(spark):
    n = 3000
    df = spark.range(n).selectExpr("CASE WHEN id % 3 < 2 THEN 'hot' WHEN id % 2 = 0 THEN NULL ELSE 'c' || id END AS g", "id AS t")
    got = numbered(df, ["g"], ["t"], partitions=7).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append((r["row_no"], r["t"]))
    assert sum(map(len, groups.values())) == n
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(1, len(members) + 1))
        assert [m[1] for m in members] == sorted(m[1] for m in members)
    assert [r["t"] for r in row_range(df, ["t"], 11, 13).orderBy("t").collect()] == [10, 11, 12]


def catalog(spark, *names):
    data = [("S", "T", n, i) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "schema_name string, table_name string, column_name string, ordinal_position int")


def test_schema_parity(spark):
    private = catalog(spark, "b")
    source, staged = catalog(spark, "a", "b", "c"), catalog(spark, "c", "b", "a", "GBN", "DMS_SCN")
    same = S.schema_parity(source, staged, catalog(spark, "a", "c"), private).collect()[0]
    assert (same["staged_is_match"], same["target_is_match"]) == (True, True)
    turned = S.schema_parity(source, catalog(spark, "a", "d"), catalog(spark, "c", "a"), private).collect()[0]
    assert (turned["staged_is_match"], turned["target_is_match"]) == (False, False)
    assert (turned["source_only"], turned["staged_only"]) == ("b,c", "d")


RUNS = "pgmid string, starttime timestamp_ntz, endtime timestamp_ntz, st string, jbpmt string, readcnt long, bycnt long, errcnt long, updcnt long, wrtcnt long, msg string"


def run(job, start, counters, param=None, seconds=1, status="OK", msg=None):
    begin = at(start)
    return (job, begin, begin.replace(second=seconds), status, param, *counters, msg)


def test_run_parity_flags_and_missing_partner(spark):
    source = spark.createDataFrame(
        [run("P", "2024-01-01 01:00:00", (2, 2, 2, 2, 2)), run("P", "2024-01-01 02:00:00", (1, 1, 1, 1, 1), ""),
         run("P", "2024-01-01 00:00:00", (9, 9, 9, 9, 9))], RUNS)
    target = spark.createDataFrame(
        [run("P", "2024-01-01 01:00:00", (1, 1, 1, 1, 1)), run("P", "2024-01-01 03:00:00", (1, 1, 1, 1, None)),
         run("Q", "2024-01-01 01:00:00", (5, 0, 0, 0, None), "x")], RUNS)
    since = "2024-01-01 00:10:00"
    got = R.run_parity(source, target, "2024-01-01", since)
    flags = rows(got, "pgmid", "readcnt_diff", "wrtcnt_diff", "match_yn", "match_yn_reference", "src_readcnt")
    # Equal differences satisfy the looser flag only; the empty parameter is a missing one.
    assert flags == [("P", 0, 1, "N", "N", 1), ("P", 1, 1, "N", "Y", 2), ("Q", None, None, None, None, 5)]
    messages = [r["err_msg"] for r in got.collect() if r["err_msg"]]
    assert messages == ["the source has no run of Q with parameter x"]
    first = R.run_parity(source, target, "2024-01-01", since, by="first")
    assert rows(first, "pgmid", "readcnt_diff") == [("P", 1), ("P", 1), ("Q", None)]


def test_run_log_and_messages(spark):
    runs = spark.createDataFrame(
        [run("P", "2024-01-01 01:00:00", (1, 1, 1, 1, None), status="ER", msg="e" * 150),
         run("Q", "2024-01-01 01:00:00", (1, 1, 1, 1, 3), status="ER")], RUNS)
    window = make_window("20240101", "20240101")
    tail = R.tail_run_log(runs, window).orderBy("prg_nm").collect()
    assert [(len(r["msg"] or ""), r["wrt_cnt"]) for r in tail] == [(100, 0), (0, 3)]
    texts = [r["txt_cntn"] for r in R.failure_messages(runs, window).orderBy("pgmid").collect()]
    assert texts[0].endswith("error: " + "e" * 100)
    assert texts[1] == "job Q ran from 2024-01-01 01:00:00 to 2024-01-01 01:00:01 and ended in an error: ?"
