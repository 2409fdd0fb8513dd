"""Physical plans and the scratch folder."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tablemend import session
from tablemend.checks import fixtures as X
from tablemend.checks.comparison import order_check
from tablemend.operators import ledger as L
from tablemend.operators import keys as J
from tablemend.operators import upsert as U
from tablemend.operators.keys import broadcast_if_short
from tablemend.plans import load
from tablemend.sources import scans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_and_columns_reach_the_scan(spark):
    orders = X.table(spark, SF_DIR, "orders")
    plan = plan_of(scans.read_window(orders, "o_orderdate", X.ORDER_WINDOW).select("o_orderkey"))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThanOrEqual(" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_all_comparisons_share_one_exchange_of_keys(spark):
    check = order_check(spark, SF_DIR)
    found = L.all_differences(check.source, check.target, check.keys, check.ts, X.ORDER_WINDOW, check.deletes)
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
    assert "o_totalprice" not in plan


def test_broadcast_only_below_the_bound(spark):
    assert "broadcast" in broadcast_if_short(spark.range(5), 5)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_short(spark.range(6), 5)._jdf.queryExecution().logical().toString()


class _Named:
    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.conf = self
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"

    def get(self, name, default):
        return self.folder if name == session.CHECKPOINT_CONF and self.folder else default


def test_scratch_folder_is_the_one_the_cluster_names():
    assert session.checkpoint_base(_Named("yarn", "hdfs://shared/c/")) == "hdfs://shared/c"
    with pytest.raises(ValueError, match="all executors"):
        session.checkpoint_base(_Named("yarn"))
    local = _Named("local[2]")
    assert session.checkpoint_base(local) == session.checkpoint_base(local)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_short_change_sets_leave_the_target_where_it_is(spark):
    """Half a day out of a large source: what counts is what is left of it, not the optimizer's estimate."""
    target, staged = (f(spark, "/root/testdata/sf0.1") for f in (X.target_orders, X.versioned_orders))
    merged = load.incremental_load(target, staged, X.KEYS, "chg_dtm", X.TimeWindow("1997-06-01 00:00:00", "1997-06-01 12:00:00"))
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan.split("LeftAnti")[0] and "FullOuter" not in plan


def test_long_change_sets_are_joined_whatever_their_estimate(spark):
    many = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(2_000_000))).alias("k"), F.lit("x").alias("v"))
    target = spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit("y").alias("v"))
    merged = U.upsert(target, many, ["k"])
    assert "FullOuter" in plan_of(merged)
    assert merged.count() == 2_000_001


def test_key_joins_shuffle_each_side_once(spark, no_broadcast):
    left = X.table(spark, SF_DIR, "orders")
    right = X.table(spark, SF_DIR, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    for join in (J.rows_with_key, J.rows_without_key):
        plan = plan_of(join(left, right, X.KEYS))
        assert plan.count("Exchange hashpartitioning") == 2
        assert plan.count("SortMergeJoin") == 1


def test_complete_keys_need_one_anti_join(spark, no_broadcast):
    left = X.table(spark, SF_DIR, "orders").select("o_orderkey", "o_custkey")
    plan = plan_of(J.rows_not_in(left, left.where("o_orderkey % 2 = 0"), ["o_orderkey", "o_custkey"]))
    assert plan.count("LeftAnti") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_whole_tables_are_read_without_a_shuffle(spark):
    assert "Exchange" not in plan_of(scans.read_full_partitioned(X.table(spark, SF_DIR, "customer")))
