"""Every registered query against its SQL, and the plans of all of them."""

import pytest
from conftest import SF_DIR
from oracle import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from tablemend.checks import ORACLES as SQL
from tablemend.checks import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert name in SQL
    compare(spark, con, SF_DIR, QUERIES[name], SQL[name])


def test_all_of_them_are_registered():
    assert QUERIES.items() <= queries().items()
    assert SQL.items() <= oracle_sql().items()


def test_entry_is_the_summary(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1
    assert rows[0]["source_total_count"] > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_upsert", "stream_folded", "stream_error_counts", "stream_late_rows"}))
def test_no_plan_compares_all_pairs(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
