"""Plan-shape checks: what ``explain`` shows must hold for every registered plan.

Correctness tests compare values; these pin the physical plan properties that decide
whether a plan survives a much larger input: no cross products or nested-loop joins, no
row-at-a-time Python, filters and column pruning at the Parquet scan, and broadcasts only
behind the size check.
"""

import re

import pytest

import __spark_entry__ as E
from medalloy.operators import sizing

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> list[str]:
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln]


def assert_scalable_shape(df) -> None:
    """No cross product, nested-loop join or row-at-a-time Python UDF in the physical plan."""
    plan = _physical(df)
    hits = [k for k in FORBIDDEN if k in plan]
    assert not hits, hits


# plans with an oracle are shape-checked in test_entry_oracle, on the same DataFrame
@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_plans_without_oracle_have_scalable_shape(spark, sf, name):
    assert_scalable_shape(E.queries()[name](spark, sf))


@pytest.fixture
def full_metadata(spark):
    """Scan metadata (pushed filters) untruncated in the plan string."""
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_filters_reach_the_scan(spark, sf, full_metadata):
    plan = _physical(E.queries()["canonical_filter"](spark, sf))
    (scan,) = [s for s in _scans(plan) if "orders.parquet" in s]
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", scan).group(1)
    assert "EqualTo(o_orderstatus,F)" in pushed and "EqualTo(o_orderpriority,1-URGENT)" in pushed


def test_scan_reads_only_needed_columns(spark, sf):
    plan = _physical(E.queries()["pivot_priority"](spark, sf))
    (scan,) = _scans(plan)
    cols = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert sorted(re.sub(r"#\d+L?", "", c) for c in cols.split(",")) == ["o_orderdate", "o_orderpriority",
                                                                         "o_totalprice"]


def test_broadcast_only_under_the_size_bound(spark, sf):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    small = spark.read.parquet(f"{sf}/nation.parquet")
    assert hinted(sizing.broadcast_if_small(small))
    big = spark.read.parquet(f"{sf}/lineitem.parquet")
    est = sizing.estimated_bytes(big)
    # a bound just below the expanded estimate of the fact table: no hint
    assert not hinted(big) and not hinted(sizing.broadcast_if_small(big, max_bytes=est * sizing.EXPANSION - 1))
    assert hinted(sizing.broadcast_if_small(big, max_bytes=est * sizing.EXPANSION))
