"""Physical plans of the registered queries: pruning reaches the scans, no Python in the hot path, no window or
nested-loop join over whole groups where the design avoids them."""

from __future__ import annotations

import re

import pytest

from tillgrid.plans import contract

TABLE_QUERIES = sorted(contract.QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_python_and_no_nested_loops(spark, sf_dir, name):
    plan = _plan(contract.QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_fact_scan_reads_only_used_columns(spark, sf_dir):
    plan = _plan(contract.QUERIES["customer_monthly_sales"](spark, sf_dir))
    schemas = re.findall(r"lineitem\.parquet\][^\n]*ReadSchema: (struct<[^>]*>)", plan)
    assert schemas == ["struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double>"]


def test_incentive_and_totals_use_no_window(spark, sf_dir):
    for name in ("sales_incentive", "customer_monthly_sales", "customer_monthly_sales_window"):
        assert "Window" not in _plan(contract.QUERIES[name](spark, sf_dir)), name


def test_rank_windows_are_bounded_by_range_partitions(spark, sf_dir):
    plan = _plan(contract.QUERIES["incentive_ties"](spark, sf_dir))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert len(windows) == 2, plan
    # One window runs inside a (group, range partition); the other runs over the per-partition totals of a group
    # (one row per range partition, ordered by its number). Neither holds a whole group's rows.
    assert all("_pid" in part or "_pid" in order for part, order in windows), windows
