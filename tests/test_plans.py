"""Physical-plan checks: no nested-loop/cartesian joins or Python UDFs in any
key; filters reach the Parquet scans."""

import pytest

from support import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython")


def _keys():
    from opscore import registry
    return sorted(registry.builders())


@pytest.mark.parametrize("key", _keys())
def test_no_forbidden_nodes(spark, key):
    from opscore import registry
    df = registry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{key}: {node}"


def test_route_filters_are_pushed(spark):
    from opscore import registry
    df = registry.queries()["route_demand"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate," in plan
    assert "GreaterThanOrEqual(o_orderdate," in plan


def test_scan_prunes_columns(spark):
    from opscore import registry
    df = registry.queries()["status_in_filter"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("key,funcs", [
    ("route_demand", ["partial_count", "partial_max", "partial_max_by"]),
    ("refund_ledger", ["partial_max_by", "partial_sum"]),
    ("search_dashboard", ["partial_count", "partial_sum", "partial_collect_set"]),
    ("resolution_score_daily", ["partial_sum"]),
    ("production_with_absence", ["partial_collect_list"]),
    ("csat_monthly", ["partial_sum", "partial_count"]),
])
def test_aggregates_are_partial_before_the_shuffle(spark, key, funcs):
    """Pre-aggregation before shuffling: each listed aggregate has a map-side
    partial step, so a hot key costs one row per map task."""
    from opscore import registry
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = registry.queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    for f in funcs:
        assert f + "(" in plan, f"{key}: no {f}"


def test_reporting_start_reaches_the_resolution_scans(spark):
    """History before the scorecard's start date is filtered at the scan,
    not after aggregating and shuffling it."""
    from opscore.plans.scorecard import Scorecard
    from opscore.sources import DriverTables
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        sc = Scorecard(DriverTables(spark, SF_SMALL), "2001-03-01", "2001-07-01",
                       "2024-01-01 06:00:00")
        plan = sc.daily_table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_quantity" in ln]
    assert scans and all("GreaterThanOrEqual(l_shipdate,2001-03-01" in ln for ln in scans)


@pytest.mark.parametrize("key", ["refund_ledger", "latest_log_join", "route_demand", "sales_by_route",
                                 "latest_sale_per_route", "search_dashboard", "search_dashboard_sql",
                                 "production_with_absence", "worst_production_per_day"])
def test_no_sort_based_aggregate(spark, key):
    """No key picks its row with a sort-based aggregate over text."""
    from opscore import registry
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = registry.queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert "SortAggregate" not in plan
