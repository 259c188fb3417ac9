"""Queries against their SQL on the smallest tables, and the contract of the entry module."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SAMPLE = [
    "s1_export_states", "s3_household_csv", "s8_config_files", "s9_s10_store_round_trip", "f2_sparse_columns",
    "f8_complete_days", "a2_hourly_load", "a3_resample_7min", "a5_outlier_truncation", "a10_threshold_candidates",
    "p1_activity_table", "p2_usage_table", "w3_w4_device_runs", "p5_profiles_by_date", "r1_price_horizon",
    "cheapest_launch_hour", "r8_recommendations_on_dates", "r11_back_test", "m4_knn_usage", "e2_usage_walk_forward",
    "w10_cold_start_days", "x1_usage_shapley", "m14_knn_impute", "stream_hourly_sums",
]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == "ok"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_hourly_window_follows_two_aggregations(spark, sf):
    """Raw events meet by (household, timestamp) first; only hourly rows are laid out by household."""
    from loadshift import fixtures as fx
    from loadshift.operators.features import load_input

    plan = load_input(fx.readings(spark, sf), fx.SHIFTABLE, 30.0, fx.span(spark, sf).today)._jdf.queryExecution().executedPlan().toString()
    window, aggregate = plan.index("Window "), plan.index("partial_sum")
    assert window < aggregate
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PushedFilters: [In(event_type, [purchase,signup])" in plan
