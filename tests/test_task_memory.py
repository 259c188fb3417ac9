"""Each sort, aggregation and window of a stage holds memory in the same task: how many of them a task has, and that hours which fan out are
dealt over all partitions of the session, however few bytes they had before."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loadshift.operators import hour_cells, hourly
from loadshift.operators.score import cold_start_days

HOLDS = re.compile(r"^(\*\(\d+\) )?(Sort|SortAggregate|HashAggregate|ObjectHashAggregate)\b")
NAMES = ["m3_logit_activity_sliding", "a18_a20_scores_by_position", "e4_agent_scores", "t2_fine_thresholds", "e6_cold_start_scores",
         "e6_cold_start_user_metrics", "a10_threshold_candidates", "a9_threshold_profile", "a23_sensitivity", "w10_cold_start_days"]


def largest_stage(plan):
    """The most operators that hold memory between two exchanges; the branches of a union have tasks of their own."""
    nodes = [(len(m[1]) // 3, m[2]) for m in (re.match(r"^([ :+-]*)(.*)$", line) for line in plan.splitlines()) if m[2]]
    most = 0

    def count(i):
        """Operators of the stage that node i belongs to, from there down, and the place after its subtree."""
        nonlocal most
        depth, text = nodes[i]
        below, i = [], i + 1
        while i < len(nodes) and nodes[i][0] > depth:
            n, i = count(i)
            below.append(n)
        own = (max if text.startswith("Union") else sum)(below or [0]) + bool(HOLDS.match(text))
        most = max(most, own)
        return (0 if re.match(r"(Broadcast|Shuffle)?Exchange", text) else own), i

    count(0)
    return most


@pytest.mark.parametrize("name", NAMES)
def test_few_operators_share_a_task(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert largest_stage(plan) <= 11 and spark.conf.get("spark.sql.unionOutputPartitioning") == "false"


def test_hours_are_dealt_over_all_partitions(spark):
    seen = spark.range(40).select(F.col("id").alias("household_id"), F.expr("explode(array(timestamp'2024-01-01 00:00', timestamp'2024-01-03 05:00'))").alias("hour_ts"), F.lit(1.0).alias("v0"))
    grid = hourly.dense_hours(seen, ["v0"], ["household_id"])
    plan = grid._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert re.search(rf"hashpartitioning\(household_id#\d+L, {spark.conf.get('spark.sql.shuffle.partitions')}\), REPARTITION_BY_NUM", plan) and grid.count() == 40 * 54


def test_a_sliding_week_sums_up_the_days_once(spark, sf):
    from loadshift.catalog.features import activity_table

    plan = hour_cells.training_cells(activity_table(spark, sf), "2024-01-10", "2024-01-20", 7)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Generate explode\(sequence\(", plan.split("== Initial Plan ==")[-1])) == 2  # the grid of hours and the dates that a count holds for


def test_the_slowest_agent_needs_no_second_pass(spark):
    rows = [(h, d, 0.5 + d / 10, 1.0 / d, None) for h in (1, None) for d in (1, 2, 3)]
    table = spark.createDataFrame(rows, "household_id int, date int, activity double, load_a double, usage_a double")
    out = cold_start_days(table, ["activity", "load_a", "usage_a"], [0.2])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + out._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1
    got = {(r.household_id, r.agent): r.days for r in out.collect()}
    assert got == {(h, a): d for h in (1, None) for a, d in (("activity", 2), ("load_a", 4), ("usage_a", 4), ("framework", 4))}
