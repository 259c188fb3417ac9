"""Prices, recommendations, back-test and reference joins."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadshift.operators import backtest, joins, recommend, sweep
from loadshift.operators.prices import horizons
from loadshift.sources import prices as price_source

T0 = datetime(2024, 3, 1)


def price_table(spark, hours, price=lambda i: float(i), zone="Z"):
    rows = [(zone, T0 + timedelta(hours=i), price(i)) for i in hours]
    return spark.createDataFrame(rows, "zone string, hour timestamp, price double")


def inputs(spark, costs, probs, usage_p=0.9):
    return spark.createDataFrame(
        [(1, "a", date(2024, 3, 1), costs, probs, usage_p)],
        "household_id int, device string, date date, costs array<double>, probs array<double>, usage_p double",
    )


def test_horizon_copies_earlier_days(spark):
    got = {r.date: r.prices for r in horizons(price_table(spark, range(72)), "2024-03-01", "2024-03-04").collect()}
    assert got[date(2024, 3, 1)] == [float(i) for i in range(24, 72)]
    assert got[date(2024, 3, 2)] == [float(i) for i in range(48, 72)] * 2
    assert got[date(2024, 3, 3)] == [float(i) for i in range(48, 72)] * 2
    assert got[date(2024, 3, 4)] == [float(i) for i in range(48, 72)] + [None] * 24


def test_horizon_from_a_given_today(spark):
    got = horizons(price_table(spark, range(72)), "2024-03-04", "2024-03-04", as_of="2024-03-02").first()
    assert got.prices == [float(i) for i in range(24, 48)] * 2


def test_horizon_is_48_hours_on_the_day_the_clock_changes(spark):
    hours = price_table(spark, range(24 * 31)).withColumn("hour", F.col("hour") + F.expr("INTERVAL 15 DAYS"))
    row = horizons(hours, "2024-03-30", "2024-03-30", "Europe/Brussels").first()
    # local midnight of 31 March is 23:00 UTC of the day before
    first = (datetime(2024, 3, 30, 23) - T0 - timedelta(days=15)).total_seconds() / 3600
    assert len(row.prices) == 48 and row.prices[0] == first and row.prices[47] == first + 47


def test_unacceptable_hours_never_win_even_with_negative_or_zero_costs(spark):
    costs = [0.0, -5.0, 2.0, 1.0] + [9.0] * 20
    probs = [0.1, 0.1, 0.8, 0.8] + [0.1] * 20
    row = recommend.recommend(inputs(spark, costs, probs), 0.5, 0.5).first()
    assert (row.best_launch_hour, row.recommendation) == (3, 3)


def test_no_acceptable_hour_takes_the_cheapest_and_flags(spark):
    row = recommend.recommend(inputs(spark, [3.0, 1.0, 1.0] + [2.0] * 21, [0.1] * 24), 0.5, 0.5).first()
    assert (row.best_launch_hour, row.no_recommend_flag_activity, row.recommendation) == (1, 1, None)


def test_missing_inputs_are_reported(spark):
    assert recommend.recommend(inputs(spark, [None] * 24, [0.9] * 24), 0.5, 0.5).first().error == "no price"
    assert recommend.recommend(inputs(spark, [1.0] * 24, None), 0.5, 0.5).first().error == "no activity prediction"
    row = recommend.recommend(inputs(spark, [1.0] * 24, [0.9] * 24, None), 0.5, 0.5).first()
    assert (row.error, row.recommendation) == ("no usage prediction", None)


def test_nearest_start_takes_the_earlier_of_equals(spark):
    df = spark.sql("SELECT array(named_struct('hour', 4), named_struct('hour', 8), named_struct('hour', 20)) AS s")

    def start(hour):
        return df.withColumn("h", F.lit(hour).cast("int")).select(backtest.nearest_start("s", "h").alias("x")).first().x

    assert [start(6), start(7), start(23), start(None)] == [4, 8, 20, 4]


def test_grid_equals_single_pairs(spark):
    load = [5.0] + [0.0] * 23
    rows = [
        (1, "a", date(2024, 3, 1), [float(h) for h in range(24)], [h / 24 for h in range(24)], 0.4, [float(i) for i in range(48)], 1, [1] * 24, [(3, load), (9, load)]),
        (1, "b", date(2024, 3, 1), [float(24 - h) for h in range(24)], [0.3] * 24, 0.6, [float(48 - i) for i in range(48)], 0, [0] * 24, None),
    ]
    df = spark.createDataFrame(
        rows,
        """household_id int, device string, date date, costs array<double>, probs array<double>, usage_p double, prices array<double>,
        usage_true int, activity_true array<int>, starts array<struct<hour:int,load:array<double>>>""",
    )
    grid = backtest.evaluate_grid(df, [0.25, 0.5], [0.25, 0.5, 0.75])
    got = {(r.device, r.activity_threshold, r.usage_threshold): r for r in grid.collect()}
    assert len(got) == 12
    for a in (0.25, 0.5):
        for u in (0.25, 0.5, 0.75):
            for r in backtest.evaluate(recommend.recommend(df, a, u)).collect():
                g = got[(r.device, a, u)]
                assert [g[c] for c in backtest.RESULT] == [r[c] for c in backtest.RESULT]


def test_reference_join_keeps_unmatched_rows_and_runs_no_job(spark):
    big = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    small = spark.createDataFrame([(1, "one")], "k int, name string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    joined = joins.join_reference(big, small, ["k"])
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    assert sorted(map(tuple, joined.select("v", "name").collect()), key=str) == [("a", "one"), ("b", "one"), ("c", None), ("d", None)]


@pytest.mark.parametrize("name", ["r7_j6_recommendation_table", "r11_back_test", "r13_a17_grid_search", "a5_outlier_truncation"])
def test_queries_cache_no_tables(spark, sf, name):
    import __spark_entry__ as entry

    entry.queries()[name](spark, sf)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_operators_build_without_jobs(spark, sf):
    """Queries fetch their dates and write the hourly base while they are built; what they are built from runs nothing."""
    from loadshift import fixtures as fx
    from loadshift.catalog.features import CONFIG
    from loadshift.operators import clean
    from loadshift.plans import stages

    span, readings = fx.span(spark, sf), fx.readings(spark, sf)
    spark.sparkContext.setJobGroup("operators", "operators")
    prepared = stages.prepare(None, CONFIG, span.today, stages.hourly_base(readings, CONFIG))
    predicted = stages.predict(prepared, "rate", span.first, span.last)
    stages.back_test(stages.recommendation_inputs(predicted, fx.households(spark, sf), fx.prices(spark, sf), span.first, span.last), prepared, [0.5], [0.5])
    clean.outlier_truncation(prepared.load, ["household_id"], "load")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("operators")
    spark.sparkContext.setJobGroup("", "")
    assert not jobs


def test_leap_day_is_not_replicated(spark, tmp_path):
    (tmp_path / "p.csv").write_text("MTU (UTC),Price\n29.02.2024 00:00 - 29.02.2024 01:00,5\n01.03.2024 00:00 - 01.03.2024 01:00,6\n")
    out = price_source.read_price_csv(spark, str(tmp_path), 2024, (2023, 2024))
    assert sorted((r.time.year, r.time.day, r.price) for r in out.collect()) == [(2023, 1, 6.0), (2024, 1, 6.0), (2024, 29, 5.0)]


def test_optimal_thresholds_prefer_savings_then_larger_thresholds(spark):
    rows = [(1, 0.1, 0.1, 5.0), (1, 0.2, 0.1, 7.0), (1, 0.1, 0.2, 7.0)]
    df = spark.createDataFrame(rows, "household_id int, activity_threshold double, usage_threshold double, total_savings double")
    best = backtest.optimal_thresholds(df).first()
    assert (best.activity_threshold, best.usage_threshold) == (0.2, 0.1)


@pytest.mark.parametrize("saved", [0.25])
def test_sentence_of_missing_recommendation(spark, saved):
    df = spark.sql("SELECT 'Washer' AS friendly_name, CAST(NULL AS INT) AS recommendation, 3 AS best_launch_hour, DATE'2024-03-01' AS recommendation_date")
    row = df.select(recommend.savings_sentence(F.lit(saved)).alias("t"), recommend.device_sentence().alias("d")).first()
    assert row.t == "There is no recommendation for the device Washer ." and row.d is None


GRID_ROW = """household_id int, device string, date date, costs array<double>, probs array<double>, usage_p double, prices array<double>,
    usage_true int, activity_true array<int>, starts array<struct<hour:int,load:array<double>>>"""


def random_rows(seed, n=60):
    rng = random.Random(seed)

    def some(make, share=0.1):
        return None if rng.random() < share else make()

    def one(i):
        level = rng.choice([4, 24])  # four levels give many equal probabilities and thresholds that hit them
        starts = sorted(rng.sample(range(24), rng.randint(1, 3)))
        return (
            rng.choice([1, 2, 2, 2]), f"d{i % 3}", date(2024, 3, 1) + timedelta(days=i),
            some(lambda: [some(lambda: float(rng.randint(0, 9)), 0.05) for _ in range(24)]),
            some(lambda: [some(lambda: rng.randint(0, level) / level, 0.05) for _ in range(24)]),
            some(lambda: rng.randint(0, 4) / 4),
            [float(rng.randint(-3, 9)) for _ in range(48)], some(lambda: rng.randint(0, 1)),
            some(lambda: [some(lambda: rng.randint(0, 1)) for _ in range(24)]),
            some(lambda: [(h, [rng.random() for _ in range(24)]) for h in starts]),
        )

    return [one(i) for i in range(n)]


def test_sweep_equals_grid(spark):
    """Nulls in every input, equal probabilities, thresholds on them, unsorted and repeated ones; a household that recommends nothing."""
    silent = (3, "a", date(2024, 3, 1), None, None, None, [1.0] * 48, None, None, None)
    df = spark.createDataFrame([*random_rows(5), silent], GRID_ROW)
    activity, usage = [0.75, 0.0, 0.25, 0.3, 1.0, 0.25, 2.0], [1.0, 0.1, 0.5, 1.5]
    got = {(r.household_id, r.activity_threshold, r.usage_threshold): r for r in sweep.sweep(df, activity, usage).collect()}
    want = backtest.grid_search(df, sorted(set(activity)), usage).collect()
    assert len(got) == len(want) == 3 * 6 * 4
    assert any(r.n_recommendations for r in want) and any(r.total_savings for r in want)
    for r in want:
        g = got[(r.household_id, r.activity_threshold, r.usage_threshold)]
        assert g.n_recommendations == r.n_recommendations
        for c in ("acceptable", "total_savings", "relative_savings_mean"):
            assert g[c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-9)), c
    assert sweep.sweep(df.limit(0), activity, usage).count() == 0
    with pytest.raises(ValueError):
        sweep.sweep(df, [], usage)


def test_sweep_rows_do_not_follow_the_pairs(spark):
    """10,000 pairs send no more rows than the 24 probabilities allow, and repeated thresholds change nothing."""
    df = spark.createDataFrame(random_rows(6), GRID_ROW)
    fine = [i / 100 for i in range(1, 101)]
    assert sweep.stretches(df, fine, fine).count() <= 25 * df.count()
    assert sweep.corners(df, fine, fine).count() <= 48 * df.count() + 2
    swept = sweep.sweep(df, fine, fine)
    assert swept.count() == 2 * 10_000
    best = backtest.optimal_thresholds(swept)
    whole = {r.household_id: r for r in sweep.summary_at(df, best).collect()}
    for r in backtest.optimal_result(swept).collect():
        w = whole[r.household_id]
        assert (w.n_recommendations, w.activity_threshold, w.usage_threshold) == (r.n_recommendations, r.activity_threshold, r.usage_threshold)
        assert w.total_savings == pytest.approx(r.total_savings, abs=1e-9)
