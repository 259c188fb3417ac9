"""Hand-made tables for the cases the derived data does not hold."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadshift.operators import clean, features, hourly, runs

T0 = datetime(2024, 1, 1)


def states(spark, rows):
    """rows: household, entity, state, timestamp, unit"""
    return spark.createDataFrame(
        rows, "household_id int, entity_id string, state string, last_updated_ts timestamp, unit_of_measurement string"
    )


def load(spark, values, start=T0, device="a"):
    rows = [(1, device, start + timedelta(hours=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "household_id int, device string, hour_ts timestamp, load double")


def run_list(df):
    rows = runs.device_runs(df).orderBy("run_start", "offset").collect()
    return [(int((r.run_start - T0).total_seconds() // 3600), r.offset, r.load) for r in rows]


def test_mean_divides_by_timestamps_of_the_whole_group(spark):
    df = states(
        spark,
        [
            (1, "a", "10", T0 + timedelta(minutes=1), "W"),
            (1, "a", "20", T0 + timedelta(minutes=2), "W"),
            (1, "b", "60", T0 + timedelta(minutes=3), "W"),
            (1, "b", "unavailable", T0 + timedelta(minutes=4), "W"),
            (1, "c", "99", T0 + timedelta(minutes=5), "V"),
        ],
    )
    row = hourly.hourly_means(df, ["a", "b"]).first()
    assert (row.v0, row.v1) == (30 / 4, 60 / 4)


def test_switches_have_their_own_timestamps(spark):
    df = states(
        spark,
        [
            (1, "a", "10", T0, "W"),
            (1, "s", "on", T0 + timedelta(minutes=1), None),
            (1, "t", "on", T0 + timedelta(minutes=2), None),
            (1, "t", "off", T0 + timedelta(minutes=3), None),
        ],
    )
    row = hourly.hourly_means(df, ["a", "s", "t"], with_switches=True).first()
    assert (row.v0, row.v1, row.v2) == (10.0, 0.5, 0.5)


def test_gaps_are_zero_and_grid_reaches_tomorrow_evening(spark):
    df = states(spark, [(1, "a", "5", T0 + timedelta(hours=h), "W") for h in (3, 6)])
    out = hourly.dense_hours(hourly.hourly_means(df, ["a"]), ["v0"], ["household_id"], "2024-01-03")
    values = {r.hour_ts: r.v0 for r in out.collect()}
    assert values[T0 + timedelta(hours=4)] == 0 and values[T0 + timedelta(hours=6)] == 5
    # 24 - 6 + 23 + 24 * 2 hours follow the last one
    assert max(values) == T0 + timedelta(hours=6 + 24 - 6 + 23 + 48)
    assert len(values) == 4 + 24 - 6 + 23 + 48


def test_resample_counts_bins_from_midnight(spark):
    df = states(spark, [(1, "a", "4", T0 + timedelta(minutes=m), "W") for m in (1, 6, 7, 22)])
    df = df.withColumn("v", F.col("state").cast("double"))
    out = hourly.resample_mean(df, ["household_id"], "last_updated_ts", ["v"], "7T").orderBy("last_updated_ts")
    assert [(r.last_updated_ts.minute, r.v) for r in out.collect()] == [(0, 4.0), (7, 4.0), (14, None), (21, 4.0)]


def test_resample_below_a_minute_and_across_days(spark):
    df = states(spark, [(1, "a", v, T0 + timedelta(seconds=s), "W") for s, v in ((20, "1"), (29, "3"), (46, "5"), (90, "7"))])
    df = df.withColumn("v", F.col("state").cast("double"))
    out = hourly.resample_mean(df, ["household_id"], "last_updated_ts", ["v"], "15S").orderBy("last_updated_ts")
    assert [((r.last_updated_ts - T0).total_seconds(), r.v) for r in out.collect()] == [(15, 2.0), (30, None), (45, 5.0), (60, None), (75, None), (90, 7.0)]
    lengths = {"30S": 30, "90s": 90, "7T": 420, "7min": 420, "24H": 86400, "h": 3600, "1D": 86400, "2W": 1209600}
    assert {p: hourly.period_seconds(p) for p in lengths} == lengths
    for bad in ("", "7", "0T", "1M", "x"):
        with pytest.raises(ValueError):
            hourly.period_seconds(bad)


def test_run_in_first_row_keeps_one_hour(spark):
    assert run_list(load(spark, [5, 6, 0, 7, 8, 0])) == [(0, 0, 5.0), (3, 0, 7.0), (3, 1, 8.0)]


def test_run_stops_after_24_hours_and_does_not_restart(spark):
    got = run_list(load(spark, [0] + [1] * 30 + [0, 2]))
    assert [x for x in got if x[0] == 1] == [(1, i, 1.0) for i in range(24)]
    assert got[-1] == (32, 0, 2.0) and len(got) == 25


def test_negative_load_ends_a_run_without_starting_one(spark):
    assert run_list(load(spark, [0, 3, -1, 4, 0, 5])) == [(1, 0, 3.0), (5, 0, 5.0)]


def test_profile_of_running_device_counts_hours_before_the_date(spark):
    values = [0] * 22 + [10, 20, 30, 40] + [0] * 46
    got = {r.date: r for r in runs.profiles_by_date(load(spark, values)).collect()}
    assert got[date(2024, 1, 1)].n_runs == 0 and sum(got[date(2024, 1, 1)].load) == 0
    assert got[date(2024, 1, 2)].load[:4] == [10, 20, 0, 0]
    assert got[date(2024, 1, 3)].load[:4] == [10, 20, 30, 40]


def test_profiles_match_brute_force(spark):
    import random

    rng = random.Random(3)
    values = [rng.choice([0, 0, 0, 5, 7]) for _ in range(24 * 12)]
    got = {r.date: r for r in runs.profiles_by_date(load(spark, values)).collect()}
    for d in range(12):
        cut = values[: 24 * d]
        found = []
        for i, v in enumerate(cut):
            if v > 0 and (i == 0 or cut[i - 1] == 0):
                length = 1
                while i > 0 and length < 24 and i + length < len(cut) and cut[i + length] > 0:
                    length += 1
                found.append(cut[i : i + length] + [0] * (24 - length))
        want = [sum(col) / len(found) for col in zip(*found)] if found else [0.0] * 24
        row = got[date(2024, 1, 1 + d)]
        assert row.n_runs == len(found) and row.load == pytest.approx(want)


def test_load_mass_is_kept_by_runs(spark):
    values = [0, 1, 2, 0, 3, 0, 0, 4, 5, 6]
    total = runs.device_runs(load(spark, values)).agg(F.sum("load")).first()[0]
    assert total == sum(values)


def test_incomplete_first_day_is_dropped(spark):
    df = load(spark, [1] * 60, T0 + timedelta(hours=5))
    days = clean.drop_incomplete_first_day(df, ["household_id", "device"], "hour_ts")
    assert days.agg(F.min("hour_ts")).first()[0] == T0 + timedelta(days=1)
    end = clean.prove_start_end(df, ["household_id", "device"], "hour_ts", "2024-01-03")
    assert end.agg(F.max("hour_ts")).first()[0] == datetime(2024, 1, 2, 23)


def test_periods_since_last_use(spark):
    from pyspark.sql import Window

    df = load(spark, [0, 0, 1, 0, 0, 1, 1])
    out = features.with_periods_since_last(df, ["load"], Window.partitionBy("device").orderBy("hour_ts"))
    got = [r.periods_since_last_load for r in out.orderBy("hour_ts").collect()]
    assert got == [None, 2, 3, 1, 2, 3, 1]


def test_truncation_uses_integer_bounds_and_leaves_zeros(spark):
    df = load(spark, [0, 0, 0, 1, 2, 3, 4, 100])
    out = clean.outlier_truncation(df, ["device"], "load", 1.5, non_zero=True).orderBy("hour_ts")
    # quartiles of 1, 2, 3, 4, 100 are 2 and 4, so the upper bound is 7
    assert [r.load for r in out.collect()] == [0, 0, 0, 1, 2, 3, 4, 7]


def test_constant_column_scales_to_zero(spark):
    out = clean.scale(load(spark, [4, 4, 4]), ["device"], "load")
    assert {r.load for r in out.collect()} == {0.0}
    with pytest.raises(ValueError):
        clean.scale(load(spark, [1]), ["device"], "load", kind="Standard")


def test_sparse_columns_follow_the_column_count(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None), (3, None, None)], "a int, b string, c string")
    # three columns: int(0.95 * 3) = 2 values needed
    assert clean.drop_sparse_columns(df).columns == ["a"]


def test_unparsable_attributes_stay_null(spark):
    df = spark.createDataFrame([(1, '{"unit_of_measurement": "W"}'), (2, None), (3, "{broken")], "id int, shared_attrs string")
    got = {r.id: r.unit_of_measurement for r in clean.unpack_attributes(df).collect()}
    assert got == {1: "W", 2: None, 3: None}


def test_latest_friendly_name_wins(spark):
    rows = [(1, "a", "1", T0 + timedelta(days=d), "W") for d in (1, 2)]
    df = states(spark, rows).withColumn(
        "friendly_name", F.when(F.dayofmonth("last_updated_ts") == 2, "old").otherwise("new")
    )
    assert clean.latest_friendly_name(df, ["a"], "2024-01-10").first().friendly_name == "new"
