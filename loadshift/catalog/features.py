"""Feature tables, runs and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadshift import fixtures as fx
from loadshift.catalog.registry import big, day, integer, query, r6, ts
from loadshift.config import Config, geometric_grid
from loadshift.operators import clean, features, rates, runs
from loadshift.operators.hourly import dense_hours, hourly_means, value_columns
from loadshift.operators.models import USAGE_FEATURES, activity_split, usage_split
from loadshift.plans import stages
from loadshift.session import write_once

CONFIG = Config(tuple(fx.SHIFTABLE), tuple(fx.ACTIVE), fx.THRESHOLD)


def today(spark: SparkSession, sf: str) -> str:
    return fx.span(spark, sf).today


def load_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.load_input(fx.readings(spark, sf), fx.SHIFTABLE, fx.THRESHOLD, today(spark, sf))


def activity_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.activity_features(fx.readings(spark, sf), fx.ACTIVE, fx.THRESHOLD, today(spark, sf))


def usage_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.usage_features(fx.readings(spark, sf), fx.SHIFTABLE, fx.THRESHOLD, today(spark, sf))


def prepared(spark: SparkSession, sf: str) -> stages.Prepared:
    """All three tables from one written hourly base, for queries that need more than one of them or one of them twice."""
    base = write_once(stages.hourly_base(fx.readings(spark, sf), CONFIG), "hourly_base")
    return stages.prepare(None, CONFIG, today(spark, sf), base)


# flags --------------------------------------------------------------------------------------------


@query
def f10_complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Usage rows from the first date on which nothing is missing."""
    out = usage_table(spark, sf).na.drop()
    return out.groupBy("household_id", "device").agg(day(F.min("day"), "first_day"), big(F.count(F.lit(1)), "n"))


@query
def f11_usage_flags(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf).select("household_id", "device", ts("hour_ts"), "usage")


@query
def f12_activity_flags(spark: SparkSession, sf: str) -> DataFrame:
    """1 where any device reaches the threshold in the hour."""
    return activity_table(spark, sf).select("household_id", ts("hour_ts"), "activity")


@query
def f13_masked_load(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf).select("household_id", "device", ts("hour_ts"), r6("load"))


@query
def f14_active_last_2_days(spark: SparkSession, sf: str) -> DataFrame:
    out = usage_table(spark, sf)
    return out.select("household_id", "device", day("day"), "activity_lag_1", "activity_lag_2", "active_last_2_days")


@query
def f15_binarised_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The three comparisons: daily mean > 0, score > threshold, score >= threshold."""
    daily = load_table(spark, sf).groupBy("household_id", "device", F.to_date("hour_ts").alias("day")).agg(
        F.avg("usage").alias("p")
    )
    return daily.select(
        "household_id",
        "device",
        day("day"),
        (F.col("p") > 0).cast("int").alias("used"),
        (F.col("p") > 0.125).cast("int").alias("above"),
        (F.col("p") >= 0.125).cast("int").alias("reached"),
    )


@query
def f16_usage_model_columns(spark: SparkSession, sf: str) -> DataFrame:
    return usage_table(spark, sf).select("household_id", "device", day("day"), "usage", *USAGE_FEATURES)


# aggregates over features -------------------------------------------------------------------------


@query
def a4_daily_usage(spark: SparkSession, sf: str) -> DataFrame:
    out = features.daily_usage(fx.readings(spark, sf), fx.SHIFTABLE, fx.THRESHOLD, today(spark, sf))
    return out.select("household_id", "device", day("day"), "usage", "activity")


@query
def p2_usage_all_devices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily flags whose activity looks at every power device instead of the shiftable ones."""
    out = features.daily_usage(fx.readings(spark, sf), fx.SHIFTABLE, fx.THRESHOLD, today(spark, sf), fx.WATT)
    return out.select("household_id", "device", day("day"), "usage", "activity")


def _profile(spark: SparkSession, sf: str, thresholds: list[float]) -> DataFrame:
    out = features.threshold_profile(fx.readings(spark, sf), fx.ACTIVE, thresholds, today(spark, sf))
    return out.select(
        "household_id", r6("threshold"), "dimension", "bucket", r6("activity"), *[r6(f"{d}_usage") for d in fx.ACTIVE]
    )


@query
def a9_threshold_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Share of active and used hours by hour, weekday and month."""
    return _profile(spark, sf, [fx.THRESHOLD])


@query
def a10_threshold_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The profile for 0 and a geometric grid, in one job."""
    return _profile(spark, sf, geometric_grid(10.0, 80.0, 4))


@query
def a11_activity_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return activity_table(spark, sf).groupBy("household_id", "hour").agg(r6(F.avg("activity"), "activity"))


@query
def a13_date_range(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.day_range(fx.states(spark, sf), ["household_id"], "last_updated_ts")
    return out.select("household_id", day("first_date"), day("last_date"))


@query
def a13_start_dates(spark: SparkSession, sf: str) -> DataFrame:
    """First midnight without gaps per table; the run may start at the latest of them. A household without a table has NULL there."""
    a = clean.min_start_date(activity_table(spark, sf), ["household_id"], "hour_ts")
    u = clean.min_start_date(usage_table(spark, sf), ["household_id"], "day")
    lo = clean.min_start_date(load_table(spark, sf), ["household_id"], "hour_ts")
    named = [x.withColumnRenamed("start_date", n) for x, n in ((a, "activity"), (u, "usage"), (lo, "load"))]
    joined = named[0].join(named[1], "household_id", "full_outer").join(named[2], "household_id", "full_outer")
    every = F.col("activity").isNotNull() & F.col("usage").isNotNull() & F.col("load").isNotNull()
    combined = F.when(every, F.greatest("activity", "usage", "load"))
    return joined.select("household_id", day("activity"), day("usage"), day("load"), day(combined, "combined"))


@query
def a14_train_start(spark: SparkSession, sf: str) -> DataFrame:
    first = activity_table(spark, sf).groupBy("household_id").agg(F.to_date(F.min("hour_ts")).alias("d"))
    return first.select("household_id", day(F.date_add("d", 3), "train_start"))


# windows ------------------------------------------------------------------------------------------


@query
def w1_activity_lags(spark: SparkSession, sf: str) -> DataFrame:
    cols = [f"activity_lag_{k}" for k in CONFIG.activity_lags]
    return activity_table(spark, sf).select("household_id", ts("hour_ts"), "activity", *cols)


@query
def w1_usage_lags(spark: SparkSession, sf: str) -> DataFrame:
    cols = [f"{f}_lag_{k}" for f in ("activity", "usage") for k in CONFIG.usage_lags]
    return usage_table(spark, sf).select("household_id", "device", day("day"), *cols)


@query
def w2_periods_since_last(spark: SparkSession, sf: str) -> DataFrame:
    """Hours since a device drew power, strictly before the hour."""
    w = Window.partitionBy("household_id", "device").orderBy("hour_ts")
    out = features.with_periods_since_last(load_table(spark, sf), ["load"], w)
    return out.select("household_id", "device", ts("hour_ts"), "periods_since_last_load")


@query
def w3_w4_device_runs(spark: SparkSession, sf: str) -> DataFrame:
    out = runs.device_runs(load_table(spark, sf))
    return out.select("household_id", "device", ts("run_start"), "offset", r6("load"))


@query
def w5_run_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """24 loads per run, keyed by its start."""
    out = runs.run_vectors(load_table(spark, sf))
    hours = [r6(F.col("load")[j], f"h{j + 1}") for j in range(24)]
    return out.select("household_id", "device", ts("run_start"), *hours)


@query
def w6_starting_times(spark: SparkSession, sf: str) -> DataFrame:
    return runs.starting_times(load_table(spark, sf)).select("household_id", "device", ts("hour_ts"))


@query
def w7_starting_hours(spark: SparkSession, sf: str) -> DataFrame:
    out = runs.starting_hours(load_table(spark, sf))
    hours = F.array_join(F.transform("hours", lambda h: h.cast("string")), ",")
    return out.select("household_id", "device", day("day"), hours.alias("hours"))


@query
def w9_padding_to_tomorrow(spark: SparkSession, sf: str) -> DataFrame:
    """The grid goes on with zeros until 23:00 of the day after today."""
    cols = value_columns(fx.SHIFTABLE)
    hourly = hourly_means(fx.readings(spark, sf), fx.SHIFTABLE)
    out = dense_hours(hourly, cols, ["household_id"], today(spark, sf))
    return out.groupBy("household_id").agg(
        ts(F.min("hour_ts"), "first_hour"), ts(F.max("hour_ts"), "last_hour"), big(F.count(F.lit(1)), "n")
    )


@query
def w11_training_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and positives of every date's expanding training set, and of its test day."""
    out = rates.activity_split(activity_table(spark, sf))
    return _split(out)


@query
def m2_sliding_training_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same for a start 10 days before the date, never before the third day."""
    return _split(rates.activity_split(activity_table(spark, sf), 10, fx.span(spark, sf).on(2)))


def _split(out: DataFrame) -> DataFrame:
    counts = ["train_rows", "train_positives", "test_rows", "test_positives"]
    return out.select("household_id", day("date"), *[big(c) for c in counts])


@query
def m1_usage_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = usage_split(usage_table(spark, sf), fx.span(spark, sf).on(-10))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("household_id", "device", "part", day("day"), "usage", *USAGE_FEATURES)


@query
def m2_activity_split(spark: SparkSession, sf: str) -> DataFrame:
    """Training hours from 30 days before the date and the 24 test hours of the next day."""
    return _activity_split(spark, sf, 1)


@query
def m2_activity_split_open(spark: SparkSession, sf: str) -> DataFrame:
    """The same with all hours after the date to test on."""
    return _activity_split(spark, sf, None)


def _activity_split(spark: SparkSession, sf: str, test_days: int | None) -> DataFrame:
    train, test = activity_split(activity_table(spark, sf), fx.span(spark, sf).on(-10), -30, test_days)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    cols = ["activity", "hour", *[f"activity_lag_{k}" for k in (24, 48, 72)]]
    return both.select("household_id", "part", ts("hour_ts"), *cols)


# whole tables -------------------------------------------------------------------------------------


@query
def p1_activity_table(spark: SparkSession, sf: str) -> DataFrame:
    return activity_table(spark, sf).withColumn("hour_ts", ts("hour_ts"))


@query
def p2_usage_table(spark: SparkSession, sf: str) -> DataFrame:
    """Flags, periods since last use, lags and time features joined by key (one row per device and day)."""
    return usage_table(spark, sf).withColumn("day", day("day"))


@query
def p3_load_table(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf).select("household_id", "device", ts("hour_ts"), r6("value"), "usage", r6("load"))


@query
def a12_load_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = runs.load_profile(load_table(spark, sf))
    long = out.select("household_id", "device", "n_runs", F.posexplode("load").alias("offset", "load"))
    return long.select("household_id", "device", big("n_runs"), integer("offset"), r6("load"))


@query
def p5_profiles_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """The typical profile known on the morning of every date."""
    out = runs.profiles_by_date(stages.complete_days(load_table(spark, sf)))
    long = out.select("household_id", "device", "date", "n_runs", F.posexplode("load").alias("offset", "load"))
    return long.select("household_id", "device", day("date"), integer("n_runs"), integer("offset"), r6("load"))
