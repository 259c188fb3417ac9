"""Model inputs: flags, lags, periods since last use, time features.

Every window is partitioned by household (and device) over hourly or daily tables, whose size is
bounded by the clock and not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadshift.functions.expressions import day_dummies
from loadshift.operators.hourly import dense_hours, hourly_means, inline_devices, to_long, value_columns


def usage_flag(col: Column | str, threshold: float) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return (col >= threshold).cast("int")


def activity_flag(columns: list[str], threshold: float | str) -> Column:
    """1 if any column reaches the threshold, a number or the name of a column."""
    limit = threshold if isinstance(threshold, str) else f"{threshold!r}D"
    return F.expr(f"cast({' OR '.join(f'{c} >= {limit}' for c in columns)} AS int)")


def masked(col: str, threshold: float) -> Column:
    """The value where it reaches the threshold, else 0."""
    return F.when(F.col(col) >= threshold, F.col(col)).otherwise(F.lit(0.0))


def lags(feature: str, steps: tuple[int, ...], w: WindowSpec) -> list[Column]:
    return [F.lag(feature, k).over(w).alias(f"{feature}_lag_{k}") for k in steps]


def with_periods_since_last(df: DataFrame, features: list[str], w: WindowSpec) -> DataFrame:
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_row", F.row_number().over(w))
    for f in features:
        used = F.last(F.when(F.col(f) != 0, F.col("_row")), ignorenulls=True).over(before)
        since = F.when(F.col("_row") > 1, F.col("_row") - F.coalesce(used, F.lit(0)))
        out = out.withColumn(f"periods_since_last_{f}", since.cast("int"))
    return out.drop("_row")


def activity_features(
    states: DataFrame | None,
    devices: list[str],
    threshold: float,
    today: str,
    steps: tuple[int, ...] = (24, 48, 72),
    means: DataFrame | None = None,
) -> DataFrame:
    """Per household and hour: activity, hour, weekday dummies and activity lags. ``means`` are the devices' hourly means, if at hand."""
    cols = value_columns(devices)
    means = hourly_means(states, devices, with_switches=True) if means is None else means
    grid = dense_hours(means, cols, ["household_id"], today)
    w = Window.partitionBy("household_id").orderBy("hour_ts")
    flagged = grid.select("household_id", "hour_ts", activity_flag(cols, threshold).alias("activity"))
    return flagged.select(
        "*", F.hour("hour_ts").cast("int").alias("hour"), *day_dummies("hour_ts"), *lags("activity", steps, w)
    )


def usage_group(devices: list[str], activity_devices: list[str] | None = None) -> list[str]:
    """The devices whose hourly means ``daily_usage`` needs."""
    return list(devices) + [d for d in (activity_devices or []) if d not in devices]


def daily_usage(
    states: DataFrame | None,
    devices: list[str],
    threshold: float,
    today: str | None,
    activity_devices: list[str] | None = None,
    means: DataFrame | None = None,
) -> DataFrame:
    """household_id, device, day, usage, activity: was anything used that day? ``means`` are those of ``usage_group``, if at hand."""
    group = usage_group(devices, activity_devices)
    cols = value_columns(group)
    active = cols if activity_devices else cols[: len(devices)]
    grid = dense_hours(hourly_means(states, group) if means is None else means, cols, ["household_id"], today)
    day = F.to_date("hour_ts").alias("day")
    flags = [F.max(usage_flag(c, threshold)).alias(c) for c in cols[: len(devices)]]
    per_day = grid.groupBy("household_id", day).agg(F.max(activity_flag(active, threshold)).alias("activity"), *flags)
    return per_day.select("household_id", "day", "activity", inline_devices(cols[: len(devices)], devices, "usage"))


def usage_features(
    states: DataFrame | None,
    devices: list[str],
    threshold: float,
    today: str | None,
    steps: tuple[int, ...] = (1, 2, 3),
    activity_devices: list[str] | None = None,
    means: DataFrame | None = None,
) -> DataFrame:
    """Per household, device and day: flags, periods since last use, lags, time features."""
    daily = daily_usage(states, devices, threshold, today, activity_devices, means)
    w = Window.partitionBy("household_id", "device").orderBy("day")
    out = with_periods_since_last(daily, ["activity", "usage"], w)
    out = out.select("*", *lags("activity", steps, w), *lags("usage", steps, w))
    return out.select(
        "*",
        active_last_2_days().alias("active_last_2_days"),
        F.lit(0).alias("hour"),
        *day_dummies("day"),
    )


def active_last_2_days() -> Column:
    """NULL lags compare false."""
    return F.expr("cast(coalesce(activity_lag_1 = 1, false) OR coalesce(activity_lag_2 = 1, false) AS int)")


def load_input(
    states: DataFrame | None, devices: list[str], threshold: float, today: str | None = None, means: DataFrame | None = None
) -> DataFrame:
    """household_id, device, hour_ts, value (hourly mean), usage flag and load (0 below the threshold)."""
    cols = value_columns(devices)
    grid = dense_hours(hourly_means(states, devices) if means is None else means, cols, ["household_id"], today)
    long = to_long(grid, devices)
    return long.select("*", usage_flag("value", threshold).alias("usage"), masked("value", threshold).alias("load"))


def candidates_reached(value: str, rising: list[float]) -> Column:
    """How many of the rising candidates a value reaches, by halving steps over a literal array."""
    limits = f"array({', '.join(f'{t!r}D' for t in rising)})"
    halves = ", ".join(str(1 << k) for k in reversed(range(len(rising).bit_length())))
    step = f"(lo, step) -> if(coalesce(get({limits}, lo + step - 1) <= {value}, false), lo + step, lo)"
    return F.expr(f"aggregate(array({halves}), 0, {step})")


def threshold_profile(
    states: DataFrame, devices: list[str], thresholds: list[float], today: str | None = None
) -> DataFrame:
    """Share of active / used hours by hour, weekday and month, per household and for every candidate threshold.

    An hour counts once for each series, the devices and the largest of them, in the interval between neighbouring candidates where
    its value lies; a candidate's count is the sum of all intervals above it, a running sum from the largest one down. All hours are one
    more series, which reaches every candidate. Neither rows nor columns multiply by the candidates before the hours are summed, so there
    may be thousands of them. The household is part of every key, so the layout of the hourly grid serves all steps; a task holds the
    counts of a household's 43 hours, weekdays and months at most, not those of their combinations.
    """
    cols = value_columns(devices)
    rising = sorted({float(t) for t in thresholds})
    grid = dense_hours(hourly_means(states, devices, with_switches=True), cols, ["household_id"], today)
    values = [cols[0] if len(cols) == 1 else f"greatest({', '.join(cols)})", *cols]
    items = ", ".join(f"named_struct('series', {i}, 'value', {v})" for i, v in enumerate(values))
    placed = grid.selectExpr("household_id", "hour_ts", f"inline(array({items}))").select("household_id", "hour_ts", "series", candidates_reached("value", rising).alias("reached"))
    every = f"if(series = 0, array(struct(series, reached), struct(-1 AS series, {len(rising)} AS reached)), array(struct(series, reached)))"
    dims = {"hour": "hour", "day_of_week": "weekday", "month": "month"}
    buckets = ", ".join(f"named_struct('dimension', '{name}', 'bucket', cast({part}(hour_ts) AS int))" for name, part in dims.items())
    cell = ["household_id", "dimension", "bucket"]
    reached = placed.selectExpr("household_id", "hour_ts", f"inline({every})").selectExpr("household_id", "series", "reached", f"inline(array({buckets}))")
    by_cell = reached.groupBy(*cell, "series", "reached").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy(*cell, "series").orderBy(F.desc("reached"))
    above = by_cell.withColumn("above", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.coalesce(F.lead("reached").over(down), F.lit(0)))
    # A count holds for all candidates down to the next value that occurs; candidates above all values have no row yet.
    served = above.filter("reached > _next").select(*cell, "series", "above", F.explode(F.sequence(F.col("_next") + 1, F.col("reached"))).alias("place"))
    names = ["activity", *[f"{d}_usage" for d in devices]]
    total = "max(CASE WHEN series = -1 THEN above END)"
    shares = [F.expr(f"coalesce(max(CASE WHEN series = {i} THEN above END), 0) / {total} AS `{name}`") for i, name in enumerate(names)]
    rows = served.groupBy(*cell, "place").agg(*shares)
    limits = f"array({', '.join(f'{t!r}D' for t in rising)})"
    return rows.select("household_id", F.expr(f"get({limits}, place - 1) AS threshold"), "dimension", "bucket", *[F.col(f"`{n}`") for n in names])
