"""Device runs and typical load profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["household_id", "device"]
MAX_HOURS = 24


def mark_runs(load: DataFrame) -> DataFrame:
    """Add run_start and offset (0..23) to the hours that belong to a run; both NULL elsewhere.

    A run starts where the load turns positive after an hour at exactly 0, holds contiguous positive
    hours and ends after 24 of them. A run at the first row of the table keeps only its first hour.
    """
    w = Window.partitionBy(*KEYS).orderBy("hour_ts")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    positive = F.col("load") > 0
    first = F.row_number().over(w) == 1
    breaks = F.sum(F.when(positive, 0).otherwise(1)).over(upto)
    starts = positive & (first | (F.lag("load").over(w) == 0))
    out = load.withColumn("_breaks", breaks).withColumn("_is_start", starts).withColumn("_is_first", first)
    start = F.last(
        F.when(F.col("_is_start"), F.struct("hour_ts", F.col("_breaks").alias("breaks"), F.col("_is_first").alias("first"))),
        ignorenulls=True,
    ).over(upto)
    out = out.withColumn("_start", start)
    hours = (F.unix_timestamp("hour_ts") - F.unix_timestamp("_start.hour_ts")) / 3600
    inside = (
        positive
        & (F.col("_start.breaks") == F.col("_breaks"))
        & (hours < F.when(F.col("_start.first"), 1).otherwise(MAX_HOURS))
    )
    return out.select(
        *load.columns,
        F.when(inside, F.col("_start.hour_ts")).alias("run_start"),
        F.when(inside, hours.cast("int")).alias("offset"),
    )


def device_runs(load: DataFrame) -> DataFrame:
    """household_id, device, run_start, offset, load: the positive hours of each run."""
    return mark_runs(load).filter(F.col("run_start").isNotNull()).select(*KEYS, "run_start", "offset", "load")


def run_vectors(load: DataFrame) -> DataFrame:
    """One row per run with its 24 hourly loads as an array, missing hours 0."""
    per_offset = [f"coalesce(max(CASE WHEN offset = {j} THEN load END), 0D)" for j in range(MAX_HOURS)]
    vector = F.expr(f"array({', '.join(per_offset)}) AS load")
    return device_runs(load).groupBy(*KEYS, "run_start").agg(vector)


def load_profile(load: DataFrame) -> DataFrame:
    """Mean load per offset over all runs of a device; 0 without runs."""
    marked = mark_runs(load)
    runs = "sum(cast(offset = 0 AS int))"
    mean = [f"coalesce(sum(CASE WHEN offset = {j} THEN load END) / {runs}, 0D)" for j in range(MAX_HOURS)]
    return marked.groupBy(*KEYS).agg(
        F.expr(f"array({', '.join(mean)}) AS load"), F.expr(f"coalesce({runs}, 0) AS n_runs")
    )


def profiles_by_date(load: DataFrame) -> DataFrame:
    """household_id, device, date, n_runs, load[24]: the typical profile known on the morning of each date.

    Only hours before the date count, so a run in progress contributes its hours so far. Running sums
    over days replace one pass per date. The caller passes hours with a complete first day.
    """
    marked = mark_runs(load)
    sums = [F.expr(f"sum(CASE WHEN offset = {j} THEN load ELSE 0D END) AS o{j}") for j in range(MAX_HOURS)]
    starts = F.expr("sum(CASE WHEN offset = 0 THEN 1 ELSE 0 END) AS starts")
    daily = marked.groupBy(*KEYS, F.to_date("hour_ts").alias("date")).agg(starts, *sums)
    before = "OVER (PARTITION BY household_id, device ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    running = daily.select(
        *KEYS,
        "date",
        F.expr(f"cast(coalesce(sum(starts) {before}, 0) AS int) AS n_runs"),
        *[F.expr(f"sum(o{j}) {before} AS o{j}") for j in range(MAX_HOURS)],
    )
    mean = [f"if(n_runs > 0, o{j} / n_runs, 0D)" for j in range(MAX_HOURS)]
    return running.select(*KEYS, "date", "n_runs", F.expr(f"array({', '.join(mean)}) AS load"))


def starting_times(load: DataFrame) -> DataFrame:
    """Hours at which a device goes from 0 to non-zero; the row before the first counts as 0."""
    w = Window.partitionBy(*KEYS).orderBy("hour_ts")
    before = F.coalesce(F.lag("load").over(w), F.lit(0.0))
    return load.withColumn("_before", before).filter((F.col("_before") == 0) & (F.col("load") != 0)).select(
        *KEYS, "hour_ts"
    )


def starting_hours(load: DataFrame) -> DataFrame:
    """household_id, device, day, hours (sorted array, at most 12 a day); days without a start are absent."""
    return (
        starting_times(load)
        .groupBy(*KEYS, F.to_date("hour_ts").alias("day"))
        .agg(F.sort_array(F.collect_list(F.hour("hour_ts").cast("int"))).alias("hours"))
    )
