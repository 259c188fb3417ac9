"""Walk-forward training counts as running sums, and the positive rate per cell as a predictor.

The model features are discrete, so a training set "as of" a date is a table of counts per cell. Running
sums over days give every date's counts in one pass, where refitting would read the history once per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USAGE_CELLS = 8
ACTIVITY_LEAD_DAYS = 3


def _first_day(day: str, keys: list[str]):
    return F.min(day).over(Window.partitionBy(*keys))


def activity_split(features: DataFrame, train_days: int | None = None, floor: str | None = None) -> DataFrame:
    """Per household and date: rows and positives of the training set up to the end of that date and of the test day.

    ``train_days`` starts the training that many days before the date, never before ``floor``; without
    it training starts 3 days after the first row. A sliding start is the difference of two running sums.
    """
    day = F.to_date("hour_ts").alias("date")
    daily = features.groupBy("household_id", day).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce("activity", F.lit(0))).alias("positives")
    )
    by_day = Window.partitionBy("household_id").orderBy("date")
    ordered = Window.partitionBy("household_id").orderBy(F.datediff("date", F.lit("1970-01-01")))
    if train_days is None:
        start = F.date_add(_first_day("date", ["household_id"]), ACTIVITY_LEAD_DAYS)
        frame = ordered.rangeBetween(Window.unboundedPreceding, 0)
    else:
        start = F.lit(floor).cast("date") if floor else F.min("date").over(Window.partitionBy("household_id"))
        frame = ordered.rangeBetween(-train_days, 0)
    usable = daily.withColumn("_ok", F.col("date") >= start)
    return usable.select(
        "household_id",
        "date",
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("rows"))).over(frame), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum(F.when(F.col("_ok"), F.col("positives"))).over(frame), F.lit(0)).alias("train_positives"),
        F.lead("rows").over(by_day).alias("test_rows"),
        F.lead("positives").over(by_day).alias("test_positives"),
    ).filter(F.col("test_rows").isNotNull())


def activity_rates(features: DataFrame) -> DataFrame:
    """household_id, date, hour, p, y: share of active days at that hour in the training set of ``date``.

    The row predicts ``hour`` of date + 1, whose truth is y; ``truth`` is the flag of ``date`` itself and
    n_pos, n_neg are the training counts. p is NULL while nothing was trained.
    """
    rows = features.select("household_id", F.to_date("hour_ts").alias("date"), "hour", "activity")
    start = F.date_add(_first_day("date", ["household_id"]), ACTIVITY_LEAD_DAYS)
    used = rows.withColumn("_ok", F.col("date") >= start)
    by_day = Window.partitionBy("household_id", "hour").orderBy("date")
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum(F.when(F.col("_ok"), 1).otherwise(0)).over(upto)
    positives = F.sum(F.when(F.col("_ok"), F.col("activity")).otherwise(0)).over(upto)
    return used.select(
        "household_id",
        "date",
        "hour",
        start.alias("start_date"),
        F.col("activity").alias("truth"),
        F.when(n > 0, positives / n).alias("p"),
        positives.alias("n_pos"),
        (n - positives).alias("n_neg"),
        F.lead("activity").over(by_day).alias("y"),
        F.lead("date").over(by_day).alias("target_date"),
    )


def activity_rate_arrays(rates: DataFrame) -> DataFrame:
    """household_id, date, probs[24] and activity_true[24], only for dates with a trained day before a predictable one."""
    usable = rates.filter(F.col("p").isNotNull() & F.col("target_date").isNotNull())
    each = usable.groupBy("household_id", "date").agg(F.expr("sort_array(collect_list(struct(hour, p, y))) AS _hours"))
    return each.select("household_id", "date", F.expr("transform(_hours, s -> s.p) AS probs"), F.expr("transform(_hours, s -> s.y) AS activity_true"))


def usage_cell():
    """The three binary features of the usage model as one number 0..7."""
    return F.expr("coalesce(usage_lag_1, 0) * 4 + coalesce(usage_lag_2, 0) * 2 + active_last_2_days")


def usage_counts(features: DataFrame) -> DataFrame:
    """Per household, device and date: training rows n[8] and positives pos[8] per feature cell up to that date."""
    keys = ["household_id", "device"]
    rows = features.select(*keys, F.col("day").alias("date"), "usage", usage_cell().alias("cell"))
    start = F.date_add(_first_day("date", keys), ACTIVITY_LEAD_DAYS)
    used = rows.withColumn("_ok", F.col("date") >= start)
    by_day = "(PARTITION BY household_id, device ORDER BY date"
    upto = f"OVER {by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def running(value: str) -> str:
        cells = [f"sum(CASE WHEN _ok AND cell = {c} THEN {value} ELSE 0 END) {upto}" for c in range(USAGE_CELLS)]
        return f"array({', '.join(cells)})"

    return used.select(
        *keys,
        "date",
        F.expr(f"{running('1')} AS n"),
        F.expr(f"{running('usage')} AS pos"),
        F.expr(f"lead(cell) OVER {by_day}) AS next_cell"),
        F.expr(f"lead(usage) OVER {by_day}) AS y"),
        F.expr(f"lead(date) OVER {by_day}) AS target_date"),
    )


def cell_rates(counts: DataFrame) -> DataFrame:
    """Add rate[8]: positive share per cell, the overall share where a cell was never trained."""
    total = "aggregate({}, 0L, (acc, x) -> acc + x)"
    out = counts.selectExpr("*", f"{total.format('n')} AS _n", f"{total.format('pos')} AS _pos")
    rate = "zip_with(pos, n, (p, n) -> if(n > 0, p / n, if(_n > 0, _pos / _n, NULL))) AS rate"
    return out.selectExpr("*", rate).drop("_n", "_pos")


def usage_train_cells(rated: DataFrame) -> DataFrame:
    """household_id, device, date, p, n_pos, n_neg: the training rows of each date by feature cell."""
    cells = "inline(arrays_zip(rate, pos, zip_with(n, pos, (a, b) -> a - b))) AS (p, n_pos, n_neg)"
    return rated.selectExpr("household_id", "device", "date", cells).filter("n_pos + n_neg > 0")


def usage_rates(features: DataFrame) -> DataFrame:
    """household_id, device, date, p, y: the rate of tomorrow's cell as known on ``date``."""
    return next_rates(cell_rates(usage_counts(features)))


def next_rates(rated: DataFrame) -> DataFrame:
    """The same from a table of ``cell_rates``."""
    return rated.filter(F.col("target_date").isNotNull()).select(
        "household_id", "device", "date", "target_date", F.get("rate", F.col("next_cell")).alias("p"), "y"
    ).filter(F.col("p").isNotNull())
