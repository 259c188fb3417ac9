"""Cheapest acceptable launch hours.

Everything about one (household, device, date) fits in one row: 24 loads, 48 prices, 24 activity
probabilities. Costs and the arg-min are array expressions, so no 24 x 24 row blow-up is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.functions.expressions import sliding_costs
from loadshift.operators.joins import join_reference

KEYS = ["household_id", "device", "date"]
# Costs are compared after rounding to this many digits, so ties resolve to the earliest hour.
COST_DIGITS = 9


def with_costs(profiles: DataFrame, households: DataFrame, horizon: DataFrame) -> DataFrame:
    """profiles + costs[24]. A zone's horizon is one row per date, matched by all its households. A household without a zone stays,
    without costs."""
    zoned = join_reference(profiles, households.select("household_id", "zone"), ["household_id"])
    priced = join_reference(zoned, horizon, ["zone", "date"])
    return priced.withColumn("costs", sliding_costs("prices", "load"))


def cost_rows(costs: DataFrame) -> DataFrame:
    return costs.select(*KEYS, F.posexplode("costs").alias("hour", "cost"))


def cheapest_hour(costs: str = "costs", acceptable: str = "true") -> Column:
    """First hour of minimal cost among the acceptable ones; ``acceptable`` may use s.hour."""
    items = f"transform({costs}, (c, h) -> named_struct('cost', round(c, {COST_DIGITS}), 'hour', h))"
    usable = f"filter({items}, s -> s.cost IS NOT NULL AND coalesce({acceptable}, false))"
    return F.expr(f"cast(array_min({usable}).hour AS int)")


def recommend(inputs: DataFrame, activity_threshold: str | float, usage_threshold: str | float) -> DataFrame:
    """inputs: household_id, device, date, costs[24], probs[24], usage_p -> flags, best hour, recommendation.

    An hour is acceptable when its activity probability reaches the threshold. If no hour is, the best
    hour is the cheapest overall and the activity flag is 1. The usage flag is 1 when the usage
    probability stays below its threshold. Missing inputs give NULL flags and an error text. The
    thresholds are numbers or names of columns.
    """
    a = activity_threshold if isinstance(activity_threshold, str) else f"{float(activity_threshold)!r}D"
    any_ok = f"exists(probs, p -> coalesce(p >= {a}, false))"
    best = F.coalesce(cheapest_hour("costs", f"get(probs, s.hour) >= {a}"), cheapest_hour("costs"))
    zone = "zone IS NULL" if "zone" in inputs.columns else "false"
    error = f"""CASE WHEN {zone} THEN 'no price zone' WHEN best_launch_hour IS NULL THEN 'no price'
        WHEN probs IS NULL THEN 'no activity prediction' WHEN usage_p IS NULL THEN 'no usage prediction' END AS error"""
    out = inputs.select(
        "*",
        best.alias("best_launch_hour"),
        F.expr(f"if(probs IS NULL, NULL, cast(NOT {any_ok} AS int)) AS no_recommend_flag_activity"),
    )
    return gate(out.select("*", F.expr(error)), usage_threshold)


def gate(best: DataFrame, usage_threshold: str | float) -> DataFrame:
    """Add the usage flag and the recommendation: the best hour if both flags are 0."""
    u = usage_threshold if isinstance(usage_threshold, str) else f"{float(usage_threshold)!r}D"
    low = F.expr(f"cast(usage_p < {u} AS int) AS no_recommend_flag_usage")
    both = "no_recommend_flag_activity = 0 AND no_recommend_flag_usage = 0"
    return best.select("*", low).withColumn("recommendation", F.expr(f"CASE WHEN {both} THEN best_launch_hour END"))


def join_predictions(costs: DataFrame, activity: DataFrame, usage: DataFrame, truth: bool = False) -> DataFrame:
    """costs + probs[24] by (household, date) + usage_p by (household, device, date). With ``truth`` what the predicted day brought comes
    along from the same rows: activity_true[24] and usage_true, for the dates that have a prediction."""
    probs = activity.select("household_id", "date", "probs", *(["activity_true"] if truth else []))
    gate = usage.select(*KEYS, F.col("p").alias("usage_p"), *([F.col("y").alias("usage_true")] if truth else []))
    return costs.join(probs, ["household_id", "date"], "left").join(gate, KEYS, "left")


def recommendation_table(recs: DataFrame, names: DataFrame, keep: tuple[str, ...] = ("zone",)) -> DataFrame:
    """The published columns, with friendly names by LEFT join on device = entity_id and the key date_device; ``keep`` names further
    columns that stay, such as the day's prices."""
    named = recs.join(
        names.select("household_id", F.col("entity_id").alias("device"), "friendly_name"),
        ["household_id", "device"],
        "left",
    )
    tomorrow = F.date_add("date", 1)
    return named.select(
        F.concat_ws("_", F.date_format(tomorrow, "yyyy-MM-dd"), F.col("device")).alias("index"),
        "household_id",
        *[c for c in recs.columns if c in keep],
        F.col("date").alias("recommendation_calculation_date"),
        tomorrow.alias("recommendation_date"),
        "device",
        "friendly_name",
        "best_launch_hour",
        "no_recommend_flag_activity",
        "no_recommend_flag_usage",
        "recommendation",
        "error",
    )


# The texts below are fixed values.
def device_sentence() -> Column:
    """One device, one sentence; NULL without a recommendation."""
    text = F.format_string(
        "You have one recommendation for the following device: %s\nPlease use it on %s at %s.",
        "friendly_name",
        F.date_format("recommendation_date", "dd.MM.yyyy"),
        F.format_string("%02d:00", "best_launch_hour"),
    )
    return F.when(F.col("recommendation").isNotNull(), text)


def price_sentence(price: Column) -> Column:
    text = F.format_string(
        "You have a recommendation for the following device: %s\n\nPlease use the device on the %s at %s oclock "
        "because it costs you only %s €.\n",
        F.col("friendly_name"),
        F.date_format("recommendation_date", "dd.MM.yyyy"),
        F.format_string("%02d:00", "best_launch_hour"),
        F.round(price, 6).cast("string"),
    )
    return F.when(F.col("recommendation").isNotNull(), text)


def savings_percent(prices: str, hour: str) -> Column:
    """Percent saved against the mean of the day's 24 hourly prices."""
    mean = f"(aggregate(slice({prices}, 1, 24), 0D, (acc, x) -> acc + x) / 24)"
    return F.expr(f"round((1 - get({prices}, {hour}) / {mean}) * 100, 2)")


def savings_sentence(saved: Column) -> Column:
    text = F.format_string(
        "You have a recommendation for the following device: %s\n\nPlease use the device on the %s at %s o'clock "
        "because it saves you %s %% of costs compared to the mean of the day.\n",
        F.col("friendly_name"),
        F.date_format("recommendation_date", "dd.MM.yyyy"),
        F.format_string("%02d:00", "best_launch_hour"),
        saved.cast("string"),
    )
    none = F.concat(F.lit("There is no recommendation for the device "), F.col("friendly_name"), F.lit(" ."))
    return F.when(F.col("recommendation").isNotNull(), text).otherwise(none)


def hour_histogram(recs: DataFrame) -> DataFrame:
    return recs.filter(F.col("recommendation").isNotNull()).groupBy("recommendation").agg(
        F.count(F.lit(1)).alias("n")
    )


def time_line(recs: DataFrame) -> DataFrame:
    return recs.select("household_id", "device", "recommendation_date", "recommendation").orderBy(
        "household_id", "device", "recommendation_date"
    )
