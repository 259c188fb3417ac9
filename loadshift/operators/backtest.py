"""Back-test of recommendations and threshold search.

One row per (household, device, date) carries everything the thresholds act on; threshold pairs are
exploded from a literal list in that row, so a grid search is one job without any threshold join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.functions.expressions import dot
from loadshift.operators.recommend import KEYS, recommend
from loadshift.operators.runs import run_vectors
from loadshift.session import spread

PAIR = ["activity_threshold", "usage_threshold"]
RESULT = [
    "recommendation",
    "acceptable",
    "relevant_start",
    "cost_no_recommendation",
    "cost_recommendation",
    "savings",
    "relative_savings",
]


def usage_truth(usage: DataFrame) -> DataFrame:
    """Was the device used on the recommended day (date + 1)?"""
    return usage.select("household_id", "device", F.date_sub("day", 1).alias("date"), F.col("usage").alias("usage_true"))


def activity_truth(activity: DataFrame) -> DataFrame:
    """The 24 activity flags of the recommended day."""
    day = F.date_sub(F.to_date("hour_ts"), 1).alias("date")
    by_hour = [f"max(CASE WHEN hour(hour_ts) = {h} THEN activity END)" for h in range(24)]
    return activity.groupBy("household_id", day).agg(F.expr(f"array({', '.join(by_hour)}) AS activity_true"))


def actual_starts(load: DataFrame) -> DataFrame:
    """The runs started on the recommended day: an array of (hour, load[24]), at most 12 a day."""
    return (
        run_vectors(load)
        .groupBy("household_id", "device", F.date_sub(F.to_date("run_start"), 1).alias("date"))
        .agg(F.sort_array(F.collect_list(F.struct(F.hour("run_start").cast("int").alias("hour"), "load"))).alias("starts"))
    )


def evaluation_inputs(
    predictions: DataFrame, usage: DataFrame, activity: DataFrame, load: DataFrame
) -> DataFrame:
    """predictions (costs, prices, probs, usage_p) with the truth of the recommended day."""
    return (
        predictions.join(usage_truth(usage), KEYS, "left")
        .join(activity_truth(activity), ["household_id", "date"], "left")
        .join(actual_starts(load), KEYS, "left")
    )


def with_starts(predictions: DataFrame, load: DataFrame) -> DataFrame:
    """The same for predictions that carry their truth, see ``recommend.join_predictions``."""
    return predictions.join(spread(actual_starts(load), KEYS), KEYS, "left")


def nearest_start(starts: str, hour: str) -> Column:
    """Start closest to ``hour``, the earlier one on ties; the first start of the day without an hour."""
    distance = f"transform({starts}, s -> named_struct('d', coalesce(abs(s.hour - {hour}), 0), 'hour', s.hour))"
    return F.expr(f"array_min({distance}).hour")


def run_cost(prices: str, hour: str, load: str) -> Column:
    """Cost of a run's load with the day's prices from ``hour`` on; NULL without an hour or prices."""
    return F.expr(f"if({hour} IS NULL OR {prices} IS NULL, NULL, {dot(f'slice({prices}, {hour} + 1, size({load}))', load)})")


def with_thresholds(df: DataFrame, activity_thresholds: list[float], usage_thresholds: list[float]) -> DataFrame:
    """Every threshold pair for every row; the pairs come from a literal list."""
    return df.select("*", _explode(activity_thresholds, PAIR[0])).select("*", _explode(usage_thresholds, PAIR[1]))


def _explode(values: list[float], name: str) -> Column:
    return F.expr(f"explode(array({', '.join(f'{float(v)!r}D' for v in values)})) AS {name}")


def _run_load(start: str) -> str:
    return f"coalesce(get(filter(starts, s -> s.hour = {start}), 0).load, array_repeat(0D, 24))"


def evaluate(recs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """recs: inputs of ``evaluation_inputs`` plus recommendation -> acceptability, costs and savings; ``keep`` names columns that stay."""
    priced = (
        recs.select(
            "*",
            F.expr("cast(usage_true * get(activity_true, recommendation) AS int) AS acceptable"),
            nearest_start("starts", "recommendation").alias("relevant_start"),
        )
        .withColumn("run_load", F.expr(_run_load("relevant_start")))
        .select(
            "*",
            run_cost("prices", "relevant_start", "run_load").alias("cost_no_recommendation"),
            run_cost("prices", "recommendation", "run_load").alias("cost_recommendation"),
        )
    )
    savings = F.col("cost_no_recommendation") - F.col("cost_recommendation")
    relative = F.when(F.col("cost_no_recommendation") != 0, savings / F.col("cost_no_recommendation"))
    return priced.select(
        *KEYS,
        *[c for c in [*PAIR, "usage_p", "without", *keep] if c in priced.columns],
        *RESULT[:5],
        savings.alias("savings"),
        relative.alias("relative_savings"),
    )


def evaluate_grid(inputs: DataFrame, activity_thresholds: list[float], usage_thresholds: list[float]) -> DataFrame:
    """Back-test every threshold pair.

    Best hour, start and costs depend on the activity threshold only; the usage threshold decides between
    that result and the one without a recommendation. Both stand in the row before the usage thresholds
    multiply it.
    """
    first = inputs.select("*", nearest_start("starts", "CAST(NULL AS INT)").alias("first_start"))
    first = first.withColumn("run_load", F.expr(_run_load("first_start")))
    first = first.withColumn("first_cost", run_cost("prices", "first_start", "run_load"))
    without = F.expr(
        """named_struct('recommendation', CAST(NULL AS INT), 'acceptable', CAST(NULL AS INT), 'relevant_start', first_start,
        'cost_no_recommendation', first_cost, 'cost_recommendation', CAST(NULL AS DOUBLE), 'savings', CAST(NULL AS DOUBLE),
        'relative_savings', CAST(NULL AS DOUBLE)) AS without"""
    )
    rows = first.select(*inputs.columns, without, _explode(activity_thresholds, PAIR[0]))
    given = evaluate(recommend(rows, PAIR[0], "usage_p"))
    pairs = given.select(
        *KEYS, PAIR[0], "usage_p", "without", F.struct(*RESULT).alias("given"), _explode(usage_thresholds, PAIR[1])
    )
    keep = f"usage_p >= {PAIR[1]} AND given.recommendation IS NOT NULL"
    return pairs.select(*KEYS, *PAIR, F.expr(f"if({keep}, given, without) AS chosen")).select(
        *KEYS, *PAIR, "chosen.*"
    )


def summarise(results: DataFrame) -> DataFrame:
    """Per household and threshold pair; a household's results are bounded by devices x dates."""
    return results.groupBy("household_id", *PAIR).agg(
        F.count("recommendation").alias("n_recommendations"),
        F.avg("acceptable").alias("acceptable"),
        F.coalesce(F.sum(F.col("acceptable") * F.col("savings")), F.lit(0.0)).alias("total_savings"),
        F.avg("relative_savings").alias("relative_savings_mean"),
        F.percentile("relative_savings", 0.5).alias("relative_savings_median"),
    )


def grid_search(inputs: DataFrame, activity_thresholds: list[float], usage_thresholds: list[float]) -> DataFrame:
    return summarise(evaluate_grid(inputs, activity_thresholds, usage_thresholds))


def sensitivity(summary: DataFrame, target: str, usage_thresholds: list[float]) -> DataFrame:
    """One summary value as a matrix activity threshold x usage threshold, sorted numerically."""
    return (
        summary.groupBy("household_id", "activity_threshold")
        .pivot("usage_threshold", sorted(usage_thresholds))
        .agg(F.first(target))
        .orderBy("household_id", "activity_threshold")
    )


def optimal_thresholds(summary: DataFrame, digits: int = 6) -> DataFrame:
    """The pair with the largest total savings per household; the larger thresholds win ties."""
    order = F.struct(F.round("total_savings", digits).alias("s"), *PAIR)
    best = F.max_by(F.struct(*PAIR), order)
    return summary.groupBy("household_id").agg(best.alias("_best")).select("household_id", "_best.*")


def optimal_result(summary: DataFrame, digits: int = 6) -> DataFrame:
    """The whole summary row of the optimal pair."""
    cols = [c for c in summary.columns if c != "household_id"]
    order = F.struct(F.round("total_savings", digits).alias("s"), *PAIR)
    return summary.groupBy("household_id").agg(F.max_by(F.struct(*cols), order).alias("_row")).select(
        "household_id", "_row.*"
    )
