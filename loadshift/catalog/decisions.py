"""Prices, costs, recommendations and their back-test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift import fixtures as fx
from loadshift.catalog.features import CONFIG, activity_table, load_table, prepared, usage_table
from loadshift.catalog.registry import big, day, integer, query, r6, ts
from loadshift.config import eighths
from loadshift.operators import backtest, clean, rates, recommend, sweep
from loadshift.operators.joins import join_reference
from loadshift.operators.prices import dense_prices, fill_from_previous_days, horizons, price_grid, shifted_prices
from loadshift.plans import stages
from loadshift.session import scratch_dir, write_once

ACTIVITY_THRESHOLD, USAGE_THRESHOLD = 0.15, 0.5
KEYS = ["household_id", "device"]


def window(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The first and the last date on which recommendations are made."""
    span = fx.span(spark, sf)
    return span.first, span.last


def horizon(spark: SparkSession, sf: str) -> DataFrame:
    return horizons(fx.prices(spark, sf), *window(spark, sf))


def costs(spark: SparkSession, sf: str, load: DataFrame | None = None) -> DataFrame:
    profiles = stages.typical_loads(load_table(spark, sf) if load is None else load, *window(spark, sf))
    return recommend.with_costs(profiles, fx.households(spark, sf), horizon(spark, sf))


def predictions(tables: stages.Prepared) -> tuple[DataFrame, DataFrame]:
    """Activity and usage probabilities with the truth of the predicted day beside them."""
    return rates.activity_rate_arrays(rates.activity_rates(tables.activity)), rates.usage_rates(tables.usage)


def inputs(spark: SparkSession, sf: str, tables: stages.Prepared | None = None) -> DataFrame:
    """Costs, activity probabilities and usage probabilities per (household, device, date)."""
    tables = tables or prepared(spark, sf)
    return recommend.join_predictions(costs(spark, sf, tables.load), *predictions(tables))


def names(spark: SparkSession, sf: str) -> DataFrame:
    return clean.latest_friendly_name(fx.readings(spark, sf), fx.SHIFTABLE, fx.span(spark, sf).now)


def recs(spark: SparkSession, sf: str, tables: stages.Prepared | None = None) -> DataFrame:
    """The recommendation table with zone and prices. The names, one row for each household and device, are written first."""
    found = recommend.recommend(inputs(spark, sf, tables), ACTIVITY_THRESHOLD, USAGE_THRESHOLD)
    return recommend.recommendation_table(found, write_once(names(spark, sf), "names"), ("zone", "prices"))


def evaluation_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is written once by its own tasks; the joins then hold no sorts of hours."""
    tables = prepared(spark, sf)
    activity, usage = predictions(tables)
    parts = write_once(activity, "activity_probabilities"), write_once(usage, "usage_probabilities")
    profiles = write_once(costs(spark, sf, tables.load), "costs")
    return backtest.with_starts(recommend.join_predictions(profiles, *parts, truth=True), tables.load)


def results(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.evaluate_grid(evaluation_inputs(spark, sf), eighths(), eighths())


def _show(table: DataFrame) -> DataFrame:
    return table.select(
        "index",
        "household_id",
        day("recommendation_calculation_date"),
        day("recommendation_date"),
        "device",
        "friendly_name",
        "best_launch_hour",
        "no_recommend_flag_activity",
        "no_recommend_flag_usage",
        "recommendation",
    )


# prices and costs ---------------------------------------------------------------------------------


@query
def cheapest_launch_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Cheapest launch hour of every device for the day after each date, and its cost."""
    best = recommend.cheapest_hour()
    out = costs(spark, sf).withColumn("best_launch_hour", best)
    return out.select(
        *KEYS, day("date"), "best_launch_hour", r6(F.get("costs", F.col("best_launch_hour")) * 1000, "cost_mill")
    )


@query
def j14_price_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Gap-free hours; a missing price is taken from one or two days earlier."""
    p = fx.prices(spark, sf)
    both = dense_prices(p).withColumnRenamed("price", "raw").join(fill_from_previous_days(p), ["zone", "hour"])
    return both.select("zone", ts("hour"), r6("raw"), r6("price"))


@query
def r1_price_horizon(spark: SparkSession, sf: str) -> DataFrame:
    out = price_grid(horizons(fx.prices(spark, sf), fx.span(spark, sf).on(-10), fx.span(spark, sf).today))
    return out.select("zone", day("date"), integer("offset"), r6("price"))


@query
def r1_price_horizon_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Days beyond the last priced one copy the prices of five days before."""
    span = fx.span(spark, sf)
    out = price_grid(horizons(fx.prices(spark, sf), span.on(-4), span.today, as_of=span.on(-5)))
    return out.select("zone", day("date"), integer("offset"), r6("price"))


@query
def w8_r2_shifted_prices(spark: SparkSession, sf: str) -> DataFrame:
    """24 start hours x the price 0..23 hours later."""
    out = shifted_prices(horizon(spark, sf))
    names_ = {f"Price_at_H+{i}": f"h{i}" for i in range(24)}
    out = out.withColumnsRenamed(names_)
    return out.select("zone", day("date"), integer("hour"), *[r6(c) for c in names_.values()])


@query
def r3_j10_cost_by_start(spark: SparkSession, sf: str) -> DataFrame:
    """cost(h) = sum of price(h + j) * load(j) for the 24 start hours."""
    out = recommend.cost_rows(costs(spark, sf))
    return out.select(*KEYS, day("date"), integer("hour"), r6(F.col("cost") * 1000, "cost_mill"))


@query
def t4_best_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The first of the cheapest start hours."""
    return costs(spark, sf).select(*KEYS, day("date"), recommend.cheapest_hour().alias("hour"))


# recommendations ----------------------------------------------------------------------------------


@query
def r4_activity_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Which hours are acceptable, and whether any is."""
    probs = rates.activity_rate_arrays(rates.activity_rates(activity_table(spark, sf)))
    any_ok = F.exists("probs", lambda p: p >= ACTIVITY_THRESHOLD)
    rows = probs.select(
        "household_id", "date", (~any_ok).cast("int").alias("no_recommend_flag_activity"), F.posexplode("probs").alias("hour", "p")
    )
    ok = (F.col("p") >= ACTIVITY_THRESHOLD).cast("int").alias("acceptable")
    return rows.select("household_id", day("date"), integer("hour"), r6("p"), ok, "no_recommend_flag_activity")


@query
def r5_usage_gate(spark: SparkSession, sf: str) -> DataFrame:
    out = rates.usage_rates(usage_table(spark, sf))
    low = (F.col("p") < USAGE_THRESHOLD).cast("int").alias("no_recommend_flag_usage")
    return out.select(*KEYS, day("date"), r6("p"), low)


@query
def r6_recommend_by_device(spark: SparkSession, sf: str) -> DataFrame:
    out = recommend.recommend(inputs(spark, sf), ACTIVITY_THRESHOLD, USAGE_THRESHOLD)
    cols = ["best_launch_hour", "no_recommend_flag_activity", "no_recommend_flag_usage", "recommendation", "error"]
    return out.select(*KEYS, day("date"), *cols)


@query
def r7_j6_recommendation_table(spark: SparkSession, sf: str) -> DataFrame:
    """The published table: key date_device, friendly names joined on the entity."""
    return _show(recs(spark, sf))


@query
def r8_recommendations_on_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Every requested household, device and date; those that cannot be served say why."""
    request = stages.requested(fx.states(spark, sf), fx.SHIFTABLE, fx.span(spark, sf).start, fx.span(spark, sf).last)
    out = stages.with_errors(request, recs(spark, sf))
    return out.select(*KEYS, day("date"), "best_launch_hour", "recommendation", "error")


@query
def r9_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """The three texts of a recommendation: plain, with the price, with the percentage saved."""
    price = F.get("prices", F.col("best_launch_hour"))
    saved = recommend.savings_percent("prices", "best_launch_hour")
    return recs(spark, sf).select(
        "household_id",
        "index",
        recommend.device_sentence().alias("plain"),
        recommend.price_sentence(price).alias("with_price"),
        recommend.savings_sentence(saved).alias("with_savings"),
    )


@query
def a24_hour_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.hour_histogram(recs(spark, sf)).select("recommendation", big("n"))


@query
def a25_time_line(spark: SparkSession, sf: str) -> DataFrame:
    out = recommend.time_line(recs(spark, sf))
    return out.select(*KEYS, day("recommendation_date"), "recommendation")


@query
def j13_stored_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Recommendations from stored stage tables instead of recomputed predictions."""
    out = stages.run(
        spark,
        fx.readings(spark, sf),
        fx.households(spark, sf),
        fx.prices(spark, sf),
        names(spark, sf),
        CONFIG.with_thresholds(ACTIVITY_THRESHOLD, USAGE_THRESHOLD),
        fx.span(spark, sf).today,
        *window(spark, sf),
        scratch_dir(spark),
        timezone="UTC",
    )
    return out["recommendations"].filter(F.col("index").isNotNull()).select(
        "index", "household_id", "best_launch_hour", "recommendation"
    )


# back-test ----------------------------------------------------------------------------------------


@query
def j7_usage_truth(spark: SparkSession, sf: str) -> DataFrame:
    """Was the device used on the recommended day?"""
    tables = prepared(spark, sf)
    keys = costs(spark, sf, tables.load).select(*KEYS, "date")
    out = keys.join(backtest.usage_truth(tables.usage), [*KEYS, "date"], "left")
    return out.select(*KEYS, day("date"), "usage_true")


@query
def j8_activity_truth(spark: SparkSession, sf: str) -> DataFrame:
    """Was someone active at the best hour of the recommended day?"""
    tables = prepared(spark, sf)
    keys = costs(spark, sf, tables.load).select(*KEYS, "date", recommend.cheapest_hour().alias("hour"))
    truth = backtest.activity_truth(tables.activity)
    out = keys.join(truth, ["household_id", "date"], "left")
    return out.select(*KEYS, day("date"), "hour", F.get("activity_true", F.col("hour")).alias("activity_true"))


@query
def j9_run_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every run of each device and day with its 24 hourly loads; a day without a run has 24 zeros and no hour."""
    load = prepared(spark, sf).load
    keys = costs(spark, sf, load).select(*KEYS, "date")
    out = keys.join(backtest.actual_starts(load), [*KEYS, "date"], "left")
    each = out.select(*KEYS, "date", F.inline_outer("starts"))
    run = F.coalesce("load", F.array_repeat(F.lit(0.0), 24))
    return each.select(*KEYS, day("date"), "hour", *[r6(run[j], f"h{j + 1}") for j in range(24)])


@query
def j11_nearest_start(spark: SparkSession, sf: str) -> DataFrame:
    """The actual start closest to the cheapest hour."""
    load = prepared(spark, sf).load
    keys = costs(spark, sf, load).select(*KEYS, "date", recommend.cheapest_hour().alias("hour"))
    out = keys.join(backtest.actual_starts(load), [*KEYS, "date"], "left")
    return out.select(*KEYS, day("date"), "hour", backtest.nearest_start("starts", "hour").alias("relevant_start"))


@query
def j12_threshold_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """All 49 threshold pairs for every household."""
    out = backtest.with_thresholds(fx.households(spark, sf), eighths(), eighths())
    return out.select("household_id", "activity_threshold", "usage_threshold")


@query
def r10_run_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Cost of every actual run with the prices of its zone and day; NULL where the day has none."""
    starts = backtest.actual_starts(load_table(spark, sf)).select(*KEYS, "date", F.inline("starts"))
    zoned = join_reference(starts, fx.households(spark, sf), ["household_id"])
    priced = join_reference(zoned, horizon(spark, sf).select("zone", "date", "prices"), ["zone", "date"])
    cost = backtest.run_cost("prices", "hour", "load")
    return priced.select(*KEYS, day("date"), "hour", r6(cost, "cost"))


@query
def r11_back_test(spark: SparkSession, sf: str) -> DataFrame:
    """Acceptability, costs and savings of every recommendation, for all threshold pairs."""
    out = results(spark, sf)
    money = ["cost_no_recommendation", "cost_recommendation", "savings", "relative_savings"]
    return out.select(
        *KEYS, day("date"), *backtest.PAIR, "recommendation", "acceptable", "relevant_start", *[r6(c) for c in money]
    )


@query
def r12_evaluate_pair(spark: SparkSession, sf: str) -> DataFrame:
    """One threshold pair, summed up per device."""
    rows = recommend.recommend(evaluation_inputs(spark, sf), 0.125, 0.5)
    out = backtest.evaluate(rows)
    return out.groupBy("device").agg(
        big(F.count("recommendation"), "n_recommendations"),
        big(F.sum("acceptable"), "n_acceptable"),
        r6(F.sum("savings"), "savings"),
    )


SUMMARY = ["acceptable", "total_savings", "relative_savings_mean", "relative_savings_median"]


@query
def r13_a17_grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """The summary of 49 threshold pairs per household, in one job."""
    out = backtest.grid_search(evaluation_inputs(spark, sf), eighths(), eighths())
    return out.select("household_id", *backtest.PAIR, big("n_recommendations"), *[r6(c) for c in SUMMARY])


@query
def a23_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    """Total savings as a matrix: activity thresholds down, usage thresholds across."""
    swept = sweep.sweep(evaluation_inputs(spark, sf), eighths(), eighths())
    out = backtest.sensitivity(swept, "total_savings", eighths())
    cols = [r6(F.col(f"`{u}`"), f"u{i + 1}") for i, u in enumerate(eighths())]
    return out.select("household_id", "activity_threshold", *cols)


@query
def t2_optimal_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.optimal_thresholds(sweep.sweep(evaluation_inputs(spark, sf), eighths(), eighths()))


@query
def t2_fine_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """The best of 3,969 threshold pairs, and what it saves."""
    fine = [i / 64 for i in range(1, 64)]
    out = backtest.optimal_result(sweep.sweep(evaluation_inputs(spark, sf), fine, fine))
    return out.select("household_id", *backtest.PAIR, big("n_recommendations"), *[r6(c) for c in SUMMARY[:3]])


@query
def t3_optimal_result(spark: SparkSession, sf: str) -> DataFrame:
    """The whole summary of the best pair, evaluated once more for that pair alone."""
    rows = write_once(evaluation_inputs(spark, sf), "evaluation")
    best = backtest.optimal_thresholds(sweep.sweep(rows, eighths(), eighths()))
    out = sweep.summary_at(rows, best)
    return out.select("household_id", *backtest.PAIR, big("n_recommendations"), *[r6(c) for c in SUMMARY])
