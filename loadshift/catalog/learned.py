"""Models, scores, cold start, explanations, weather and the streaming base."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadshift import fixtures as fx
from loadshift.catalog.decisions import KEYS, recs, window
from loadshift.catalog.features import CONFIG, activity_table, load_table, prepared, usage_table
from loadshift.catalog.registry import big, day, integer, query, r6, ts
from loadshift.functions.metrics import largest_error
from loadshift.operators import cells, explain, hour_cells, impute, models, rates, recommend, score
from loadshift.operators.features import load_input
from loadshift.operators.learners import LEARNERS
from loadshift.operators.models import ACTIVITY_FEATURES, USAGE_FEATURES
from loadshift.plans import stages
from loadshift.session import scratch_dir, write_once
from loadshift.sources.weather import daily as weather_daily
from loadshift.streaming import load as load_stream
from loadshift.streaming.hourly import closing_sums, completed, hourly_sums

WEATHER = list(fx.WEATHER_SOURCE)
TOLERANCES = [0.05, 0.10, 0.15, 0.20, 0.25]
AGENTS = score.agent_names(fx.SHIFTABLE)


def _activity_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rates.activity_rates(activity_table(spark, sf))


def _usage_rated(spark: SparkSession, sf: str, table: DataFrame | None = None) -> DataFrame:
    return rates.cell_rates(rates.usage_counts(usage_table(spark, sf) if table is None else table))


# models -------------------------------------------------------------------------------------------


CELL_MODELS = {"logit": cells.logit_usage, "logit_sm": cells.logit_sm_usage, "knn": cells.knn_usage}
COUNT_FITS = {"ada": cells.ada, "xgboost": cells.xgboost, "ebm": cells.ebm, "random forest": cells.random_forest}


def _usage_model(spark: SparkSession, sf: str, model_type: str, first: str | None = None) -> DataFrame:
    """Models of running counts, one fit per household, device and date."""
    table = usage_table(spark, sf)
    dates = (first or window(spark, sf)[0], window(spark, sf)[1])
    if model_type in CELL_MODELS:
        out = CELL_MODELS[model_type](table, *dates)
    else:
        out = cells.usage_of_counts(table, *dates, COUNT_FITS[model_type])
    return out.select(*KEYS, day("date"), day("day"), "y", r6("p"), "error")


@query
def m3_logit_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic regression per household and date: probability of activity for every hour of the next day."""
    return _activity_hours(hour_cells.logit_activity(activity_table(spark, sf), *window(spark, sf)))


def _activity_hours(out: DataFrame) -> DataFrame:
    return out.select("household_id", day("date"), ts("hour_ts"), "y", r6("p"), "error")


@query
def m3_logit_activity_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """The same on the week up to each date."""
    return _activity_hours(hour_cells.logit_activity(activity_table(spark, sf), *window(spark, sf), train_days=7))


@query
def m3_logit_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "logit")


@query
def m4_knn_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Share of active hours among the 10 nearest training hours."""
    return _activity_hours(hour_cells.knn_activity(activity_table(spark, sf), *window(spark, sf)))


@query
def m4_knn_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "knn")


@query
def m5_random_forest_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "random forest")


@query
def m6_ada_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "ada")


@query
def m7_boosted_trees_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "xgboost")


@query
def m8_ebm_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "ebm")


@query
def m9_logit_sm_usage(spark: SparkSession, sf: str) -> DataFrame:
    return _usage_model(spark, sf, "logit_sm")


@query
def m9_logit_sm_activity(spark: SparkSession, sf: str) -> DataFrame:
    return _activity_hours(hour_cells.logit_sm_activity(activity_table(spark, sf), *window(spark, sf)))


@query
def m10_every_model_type(spark: SparkSession, sf: str) -> DataFrame:
    """All seven model types for the last date."""
    parts = [_usage_model(spark, sf, m, window(spark, sf)[1]).withColumn("model_type", F.lit(m)) for m in LEARNERS]
    return reduce(DataFrame.unionByName, parts)


@query
def m10_m11_distributed_logit(spark: SparkSession, sf: str) -> DataFrame:
    """One distributed model over the training rows of all households, and its predictions for the next day."""
    train, test = models.usage_split(usage_table(spark, sf), fx.span(spark, sf).on(-5))
    model = models.fit_table(train, USAGE_FEATURES, "usage", "logit")
    out = models.predict_table(model, test)
    return out.select(*KEYS, day("day"), "usage", r6("p"))


@query
def m12_next_day_activity(spark: SparkSession, sf: str) -> DataFrame:
    """One date: the random forest of every household for the hours of the next day."""
    out = models.activity_walk_forward(activity_table(spark, sf), "random forest", *[window(spark, sf)[1]] * 2)
    return out.select("household_id", day("date"), ts("hour_ts"), "y", r6("p"), "error")


@query
def m12_next_day_with_weather(spark: SparkSession, sf: str) -> DataFrame:
    """The same date with five weather columns among the features."""
    weather = impute.enrich(fx.weather(spark, sf), WEATHER)
    table = impute.join_weather(activity_table(spark, sf), weather, fx.households(spark, sf), "hour_ts").filter(F.col("household_id").isNotNull())
    out = models.activity_walk_forward(
        table, "xgboost", *[fx.span(spark, sf).on(-5)] * 2, features=[*ACTIVITY_FEATURES, *WEATHER]
    )
    return out.select("household_id", day("date"), ts("hour_ts"), "y", r6("p"), "error")


@query
def m12_usage_with_daily_weather(spark: SparkSession, sf: str) -> DataFrame:
    """The usage model of one date with the daily weather of the household's station among the features, through the stages."""
    tables = stages.with_weather(prepared(spark, sf), fx.weather(spark, sf).drop("tsun"), fx.households(spark, sf), WEATHER)
    out = stages.predict(tables, "logit", *[fx.span(spark, sf).on(-5)] * 2, CONFIG, tuple(WEATHER)).usage
    return out.select(*KEYS, day("date"), day("day"), "y", r6("p"), "error")


# weather ------------------------------------------------------------------------------------------


@query
def m14_knn_impute(spark: SparkSession, sf: str) -> DataFrame:
    """Every gap from the 7 nearest hours, weighted by inverse distance."""
    out = impute.knn_impute(fx.weather(spark, sf), "station", "time", WEATHER)
    return out.select("station", ts("time"), *[r6(c) for c in WEATHER])


@query
def m13_weather_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Empty columns dropped, gaps filled, values scaled to 0..1."""
    out = impute.enrich(fx.weather(spark, sf), [*WEATHER, "tsun"])
    return out.select("station", ts("time"), *[r6(c) for c in sorted(WEATHER)])


@query
def j4_weather_join(spark: SparkSession, sf: str) -> DataFrame:
    """Activity hours with the weather of the hour; weather hours without features stay."""
    out = impute.join_weather(activity_table(spark, sf), fx.weather(spark, sf).drop("tsun"), fx.households(spark, sf), "hour_ts")
    return out.select("household_id", "station", ts("time"), "activity", *[r6(c) for c in WEATHER])


# scores -------------------------------------------------------------------------------------------


@query
def e1_auc_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """AUC of the hourly activity rates for each next day; NULL where the day has one class."""
    out = score.auc(_activity_rates(spark, sf), ["household_id", "date"])
    return out.select("household_id", day("date"), r6("auc"), big("n"))


def _scored_dates(spark: SparkSession, sf: str) -> tuple[str, str]:
    """From the eighth day to two days before today."""
    return fx.span(spark, sf).on(7), fx.span(spark, sf).on(-2)


def _activity_scores(spark: SparkSession, sf: str, table: DataFrame | None = None, metric: score.CellMetric | None = None) -> DataFrame:
    out = write_once(rates.activity_rates(activity_table(spark, sf) if table is None else table), "activity_rates")
    cells = out.select("household_id", "date", "p", "n_pos", "n_neg")
    return score.walk_forward_auc(out, cells, ["household_id"], *_scored_dates(spark, sf), metric=metric)


def _usage_scores(spark: SparkSession, sf: str, table: DataFrame | None = None, metric: score.CellMetric | None = None) -> DataFrame:
    table = prepared(spark, sf).usage if table is None else table
    rated = write_once(_usage_rated(spark, sf, table), "usage_rates")
    return score.walk_forward_auc(
        rates.next_rates(rated), rates.usage_train_cells(rated), KEYS, *_scored_dates(spark, sf), inclusive=False, metric=metric
    )


@query
def e2_activity_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Mean train AUC over the dates and the pooled test AUC."""
    out = _activity_scores(spark, sf)
    return out.select("household_id", r6("auc_train"), r6("auc_test"), big("n_dates"), big("n_test"))


@query
def e2_usage_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """The same per device; both end dates are excluded."""
    out = _usage_scores(spark, sf)
    return out.select(*KEYS, r6("auc_train"), r6("auc_test"), big("n_dates"), big("n_test"))


@query
def e2_knn_activity_auc(spark: SparkSession, sf: str) -> DataFrame:
    """Pooled test AUC of the nearest-neighbour model."""
    out = score.auc(hour_cells.knn_activity(activity_table(spark, sf), *window(spark, sf)), ["household_id"])
    return out.select("household_id", r6("auc"), big("n"))


@query
def e2_logit_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Walk-forward AUC of the fitted regression: mean over the dates' training rows, and pooled over the days after."""
    fitted = write_once(hour_cells.fits(activity_table(spark, sf), *window(spark, sf)), "activity_fits")
    out = score.walk_forward_auc(hour_cells.test_rows(fitted), hour_cells.train_cells(fitted), ["household_id"], *_scored_dates(spark, sf))
    return out.select("household_id", r6("auc_train"), r6("auc_test"), big("n_dates"), big("n_test"))


@query
def e2_logit_usage(spark: SparkSession, sf: str) -> DataFrame:
    """The same per device; both end dates are excluded."""
    fitted = write_once(cells.logit_cells(usage_table(spark, sf), *window(spark, sf)), "usage_fits")
    tested = fitted.select(*KEYS, "date", F.get("rate", F.col("next_cell")).alias("p"), "y").filter("p IS NOT NULL")
    out = score.walk_forward_auc(tested, rates.usage_train_cells(fitted), KEYS, *_scored_dates(spark, sf), inclusive=False)
    return out.select(*KEYS, r6("auc_train"), r6("auc_test"), big("n_dates"), big("n_test"))


@query
def e5_logit_activity_all_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every date's regression on all rows of the household: AUC and mean squared distance of each date."""
    table = activity_table(spark, sf)
    scored = write_once(hour_cells.all_cells(hour_cells.fits(table, *window(spark, sf)), table), "activity_all_rows")
    keys = ["household_id", "date"]
    gap = score.brier().over(scored, keys).select(*keys, F.col("auc").alias("brier"))
    out = score.auc_from_counts(scored, keys).join(gap, keys)
    return out.select("household_id", day("date"), r6("auc"), r6("brier"), big("n"))


def _load_errors(spark: SparkSession, sf: str, metric, load: DataFrame | None = None) -> DataFrame:
    load = prepared(spark, sf).load if load is None else load
    return score.load_errors(load, stages.complete_days(load), metric)


@query
def e3_load_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Squared error of every run against the profile known on its day."""
    out = _load_errors(spark, sf, "mse")
    return out.select(*KEYS, ts("run_start"), r6("error"))


@query
def e3_load_score(spark: SparkSession, sf: str) -> DataFrame:
    out = score.load_score(_load_errors(spark, sf, "mse"))
    return out.select(*KEYS, r6("error"), big("n_runs"))


@query
def e6_user_metric(spark: SparkSession, sf: str) -> DataFrame:
    """A Python score function instead of a registered one: the largest absolute error."""
    out = score.load_score(_load_errors(spark, sf, lambda a, b: np.abs(a - b).max()))
    return out.select(*KEYS, r6("error"), big("n_runs"))


@query
def e7_normalised_distance(spark: SparkSession, sf: str) -> DataFrame:
    out = _load_errors(spark, sf, "normalised_distance")
    return out.select(*KEYS, ts("run_start"), r6("error"))


def _agent_scores(spark: SparkSession, sf: str) -> DataFrame:
    tables = prepared(spark, sf)
    activity = _activity_scores(spark, sf, tables.activity).withColumnRenamed("auc_test", "auc")
    usage = _usage_scores(spark, sf, tables.usage).withColumnRenamed("auc_test", "auc")
    return score.agent_scores(activity, usage, score.load_score(_load_errors(spark, sf, "mse", tables.load)))


@query
def e4_agent_scores(spark: SparkSession, sf: str) -> DataFrame:
    """One AUC for activity, one AUC and one error per device."""
    return _agent_scores(spark, sf).select("household_id", "agent", "device", r6("score"))


@query
def a18_a20_scores_by_position(spark: SparkSession, sf: str) -> DataFrame:
    """All households, one column per score and device position."""
    out = score.scores_by_position(_agent_scores(spark, sf), fx.SHIFTABLE)
    return out.select("household_id", *[r6(c) for c in out.columns[1:]])


# cold start ---------------------------------------------------------------------------------------


@query
def e5_predict_all_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Every date's model for all cells: hour, probability, training counts."""
    out = _activity_rates(spark, sf).filter(F.col("p").isNotNull())
    return out.select("household_id", day("date"), "hour", r6("p"), big("n_pos"), big("n_neg"))


@query
def e5_predict_all_usage(spark: SparkSession, sf: str) -> DataFrame:
    out = _usage_rated(spark, sf).select(*KEYS, "date", F.expr("posexplode(rate) AS (cell, p)"))
    return out.filter(F.col("p").isNotNull()).select(*KEYS, day("date"), integer("cell"), r6("p"))


def _cold_start(spark: SparkSession, sf: str) -> DataFrame:
    return stages.cold_start_scores(prepared(spark, sf), fx.span(spark, sf).today)


@query
def e6_cold_start_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score of each date's models on the full truth."""
    return _cold_start(spark, sf).select("household_id", "agent", day("date"), r6("score"))


@query
def e6_cold_start_user_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The same with scores that are not built in: the Brier score of activity and usage, the largest error of the load profiles."""
    out = stages.cold_start_scores(prepared(spark, sf), fx.span(spark, sf).today, score.brier(), largest_error)
    return out.select("household_id", "agent", day("date"), r6("score"))


@query
def e6_user_metric_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Brier score of the activity predictions, of the training rows and of the days after."""
    out = _activity_scores(spark, sf, metric=score.brier())
    return out.select("household_id", r6("auc_train", "brier_train"), r6("auc_test", "brier_test"), big("n_dates"), big("n_test"))


@query
def e6_user_metric_usage(spark: SparkSession, sf: str) -> DataFrame:
    out = _usage_scores(spark, sf, metric=score.brier())
    return out.select(*KEYS, r6("auc_train", "brier_train"), r6("auc_test", "brier_test"), big("n_dates"), big("n_test"))


@query
def a22_cold_start_table(spark: SparkSession, sf: str) -> DataFrame:
    out = score.cold_start_table(_cold_start(spark, sf), AGENTS)
    return out.select("household_id", day("date"), *[r6(a) for a in AGENTS])


def _cold_start_days(spark: SparkSession, sf: str) -> DataFrame:
    table = score.cold_start_table(_cold_start(spark, sf), AGENTS)
    return score.cold_start_days(table, AGENTS, TOLERANCES)


@query
def w10_cold_start_days(spark: SparkSession, sf: str) -> DataFrame:
    """First day from which the score stays within the tolerance, per agent and for the slowest one."""
    return _cold_start_days(spark, sf).select("household_id", "tolerance", "agent", "days")


@query
def a19_cold_start_summary(spark: SparkSession, sf: str) -> DataFrame:
    return score.cold_start_summary(_cold_start_days(spark, sf), fx.SHIFTABLE)


# explanations -------------------------------------------------------------------------------------


@query
def x1_usage_shapley(spark: SparkSession, sf: str) -> DataFrame:
    """Exact Shapley values of the usage features for every device and date."""
    out = explain.usage_shapley(_usage_rated(spark, sf))
    long = out.select(*KEYS, "date", "base_value", F.inline("importance"))
    return long.select(*KEYS, day("date"), "feature", r6("importance"), r6("base_value"))


@query
def x3_shapley_reconstruction(spark: SparkSession, sf: str) -> DataFrame:
    """Base value plus contributions next to the prediction."""
    out = explain.reconstruct(explain.usage_shapley(_usage_rated(spark, sf)))
    return out.select(*KEYS, day("date"), r6("p"), r6("shap"))


@query
def t1_sorted_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Features in descending order of importance (rounded first, names on ties)."""
    out = explain.usage_shapley(_usage_rated(spark, sf))
    rounded = F.expr("transform(importance, s -> named_struct('feature', s.feature, 'importance', round(s.importance, 6)))")
    ranked = out.withColumn("importance", rounded).withColumn("importance", explain.sorted_importance("importance"))
    return ranked.select(*KEYS, day("date"), F.expr("array_join(importance.feature, ' > ') AS ranking"))


@query
def x7_t6_usage_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Why a device is expected to be used."""
    out = explain.usage_shapley(_usage_rated(spark, sf))
    rounded = F.expr("transform(importance, s -> named_struct('feature', s.feature, 'importance', round(s.importance, 6)))")
    text = explain.usage_sentence("importance", F.expr("next_cell & 1"))
    return out.withColumn("importance", rounded).select(*KEYS, day("date"), text.alias("sentence"))


def _timed_recommendations(spark: SparkSession, sf: str, tables: stages.Prepared) -> DataFrame:
    """All recommendations, with the time of the best launch hour where there is one."""
    at = F.expr("cast(recommendation_date AS timestamp) + make_dt_interval(0, best_launch_hour)")
    return recs(spark, sf, tables).withColumn("hour_ts", at)


def _activity_explained(spark: SparkSession, sf: str, tables: stages.Prepared, found: DataFrame | None = None) -> DataFrame:
    """The regression's attributions at all best launch hours."""
    found = _timed_recommendations(spark, sf, tables) if found is None else found
    best = found.filter(F.col("hour_ts").isNotNull()).select("household_id", "hour_ts")
    return hour_cells.explain_activity(tables.activity, *window(spark, sf), best)


@query
def x1_x2_activity_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Shapley values over 1,024 coalitions against all training hours."""
    out = explain.reconstruct(_activity_explained(spark, sf, prepared(spark, sf)))
    long = out.select("household_id", "date", "hour_ts", "p", "shap", F.inline_outer(explain.sorted_importance("importance")))
    return long.select("household_id", day("date"), ts("hour_ts"), r6("p"), r6("shap"), "feature", r6("importance"))


@query
def x5_explanation_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """What the attributions of each date cost: hours explained and the seconds that their fits and coalitions took in the tasks."""
    out = _activity_explained(spark, sf, prepared(spark, sf)).filter(F.col("p").isNotNull())
    timed = out.groupBy("date").agg(F.count(F.lit(1)).alias("n_hours"), F.sum("seconds").alias("seconds"))
    return timed.select(day("date"), big("n_hours"), "seconds")


@query
def x6_activity_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Why a resident is expected to be active, from the attributions of the activity model."""
    tables = prepared(spark, sf)
    table = tables.activity
    lags = [F.coalesce(f"activity_lag_{k}", F.lit(0)) for k in (24, 48, 72)]
    out = _activity_explained(spark, sf, tables).join(table.drop("activity"), ["household_id", "hour_ts"])
    text = explain.activity_sentence("importance", lags)
    return out.select("household_id", ts("hour_ts"), text.alias("sentence"))


@query
def x_explained_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    """Every recommendation with the reasons of both agents and the saving; without one, the text that says so."""
    tables = prepared(spark, sf)
    found = write_once(_timed_recommendations(spark, sf, tables), "timed_recommendations")
    table = tables.activity
    lags = [F.coalesce(f"activity_lag_{k}", F.lit(0)) for k in (24, 48, 72)]
    active = _activity_explained(spark, sf, tables, found).join(table.drop("activity"), ["household_id", "hour_ts"])
    active = active.select("household_id", "hour_ts", explain.activity_sentence("importance", lags).alias("activity_reason"))
    rounded = F.expr("transform(importance, s -> named_struct('feature', s.feature, 'importance', round(s.importance, 6)))")
    used = explain.usage_shapley(_usage_rated(spark, sf, tables.usage)).withColumn("importance", rounded)
    reason = explain.usage_sentence("importance", F.expr("next_cell & 1")).alias("usage_reason")
    used = used.select(*KEYS, F.col("date").alias("recommendation_calculation_date"), reason)
    out = found.join(active, ["household_id", "hour_ts"], "left").join(used, [*KEYS, "recommendation_calculation_date"], "left")
    some = F.col("recommendation").isNotNull()
    return out.select(
        "household_id",
        "index",
        "recommendation",
        recommend.savings_sentence(recommend.savings_percent("prices", "best_launch_hour")).alias("text"),
        F.when(some, F.col("activity_reason")).alias("activity_reason"),
        F.when(some, F.col("usage_reason")).alias("usage_reason"),
    )


@query
def x6_sentence_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The sentence for every hour, with the spread of activity as importance of a feature."""
    table = prepared(spark, sf).activity
    spread = [F.expr(f"round(avg(CASE WHEN {f} = 1 THEN activity END) - avg(activity), 6) AS `{f}`") for f in ACTIVITY_FEATURES[1:]]
    hour = F.expr("round(avg(CASE WHEN hour >= 12 THEN activity END) - avg(activity), 6) AS hour")
    per_house = table.groupBy("household_id").agg(hour, *spread)
    items = ", ".join(f"named_struct('feature', '{f}', 'importance', `{f}`)" for f in ACTIVITY_FEATURES)
    importance = per_house.select("household_id", F.expr(f"array({items}) AS importance"))
    hours = table.join(importance, "household_id")
    lags = [F.coalesce(f"activity_lag_{k}", F.lit(0)) for k in (24, 48, 72)]
    return hours.select(
        "household_id",
        ts("hour_ts"),
        explain.activity_sentence("importance", lags).alias("sentence"),
        explain.activity_sentence("importance", lags, compat=True).alias("literal_sentence"),
    )


def _usage_explained(spark: SparkSession, sf: str, first: str | None = None) -> DataFrame:
    """The usage rows of the days after all dates, or after those from ``first`` on."""
    dates = (first or window(spark, sf)[0], window(spark, sf)[1])
    return explain.explain(usage_table(spark, sf), KEYS, USAGE_FEATURES, "usage", "day", "logit", *dates)


@query
def x4_lime_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Local linear prediction next to the model's and the Shapley reconstruction, for the last ten dates."""
    out = explain.reconstruct(_usage_explained(spark, sf, fx.span(spark, sf).on(-10)))
    return out.select(*KEYS, day("date"), "y", r6("p"), r6("shap"), r6("lime"))


@query
def e8_xai_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """How well the two explainers reproduce truth and predictions, per household and device."""
    explained = explain.reconstruct(_usage_explained(spark, sf)).select(*KEYS, "y", "p", "lime", "shap")
    out = score.xai_metrics(write_once(explained, "usage_explained"), KEYS)
    return out.select(*KEYS, *[r6(c) for c in out.columns[2:]])


@query
def e8_xai_metric_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics for two stand-in explainers: yesterday's rate and the base value."""
    out = explain.usage_shapley(_usage_rated(spark, sf))
    rows = out.select(*KEYS, "y", "p", F.expr("round(p, 1) AS lime"), F.expr("round(base_value, 3) AS shap"))
    metrics = score.xai_metrics(rows, KEYS, 0.1)
    return metrics.select(*KEYS, *[r6(c) for c in metrics.columns[2:]])


@query
def t7_weather_clause(spark: SparkSession, sf: str) -> DataFrame:
    """The two strongest weather columns of each day, by distance from the station's mean over the days."""
    table = weather_daily(fx.weather(spark, sf))
    above = ", ".join(
        f"named_struct('feature', '{c}', 'importance', round({c} - avg({c}) OVER (PARTITION BY station), 6))" for c in WEATHER
    )
    rows = table.selectExpr("*", f"array({above}) AS importance")
    clause = explain.weather_clause("importance", {c: F.col(c) for c in WEATHER})
    return rows.select("station", day("time"), clause.alias("clause"))


# streaming ----------------------------------------------------------------------------------------


def _state_stream(spark: SparkSession, sf: str) -> DataFrame:
    return fx.states_of(spark.readStream.schema(fx.EVENTS).parquet(f"{sf}/events*.parquet"))


def _streamed(spark: SparkSession, out: DataFrame) -> DataFrame:
    """What a stream gives until it has read its input, appended to files as the watermark passes."""
    path = scratch_dir(spark)
    job = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/hours")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/hours")


@query
def stream_hourly_sums(spark: SparkSession, sf: str) -> DataFrame:
    """The hours that the stream closes."""
    hours = _streamed(spark, hourly_sums(_state_stream(spark, sf), fx.SHIFTABLE))
    return hours.select("household_id", "entity_id", ts("hour_ts"), r6("value_sum"), big("n"))


@query
def stream_completed_hours(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the batch step that adds open hours and late events."""
    closed = _streamed(spark, hourly_sums(_state_stream(spark, sf), fx.SHIFTABLE))
    out = completed(closed, closing_sums(fx.states(spark, sf), fx.SHIFTABLE, closed))
    return out.select("household_id", "entity_id", ts("hour_ts"), r6("value_sum"), big("n"))


@query
def stream_hourly_load(spark: SparkSession, sf: str) -> DataFrame:
    """The gap-free hourly means from the hours that the stream closes and the batch step after it."""
    closed = _streamed(spark, load_stream.closed_hours(fx.readings_of(_state_stream(spark, sf), spark, sf), fx.SHIFTABLE))
    closing = load_stream.closing_hours(fx.readings(spark, sf), fx.SHIFTABLE, closed)
    out = load_input(None, fx.SHIFTABLE, fx.THRESHOLD, means=load_stream.means(closed, closing, fx.SHIFTABLE))
    return out.select("household_id", "device", ts("hour_ts"), r6("value"))
