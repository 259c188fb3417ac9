"""The stages of a whole run: prepare, predict, recommend, evaluate.

Each stage takes and returns DataFrames for all households and dates at once. ``run`` can leave the
stage tables in the shared store, so that a later stage reads files instead of recomputing its inputs
and a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadshift.config import Config
from loadshift.functions.metrics import array_metric
from loadshift.operators import backtest, hour_cells, hourly, impute, models, rates, recommend, runs, score
from loadshift.operators.features import activity_features, load_input, usage_features, usage_group
from loadshift.operators.prices import horizons
from loadshift.sources import store
from loadshift.sources import weather as weather_source


@dataclass(frozen=True)
class Prepared:
    activity: DataFrame
    usage: DataFrame
    load: DataFrame


@dataclass(frozen=True)
class Predicted:
    activity: DataFrame  # household_id, date, probs[24]
    usage: DataFrame  # household_id, device, date, p
    load: DataFrame  # household_id, device, date, load[24]


def device_groups(config: Config) -> list[list[str]]:
    """The device groups whose hourly means the three feature tables need: activity, load and usage."""
    devices = list(config.shiftable_devices)
    active = list(config.activity_devices) if config.usage_activity_from == "all" else None
    return [list(config.activity_devices), devices, usage_group(devices, active)]


def hourly_base(states: DataFrame, config: Config) -> DataFrame:
    """The one table that ``prepare`` needs instead of the readings; to be written once."""
    return hourly.hourly_base(states, device_groups(config))


def prepare(states: DataFrame | None, config: Config, today: str, base: DataFrame | None = None) -> Prepared:
    """The three feature tables from the readings, or from their written ``hourly_base``: then no raw row is read again."""
    devices, threshold = list(config.shiftable_devices), config.threshold
    active = list(config.activity_devices) if config.usage_activity_from == "all" else None
    means: list[DataFrame | None] = [None] * 3
    if base is not None:
        groups = device_groups(config)
        means = [hourly.means_of_base(base, groups, g, with_switches=g == 0) for g in range(3)]
    return Prepared(
        activity_features(states, list(config.activity_devices), threshold, today, config.activity_lags, means[0]),
        usage_features(states, devices, threshold, today, config.usage_lags, active, means[2]),
        load_input(states, devices, threshold, today, means[1]),
    )


def with_weather(prepared: Prepared, weather: DataFrame, stations: DataFrame, columns: list[str]) -> Prepared:
    """The feature tables with the weather of each household's station (household_id, station), imputed and scaled: hourly for
    activity, daily means for usage. Rows without weather keep NULLs."""
    hourly = impute.enrich(weather.select("station", "time", *columns), columns)
    daily = weather_source.daily(hourly, columns)

    def joined(features: DataFrame, rows: DataFrame, ts: str, grain: str) -> DataFrame:
        out = impute.join_weather(features, rows, stations, ts, grain).filter(F.col("household_id").isNotNull()).drop("time", "station")
        keys = [c for c in ("household_id", "device", ts) if c in features.columns]
        return features.join(out.select(*keys, *columns), keys, "left")

    return Prepared(joined(prepared.activity, hourly, "hour_ts", "hour"), joined(prepared.usage, daily, "day", "day"), prepared.load)


def complete_days(load: DataFrame) -> DataFrame:
    """Without an incomplete first day. The load table has no gaps, so its first day is complete if it
    starts at midnight, which one window tells."""
    first = F.min("hour_ts").over(Window.partitionBy("household_id", "device"))
    kept = "hour(_first) = 0 OR to_date(hour_ts) > to_date(_first)"
    return load.withColumn("_first", first).filter(kept).drop("_first")


def typical_loads(load: DataFrame, first_date: str, last_date: str) -> DataFrame:
    """Profiles as of every date in the range."""
    dates = F.col("date").between(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))
    return runs.profiles_by_date(complete_days(load)).filter(dates)


def probability_arrays(rows: DataFrame) -> DataFrame:
    """(household, date, hour_ts, p) of the next day to one probs[24] per (household, date)."""
    ordered = F.expr("transform(sort_array(collect_list(struct(hour_ts, p))), s -> s.p) AS probs")
    return rows.filter(F.col("p").isNotNull()).groupBy("household_id", "date").agg(ordered)


def predict(
    prepared: Prepared,
    model_type: str,
    first_date: str,
    last_date: str,
    config: Config | None = None,
    weather: tuple[str, ...] = (),
    **args,
) -> Predicted:
    """model_type 'rate' is the positive share per feature cell; other names are fitted models, which take further arguments and
    the ``weather`` columns of ``with_weather`` as features. With a configuration the activity model trains on its last
    ``activity_train_days`` days, never before ``train_floor``."""
    dates = F.col("date").between(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))
    load = typical_loads(prepared.load, first_date, last_date)
    if model_type == "rate":
        activity = rates.activity_rate_arrays(rates.activity_rates(prepared.activity))
        usage = rates.usage_rates(prepared.usage)
        return Predicted(activity.filter(dates), usage.filter(dates), load)
    span = {"train_days": config.activity_train_days, "floor": config.train_floor} if config else {}
    active, used = [*models.ACTIVITY_FEATURES, *weather], [*models.USAGE_FEATURES, *weather]
    if model_type in ("logit", "logit_sm") and not weather and not args:
        fit = hour_cells.logit_activity if model_type == "logit" else hour_cells.logit_sm_activity
        activity = fit(prepared.activity, first_date, last_date, **span)
    else:
        activity = models.activity_walk_forward(prepared.activity, model_type, first_date, last_date, features=active, **span, **args)
    usage = models.usage_walk_forward(prepared.usage, model_type, first_date, last_date, features=used, **args)
    return Predicted(probability_arrays(activity), usage, load)


def recommendation_inputs(
    predicted: Predicted, households: DataFrame, prices: DataFrame, first_date: str, last_date: str, timezone: str = "UTC"
) -> DataFrame:
    horizon = horizons(prices, first_date, last_date, timezone)
    costs = recommend.with_costs(predicted.load, households, horizon)
    return recommend.join_predictions(costs, predicted.activity, predicted.usage)


def recommendations(
    inputs: DataFrame, names: DataFrame, activity_threshold: float = 0.6, usage_threshold: float = 0.5
) -> DataFrame:
    return recommend.recommendation_table(recommend.recommend(inputs, activity_threshold, usage_threshold), names)


def requested(states: DataFrame, devices: list[str], first_date: str, last_date: str) -> DataFrame:
    """Every (household, device, date) a run is asked for."""
    dates = F.explode(F.sequence(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))).alias("date")
    device = F.explode(F.array(*[F.lit(d) for d in devices])).alias("device")
    return states.select("household_id").distinct().select("household_id", device).select("*", dates)


def with_errors(request: DataFrame, recs: DataFrame) -> DataFrame:
    """Requested keys without a recommendation row stay, with the reason."""
    keys = ["household_id", "device", "date"]
    found = recs.withColumnRenamed("recommendation_calculation_date", "date")
    joined = request.join(found, keys, "left")
    return joined.withColumn("error", F.when(F.col("index").isNull(), "no load profile").otherwise(F.col("error")))


def back_test(
    inputs: DataFrame, prepared: Prepared, activity_thresholds: list[float], usage_thresholds: list[float]
) -> DataFrame:
    rows = backtest.evaluation_inputs(inputs, prepared.usage, prepared.activity, prepared.load)
    return backtest.evaluate_grid(rows, activity_thresholds, usage_thresholds)


def cold_start_scores(
    prepared: Prepared, last_day: str, metric: score.CellMetric | None = None, load_metric: str | Callable = "mse"
) -> DataFrame:
    """household_id, agent, date, score for activity, usage and load; ``last_day`` is the last day with data. ``metric`` scores the
    predictions of activity and usage instead of the AUC, ``load_metric`` the profiles."""
    activity = score.activity_cold_start(rates.activity_rates(prepared.activity), last_day, metric)
    usage = score.usage_cold_start(rates.cell_rates(rates.usage_counts(prepared.usage)), last_day, metric)
    load = score.load_cold_start(runs.profiles_by_date(complete_days(prepared.load)), last_day, array_metric(load_metric))
    return activity.unionByName(usage).unionByName(load)


def run(
    spark: SparkSession,
    states: DataFrame,
    households: DataFrame,
    prices: DataFrame,
    names: DataFrame,
    config: Config,
    today: str,
    first_date: str,
    last_date: str,
    path: str,
    model_type: str = "rate",
    timezone: str | None = None,
    weather: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """prepare -> predict -> recommend with every stage written below ``path``, one store per stage.

    ``timezone`` is the configuration's unless given. With ``config.weather`` the weather of the households' stations joins the
    features of fitted models. A stage whose inputs, configuration and dates are those of an earlier run is read from that run, so a
    second call reads no raw event. Inputs are known by their files; tables that come from no files are never taken for known.
    """
    columns = [c for c in weather.columns if c not in ("station", "time")] if config.weather and weather is not None else []
    zone = timezone or config.timezone
    sources = store.sources_fingerprint(states, households, prices, names, *([weather] if columns else []))

    def stage(name: str, make: Callable[[], DataFrame], *parts: object) -> DataFrame:
        text = repr((name, sources, config, today, *parts))
        fingerprint = sha256(text.encode()).hexdigest() if sources else None
        known = store.find(spark, f"{path}/{name}", fingerprint)
        known = known or store.dump(f"{path}/{name}", {"output": make()}, model_type, model_type, config.weather, fingerprint)
        return store.read(spark, f"{path}/{name}", "output", known).drop(*store.PARTITIONS)

    base = stage("hourly_base", lambda: hourly_base(states, config))
    plain = prepare(None, config, today, base)
    made = with_weather(plain, weather, households, columns) if columns else plain
    prepared = Prepared(
        stage("activity_features", lambda: made.activity, columns),
        stage("usage_features", lambda: made.usage, columns),
        stage("load_input", lambda: made.load),
    )
    dates = (model_type, first_date, last_date, columns, zone)
    predicted = predict(prepared, model_type, first_date, last_date, config, tuple(columns))
    inputs = stage("inputs", lambda: recommendation_inputs(predicted, households, prices, first_date, last_date, zone), *dates)

    def final() -> DataFrame:
        recs = recommendations(inputs, names, config.activity_threshold, config.usage_threshold)
        return with_errors(requested(states, list(config.shiftable_devices), first_date, last_date), recs)

    return {"inputs": inputs, "recommendations": stage("recommendations", final, *dates)}
