"""Sources, filters, cleaning and table-shaping operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift import fixtures as fx
from loadshift.catalog.registry import big, day, integer, query, r6, ts
from loadshift.functions.expressions import MONTH_NAMES, dummies, number, safe_name, safe_name_spaced, time_features
from loadshift.operators import clean, hourly
from loadshift.operators.features import load_input
from loadshift.operators.models import spread
from loadshift.session import scratch_dir
from loadshift.sources import configs, households, prices, states, store, weather

EVENT = ["household_id", "entity_id", "state"]


def _load(spark: SparkSession, sf: str, today: str | None = None) -> DataFrame:
    return load_input(fx.readings(spark, sf), fx.SHIFTABLE, fx.THRESHOLD, today)


# sources ------------------------------------------------------------------------------------------


@query
def s1_export_states(spark: SparkSession, sf: str) -> DataFrame:
    """States of the last 20 days with their attribute text."""
    out = states.export_states(fx.states(spark, sf), fx.state_attributes(spark, sf), fx.span(spark, sf).now, 20)
    return out.select(*EVENT, ts("last_updated_ts"), "attributes_id", "shared_attrs")


@query
def s1_epoch_time(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch seconds to timestamps: events per day."""
    epoch = fx.events(spark, sf).select(F.unix_timestamp("ts").cast("double").alias("last_updated_ts"))
    return states.with_event_time(epoch).groupBy(day("last_updated_ts", "day")).agg(big(F.count(F.lit(1)), "n"))


@query
def s2_reading_columns(spark: SparkSession, sf: str) -> DataFrame:
    return fx.states(spark, sf).select("entity_id", ts("last_updated_ts"), "state")


def _write_household_csv(spark: SparkSession, sf: str) -> str:
    """House files: the rows of a house go to one task and file, unless they are many, so that files grow with the houses only."""
    path = scratch_dir(spark)
    value = [
        F.sum(F.when(F.col("event_type") == d, F.col("value"))).alias(f"Appliance{i}")
        for i, d in enumerate(fx.ACTIVE)
    ]
    empty = [F.lit(None).cast("double").alias(f"Appliance{i}") for i in range(len(fx.ACTIVE), 10)]
    wide = (
        fx.events(spark, sf)
        .groupBy(F.floor(F.col("user_id") / 5).cast("int").alias("h"), F.date_trunc("second", "ts").alias("Time"))
        .agg(*value)
        .select("h", "Time", F.unix_timestamp("Time").alias("Unix"), *[f"Appliance{i}" for i in range(5)], *empty)
        .withColumn("Issues", F.lit(0))
    )
    file = F.format_string("CLEAN_House%d.csv", "h").alias("file")
    wide.select(file, "*").drop("h").hint("rebalance", F.col("file")).write.partitionBy("file").csv(path, header=True)
    return path


def _write_labels(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark)
    entries = ", ".join(f"{i}.{d} meter" for i, d in enumerate(fx.ACTIVE))
    section = F.format_string("notes\n\nHouse %d\n\t" + entries + "\n\t5.spare, 6.spare\n", "household_id")
    fx.states(spark, sf).select("household_id").distinct().select(section).write.text(path)
    return path


@query
def s3_household_csv(spark: SparkSession, sf: str) -> DataFrame:
    """House files and their label text, read back in long form with the house's labels."""
    long = households.load_household(spark, _write_household_csv(spark, sf), _write_labels(spark, sf)).filter(F.col("value").isNotNull())
    return long.select("household_id", ts("Time", "time"), "device", r6("value"))


@query
def s3_label_map(spark: SparkSession, sf: str) -> DataFrame:
    return households.read_labels(spark, _write_labels(spark, sf)).select("household_id", "appliance", "label")


@query
def s4_price_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A price file of one year replicated to three years."""
    path = scratch_dir(spark)
    fmt = "dd.MM.yyyy HH:mm"
    label = F.concat(
        F.date_format("hour", fmt), F.lit(" - "), F.date_format(F.col("hour") + F.expr("INTERVAL 1 HOUR"), fmt)
    )
    fx.prices(spark, sf).select(label.alias("MTU (UTC)"), "price").write.csv(path, header=True)
    out = prices.read_price_csv(spark, path, 2024, (2022, 2023, 2024))
    return out.select(ts("time"), r6("price"))


@query
def s5_prices_around_date(spark: SparkSession, sf: str) -> DataFrame:
    """Local hours within 20 days of the day after the date, as UTC."""
    out = prices.prices_around(fx.prices(spark, sf), "2024-01-15", "Europe/Brussels", 20)
    return out.select("zone", ts("hour"), r6("price"))


@query
def s6_price_history(spark: SparkSession, sf: str) -> DataFrame:
    out = prices.price_history(fx.prices(spark, sf), "2024-01-05", "2024-01-20")
    return out.select("zone", ts("hour"), r6("price"))


@query
def s7_weather_range(spark: SparkSession, sf: str) -> DataFrame:
    """Weather hours within the time range of a feature table."""
    table = clean.until_yesterday(_load(spark, sf), "hour_ts", "2024-01-21")
    out = weather.observations_for(fx.weather(spark, sf), table, "hour_ts")
    return out.select("station", ts("time"), *[r6(c) for c in fx.WEATHER_SOURCE])


@query
def s7_weather_daily(spark: SparkSession, sf: str) -> DataFrame:
    out = weather.daily(fx.weather(spark, sf))
    return out.select("station", ts("time"), *[r6(c) for c in fx.WEATHER_SOURCE])


def _write_configs(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark)
    h = F.col("household_id")
    devices = F.when(h % 2 == 0, F.array(*[F.lit(d) for d in fx.SHIFTABLE])).otherwise(F.array(F.lit("signup")))
    user = F.struct(
        devices.alias("shiftable_devices"),
        F.array(*[F.lit(d) for d in fx.ACTIVE]).alias("active_appliances"),
        F.lit(fx.THRESHOLD).alias("threshold"),
    )
    rows = fx.states(spark, sf).select("household_id").distinct()
    files = rows.select(
        F.format_string("%d_knn_config.json", h).alias("file"),
        F.struct(h.alias("household")).alias("data"),
        user.alias("user_input"),
    )
    # Files cost time, not bytes: few bytes must not become few tasks.
    spread(files, ["file"]).write.partitionBy("file").json(path)
    return path


@query
def s8_config_files(spark: SparkSession, sf: str) -> DataFrame:
    out = configs.read_configs(spark, _write_configs(spark, sf))
    return out.select(
        "household_id",
        F.array_join("shiftable_devices", ",").alias("shiftable_devices"),
        F.array_join("active_appliances", ",").alias("active_appliances"),
        "threshold",
    )


@query
def a21_device_legend(spark: SparkSession, sf: str) -> DataFrame:
    out = configs.device_legend(configs.read_configs(spark, _write_configs(spark, sf)), 2)
    return out.select("household_id", F.col("0").alias("device_0"), F.col("1").alias("device_1"))


@query
def s9_s10_store_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Load table written twice, under two pairs of activity and usage models, then read back: both are there."""
    path = scratch_dir(spark)
    for activity_model, usage_model in (("knn", "knn"), ("logit", "rate"), ("knn", "knn")):
        store.dump(path, {"df": _load(spark, sf)}, activity_model, usage_model, False)
    back = store.load(spark, path, ["df"])["df"]
    return back.groupBy("household_id", "device", "activity_model", "usage_model").agg(
        big(F.count(F.lit(1)), "n"), r6(F.sum("load"), "load")
    )


# filters ------------------------------------------------------------------------------------------


@query
def f1_unpack_attributes(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.unpack_attributes(fx.state_attributes(spark, sf))
    return out.withColumnRenamed("calibration.offset", "calibration_offset").withColumn(
        "restored", integer("restored")
    )


@query
def f1_attribute_value(spark: SparkSession, sf: str) -> DataFrame:
    """Undeclared keys straight from the JSON."""
    attrs = fx.state_attributes(spark, sf)
    return attrs.select(
        "attributes_id",
        clean.attribute_value("friendly_name").alias("friendly_name"),
        clean.attribute_value("calibration.offset", "double").alias("calibration_offset"),
    )


@query
def f2_sparse_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of the joined table, their values and whether the column stays."""
    table = fx.readings(spark, sf).withColumnRenamed("calibration.offset", "calibration_offset")
    limit = clean.sparse_limit(len(table.columns))
    counts = clean.non_null_counts(table)
    return counts.select("column", big("n_non_null"), (F.col("n_non_null") >= limit).cast("int").alias("kept"))


@query
def f3_numeric_states(spark: SparkSession, sf: str) -> DataFrame:
    """Unparsable states stay as rows without a number."""
    out = clean.coerce_state(fx.states(spark, sf))
    return out.groupBy("entity_id").agg(
        big(F.count(F.lit(1)), "n_rows"), big(F.count("state"), "n_numbers"), r6(F.sum("state"), "total")
    )


@query
def f4_watt_devices(spark: SparkSession, sf: str) -> DataFrame:
    out = hourly.watt_rows(fx.readings(spark, sf), fx.SHIFTABLE)
    return out.select(*EVENT, ts("last_updated_ts"))


@query
def f5_switched_on(spark: SparkSession, sf: str) -> DataFrame:
    out = hourly.on_rows(fx.readings(spark, sf), fx.ACTIVE).withColumn("state", F.lit(1))
    return out.select(*EVENT, ts("last_updated_ts"))


@query
def f6_last_days(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.recent(fx.states(spark, sf), fx.span(spark, sf).now, 7)
    return out.groupBy("household_id", "entity_id").agg(big(F.count(F.lit(1)), "n"))


@query
def f7_timespan(spark: SparkSession, sf: str) -> DataFrame:
    """Both ends belong to the span."""
    out = clean.timespan(_load(spark, sf), "hour_ts", "2024-01-10 06:00:00", days=1, hours=6)
    return out.select("household_id", "device", ts("hour_ts"), r6("load"))


@query
def f8_complete_days(spark: SparkSession, sf: str) -> DataFrame:
    """Incomplete first days and an incomplete end date are cut."""
    out = clean.prove_start_end(_load(spark, sf), ["household_id", "device"], "hour_ts", fx.span(spark, sf).today)
    return out.groupBy("household_id", "device").agg(
        ts(F.min("hour_ts"), "first_hour"), ts(F.max("hour_ts"), "last_hour"), big(F.count(F.lit(1)), "n")
    )


@query
def f9_until_yesterday(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.until_yesterday(_load(spark, sf), "hour_ts", "2024-01-15")
    return out.groupBy("household_id", "device").agg(
        ts(F.max("hour_ts"), "last_hour"), big(F.count(F.lit(1)), "n"), r6(F.sum("load"), "load")
    )


@query
def f17_numeric_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of every numeric column of the event table."""
    events = fx.events(spark, sf)
    return events.agg(*[r6(F.avg(c), c) for c in clean.numeric_columns(events)])


# joins and set operations -------------------------------------------------------------------------


@query
def j1_attribute_join(spark: SparkSession, sf: str) -> DataFrame:
    """All states with their attribute sets; a state without one keeps NULLs."""
    known = clean.unpack_attributes(fx.state_attributes(spark, sf))
    out = states.join_attributes(fx.states(spark, sf), known)
    return out.groupBy("household_id", "entity_id").agg(
        big(F.count(F.lit(1)), "n"), big(F.count("friendly_name"), "n_named")
    )


@query
def j2_outer_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Power pivot and switch pivot joined on the timestamp: the side that did not report is NULL, not 0."""
    rows = fx.readings(spark, sf)
    switches = ["click", "error"]
    watt = hourly.pivot_devices(hourly.watt_rows(rows, fx.WATT), fx.WATT, F.coalesce(number("state"), F.lit(0.0)))
    on = hourly.pivot_devices(hourly.on_rows(rows, switches), switches, F.lit(1.0))
    out = watt.join(on, ["household_id", "last_updated_ts"], "full_outer")
    return out.select("household_id", ts("last_updated_ts"), *fx.WATT, *switches)


@query
def j5_column_bind(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute columns next to the base columns, by key."""
    out = states.join_attributes(fx.states(spark, sf), clean.unpack_attributes(fx.state_attributes(spark, sf)))
    return out.select(*EVENT, ts("last_updated_ts"), "attributes_id", "unit_of_measurement", "friendly_name")


@query
def u1_union_years(spark: SparkSession, sf: str) -> DataFrame:
    """The same prices for two years, stacked."""
    p = fx.prices(spark, sf)
    earlier = p.withColumn("hour", F.add_months("hour", -12).cast("timestamp") + (F.col("hour") - F.date_trunc("day", "hour")))
    return p.unionByName(earlier).select("zone", ts("hour"), r6("price"))


@query
def u2_distinct_days(spark: SparkSession, sf: str) -> DataFrame:
    return fx.states(spark, sf).select("household_id", day("last_updated_ts", "day")).distinct()


@query
def u3_non_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Weather column names without the all-empty ones."""
    table = fx.weather(spark, sf).drop("station", "time")
    return clean.non_null_counts(table).filter(F.col("n_non_null") > 0).select("column")


# cleaning and shaping -----------------------------------------------------------------------------


@query
def a1_device_pivot(spark: SparkSession, sf: str) -> DataFrame:
    rows = hourly.watt_rows(fx.readings(spark, sf), fx.SHIFTABLE)
    out = hourly.pivot_devices(rows, fx.SHIFTABLE, number("state"))
    return out.select("household_id", ts("last_updated_ts"), *fx.SHIFTABLE)


@query
def a1_duplicate_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings that share household, device and second, and, coarser, the hour."""
    rows = fx.states(spark, sf)
    parts = [rows.withColumn("last_updated_ts", F.date_trunc(unit, "last_updated_ts")) for unit in ("second", "hour")]
    out = hourly.duplicate_readings(parts[0]).unionByName(hourly.duplicate_readings(parts[1]))
    return out.select("household_id", "entity_id", ts("last_updated_ts"), big("n"))


@query
def a2_hourly_load(spark: SparkSession, sf: str) -> DataFrame:
    """Gap-free hourly means; the mean divides by all distinct timestamps of the device group."""
    return _load(spark, sf).select("household_id", "device", ts("hour_ts"), r6("value"))


def _resampled(spark: SparkSession, sf: str, period: str) -> DataFrame:
    rows = hourly.watt_rows(fx.readings(spark, sf), fx.WATT).withColumn("value", number("state"))
    out = hourly.resample_mean(rows, ["household_id", "entity_id"], "last_updated_ts", ["value"], period)
    return out.select("household_id", "entity_id", ts("last_updated_ts"), r6("value"))


@query
def a3_resample_7min(spark: SparkSession, sf: str) -> DataFrame:
    """7-minute means of every power device, counted from midnight of its first day; empty bins are NULL."""
    return _resampled(spark, sf, "7T")


@query
def a3_resample_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf, "1D")


@query
def a5_outlier_truncation(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading of a power sensor, cut at the quartile bounds of the household's device."""
    rows = hourly.watt_rows(fx.readings(spark, sf), fx.WATT).withColumn("value", number("state"))
    out = clean.outlier_truncation(rows, ["household_id", "entity_id"], "value", 0.2)
    return out.select("household_id", "entity_id", ts("last_updated_ts"), r6("value"))


@query
def a6_truncate_non_zero(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly loads, zeros left alone and not counted in the quartiles."""
    out = clean.outlier_truncation(_load(spark, sf), ["household_id", "device"], "value", 0.2, non_zero=True)
    return out.select("household_id", "device", ts("hour_ts"), r6("value"))


@query
def a7_min_max_scale(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.scale(_load(spark, sf), ["household_id", "device"], "value")
    return out.select("household_id", "device", ts("hour_ts"), r6("value"))


@query
def a8_friendly_names(spark: SparkSession, sf: str) -> DataFrame:
    return clean.friendly_names(fx.readings(spark, sf), fx.SHIFTABLE, fx.span(spark, sf).now)


@query
def p4_friendly_name_table(spark: SparkSession, sf: str) -> DataFrame:
    """Unpacked attributes to one name per device: the latest."""
    return clean.latest_friendly_name(fx.readings(spark, sf), fx.SHIFTABLE, fx.span(spark, sf).now)


@query
def a15_days_in_range(spark: SparkSession, sf: str) -> DataFrame:
    """Every calendar day between a household's first and last event."""
    bounds = fx.states(spark, sf).groupBy("household_id").agg(
        F.to_date(F.min("last_updated_ts")).alias("a"), F.to_date(F.max("last_updated_ts")).alias("b")
    )
    return bounds.select("household_id", F.explode(F.sequence("a", "b")).alias("d")).select("household_id", day("d", "day"))


@query
def a16_last_reported(spark: SparkSession, sf: str) -> DataFrame:
    out = clean.last_reported(fx.states(spark, sf), ["household_id"], "last_updated_ts")
    gap = clean.days_between(F.col("last_reported"), F.lit("2024-02-10").cast("date"))
    return out.select("household_id", day("last_reported"), integer(gap, "days"))


@query
def a26_data_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Count, missing, mean, spread and quartiles per household and power sensor."""
    rows = hourly.watt_rows(fx.readings(spark, sf), fx.WATT).withColumn("value", number("state"))
    counted = rows.groupBy("household_id", "entity_id", "value").agg(F.count(F.lit(1)).alias("n"))
    q = F.percentile("value", F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)]), F.col("n"))
    n = F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    mean = F.sum(F.col("value") * F.col("n")) / n
    square = F.sum(F.col("value") * F.col("value") * F.col("n"))
    out = counted.groupBy("household_id", "entity_id").agg(
        big(n, "count"),
        big(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)), "missing"),
        r6(mean, "mean"),
        r6(F.sqrt((square - mean * mean * n) / (n - 1)), "std"),
        r6(F.min("value"), "min"),
        r6(F.max("value"), "max"),
        q.alias("q"),
    )
    return out.select("*", *[r6(F.col("q")[i], f"q{i + 1}") for i in range(3)]).drop("q")


@query
def a26_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Readings per household and device in 10 equal bins of 0..500."""
    rows = hourly.watt_rows(fx.readings(spark, sf), fx.WATT).withColumn("value", number("state"))
    bin_ = F.width_bucket("value", F.lit(0.0), F.lit(500.0), F.lit(10))
    return rows.groupBy("household_id", "entity_id", integer(bin_, "bin")).agg(big(F.count(F.lit(1)), "n"))


# scalar functions ---------------------------------------------------------------------------------


@query
def fn_time_features(spark: SparkSession, sf: str) -> DataFrame:
    cols = time_features("hour")
    base = fx.prices(spark, sf)
    return base.select(ts("hour", "at"), *[c.alias(n) for n, c in cols.items()])


@query
def fn_safe_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("Sensor."), F.col("event_type"), F.lit(" (Plug 1)"))
    return fx.events(spark, sf).select(raw.alias("entity")).distinct().select(
        "entity", safe_name("entity").alias("safe"), safe_name_spaced("entity").alias("safe_spaced")
    )


@query
def fn_dummies(spark: SparkSession, sf: str) -> DataFrame:
    """Dummy columns of month and entity; the alphabetically first category has none."""
    rows = fx.states(spark, sf)
    month = dummies(F.date_format("last_updated_ts", "MMMM"), MONTH_NAMES, "month")
    entity = dummies(F.col("entity_id"), fx.ACTIVE, "entity")
    flagged = rows.select("household_id", *month, *entity)
    return flagged.groupBy("household_id").agg(*[big(F.sum(c), c) for c in flagged.columns[1:]])
