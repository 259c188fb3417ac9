"""Hourly means over a stream of readings, divided by the distinct timestamps of the whole device group.

Two keyed states follow each other: one row per (household, timestamp), whose keys spread even if one household sends most events, then
one per (household, hour), which counts these rows. The denominator thus needs no set of timestamps. Gaps are filled when the hours are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.functions.expressions import number
from loadshift.operators.hourly import value_columns, watt_rows
from loadshift.streaming.hourly import completed

HOUR = ("household_id", "hour_ts")


def _power(readings: DataFrame, devices: list[str]) -> DataFrame:
    """Power readings with a household and a time; others have no place in an hour."""
    rows = watt_rows(readings, devices).select(
        "household_id", "entity_id", F.col("last_updated_ts").alias("ts"), F.coalesce(number("state"), F.lit(0.0)).alias("value")
    )
    return rows.filter("household_id IS NOT NULL AND ts IS NOT NULL")


def _hours(rows: DataFrame, devices: list[str], hour: Column) -> DataFrame:
    cols = value_columns(devices)
    quoted = [d.replace("'", "''") for d in devices]
    sums = [F.expr(f"sum(CASE WHEN entity_id = '{d}' THEN value END) AS {c}") for c, d in zip(cols, quoted)]
    per_ts = rows.groupBy("household_id", "ts").agg(F.count(F.lit(1)).alias("n"), *sums)
    totals = [F.sum(c).alias(c) for c in ("n", *cols)]
    return per_ts.groupBy("household_id", hour).agg(F.count(F.lit(1)).alias("n_times"), *totals)


def closed_hours(readings: DataFrame, devices: list[str], lateness: str = "2 hours") -> DataFrame:
    """household_id, hour_ts, n_times (distinct timestamps), n (readings) and one sum per device (v0, v1, ...) of each hour of an append-only
    stream that the watermark has passed. Later events are not in it, see ``late_hours``."""
    rows = _power(readings, devices).withWatermark("ts", lateness)
    hours = _hours(rows, devices, F.window("ts", "1 hour").alias("hour"))
    return hours.select("household_id", F.col("hour.start").alias("hour_ts"), "n_times", "n", *value_columns(devices))


def _counted(readings: DataFrame, devices: list[str], closed: DataFrame) -> DataFrame:
    rows = _power(readings, devices)
    counts = rows.groupBy("household_id", F.date_trunc("hour", "ts").alias("hour_ts")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(closed.select(*HOUR, F.col("n").alias("n_closed")), list(HOUR), "left")


def late_hours(readings: DataFrame, devices: list[str], closed: DataFrame) -> DataFrame:
    """household_id, hour_ts, n_late: how many readings came after the stream had closed their hour."""
    return _counted(readings, devices, closed).filter("n > n_closed").select(*HOUR, (F.col("n") - F.col("n_closed")).alias("n_late"))


def closing_hours(readings: DataFrame, devices: list[str], closed: DataFrame) -> DataFrame:
    """The batch step at the end of a span: rows, as in ``closed_hours``, of the hours that the stream did not close or closed without late
    events. Readings of all other hours are counted and no more."""
    wanted = _counted(readings, devices, closed).filter("NOT n <=> n_closed").select(*HOUR)
    rows = _power(readings, devices).withColumn("hour_ts", F.date_trunc("hour", "ts")).join(wanted, list(HOUR), "left_semi")
    return _hours(rows, devices, F.date_trunc("hour", "ts").alias("hour_ts")).select(closed.columns)


def means(closed: DataFrame, closing: DataFrame, devices: list[str]) -> DataFrame:
    """household_id, hour_ts and a mean per device, as ``operators.hourly.hourly_means``; ``features.load_input`` fills the gaps."""
    hours = completed(closed, closing, HOUR)
    return hours.select(*HOUR, *[F.expr(f"coalesce({c} / n_times, 0D) AS {c}") for c in value_columns(devices)])
