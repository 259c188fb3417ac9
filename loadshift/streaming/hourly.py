"""The hourly base of the feature tables over a stream of states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.functions.expressions import number


def _valued(states: DataFrame, devices: list[str]) -> tuple[DataFrame, Column]:
    return states.filter(F.col("entity_id").isin(list(devices))), F.coalesce(number("state"), F.lit(0.0))


def hourly_sums(states: DataFrame, devices: list[str], lateness: str = "2 hours") -> DataFrame:
    """household_id, entity_id, hour_ts, value_sum, n per closed hour of an append-only state stream.

    Events later than ``lateness`` behind the newest one, and hours that are still open, are left to ``closing_sums``. Sums and
    counts merge further; the group-wide mean divides by the distinct timestamps in the batch layer.
    """
    rows, value = _valued(states, devices)
    window = F.window("last_updated_ts", "1 hour")
    return (
        rows.withWatermark("last_updated_ts", lateness)
        .groupBy("household_id", "entity_id", window)
        .agg(F.sum(value).alias("value_sum"), F.count(F.lit(1)).alias("n"))
        .select("household_id", "entity_id", F.col("window.start").alias("hour_ts"), "value_sum", "n")
    )


def closing_sums(states: DataFrame, devices: list[str], closed: DataFrame) -> DataFrame:
    """The batch step at the end of a span: rows, as in ``hourly_sums``, of all hours of ``states`` that the stream did not close or
    closed without late events. They replace what ``closed`` has for these hours."""
    rows, value = _valued(states, devices)
    keys = ["household_id", "entity_id", "hour_ts"]
    full = rows.groupBy("household_id", "entity_id", F.date_trunc("hour", "last_updated_ts").alias("hour_ts"))
    full = full.agg(F.sum(value).alias("value_sum"), F.count(F.lit(1)).alias("n"))
    seen = closed.select(*keys, F.col("n").alias("_seen"))
    return full.join(seen, keys, "left").filter(~F.col("n").eqNullSafe(F.col("_seen"))).drop("_seen")


def completed(closed: DataFrame, closing: DataFrame, keys: tuple[str, ...] = ("household_id", "entity_id", "hour_ts")) -> DataFrame:
    return closed.join(closing.select(*keys), list(keys), "left_anti").unionByName(closing)
