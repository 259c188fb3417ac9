"""Weather observations for the time range of a feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadshift.schemas import WEATHER_COLUMNS


def observations_for(weather: DataFrame, features: DataFrame, ts: str) -> DataFrame:
    """Rows between the first and last feature time. The bounds are a one-row aggregate."""
    bounds = features.agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    inside = F.col("time").between(F.col("_first"), F.col("_last"))
    return weather.join(F.broadcast(bounds), inside).drop("_first", "_last")


def daily(weather: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Daily means per station."""
    columns = columns or WEATHER_COLUMNS
    return weather.groupBy("station", F.date_trunc("day", "time").alias("time")).agg(
        *[F.avg(c).alias(c) for c in columns]
    )
