"""Day-ahead price tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.schemas import PRICE_CSV


def read_price_csv(
    spark: SparkSession, path: str, year: int, years: tuple[int, ...], fmt: str = "dd.MM.yyyy HH:mm"
) -> DataFrame:
    """Price file with interval labels '01.01.2015 00:00 - 01.01.2015 01:00', replicated to other years.

    The year is replaced as text in the part before the dash; labels that do not exist in the target
    year (29 February) are dropped.
    """
    rows = spark.read.csv(path, schema=PRICE_CSV, header=True)
    start = F.trim(F.split("interval", "-")[0])
    other = F.explode(F.array(*[F.lit(str(y)) for y in years]))
    return (
        rows.select(start.alias("start"), "price", other.alias("year"))
        .select(
            F.try_to_timestamp(F.replace("start", F.lit(str(year)), F.col("year")), F.lit(fmt)).alias("time"), "price"
        )
        .filter(F.col("time").isNotNull())
    )


def localise(prices: DataFrame, timezone: str) -> DataFrame:
    """Wall-clock hours of a zone to instants."""
    return prices.withColumn("hour", F.to_utc_timestamp("hour", timezone))


def prices_around(prices: DataFrame, date: str, timezone: str, days: int = 20) -> DataFrame:
    """Prices within ``days`` days of the day after ``date`` (local midnights), in UTC."""
    target = F.date_add(F.lit(date).cast("date"), 1)

    def midnight(d):
        return F.to_utc_timestamp(d.cast("timestamp"), timezone)

    lower, upper = midnight(F.date_sub(target, days)), midnight(F.date_add(target, days))
    return localise(prices, timezone).filter(F.col("hour").between(lower, upper))


def price_history(prices: DataFrame, start: str, end: str) -> DataFrame:
    """Hours in [start, end)."""
    return prices.filter((F.col("hour") >= F.lit(start).cast("timestamp")) & (F.col("hour") < F.lit(end).cast("timestamp")))
