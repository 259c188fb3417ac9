"""48-hour price horizons and shifted price tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOURS = 48


def dense_prices(prices: DataFrame, extra_days: int = 2) -> DataFrame:
    """Gap-free hours per zone from the first priced hour to ``extra_days`` days after the last priced day."""
    w = Window.partitionBy("zone").orderBy("hour")
    one = F.expr("INTERVAL 1 HOUR")
    end = F.date_trunc("day", "hour") + F.make_dt_interval(F.lit(extra_days), F.lit(23))
    nxt = F.coalesce(F.lead("hour").over(w) - one, end)
    grid = prices.withColumn("_next", nxt).select(
        "zone", F.col("hour").alias("_seen"), "price", F.explode(F.sequence("hour", "_next", one)).alias("hour")
    )
    return grid.select("zone", "hour", F.when(F.col("hour") == F.col("_seen"), F.col("price")).alias("price"))


def fill_from_previous_days(prices: DataFrame, extra_days: int = 2) -> DataFrame:
    """A missing hour takes the price of the same hour one day earlier, else two days earlier."""
    w = Window.partitionBy("zone").orderBy("hour")
    filled = F.coalesce("price", F.lag("price", 24).over(w), F.lag("price", 48).over(w))
    return dense_prices(prices, extra_days).select("zone", "hour", filled.alias("price"))


def horizons(
    prices: DataFrame, first_date: str, last_date: str, timezone: str = "UTC", as_of: str | None = None
) -> DataFrame:
    """zone, date, prices[48]: the 48 hours from local midnight of date + 1, for every calculation date.

    Known hours keep their price; later ones copy the same hour one or two days earlier, which for the
    day of calculation is "today". With ``as_of`` a horizon beyond the last priced day copies that
    day's hours instead. Hours that stay unknown are NULL. Prices are instants in UTC.
    """
    filled = fill_from_previous_days(prices)
    days = F.explode(F.sequence(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))).alias("date")
    zones = prices.groupBy("zone").agg(F.max(F.to_date(F.from_utc_timestamp("hour", timezone))).alias("last_day"))
    hours = f"transform(sequence(0, {HOURS - 1}), i -> midnight + make_dt_interval(0, i))"
    midnight = F.to_utc_timestamp(F.date_add("date", 1).cast("timestamp"), timezone).alias("midnight")
    wanted = (
        zones.select("zone", "last_day", days)
        .select("*", midnight)
        .select("zone", "date", "last_day", F.expr(f"posexplode({hours}) AS (offset, hour)"))
    )
    joined = wanted.join(filled, ["zone", "hour"], "left")
    price = F.col("price")
    if as_of is not None:
        today = prices.filter(F.to_date(F.from_utc_timestamp("hour", timezone)) == F.lit(as_of).cast("date")).select(
            "zone", F.hour(F.from_utc_timestamp("hour", timezone)).alias("_h"), F.col("price").alias("_today")
        )
        joined = joined.withColumn("_h", F.hour(F.from_utc_timestamp("hour", timezone))).join(today, ["zone", "_h"], "left")
        price = F.when(F.date_add("date", 1) > F.col("last_day"), F.col("_today")).otherwise(price)
    ordered = F.expr("transform(sort_array(collect_list(struct(offset, price))), s -> s.price) AS prices")
    return joined.withColumn("price", price).groupBy("zone", "date").agg(ordered)


def price_grid(horizon: DataFrame) -> DataFrame:
    """The long form of ``horizons``: zone, date, offset, price."""
    return horizon.select("zone", "date", F.posexplode("prices").alias("offset", "price"))


def shifted_prices(horizon: DataFrame) -> DataFrame:
    """24 rows per (zone, date) with Price_at_H+0 .. Price_at_H+23: the price i hours after the start hour."""
    hour = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    rows = horizon.select("zone", "date", "prices", hour)
    cols = [F.expr(f"get(prices, hour + {i}) AS `Price_at_H+{i}`") for i in range(24)]
    return rows.select("zone", "date", "hour", *cols)
