"""Smart-home tables derived from the generic event table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.operators.clean import unpack_attributes
from loadshift.sources.states import join_attributes

EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
SHIFTABLE = ["purchase", "signup"]
ACTIVE = ["purchase", "signup", "view", "click", "error"]
WATT = ["purchase", "signup", "view"]
THRESHOLD = 30.0
ZONE = "Z1"
STATION = "W1"
# Which event type carries which weather reading.
WEATHER_SOURCE = {"temp": "click", "dwpt": "error", "rhum": "purchase", "wdir": "signup", "wspd": "view"}


@dataclass(frozen=True)
class Span:
    """The dates of a run over all events, as texts: the first recommendations are made on the fifth day, the last ones on the day before
    today, the day of the last event; now is the midnight after it."""

    start: str
    today: str

    def on(self, days: int) -> str:
        """So many days after the first event's day; before today for negative numbers."""
        return (date.fromisoformat(self.start if days >= 0 else self.today) + timedelta(days)).isoformat()

    @property
    def first(self) -> str:
        return self.on(4)

    @property
    def last(self) -> str:
        return self.on(-1)

    @property
    def now(self) -> str:
        return f"{date.fromisoformat(self.today) + timedelta(1)} 00:00:00"


def span(spark: SparkSession, sf_dir: str) -> Span:
    """From the smallest and the largest timestamp, the one row that queries fetch while they are built. Without events the dates are
    those of 1970."""
    row = events(spark, sf_dir).agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
    return Span((row.a or date(1970, 1, 1)).isoformat(), (row.b or date(1970, 1, 1)).isoformat())


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


_ENTITIES = ", ".join(f"'{e}'" for e in ACTIVE)
_IS_WATT = "event_type IN ({})".format(", ".join(f"'{e}'" for e in WATT))
_K = "cast(get_json_object(props, '$.k') AS bigint)"
_ATTRIBUTES_ID = f"{_K} * 8 + array_position(array({_ENTITIES}), event_type) - 1"


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states_of(events(spark, sf_dir))


def states_of(events_: DataFrame) -> DataFrame:
    return events_.selectExpr(
        "cast(floor(user_id / 5) AS int) AS household_id",
        "event_type AS entity_id",
        f"CASE WHEN {_IS_WATT} THEN cast(value AS string) WHEN value >= 35 THEN 'on' ELSE 'off' END AS state",
        "ts AS last_updated_ts",
        f"{_ATTRIBUTES_ID} AS attributes_id",
    )


def state_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (entity, k); switches have no unit, and only a few sets carry a nested calibration."""
    pairs = events(spark, sf_dir).selectExpr("event_type", f"{_K} AS k", f"{_ATTRIBUTES_ID} AS attributes_id").distinct()
    text = f"""concat('{{', CASE WHEN {_IS_WATT} THEN '"unit_of_measurement": "W", ' ELSE '' END,
        '"friendly_name": "', initcap(event_type), ' plug ', k % 2,
        '", "restored": ', CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END, ', "device_class": null',
        CASE WHEN k = 7 THEN ', "calibration": {{"offset": 0.5}}' ELSE '' END, '}}') AS shared_attrs"""
    return pairs.selectExpr("attributes_id", text)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States joined with their unpacked attributes: the input of every feature table."""
    return readings_of(states(spark, sf_dir), spark, sf_dir)


def readings_of(some_states: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for given states, which may be a stream."""
    return join_attributes(some_states, unpack_attributes(state_attributes(spark, sf_dir)))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly price per MWh of one zone; hours without a view event are missing."""
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "view")
        .groupBy(F.date_trunc("hour", "ts").alias("hour"))
        .agg((F.avg("value") - 5).alias("price"))
        .select(F.lit(ZONE).alias("zone"), "hour", "price")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [F.avg(F.when(F.col("event_type") == e, F.col("value"))).alias(c) for c, e in WEATHER_SOURCE.items()]
    return (
        events(spark, sf_dir)
        .groupBy(F.date_trunc("hour", "ts").alias("time"))
        .agg(*cols, F.lit(None).cast("double").alias("tsun"))
        .select(F.lit(STATION).alias("station"), "time", *WEATHER_SOURCE, "tsun")
    )


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each household with its price zone and weather station."""
    return states(spark, sf_dir).select("household_id").distinct().withColumns({"zone": F.lit(ZONE), "station": F.lit(STATION)})
