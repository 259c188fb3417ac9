"""The raw event log and its attribute dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A landed table as Parquet, CSV or JDBC."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load() if fmt == "jdbc" else reader.load(path)


def with_event_time(states: DataFrame) -> DataFrame:
    """last_updated_ts from epoch seconds."""
    return states.withColumn("last_updated_ts", F.timestamp_seconds(F.col("last_updated_ts")))


def newer_than(states: DataFrame, now: str, number_days: int) -> DataFrame:
    """Rows strictly newer than ``now`` minus ``number_days`` days; a plain comparison, so it reaches the scan."""
    start = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(number_days))
    return states.filter(F.col("last_updated_ts") > start)


def join_attributes(states: DataFrame, attributes: DataFrame) -> DataFrame:
    """LEFT join on attributes_id; states without attributes keep NULLs.

    No broadcast is forced: the engine broadcasts the dictionary while it is below its size limit and
    otherwise shuffles, where adaptive execution splits a hot attributes_id. Pass an unpacked dictionary
    to parse the JSON once per attribute set and not once per state.
    """
    return states.join(attributes, "attributes_id", "left")


def export_states(states: DataFrame, attributes: DataFrame, now: str, number_days: int = 30) -> DataFrame:
    return join_attributes(newer_than(states, now, number_days), attributes)
