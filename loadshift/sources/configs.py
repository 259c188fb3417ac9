"""Household configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.schemas import CONFIG_JSON


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """household_id, shiftable_devices, active_appliances, threshold from every *config.json of a folder."""
    raw = spark.read.json(f"{path}/*config.json", schema=CONFIG_JSON, multiLine=True)
    return raw.select(F.col("data.household").alias("household_id"), "user_input.*")


def device_legend(configs: DataFrame, max_devices: int) -> DataFrame:
    """Household x device position table, ordered by household."""
    positions = configs.select("household_id", F.posexplode("shiftable_devices").alias("position", "device"))
    wide = positions.groupBy("household_id").pivot("position", list(range(max_devices))).agg(F.first("device"))
    return wide.orderBy("household_id")
