"""Households kept as CSV files: one wide file per house plus a text file of appliance labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadshift.operators.joins import join_reference
from loadshift.schemas import HOUSEHOLD_CSV


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """household_id, appliance (Appliance0..9), label from the label text.

    A house section begins with a line 'House N'; its entries read '0.Aggregate, 1.Fridge, ...'. A file is read in blocks by several
    tasks: the house of a line is that of the last such line before it in its block, or else in the blocks before, of which one row
    each is looked at. Lines before any house name no appliance.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # grows along the lines of a block
    )
    number = F.regexp_extract("value", r"^House (\d+)", 1)
    numbered = lines.withColumn("house", F.when(number != "", number).cast("int"))
    in_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    own = numbered.withColumn("house", F.last("house", ignorenulls=True).over(in_block))
    ends = numbered.groupBy("file", "block").agg(F.max_by("house", F.when(F.col("house").isNotNull(), F.col("at"))).alias("house"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("file", "block", F.last("house", ignorenulls=True).over(before).alias("carried"))
    household = F.coalesce("house", "carried").alias("household_id")
    entry = F.explode(F.regexp_extract_all("value", F.lit(r"\d\.[^,]+"), F.lit(0))).alias("entry")
    return (
        own.join(carried, ["file", "block"])
        .select(household, entry)
        .filter("household_id IS NOT NULL")
        .select(
            "household_id",
            F.concat(F.lit("Appliance"), F.substring_index("entry", ".", 1)).alias("appliance"),
            F.expr("substring(entry, instr(entry, '.') + 1)").alias("label"),
        )
    )


def read_households(spark: SparkSession, path: str) -> DataFrame:
    """All CLEAN_HouseN.csv files (or folders of part files) below a folder; household_id is N."""
    name = F.regexp_extract(F.input_file_name(), r"CLEAN_House(\d+)\.csv", 1)
    files = spark.read.csv(f"{path}/*CLEAN_House*.csv", schema=HOUSEHOLD_CSV, header=True)
    return files.withColumn("household_id", name.cast("int"))


def label_appliances(households: DataFrame, labels: DataFrame) -> DataFrame:
    """Long form with the house's own labels: household_id, Time, device, value.

    The wide row is unpivoted in place and the label table (ten rows per house) is joined, instead of
    renaming columns house by house. One house may hold a third of the readings.
    """
    appliances = [c for c in households.columns if c.startswith("Appliance")]
    long = households.unpivot(["household_id", "Time"], appliances, "appliance", "value")
    labelled = join_reference(long, labels, ["household_id", "appliance"]).filter(F.col("label").isNotNull())
    return labelled.select("household_id", "Time", F.col("label").alias("device"), "value")


def load_household(spark: SparkSession, path: str, labels_path: str, house_id: int | None = None) -> DataFrame:
    houses = read_households(spark, path)
    if house_id is not None:
        houses = houses.filter(F.col("household_id") == house_id)
    return label_appliances(houses, read_labels(spark, labels_path))
