"""Streams against the same rows in one batch."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loadshift.operators import hourly
from loadshift.streaming import load

DEVICES = ["a", "b'c"]
READING = "household_id int, entity_id string, state string, unit_of_measurement string, last_updated_ts timestamp"
T0 = datetime(2024, 3, 1)


def rows(seed, n=3000):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = T0 + timedelta(seconds=30 * rng.randint(0, 2880))  # a day in steps of 30 s: many equal timestamps
        if at.hour in (4, 5, 6):
            continue  # a gap
        household = rng.choice([1, 1, 1, 2, None]) if rng.random() < 0.9 else 3
        state = rng.choice([str(rng.randint(0, 90)), "unavailable", None])
        out.append((household, rng.choice([*DEVICES, "other"]), state, rng.choice(["W", "W", "W", None, "V"]), at if rng.random() < 0.99 else None))
    return sorted(out, key=lambda r: (r[4] or T0, str(r)))


def run(spark, tmp_path, batches, lateness="1 hour"):
    folder = tmp_path / "in"
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, READING).coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")
    stream = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{folder}/part=*")
    out = load.closed_hours(stream, DEVICES, lateness)
    job = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress"))
    job.trigger(availableNow=True).start().awaitTermination()
    readings = spark.createDataFrame([r for b in batches for r in b], READING)
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out")), readings


def hours(df):
    return {(r.household_id, r.hour_ts): (round(r.v0, 9), round(r.v1, 9)) for r in df.collect()}


def test_streamed_means_equal_the_batch(spark, tmp_path):
    """Six batches in order of time, the last with readings of hours long closed, of a new household and of an empty hour."""
    ordered = rows(1)
    late = [(1, "a", "70", "W", T0 + timedelta(hours=2, seconds=7)), (1, "a", "5", "W", T0 + timedelta(hours=2, seconds=7)), (9, "a", "3", "W", T0), (1, "b'c", "8", "W", T0 + timedelta(hours=5))]
    size = len(ordered) // 6 + 1
    batches = [ordered[i : i + size] for i in range(0, len(ordered), size)]
    batches[-1] = batches[-1] + late
    closed, readings = run(spark, tmp_path, batches)
    closing = load.closing_hours(readings, DEVICES, closed)
    known = readings.filter("household_id IS NOT NULL AND last_updated_ts IS NOT NULL")
    want = hours(hourly.hourly_means(known, DEVICES))
    assert hours(load.means(closed, closing, DEVICES)) == want
    assert 20 < closed.count() < len(want)
    # only open and late hours are summed once more
    assert closing.count() < len(want) / 2
    assert [tuple(r) for r in load.late_hours(readings, DEVICES, closed).collect()] == [(1, T0 + timedelta(hours=2), 2)]
    times = known.filter("unit_of_measurement = 'W'").filter(F.col("entity_id").isin(DEVICES)).groupBy("household_id", F.date_trunc("hour", "last_updated_ts").alias("h"))
    distinct = {(r.household_id, r.h): r.n for r in times.agg(F.countDistinct("last_updated_ts").alias("n")).collect()}
    assert all(distinct[(r.household_id, r.hour_ts)] == r.n_times for r in closing.collect())


def test_stream_without_power_readings(spark, tmp_path):
    closed, readings = run(spark, tmp_path, [[(1, "other", "1", "W", T0), (1, "a", "1", None, T0)]])
    assert closed.count() == 0
    assert load.means(closed, load.closing_hours(readings, DEVICES, closed), DEVICES).count() == 0
