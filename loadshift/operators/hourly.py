"""Regular hour grids from raw readings.

A hot household may hold a third of all events, so raw rows are reduced in two steps: first per
(household, timestamp), whose keys spread over the whole cluster, then per (household, hour) with
map-side sums. Only the hourly table, bounded by the clock, is ever laid out by household.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadshift.functions.expressions import number
from loadshift.session import spread


def value_columns(devices: list[str]) -> list[str]:
    return [f"v{i}" for i in range(len(devices))]


def watt_rows(states: DataFrame, devices: list[str]) -> DataFrame:
    return states.filter(F.col("unit_of_measurement").isin("W") & F.col("entity_id").isin(list(devices)))


def on_rows(states: DataFrame, devices: list[str]) -> DataFrame:
    return states.filter((F.col("state") == "on") & F.col("entity_id").isin(list(devices)))


def hourly_means(states: DataFrame, devices: list[str], with_switches: bool = False) -> DataFrame:
    """household_id, hour_ts and one mean per device (v0, v1, ...) for the hours that have readings.

    The mean of a power sensor is its sum over the number of distinct timestamps of all power sensors
    of the group in that hour; unparsable states count as 0. Switches that are on count 1 over the
    distinct timestamps at which any switch of the group was on.
    """
    watt = "coalesce(unit_of_measurement = 'W', false)"
    wanted = f"{watt} OR state = 'on'" if with_switches else watt
    rows = states.filter(F.col("entity_id").isin(list(devices))).filter(wanted)
    rows = rows.select(
        "household_id",
        "entity_id",
        F.col("last_updated_ts").alias("ts"),
        F.expr(f"{watt} AS watt"),
        F.coalesce(number("state"), F.lit(0.0)).alias("value"),
    )
    cols = value_columns(devices)
    literal = {c: d.replace("'", "''") for c, d in zip(cols, devices)}
    power = [F.expr(f"sum(CASE WHEN watt AND entity_id = '{literal[c]}' THEN value END) AS w_{c}") for c in cols]
    switch = [F.expr(f"sum(CASE WHEN NOT watt AND entity_id = '{literal[c]}' THEN 1D END) AS s_{c}") for c in cols]
    sums = power + switch if with_switches else power
    flags = [F.expr("max(cast(watt AS int)) AS n_watt"), F.expr("max(cast(NOT watt AS int)) AS n_on")]
    per_ts = rows.groupBy("household_id", "ts").agg(*flags, *sums)
    totals = [F.expr(f"sum({c}) AS {c}") for c in per_ts.columns if c not in ("household_id", "ts")]
    per_hour = per_ts.groupBy("household_id", F.date_trunc("hour", "ts").alias("hour_ts")).agg(*totals)
    mean = "coalesce(w_{0} / n_watt, 0D) + coalesce(s_{0} / n_on, 0D)" if with_switches else "coalesce(w_{0} / n_watt, 0D)"
    return per_hour.select("household_id", "hour_ts", *[F.expr(f"{mean.format(c)} AS {c}") for c in cols])


def hourly_base(states: DataFrame, groups: list[list[str]]) -> DataFrame:
    """One row per household and hour with all that the hourly means of several device groups need, from one pass over the readings.

    w: for each device (of ``base_devices``) the sum of its power readings, s: how often its switch was on; n_watt and n_on: for each
    group the distinct timestamps at which it had a power reading or a switch on. Hours without either have no row. To be written
    once; ``means_of_base`` then gives any group's means without the raw rows.
    """
    devices = base_devices(groups)
    watt = "coalesce(unit_of_measurement = 'W', false)"
    rows = states.filter(F.col("entity_id").isin(devices)).filter(f"{watt} OR state = 'on'")
    rows = rows.select(
        "household_id",
        "entity_id",
        F.col("last_updated_ts").alias("ts"),
        F.expr(f"{watt} AS watt"),
        F.coalesce(number("state"), F.lit(0.0)).alias("value"),
    )
    quoted = [d.replace("'", "''") for d in devices]
    sums = [F.expr(f"sum(CASE WHEN watt AND entity_id = '{d}' THEN value END) AS w{i}") for i, d in enumerate(quoted)]
    sums += [F.expr(f"sum(CASE WHEN NOT watt AND entity_id = '{d}' THEN 1D END) AS s{i}") for i, d in enumerate(quoted)]
    for g, group in enumerate(groups):
        of = F.col("entity_id").isin(list(group))
        sums += [F.max((F.col("watt") & of).cast("int")).alias(f"n_watt{g}"), F.max((~F.col("watt") & of).cast("int")).alias(f"n_on{g}")]
    per_ts = rows.groupBy("household_id", "ts").agg(*sums)
    names = [c for c in per_ts.columns if c not in ("household_id", "ts")]
    per_hour = per_ts.groupBy("household_id", F.date_trunc("hour", "ts").alias("hour_ts")).agg(*[F.sum(c).alias(c) for c in names])
    packed = {"w": [f"w{i}" for i in range(len(devices))], "s": [f"s{i}" for i in range(len(devices))]}
    packed |= {n: [f"{n}{g}" for g in range(len(groups))] for n in ("n_watt", "n_on")}
    return per_hour.select("household_id", "hour_ts", *[F.array(*cols).alias(n) for n, cols in packed.items()])


def base_devices(groups: list[list[str]]) -> list[str]:
    """All devices of the groups, each once, in order."""
    return list(dict.fromkeys(d for group in groups for d in group))


def means_of_base(base: DataFrame, groups: list[list[str]], group: int, with_switches: bool = False) -> DataFrame:
    """What ``hourly_means`` gives for the devices of one group, from the table of ``hourly_base`` with the same groups."""
    places = base_devices(groups)
    seen = f"n_watt[{group}] > 0" + (f" OR n_on[{group}] > 0" if with_switches else "")
    mean = "coalesce(w[{0}] / n_watt[{1}], 0D)" + (" + coalesce(s[{0}] / n_on[{1}], 0D)" if with_switches else "")
    devices = groups[group]
    means = [F.expr(f"{mean.format(places.index(d), group)} AS {c}") for c, d in zip(value_columns(devices), devices)]
    return base.filter(seen).select("household_id", "hour_ts", *means)


def dense_hours(hourly: DataFrame, columns: list[str], keys: list[str], today: str | None = None) -> DataFrame:
    """Fill the gaps between a key's first and last hour with zeros.

    With ``today`` the grid goes on until 23:00 of the day after it (the day to predict). Each observed
    hour emits itself and the gap up to the next one, so no grid join is needed. Hours fan out and are sorted more than once in the task
    that gets them, so they are dealt over all partitions of the session.
    """
    hourly = spread(hourly, keys)
    w = Window.partitionBy(*keys).orderBy("hour_ts")
    one = F.expr("INTERVAL 1 HOUR")
    last_day = F.date_trunc("day", "hour_ts")
    end = F.col("hour_ts")
    if today is not None:
        days = F.abs(F.datediff(F.lit(today).cast("date"), last_day))
        end = last_day + F.make_dt_interval(days, F.lit(47))
    grid = hourly.withColumn("next_ts", F.lead("hour_ts").over(w)).select(
        *keys,
        F.col("hour_ts").alias("seen_ts"),
        *columns,
        F.explode(F.sequence("hour_ts", F.coalesce(F.col("next_ts") - one, end), one)).alias("hour_ts"),
    )
    values = [F.expr(f"if(hour_ts = seen_ts, {c}, 0D) AS {c}") for c in columns]
    return grid.select(*keys, "hour_ts", *values)


def to_long(wide: DataFrame, devices: list[str], name: str = "value") -> DataFrame:
    """One row per device instead of one column per device."""
    cols = value_columns(devices)
    keep = [c for c in wide.columns if c not in cols]
    return wide.select(*keep, inline_devices(cols, devices, name))


def inline_devices(columns: list[str], devices: list[str], name: str) -> Column:
    """Rows (device, name) from one column per device."""
    items = [
        "named_struct('device', '{}', '{}', {})".format(d.replace("'", "''"), name, c) for c, d in zip(columns, devices)
    ]
    return F.expr(f"inline(array({', '.join(items)}))")


def resample_mean(df: DataFrame, keys: list[str], ts: str, columns: list[str], period: str) -> DataFrame:
    """Mean per period, a whole number of seconds; empty periods are NULL rows.

    Bins are numbered by whole periods since midnight of the key's first day, so any period works,
    not only divisors of a day.
    """
    length = period_seconds(period)
    seconds = F.lit(length)
    # Whole minutes (or seconds) first: a hot key shrinks to clock size before its rows meet in one window.
    unit = "second" if length % 60 else "minute"
    per_minute = df.groupBy(*keys, F.date_trunc(unit, ts).alias("minute")).agg(
        *[F.sum(c).alias(f"sum_{c}") for c in columns], *[F.count(c).alias(f"n_{c}") for c in columns]
    )
    origin = F.date_trunc("day", F.min("minute").over(Window.partitionBy(*keys)))
    bins = (
        per_minute.withColumn("origin_ts", origin)
        .withColumn("bin", F.floor((F.unix_timestamp("minute") - F.unix_timestamp("origin_ts")) / seconds))
        .groupBy(*keys, "origin_ts", "bin")
        .agg(*[(F.sum(f"sum_{c}") / F.sum(f"n_{c}")).alias(c) for c in columns])
    )
    w = Window.partitionBy(*keys).orderBy("bin")
    grid = bins.withColumn("next_bin", F.coalesce(F.lead("bin").over(w) - 1, F.col("bin"))).select(
        *keys, "origin_ts", F.col("bin").alias("seen"), *columns, F.explode(F.sequence("bin", "next_bin")).alias("bin")
    )
    real = F.col("bin") == F.col("seen")
    return grid.select(
        *keys,
        F.timestamp_seconds(F.unix_timestamp("origin_ts") + F.col("bin") * seconds).alias(ts),
        *[F.when(real, F.col(c)).alias(c) for c in columns],
    )


#: Seconds of the units of a period, fixed.
UNIT_SECONDS = {"S": 1, "SEC": 1, "T": 60, "MIN": 60, "H": 3600, "D": 86400, "W": 604800}


def period_seconds(period: str) -> int:
    """'30S', '7T', '7min', '24H', '1D', 'H' to seconds."""
    parts = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", period)
    unit = UNIT_SECONDS.get(parts[2].upper()) if parts else None
    if unit is None or parts[1] and int(parts[1]) == 0:
        raise ValueError(f"not a period of whole seconds: {period!r}")
    return int(parts[1] or 1) * unit


def pivot_devices(rows: DataFrame, devices: list[str], value: Column, fill: float | None = 0.0) -> DataFrame:
    """(household, timestamp) x device table; the device list is given, so no extra pass finds it. Two readings of a device at
    the same time have no place in it: the job fails and names them; ``duplicate_readings`` lists all."""
    rows = rows.select("household_id", "last_updated_ts", "entity_id", value.alias("value"))
    kind = rows.schema["value"].dataType
    twice = F.concat_ws(" ", F.lit("several readings of one device at"), F.first("last_updated_ts"), F.lit("in household"), F.first("household_id"))
    wide = (
        rows
        .groupBy("household_id", "last_updated_ts")
        .pivot("entity_id", list(devices))
        .agg(F.when(F.count(F.lit(1)) > 1, F.raise_error(twice).cast(kind)).otherwise(F.first("value")))
    )
    return wide if fill is None else wide.na.fill(fill, list(devices))


def duplicate_readings(rows: DataFrame) -> DataFrame:
    """(household, device, timestamp) seen more than once; a pivot over them is not defined."""
    return (
        rows.groupBy("household_id", "entity_id", "last_updated_ts")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
