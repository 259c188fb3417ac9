"""Row filters, attribute unpacking and value cleaning on the raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadshift.functions.expressions import number
from loadshift.operators.joins import join_reference
from loadshift.schemas import ATTRIBUTE_FIELDS


def unpack_attributes(df: DataFrame, fields: T.StructType = ATTRIBUTE_FIELDS) -> DataFrame:
    """The JSON text column as one column per declared key; nested keys get dotted names."""
    parsed = df.withColumn("_attrs", F.from_json("shared_attrs", fields))
    columns = []
    for f in fields.fields:
        if isinstance(f.dataType, T.StructType):
            columns += [F.col(f"_attrs.{f.name}.{s.name}").alias(f"{f.name}.{s.name}") for s in f.dataType.fields]
        else:
            columns.append(F.col(f"_attrs.{f.name}").alias(f.name))
    return parsed.select(*[c for c in df.columns if c != "shared_attrs"], *columns)


def attribute_value(key: str, type_name: str = "string") -> Column:
    """One undeclared key of the JSON text, for ad-hoc use."""
    return F.try_variant_get(F.try_parse_json("shared_attrs"), f"$.{key}", type_name)


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row (column, n_non_null) per column, from a single pass."""
    counts = df.agg(*[F.count(_quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_non_null")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*items)))


def sparse_limit(n_columns: int) -> int:
    """Non-null values a column needs to stay: the limit counts columns, not rows."""
    return int(0.95 * n_columns)


def drop_sparse_columns(df: DataFrame) -> DataFrame:
    """Drop the columns with fewer non-null values than ``sparse_limit``; reads the data once."""
    limit = sparse_limit(len(df.columns))
    keep = [r["column"] for r in non_null_counts(df).filter(F.col("n_non_null") >= limit).collect()]
    return df.select(*[_quoted(c) for c in df.columns if c in keep])


def all_null_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns without any value; one row of counts reaches the driver."""
    row = df.agg(*[F.count(_quoted(c)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] == 0]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def coerce_state(df: DataFrame) -> DataFrame:
    """state as a number; rows whose text is no number stay, with NULL."""
    return df.withColumn("state", number("state"))


def recent(df: DataFrame, now: str, days: int = 30) -> DataFrame:
    """Rows strictly later than midnight ``days`` days before ``now``."""
    return df.filter(F.col("last_updated_ts") > F.date_sub(F.lit(now).cast("date"), days).cast("timestamp"))


def timespan(df: DataFrame, ts: str, start: str, closed: str = "both", **delta: int) -> DataFrame:
    """Rows in [start, start + delta]; ``closed`` may be 'both' or 'left'."""
    first = F.lit(start).cast("timestamp")
    end = first + F.make_dt_interval(
        *[F.lit(delta.get(unit, 0)) for unit in ("days", "hours", "minutes", "seconds")]
    )
    upper = F.col(ts) <= end if closed == "both" else F.col(ts) < end
    return df.filter((F.col(ts) >= first) & upper)


def until_yesterday(df: DataFrame, ts: str, date: str) -> DataFrame:
    """Rows up to the end of the day before ``date``."""
    return df.filter(F.col(ts) < F.lit(date).cast("timestamp"))


def drop_incomplete_first_day(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Without a key's first day if it has fewer than 24 hourly rows."""
    day = F.to_date(ts)
    w = Window.partitionBy(*keys)
    first = F.min(day).over(w)
    n_first = F.sum(F.when(F.col("_day") == F.col("_first"), 1).otherwise(0)).over(w)
    marked = df.withColumn("_day", day).withColumn("_first", first).withColumn("_n", n_first)
    return marked.filter((F.col("_n") >= 24) | (F.col("_day") > F.col("_first"))).drop("_day", "_first", "_n")


def prove_start_end(df: DataFrame, keys: list[str], ts: str, date: str) -> DataFrame:
    """Complete first day, nothing after ``date``, and ``date`` itself only if complete."""
    end = F.lit(date).cast("date")
    w = Window.partitionBy(*keys)
    n_last = F.sum((F.to_date(ts) == end).cast("int")).over(w)
    cut = drop_incomplete_first_day(df, keys, ts).filter(F.to_date(ts) <= end).withColumn("_n", n_last)
    return cut.filter((F.to_date(ts) < end) | (F.col("_n") >= 24)).drop("_n")


#: Keys with at most so many values keep all of them between their splitters; the ranks that splitters may be off, in parts of a key's values.
WHOLE, OFF = 20_000, 1e-4


def exact_quantiles(df: DataFrame, keys: list[str], column: str, shares: list[float], whole: int = WHOLE) -> DataFrame:
    """keys and q0, q1, ...: exact quantiles by linear interpolation, without a buffer of a key's values.

    A sketch gives two splitters around each quantile, off by a known part of the ranks at most. Values outside the splitters are only
    counted, by range; those between two splitters, a few in ten thousand, are counted one by one, and a running sum over them and the
    range counts finds the two ranks that a quantile lies between. NULLs have no rank, a key without values has no row, and NaN counts
    as larger than all numbers. ``df`` is read twice; ``shares`` ascend.
    """
    value = F.col(column).cast("double")
    rows = df.filter(F.col(column).isNotNull()).select(*keys, value.alias("_v"))
    ends = [e for s in shares for e in (max(s - 2 * OFF, 0.0), min(s + 2 * OFF, 1.0))]
    sketch = F.percentile_approx("_v", F.array(*[F.lit(e) for e in ends]), F.lit(int(1 / OFF)))
    known = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), sketch.alias("_ends"))
    # In short keys a rank is a large part of all: there the first range holds everything.
    short = F.col("_n") <= whole
    limits = [F.when(short, F.col("_least") if i == 0 else F.col("_most")).otherwise(F.col("_ends")[i]) for i in range(len(ends))]
    splitters = known.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_n", F.array(*limits).alias("_ends"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    placed = rows.join(splitters, reduce(lambda a, b: a & b, same))
    # Ranges 1, 3, ... lie between splitters; of the values of the others only the number counts.
    ranges = F.lit(2 * len(shares))
    for i in reversed(range(len(shares))):
        low, high = F.col("_ends")[2 * i], F.col("_ends")[2 * i + 1]
        ranges = F.when(F.col("_v") < low, 2 * i).when(F.col("_v") <= high, 2 * i + 1).otherwise(ranges)
    ranged = placed.select(*keys, "_n", ranges.alias("_range"), "_v")
    counted = ranged.groupBy(*keys, "_n", "_range", F.when(F.col("_range") % 2 == 1, F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_count"))
    order = Window.partitionBy(*keys).orderBy("_range", "_v").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("_upto", F.sum("_count").over(order))
    found = []
    for i, s in enumerate(shares):
        place = (F.col("_n") - 1) * F.lit(float(s))
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_count"))
            found.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{side}{i}"))
    picked = summed.groupBy(*keys, "_n").agg(*found)
    out = []
    for i, s in enumerate(shares):
        place = (F.col("_n") - 1) * F.lit(float(s))
        part = place - F.floor(place)
        out.append((F.col(f"_low{i}") + F.when(part > 0, part * (F.col(f"_high{i}") - F.col(f"_low{i}"))).otherwise(0.0)).alias(f"q{i}"))
    return picked.select(*keys, *out)


def value_quartiles(df: DataFrame, keys: list[str], column: str, non_zero: bool = False) -> DataFrame:
    """Exact Q1 and Q3 by linear interpolation per key, of all values or of those other than 0."""
    rows = df.filter(F.col(column) != 0) if non_zero else df
    found = exact_quantiles(rows, keys, column, [0.25, 0.75])
    return found.select(*keys, F.col("q0").alias("q1"), F.col("q1").alias("q3"))


def outlier_truncation(
    df: DataFrame, keys: list[str], column: str, factor: float = 1.5, non_zero: bool = False
) -> DataFrame:
    """Values outside [Q1 - f*IQR, Q3 + f*IQR] become the bound, cut to an integer toward zero.

    With ``non_zero`` both the quartiles and the replacement leave zeros alone.
    """
    iqr = F.col("q3") - F.col("q1")
    lower, upper = F.col("q1") - factor * iqr, F.col("q3") + factor * iqr
    value = F.col(column)
    cut = (
        F.when(value > upper, upper.cast("bigint").cast("double"))
        .when(value < lower, lower.cast("bigint").cast("double"))
        .otherwise(value)
    )
    if non_zero:
        cut = F.when(value != 0, cut).otherwise(value)
    bounds = value_quartiles(df, keys, column, non_zero)
    return join_reference(df, bounds, keys).withColumn(column, cut).drop("q1", "q3")


def scale(df: DataFrame, keys: list[str], column: str, kind: str = "MinMax") -> DataFrame:
    """Min-max scaling per key; a constant column becomes 0."""
    if kind != "MinMax":
        raise ValueError(f"scaling method {kind!r} is not available")
    span = F.col("_max") - F.col("_min")
    ranges = df.groupBy(*keys).agg(F.min(column).alias("_min"), F.max(column).alias("_max"))
    scaled = F.when(span == 0, F.lit(0.0)).otherwise((F.col(column) - F.col("_min")) / span)
    return join_reference(df, ranges, keys).withColumn(column, scaled).drop("_min", "_max")


def friendly_names(df: DataFrame, devices: list[str], now: str, days: int = 30) -> DataFrame:
    """Distinct (household, entity, friendly name) of the power devices in the last days."""
    watt = df.filter(F.col("unit_of_measurement").isin("W") & F.col("entity_id").isin(list(devices)))
    return recent(watt, now, days).select("household_id", "entity_id", "friendly_name").distinct()


def latest_friendly_name(df: DataFrame, devices: list[str], now: str, days: int = 30) -> DataFrame:
    """One name per (household, entity): the one reported last."""
    watt = df.filter(F.col("unit_of_measurement").isin("W") & F.col("entity_id").isin(list(devices)))
    latest = F.max_by("friendly_name", F.struct("last_updated_ts", "friendly_name"))
    return recent(watt, now, days).groupBy("household_id", "entity_id").agg(latest.alias("friendly_name"))


def last_reported(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.to_date(F.max(ts)).alias("last_reported"))


def days_between(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def day_range(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """first_date = first event + 1 day, last_date = last event - 1 day."""
    return df.groupBy(*keys).agg(
        F.date_add(F.to_date(F.min(ts)), 1).alias("first_date"),
        F.date_sub(F.to_date(F.max(ts)), 1).alias("last_date"),
    )


def min_start_date(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """First midnight row without any NULL, as a date."""
    complete = F.lit(True)
    for c in df.columns:
        complete = complete & _quoted(c).isNotNull()
    usable = F.when(complete & (F.hour(ts) == 0), F.col(ts))
    return df.groupBy(*keys).agg(F.to_date(F.min(usable)).alias("start_date"))
