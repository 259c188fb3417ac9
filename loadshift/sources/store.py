"""Stage tables between sessions, as append-only runs with a manifest.

A run is one call of ``dump``: its tables lie below ``<table>/run=<id>``, by activity model, usage model, weather flag and household
bucket, and are never changed. One manifest entry, written last, commits all tables of the run at once; what has no entry, as a write
that was killed, is read by nobody. Several runs may write at the same time.

``load`` merges on read: of each (models, weather, household, date) the rows of the newest run that has any. A run may carry a
fingerprint of all that went into it, by which a later run finds and reuses it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One folder per household would mean millions of folders; a household lies in one of these buckets,
# sorted by household, so a lookup opens one folder and skips most row groups.
BUCKETS = 64
PARTITIONS = ["activity_model", "usage_model", "weather", "bucket"]
# The tables a run may leave behind.
TABLES = ["config", "df", "output", "results", "scores", "predictions", "predictions_usage"]
MANIFEST = "run string, number bigint, tables map<string,string>, activity_model string, usage_model string, weather boolean, fingerprint string"
KEYS = ["activity_model", "usage_model", "weather", "household_id"]
#: Columns that are a row's date, the first that a table has; a table without any is replaced by household.
DATES = ["date", "recommendation_calculation_date", "day", "hour_ts"]


@dataclass(frozen=True)
class Run:
    """A committed run: schemas holds the JSON schema of each of its tables."""

    run: str
    number: int
    schemas: dict[str, str]
    activity_model: str
    usage_model: str
    weather: bool
    fingerprint: str | None


def bucket(household: Column | str) -> Column:
    return F.pmod(F.xxhash64(household), F.lit(BUCKETS)).cast("int")


def runs(spark: SparkSession, path: str) -> list[Run]:
    """The committed runs, oldest first; their number is that of the calls of ``dump``. A folder without a store has none."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [Run(r.run, r.number, r.tables, r.activity_model, r.usage_model, r.weather, r.fingerprint) for r in rows]
    return sorted(found, key=lambda r: (r.number, r.run))


def find(spark: SparkSession, path: str, fingerprint: str | None) -> Run | None:
    """The newest run with the fingerprint."""
    return next((r for r in reversed(runs(spark, path)) if fingerprint and r.fingerprint == fingerprint), None)


def dump(
    path: str, tables: dict[str, DataFrame], activity_model: str, usage_model: str, weather: bool, fingerprint: str | None = None
) -> Run | None:
    """Add a run with these tables below ``path``; what is there stays. Nothing is seen by readers until all tables are written.

    Rows are laid out by ranges of (bucket, household, row content), as many as the session has shuffle partitions, so a hot
    household is spread over many tasks and the number of tasks follows the session.
    """
    unknown = [name for name in tables if name not in TABLES]
    if unknown:
        raise ValueError(f"unknown table {unknown[0]!r}")
    if not tables:
        return None
    spark = next(iter(tables.values())).sparkSession
    name_of_run = f"r{uuid.uuid4().hex}"
    schemas = {}
    for name, df in tables.items():
        out = df.drop(*PARTITIONS).withColumns(
            {
                "activity_model": F.lit(activity_model),
                "usage_model": F.lit(usage_model),
                "weather": F.lit(weather),
                "bucket": bucket("household_id"),
            }
        )
        schemas[name] = out.schema.json()
        if name != "config":
            hashable = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]
            ranged = out.withColumn("_spread", F.xxhash64(*hashable))
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            out = ranged.repartitionByRange(n, "bucket", "household_id", "_spread").sortWithinPartitions("bucket", "household_id").drop("_spread")
        writer = out.write.mode("errorifexists").partitionBy(*PARTITIONS)
        target = f"{path}/{name}/run={name_of_run}"
        writer.json(target) if name == "config" else writer.parquet(target)
    number = max((r.number for r in runs(spark, path)), default=0) + 1
    entry = [(name_of_run, number, schemas, activity_model, usage_model, weather, fingerprint)]
    spark.createDataFrame(entry, MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return Run(*entry[0])


def read(spark: SparkSession, path: str, name: str, run: Run) -> DataFrame:
    """One table of one run, with its partition columns; a run without rows gives no rows."""
    schema = T.StructType.fromJson(json.loads(run.schemas[name]))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    reader = spark.read.schema(schema)
    target = f"{path}/{name}/run={run.run}"
    return reader.json(target) if name == "config" else reader.parquet(target)


def load(spark: SparkSession, path: str, names: list[str], household: int | None = None) -> dict[str, DataFrame]:
    """Tables as the committed runs leave them; one household reads its bucket only. A table that no run has is an error.

    Of each (models, weather, household, date) the newest run that has rows gives all of them. Runs of equal number, which were
    written at the same time, are ordered by their names. Rows of a run are told by its number alone, so nothing is compared where
    a table has one run only.
    """
    known = runs(spark, path)
    out = {}
    for name in names:
        having = [r for r in known if name in r.schemas]
        if not having:
            raise ValueError(f"no run below {path!r} has a table {name!r}")
        parts = []
        for place, run in enumerate(having):
            df = read(spark, path, name, run)
            if household is not None:
                df = df.filter((F.col("bucket") == bucket(F.lit(household).cast(df.schema["household_id"].dataType))) & (F.col("household_id") == household))
            parts.append(df.drop("bucket").withColumn("_place", F.lit(place)))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        out[name] = (newest(rows) if len(having) > 1 else rows).drop("_place")
    return out


def newest(rows: DataFrame) -> DataFrame:
    """Of each (models, weather, household, date) the rows with the largest _place. Maxima are partial aggregates, and what meets
    them by key is a plain join, in which adaptive execution splits a hot household."""
    date = next((d for d in DATES if d in rows.columns), None)
    keys = [*KEYS, *(["_date"] if date else [])]
    dated = rows.withColumn("_date", F.to_date(date)) if date else rows
    last = dated.groupBy(*keys).agg(F.max("_place").alias("_last"))
    renamed = last.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_last")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    kept = dated.join(renamed, same & (F.col("_place") == F.col("_last")), "left_semi")
    return kept.drop("_date")


def compact(spark: SparkSession, path: str, name: str) -> list[Run]:
    """Write what ``load`` gives as one run for each pair of models and weather flag; later reads win against all older runs."""
    rows = load(spark, path, [name])[name]
    kinds = {(r.activity_model, r.usage_model, r.weather) for r in runs(spark, path) if name in r.schemas}
    out = []
    for a, u, w in sorted(kinds):
        own = rows.filter((F.col("activity_model") == a) & (F.col("usage_model") == u) & (F.col("weather") == w))
        out.append(dump(path, {name: own}, a, u, w))
    return out


def sources_fingerprint(*frames: DataFrame) -> str | None:
    """A digest of the files that the tables read (path, length, time of change) and of their plans; None if one of them reads no
    files, since then nothing tells whether its rows are the same. Files are listed, not read."""
    digest = hashlib.sha256()
    for df in frames:
        files = df.inputFiles()
        if not files:
            return None
        listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        row = listed.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        digest.update(repr((tuple(row), df.semanticHash())).encode())
    return digest.hexdigest()
