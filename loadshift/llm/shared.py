"""Reading tables, storing intermediate results and sizes that follow the session."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.llm.words import WORKER
from loadshift.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which whoever runs a job sizes to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes to the shared folder and reads again: it cuts the lineage, and a lost executor costs no earlier stage."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(doc_id: Column, text: Column) -> Column:
    """Of a row's id and text; a null id is unlike any number."""
    return F.xxhash64(doc_id.isNull(), F.coalesce(doc_id, F.lit(-1)), text)


def once_per_worker(key: str, make: Callable[[], Any]) -> Any:
    """A value that lives as long as a Python worker has tasks of one kind, see tidy(). Functions travel by value, so a global of
    this module would be made anew in each task."""
    holder = sys.modules.setdefault(WORKER, types.ModuleType(WORKER))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint behind a count; a larger side keeps the shuffle join that Spark picks."""
    return F.broadcast(df) if small_enough(df, rows) else df
