"""Registration and output formatting shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def ts(col: Column | str, name: str | None = None) -> Column:
    if isinstance(col, str):
        return F.expr(f"date_format(`{col}`, 'yyyy-MM-dd HH:mm:ss') AS `{name or col}`")
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name or str(col))


def day(col: Column | str, name: str | None = None) -> Column:
    if isinstance(col, str):
        return F.expr(f"date_format(`{col}`, 'yyyy-MM-dd') AS `{name or col}`")
    return F.date_format(col, "yyyy-MM-dd").alias(name or str(col))


def r6(col: Column | str, name: str | None = None) -> Column:
    """Six digits for comparison; the nudge moves exact ties to one side in every engine."""
    if isinstance(col, str):
        return F.expr(f"round(`{col}` + 1e-9D, 6) + 0D AS `{name or col}`")
    return (F.round(col + 1e-9, 6) + F.lit(0.0)).alias(name or str(col))


def big(col: Column | str, name: str | None = None) -> Column:
    if isinstance(col, str):
        return F.expr(f"cast(`{col}` AS bigint) AS `{name or col}`")
    return col.cast("bigint").alias(name or str(col))


def integer(col: Column | str, name: str | None = None) -> Column:
    if isinstance(col, str):
        return F.expr(f"cast(`{col}` AS int) AS `{name or col}`")
    return col.cast("int").alias(name or str(col))
