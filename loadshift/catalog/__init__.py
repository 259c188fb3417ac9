"""Every operator as a query over the given tables: name -> function of (spark, folder of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadshift.catalog.registry import QUERIES


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from loadshift.catalog import decisions, features, learned, tables  # noqa: F401

    return dict(QUERIES)
