"""Score functions by name: Column expressions over arrays, or any Python function on numpy arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_error_sum(a: Column, b: Column) -> Column:
    d = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x)


def mse(y_true: Column, y_hat: Column) -> Column:
    return squared_error_sum(y_true, y_hat) / F.size(y_true)


def mae(y_true: Column, y_hat: Column) -> Column:
    d = F.zip_with(y_true, y_hat, lambda x, y: F.abs(x - y))
    return F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x) / F.size(y_true)


def normalised_distance(y_true: Column, y_hat: Column) -> Column:
    """||y - y_hat|| / ||y||; NULL for an all-zero y."""
    norm = F.aggregate(y_true, F.lit(0.0), lambda acc, x: acc + x * x)
    return F.when(norm > 0, F.sqrt(squared_error_sum(y_true, y_hat)) / F.sqrt(norm))


def on_columns(metric: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    """Marks a user's metric as one that builds a Column from two array Columns, so it runs without Python workers."""
    metric.on_columns = True
    return metric


@on_columns
def largest_error(y_true: Column, y_hat: Column) -> Column:
    return F.array_max(F.zip_with(y_true, y_hat, lambda x, y: F.abs(x - y)))


ARRAY_METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "mse": mse,
    "mae": mae,
    "normalised_distance": normalised_distance,
}


def array_metric(metric: str | Callable) -> Callable[[Column, Column], Column]:
    """A registered name, a function of two Columns marked by ``on_columns``, or a Python function (y_true, y_hat) -> float run in
    Arrow batches."""
    if isinstance(metric, str):
        return ARRAY_METRICS[metric]
    if getattr(metric, "on_columns", False):
        return metric

    @F.pandas_udf("double")
    def custom(y_true: pd.Series, y_hat: pd.Series) -> pd.Series:
        pairs = zip(y_true, y_hat)
        return pd.Series([float(metric(np.asarray(a), np.asarray(b))) for a, b in pairs])

    return custom
