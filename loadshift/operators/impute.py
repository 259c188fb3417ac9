"""Weather: imputation from similar hours, scaling and the join to feature tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadshift.operators.clean import all_null_columns
from loadshift.operators.joins import join_reference


def knn_impute(df: DataFrame, key: str, ts: str, columns: list[str], n_neighbors: int = 7, chunks: int = 1) -> DataFrame:
    """Fill gaps with the inverse-distance mean of the nearest rows that have the value; ties: the earlier row.

    Distances use the columns present in both rows, scaled up to all columns; neighbours at distance 0 alone decide; a row that shares no
    column with any donor takes the column mean, one of a column without any value stays empty. A station's hours, bounded by the clock,
    are one group, sent once; with ``chunks`` its rows with gaps are spread over so many tasks, each of which gets the whole station.
    Rows without gaps pass by unchanged.
    """
    names = ", ".join(f"`{c}` double" for c in columns)
    schema = f"`{key}` {_type(df, key)}, `{ts}` {_type(df, ts)}, {names}"
    rows = df.select(key, ts, *columns)
    gap = " OR ".join(f"`{c}` IS NULL" for c in columns)

    copies = "0 AS _chunk" if chunks == 1 else f"explode(sequence(0, {chunks - 1})) AS _chunk"
    spread = rows.selectExpr("*", copies).selectExpr("*", f"({gap}) AND _chunk = pmod(xxhash64(`{ts}`), {chunks}) AS _fill")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts, kind="stable")
        D, wanted = pdf[columns].to_numpy(dtype=float), pdf["_fill"].to_numpy(dtype=bool)
        filled = pd.DataFrame(fill_gaps(D, n_neighbors, wanted)[wanted], columns=columns)
        return filled.assign(**{c: pdf.loc[wanted, c].to_numpy() for c in (key, ts)})[[key, ts, *columns]]

    filled = spread.groupBy(key, "_chunk").applyInPandas(fill, schema)
    return rows.filter(f"NOT ({gap})").unionByName(filled)


def fill_gaps(D: np.ndarray, k: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """The table with its gaps (NaN) filled, or those of the wanted rows. Rows are grouped by which columns they have; each pair of such groups shares the same
    columns, so its distances obey the triangle inequality and ``nearest`` need not look at all of them."""
    present, out, width = ~np.isnan(D), D.copy(), D.shape[1]
    patterns, of = np.unique(present, axis=0, return_inverse=True)
    members = [np.flatnonzero(of.ravel() == p) for p in range(len(patterns))]
    for have, ask in zip(patterns, members):
        ask = ask if wanted is None else ask[wanted[ask]]
        if have.all() or not len(ask):
            continue
        found = {}
        for p, (donor, give) in enumerate(zip(patterns, members)):
            shared = have & donor
            if shared.any() and (donor & ~have).any():
                d2, rows = nearest(D[np.ix_(ask, shared)], D[np.ix_(give, shared)], k)
                found[p] = np.sqrt(d2 * width / shared.sum()), np.where(rows < 0, -1, give[rows])
        for j in np.flatnonzero(~have):
            usable = [found[p] for p in found if patterns[p][j]]
            if not usable:
                out[ask, j] = D[present[:, j], j].mean() if present[:, j].any() else np.nan
                continue
            d, rows = (np.concatenate(parts, axis=1) for parts in zip(*usable))
            first = np.lexsort((rows, d), axis=1)[:, :k]
            d, rows = np.take_along_axis(d, first, 1), np.take_along_axis(rows, first, 1)
            exact = d == 0
            # An absent neighbour is infinitely far and weighs nothing.
            with np.errstate(divide="ignore"):
                weight = np.where(exact.any(axis=1, keepdims=True), exact, 1 / np.where(exact, 1, d))
            out[ask, j] = (weight * np.where(rows < 0, 0, D[rows, j])).sum(axis=1) / weight.sum(axis=1)
    return out


#: Distances computed at a time.
CELLS = 1 << 21


def nearest(asked: np.ndarray, given: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and places of the k given rows nearest to each asked one, ties by place; short lists end with inf and -1.

    Given rows are sorted by their distance to a pivot. Two rows are at least as far apart as their distances to it differ, so a
    search that goes outwards from the asked row's own distance ends as soon as that difference exceeds the k-th best.
    """
    pivot = given.mean(axis=0)
    radius = np.sqrt(((given - pivot) ** 2).sum(axis=1))
    order = np.argsort(radius, kind="stable")
    radius, n = radius[order], len(given)
    own = np.sqrt(((asked - pivot) ** 2).sum(axis=1))
    middle = np.searchsorted(radius, own)
    best, rows = np.full((len(asked), k), np.inf), np.full((len(asked), k), -1)
    # Rounding must not end a search too early.
    slack = 1e-9 * (1 + np.abs(own) + (radius[-1] if n else 0))
    left, reach = np.arange(len(asked)), 2 * k
    while len(left):
        open_, step = [], max(1, CELLS // (2 * min(reach, n) * asked.shape[1]))
        for at in (left[i : i + step] for i in range(0, len(left), step)):
            low, high = np.maximum(middle[at] - reach, 0), np.minimum(middle[at] + reach, n)
            places = low[:, None] + np.arange(min(2 * reach, n))
            inside = places < high[:, None]
            candidates = order[np.minimum(places, n - 1)]
            d2 = np.where(inside, ((asked[at][:, None, :] - given[candidates]) ** 2).sum(axis=2), np.inf)
            first = np.lexsort((candidates, d2), axis=1)[:, :k]
            kept = np.take_along_axis(d2, first, 1)
            best[at, : kept.shape[1]] = kept
            rows[at, : kept.shape[1]] = np.where(np.isinf(kept), -1, np.take_along_axis(candidates, first, 1))
            below = np.where(low > 0, own[at] - radius[np.maximum(low - 1, 0)], np.inf)
            above = np.where(high < n, radius[np.minimum(high, n - 1)] - own[at], np.inf)
            beyond = np.minimum(below, above) - slack[at]
            open_.append(at[~(np.isinf(beyond) | (np.sqrt(best[at, -1]) < beyond))])
        left, reach = np.concatenate(open_), reach * 4
    return best, rows


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def min_max(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Scale every column to 0..1 per key; constant columns become 0. One aggregate serves all columns."""
    bounds = df.groupBy(key).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )

    def scaled(c: str):
        span = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        return F.when(span == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"_lo_{c}")) / span).alias(c)

    rest = [c for c in df.columns if c not in columns]
    return join_reference(df, bounds, [key]).select(*rest, *[scaled(c) for c in columns])


def enrich(weather: DataFrame, columns: list[str], key: str = "station", ts: str = "time") -> DataFrame:
    """Drop all-empty columns, impute, scale."""
    empty = set(all_null_columns(weather, columns))
    kept = sorted(c for c in columns if c not in empty)
    return min_max(knn_impute(weather, key, ts, kept), key, kept)


def join_weather(features: DataFrame, weather: DataFrame, stations: DataFrame, ts: str, grain: str = "hour") -> DataFrame:
    """RIGHT join of each household to the weather of its station (household_id, station) on the hour or day: weather rows without
    features stay, with NULL features.

    Written as an inner join plus the unmatched weather rows, so that neither side of an hour that all households share has to
    pass through one task: the weather may be broadcast, and a shuffled hot (station, hour) is split by adaptive execution.
    """
    right = weather.withColumn("_at", F.date_trunc(grain, "time"))
    left = features.withColumn("_at", F.date_trunc(grain, ts)).join(stations.select("household_id", "station"), "household_id")
    unmatched = right.join(left.select("station", "_at").distinct(), ["station", "_at"], "left_anti")
    return left.join(right, ["station", "_at"]).unionByName(unmatched, allowMissingColumns=True).drop("_at")
