"""Weather imputation against all pairs of rows."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from loadshift.operators import impute

T0 = datetime(2024, 3, 1)


def plain(D, k):
    """Every gap from the distances to all rows."""
    out = D.copy()
    for i, x in enumerate(D):
        for j in np.flatnonzero(np.isnan(x)):
            near = []
            for r, y in enumerate(D):
                both = ~np.isnan(x) & ~np.isnan(y)
                if both.any() and not np.isnan(y[j]):
                    near.append((np.sqrt(((x[both] - y[both]) ** 2).sum() * D.shape[1] / both.sum()), r))
            near = sorted(near)[:k]
            if not near:
                out[i, j] = np.nanmean(D[:, j]) if (~np.isnan(D[:, j])).any() else np.nan
            elif near[0][0] == 0:
                out[i, j] = np.mean([D[r, j] for d, r in near if d == 0])
            else:
                out[i, j] = np.average([D[r, j] for _, r in near], weights=[1 / d for d, _ in near])
    return out


def table(seed, n, width=4, levels=None, gaps=0.3):
    rng = np.random.default_rng(seed)
    D = rng.integers(0, levels, (n, width)).astype(float) if levels else rng.normal(size=(n, width)) * [1, 10, 100, 1][:width]
    D[rng.random((n, width)) < gaps] = np.nan
    return D


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("levels", [None, 3, 40])
def test_gaps_equal_all_pairs(seed, levels, monkeypatch):
    """Equal distances, repeated rows, rows without any value; small blocks of distances."""
    monkeypatch.setattr(impute, "CELLS", 64 if seed % 2 else 1 << 21)
    D = table(seed, 150, levels=levels, gaps=[0.1, 0.3, 0.7][seed % 3])
    np.testing.assert_allclose(impute.fill_gaps(D, 5), plain(D, 5), rtol=1e-9)


def test_odd_tables():
    nan = np.nan
    for D in ([[nan, nan]], [[1.0, nan]], [[1.0, nan], [nan, 2.0]], [[nan, 5.0], [nan, 7.0]], [[1.0, 2.0], [1.0, nan], [1.0, 4.0]], [[1.0, 2.0]]):
        np.testing.assert_allclose(impute.fill_gaps(np.array(D), 7), plain(np.array(D), 7))


def test_search_looks_at_few_rows():
    """Hours of smooth weather: most rows are never compared."""
    hour = np.arange(20_000)
    given = np.stack([20 * np.sin(hour / 24) + hour / 500, 5 * np.cos(hour / 240)], axis=1)
    asked = given[::40] + 0.01
    seen = 0
    where = np.where

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def where(self, test, *rest):
            nonlocal seen
            if getattr(test, "ndim", 0) == 2 and test.dtype == bool and test.shape[1] > 7:
                seen += test.size
            return where(test, *rest)

    original, impute.np = impute.np, Counting()
    try:
        d2, rows = impute.nearest(asked, given, 7)
    finally:
        impute.np = original
    full = ((asked[:, None, :] - given[None]) ** 2).sum(axis=2)
    np.testing.assert_array_equal(rows, np.argsort(full, axis=1, kind="stable")[:, :7])
    assert 0 < seen < full.size / 4


def test_stations_of_unlike_size(spark):
    """One group a station, a factor of 10 apart; rows without gaps stay, every row comes out once."""
    names = [f"c{i}" for i in range(4)]
    tables = {"big": table(1, 600), "small": table(2, 60), "empty": np.full((3, 4), np.nan), None: table(3, 20)}
    rows = [(k, T0 + timedelta(hours=i), *[None if np.isnan(v) else float(v) for v in x]) for k, D in tables.items() for i, x in enumerate(D)]
    df = spark.createDataFrame(rows, "station string, time timestamp, " + ", ".join(f"{c} double" for c in names))
    out = impute.knn_impute(df, "station", "time", names, 7)
    got = {(r.station, r.time): [r[c] for c in names] for r in out.collect()}
    assert len(got) == len(rows) == out.count()
    for k, D in tables.items():
        want = plain(D, 7)
        for i, x in enumerate(want):
            np.testing.assert_allclose([np.nan if v is None else v for v in got[(k, T0 + timedelta(hours=i))]], x, rtol=1e-9)
    assert impute.knn_impute(df.limit(0), "station", "time", names).count() == 0
