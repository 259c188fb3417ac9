"""Activity models from running cells against one fit per date over the whole history."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadshift.operators import explain, hour_cells, models
from loadshift.operators.models import ACTIVITY_FEATURES, DAY_DUMMIES

FIRST, LAST = "2024-01-02", "2024-01-16"
D0 = datetime(2024, 1, 1)
SCHEMA = "household_id int, hour_ts timestamp, activity int, hour int, " + ", ".join(f"{f} int" for f in ACTIVITY_FEATURES[1:])


def table(spark, seed=3, days=15):
    """Household 1: random; 2: separable by a lag; 3: one class; 4: holes, NULL labels and lags; 5: starts late."""
    rng = np.random.default_rng(seed)
    rows = []
    for house in range(1, 6):
        for i in range(days * 24):
            at = D0 + timedelta(hours=i)
            if (house == 4 and i // 24 in (5, 6, 9)) or (house == 5 and i < 24 * 9):
                continue
            flags = [int(v) for v in rng.integers(0, 2, 3)]
            y = {1: int(rng.random() < 0.2 + 0.5 * flags[1]), 2: flags[0], 3: 0}.get(house, int(rng.integers(0, 2)))
            if house == 4 and i % 11 == 0:
                y = flags[0] = None
            days_of = [int(at.strftime("%A") == d.removeprefix("day_name_")) for d in DAY_DUMMIES]
            rows.append((house, at, y, at.hour, *days_of, *flags))
    return spark.createDataFrame(rows, SCHEMA)


def same(got, want, columns):
    key = lambda r: (r["household_id"], r["date"], r["hour_ts"])
    got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in want] and want
    for a, b in zip(got, want):
        for c in columns:
            assert (a[c] == b[c]) if isinstance(b[c], str) or b[c] is None else a[c] == pytest.approx(b[c], abs=1e-7), (key(a), c)


@pytest.mark.parametrize("span", [{}, {"train_days": 4}, {"train_days": 3, "floor": "2024-01-05"}])
def test_logit_equals_a_fit_over_the_history(spark, span):
    rows = table(spark)
    same(hour_cells.logit_activity(rows, FIRST, LAST, **span), models.activity_walk_forward(rows, "logit", FIRST, LAST, **span), ["y", "p", "error"])


def test_logit_sm_equals_a_fit_over_the_history(spark):
    rows = table(spark).filter("household_id IN (1, 4, 5)")
    same(hour_cells.logit_sm_activity(rows, FIRST, LAST), models.activity_walk_forward(rows, "logit_sm", FIRST, LAST), ["y", "p", "error"])


def test_neighbours_equal_a_search_of_the_history(spark):
    rows = table(spark)
    same(hour_cells.knn_activity(rows, FIRST, LAST), models.activity_walk_forward(rows, "knn", FIRST, LAST), ["y", "p", "error"])


def test_scored_cells_equal_the_scores_of_the_rows(spark):
    rows = table(spark)
    fitted = hour_cells.fits(rows, FIRST, LAST)
    for got, scope in ((hour_cells.train_cells(fitted), "train"), (hour_cells.all_cells(fitted, rows), "all")):
        want = models.activity_walk_forward(rows, "logit", FIRST, LAST, scope=scope)
        sums = [F.sum(F.col("n_pos") * F.col("p")).alias("a"), F.sum(F.col("n_neg") * F.col("p")).alias("b"), F.sum(F.col("n_pos") + F.col("n_neg")).alias("n")]
        got, want = ({(r["household_id"], r["date"]): r[2:] for r in d.groupBy("household_id", "date").agg(*sums).collect()} for d in (got, want))
        assert got.keys() == want.keys() and want
        assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_attributions_equal_enumeration_and_add_up(spark):
    rows = table(spark)
    targets = rows.filter("hour IN (3, 18) AND household_id <> 2").select("household_id", "hour_ts")
    got = hour_cells.explain_activity(rows, FIRST, LAST, targets)
    want = explain.explain(rows, ["household_id"], ACTIVITY_FEATURES, "activity", "hour_ts", "logit", FIRST, LAST, targets=targets)
    parts = [F.expr(f"importance[{i}].importance AS i{i}") for i in range(len(ACTIVITY_FEATURES))]
    names = [f"i{i}" for i in range(len(ACTIVITY_FEATURES))]
    same(got.select("*", *parts), want.select("*", *parts), ["y", "p", "base_value", *names])
    summed = explain.reconstruct(got).filter("p IS NOT NULL")
    assert summed.filter("abs(p - shap) > 1e-9 OR seconds <= 0").count() == 0 and summed.count() > 0


def test_no_rows(spark):
    rows = table(spark, days=1).filter("false")
    for f in (hour_cells.logit_activity, hour_cells.knn_activity, hour_cells.explain_activity):
        assert f(rows, FIRST, LAST).count() == 0


def test_usage_cells_hold_the_probabilities_of_the_test_rows(spark, sf):
    from loadshift.catalog.features import usage_table
    from loadshift.operators import cells

    usage = usage_table(spark, sf)
    dates = ("2024-01-05", "2024-01-29")
    want = {(r[0], r[1], r[2]): r[3] for r in cells.logit_usage(usage, *dates).filter("p IS NOT NULL").select("household_id", "device", "date", "p").collect()}
    got = {(r[0], r[1], r[2]): r[3] for r in cells.logit_cells(usage, *dates).select("household_id", "device", "date", F.get("rate", F.col("next_cell"))).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
