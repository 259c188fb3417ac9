"""Learners, walk-forward, scores, imputation and explanations against brute force."""

import itertools
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadshift.operators import explain, impute, learners, models, score

D0 = date(2024, 1, 1)


def sample(n=300, seed=0):
    rng = np.random.default_rng(seed)
    X = np.column_stack([rng.integers(0, 24, n), *rng.integers(0, 2, (3, n))]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(X[:, 1] * 2 + X[:, 2] - 1.5)))).astype(float)
    return X, y


@pytest.mark.parametrize("name", list(learners.LEARNERS))
def test_every_learner_ranks_better_than_chance(name):
    X, y = sample()
    p = learners.fit(X, y, 1 - y, name)(X)
    wins = (p[y == 1][:, None] > p[y == 0][None, :]).mean()
    losses = (p[y == 1][:, None] < p[y == 0][None, :]).mean()
    assert ((p >= 0) & (p <= 1)).all() and wins > losses + 0.25


def test_logit_reaches_the_optimum_of_the_penalised_loss():
    X, y = sample()
    score_ = learners.logit(X, y, 1 - y)

    def loss(shift):
        z = np.hstack([X, np.ones((len(X), 1))]) @ shift
        return np.log1p(np.exp(z)).sum() - (y * z).sum() + 0.5 * (shift[:-1] ** 2).sum()

    eye = np.vstack([np.zeros(4), np.eye(4)])
    odds = np.log(score_(eye) / (1 - score_(eye)))
    w = np.append(odds[1:] - odds[0], odds[0])
    for i, step in itertools.product(range(5), (1e-3, -1e-3)):
        assert loss(w) <= loss(w + step * np.eye(5)[i]) + 1e-9


def test_merged_rows_give_the_same_logit():
    X, y = sample()
    a, b = learners.logit(X, y, 1 - y)(X), learners.fit(X, y, 1 - y, "logit")(X)
    assert np.allclose(a, b, atol=1e-8)


def test_knn_prefers_the_latest_of_equally_far_rows():
    X = np.zeros((30, 1))
    y = np.array([0.0] * 20 + [1.0] * 10)
    assert learners.knn(X, y, 1 - y)(np.zeros((1, 1)))[0] == 1.0


def test_single_deep_tree_equals_cell_means():
    X, y = sample(500)
    X = X[:, 1:]
    cells, at = np.unique(X, axis=0, return_inverse=True)
    f, design = learners._design(cells)
    pos = np.bincount(at.reshape(-1), y)
    n = np.bincount(at.reshape(-1)).astype(float)
    split, value = learners._grow(design(cells), f, pos[None], n[None], 3)
    assert np.allclose(learners._leaf_values(design(cells), split, value)[0], pos / n)


def test_unknown_model_is_an_error():
    with pytest.raises(ValueError):
        learners.fit(np.zeros((1, 1)), np.ones(1), np.zeros(1), "svm")


def usage_rows(spark, days=25, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for h in (1, 2):
        for i in range(days):
            a, b, c, y = (int(v) for v in rng.integers(0, 2, 4))
            rows.append((h, "x", D0 + timedelta(days=i), a, b, c, y))
    return spark.createDataFrame(
        rows, "household_id int, device string, day date, usage_lag_1 int, usage_lag_2 int, active_last_2_days int, usage int"
    )


def test_chunks_do_not_change_predictions(spark):
    df = usage_rows(spark)
    one = models.usage_walk_forward(df, "logit", "2024-01-08", "2024-01-20")
    many = models.usage_walk_forward(df, "logit", "2024-01-08", "2024-01-20", chunks=3)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_walk_forward_matches_one_fit(spark):
    df = usage_rows(spark)
    pdf = df.filter("household_id = 1").orderBy("day").toPandas()
    train = pdf.iloc[3:15]
    X = train[models.USAGE_FEATURES].to_numpy(dtype=float)
    y = train["usage"].to_numpy(dtype=float)
    want = learners.fit(X, y, 1 - y, "ada")(pdf.iloc[15:16][models.USAGE_FEATURES].to_numpy(dtype=float))[0]
    got = models.usage_walk_forward(df, "ada", "2024-01-15", "2024-01-15").filter("household_id = 1").first()
    assert got.day == D0 + timedelta(days=15) and got.p == pytest.approx(want)


def test_cells_of_scope_all_cover_every_row(spark):
    out = models.usage_walk_forward(usage_rows(spark), "logit", "2024-01-15", "2024-01-15", scope="all")
    total = out.groupBy("household_id").agg(F.sum(F.col("n_pos") + F.col("n_neg")).alias("n"))
    assert {r.n for r in total.collect()} == {25}


def test_distributed_logit_agrees_with_the_local_one(spark):
    df = usage_rows(spark, 200)
    model = models.fit_table(df, models.USAGE_FEATURES, "usage", "logit")
    got = models.predict_table(model, df).orderBy("household_id", "day").toPandas()
    X = got[models.USAGE_FEATURES].to_numpy(dtype=float)
    y = got["usage"].to_numpy(dtype=float)
    assert np.allclose(got["p"], learners.fit(X, y, 1 - y, "logit")(X), atol=1e-4)


def test_auc_with_ties_and_single_class(spark):
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 2, 200), rng.integers(0, 6, 200) / 6
    rows = [(1, int(a), float(b)) for a, b in zip(y, p)] + [(2, 1, 0.5)]
    df = spark.createDataFrame(rows, "k int, y int, p double")
    got = {r.k: r.auc for r in score.auc(df, ["k"]).collect()}
    wins = [(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]]
    assert got[1] == pytest.approx(np.mean(wins)) and got[2] is None
    flipped = {r.k: r.auc for r in score.auc(df.withColumn("p", 1 - F.col("p")), ["k"]).collect()}
    assert flipped[1] == pytest.approx(1 - got[1])


def test_cold_start_days(spark):
    rows = [(1, D0 + timedelta(days=i), a, b) for i, (a, b) in enumerate([(0.5, 9.0), (0.9, 0.1), (0.7, 0.3), (1.0, 0.0)])]
    table = spark.createDataFrame(rows, "household_id int, date date, activity double, load_x double")
    got = {(r.agent, r.tolerance): r.days for r in score.cold_start_days(table, ["activity", "load_x"], [0.2, 0.4, 0.0]).collect()}
    assert got[("activity", 0.2)] == 4 and got[("activity", 0.4)] == 2 and got[("load_x", 0.4)] == 2
    # nothing beats the maximum itself, and no error lies below 0: one more than the days there are
    assert got[("activity", 0.0)] == 5 and got[("load_x", 0.0)] == 5 and got[("framework", 0.2)] == 4


def test_imputation_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    X = rng.random((60, 3))
    X[rng.random((60, 3)) < 0.2] = np.nan
    X[7] = np.nan
    rows = [("s", i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(X)]
    df = spark.createDataFrame(rows, "station string, t int, a double, b double, c double")
    got = impute.knn_impute(df, "station", "t", ["a", "b", "c"], chunks=3).orderBy("t").toPandas()[["a", "b", "c"]].to_numpy()
    for i in range(60):
        for j in range(3):
            if not np.isnan(X[i, j]):
                assert got[i, j] == X[i, j]
                continue
            near = []
            for k in range(60):
                shared = ~np.isnan(X[i]) & ~np.isnan(X[k])
                if not np.isnan(X[k, j]) and shared.any():
                    near.append((np.sqrt(((X[i] - X[k])[shared] ** 2).sum() * 3 / shared.sum()), X[k, j]))
            near = sorted(near)[:7]
            want = np.average([v for _, v in near], weights=[1 / d for d, _ in near]) if near else np.nanmean(X[:, j])
            assert got[i, j] == pytest.approx(want)


def test_shapley_values_add_up_to_the_prediction(spark):
    out = explain.explain(
        usage_rows(spark), ["household_id", "device"], models.USAGE_FEATURES, "usage", "day", "logit", "2024-01-15", "2024-01-20", lime_samples=500
    )
    rows = explain.reconstruct(out).collect()
    assert len(rows) == 12
    for r in rows:
        assert r.shap == pytest.approx(r.p) and 0 <= r.lime <= 1


def test_shapley_values_match_all_orderings(spark):
    df = usage_rows(spark, 15)
    r = explain.explain(df, ["household_id", "device"], models.USAGE_FEATURES, "usage", "day", "logit", "2024-01-13", "2024-01-13", lime_samples=0).filter("household_id = 1").first()
    pdf = df.filter("household_id = 1").orderBy("day").toPandas()
    X = pdf[models.USAGE_FEATURES].to_numpy(dtype=float)
    y = pdf["usage"].to_numpy(dtype=float)
    f = learners.fit(X[3:13], y[3:13], 1 - y[3:13], "logit")
    phi = np.zeros(3)
    for order in itertools.permutations(range(3)):
        Z = X[3:13].copy()
        for i in order:
            before = f(Z).mean()
            Z[:, i] = X[13, i]
            phi[i] += (f(Z).mean() - before) / 6
    assert [s.importance for s in r.importance] == pytest.approx(list(phi))


def test_weather_clause_names_the_two_strongest_columns(spark):
    names = [*models.ACTIVITY_FEATURES, "dwpt", "rhum", "temp", "wdir", "wspd"]
    value = {"temp": 0.5, "wspd": 0.2, "activity_lag_48": 0.1}
    items = ", ".join(f"named_struct('feature', '{n}', 'importance', {value.get(n, -0.1)}D)" for n in names)
    df = spark.sql(f"SELECT array({items}) AS imp")
    weather = {c: F.lit(1.234) for c in ("dwpt", "rhum", "temp", "wdir", "wspd")}
    lags = [F.lit(0)] * 3
    text = df.select(explain.activity_sentence("imp", lags, weather).alias("t")).first().t
    assert text == (
        "We based the recommendation on your past activity and usage of the device. "
        "We believe you are active today since you were not active during the last two days."
        "The weather conditions (temperature:1.23, windspeed:1.23) support that recommendation."
    )


def test_cell_models_equal_one_fit_per_date(spark):
    from loadshift.operators import cells

    df = usage_rows(spark)
    by_name = {"logit": cells.logit_usage, "logit_sm": cells.logit_sm_usage, "knn": cells.knn_usage}
    for name, of_cells in by_name.items():
        want = {(r.household_id, r.date): (r.p, r.error) for r in models.usage_walk_forward(df, name, "2024-01-02", "2024-01-23").collect()}
        got = {(r.household_id, r.date): (r.p, r.error) for r in of_cells(df, "2024-01-02", "2024-01-23").collect()}
        assert got.keys() == want.keys() and len(got) == 44
        for k, (p, error) in want.items():
            assert got[k][1] == error and (got[k][0] == pytest.approx(p, abs=1e-6) if p is not None else got[k][0] is None)
        assert {e for _, e in got.values()} >= {None, "no training rows"}


def test_weather_follows_the_station_of_the_household(spark):
    features = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")], "household_id int, t string").selectExpr("household_id", "cast(t AS timestamp) AS hour_ts")
    weather = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "station string, temp double").withColumn("time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    stations = spark.createDataFrame([(1, "A"), (2, "B")], "household_id int, station string")
    got = {(r.household_id, r.station, r.temp) for r in impute.join_weather(features, weather, stations, "hour_ts").collect()}
    assert got == {(1, "A", 1.0), (2, "B", 2.0), (None, "C", 3.0)}


def test_pivot_refuses_two_readings_at_one_time(spark):
    from loadshift.operators import hourly

    rows = spark.createDataFrame([(1, "a", 1.0), (1, "a", 9.0)], "household_id int, entity_id string, v double").withColumn("last_updated_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    with pytest.raises(Exception, match="several readings"):
        hourly.pivot_devices(rows, ["a"], F.col("v")).collect()
    assert hourly.duplicate_readings(rows).first().n == 2


def test_prices_follow_the_zone(spark):
    from loadshift.operators import recommend

    profiles = spark.createDataFrame([(1, "x", "2024-01-01", [1.0] * 24), (2, "x", "2024-01-01", [1.0] * 24), (3, "x", "2024-01-01", [1.0] * 24)], "household_id int, device string, date string, load array<double>")
    homes = spark.createDataFrame([(1, "Z1"), (2, "Z2")], "household_id int, zone string")
    horizon = spark.createDataFrame([("Z1", "2024-01-01", [1.0] * 48), ("Z2", "2024-01-01", [2.0] * 48)], "zone string, date string, prices array<double>")
    got = {r.household_id: r.costs and r.costs[0] for r in recommend.with_costs(profiles, homes, horizon).collect()}
    assert set(got) == {1, 2, 3} and got[2] == pytest.approx(2 * got[1]) and got[3] is None


def test_fits_solved_together_equal_one_fit_per_date(spark):
    """Of rows with gaps and a household that starts late, whose first day has no training rows."""
    from loadshift.operators import cells

    days = usage_rows(spark, 24).filter("day <> date'2024-01-09' AND (household_id = 1 OR day > date'2024-01-06')")
    for name, fit in (("ada", cells.ada), ("xgboost", cells.xgboost), ("ebm", cells.ebm), ("random forest", cells.random_forest)):
        got = cells.usage_of_counts(days, "2024-01-02", "2024-01-20", fit).collect()
        want = models.usage_walk_forward(days, name, "2024-01-02", "2024-01-20").collect()
        values = {(r.household_id, r.device, r.day): (r.date, r.y, r.error, r.p) for r in got}
        assert len(got) == len(want) == len(values)
        for r in want:
            found = values[r.household_id, r.device, r.day]
            assert found[:3] == (r.date, r.y, r.error)
            assert found[3] == pytest.approx(r.p, abs=1e-9) if r.p is not None else found[3] is None


def test_forest_by_node_sums_equals_the_dense_one(monkeypatch):
    """The trees of ``_grow`` over all thresholds, from the same draws."""
    rng = np.random.default_rng(7)
    X = np.column_stack([np.tile(np.arange(24), 9), rng.normal(size=216).round(1), *(rng.random((3, 216)) < 0.3)]).astype(float)
    y = (rng.random(216) < 0.3 + 0.3 * X[:, 2]).astype(float)
    got = learners.fit(X, y, 1 - y, "random forest", n_estimators=60)(X)
    f, design = learners._design(np.unique(X, axis=0))
    B = design(np.unique(X, axis=0))

    def dense(V, n_cuts, p, n, depth, n_features, rng):
        return learners._grow(B, f, p, n, depth, n_features=n_features, rng=rng)

    monkeypatch.setattr(learners, "_grow_counts", dense)
    assert np.array_equal(got, learners.fit(X, y, 1 - y, "random forest", n_estimators=60)(X))


def test_xai_metrics_read_stored_explanations(spark, sf):
    """Their six aggregates fit and explain nothing again."""
    from loadshift.catalog import learned

    plan = learned.e8_xai_metrics(spark, sf)._jdf.queryExecution().logical().toString()
    assert "FlatMapGroupsInPandas" not in plan


def test_lime_with_merged_samples_equals_all_samples(spark):
    """A LIME value from 5,000 sampled rows one by one."""
    n, samples = 3, 5000
    out = explain.explain(usage_rows(spark), ["household_id", "device"], models.USAGE_FEATURES, "usage", "day", "logit", "2024-01-15", "2024-01-15")
    got = out.filter("household_id = 1").first()
    pdf = usage_rows(spark).filter("household_id = 1").toPandas().sort_values("day")
    X, y = pdf[models.USAGE_FEATURES].to_numpy(float), pdf["usage"].to_numpy(float)
    train = slice(models.LEAD_DAYS, 15)
    score, rng, x = learners.fit(X[train], y[train], 1 - y[train], "logit"), np.random.default_rng(0), X[15]
    sample = np.column_stack([rng.choice(X[train][:, j], samples) for j in range(n)])
    sample[0] = x
    same = (sample == x).astype(float)
    kernel = np.exp(-(n - same.sum(axis=1)) / (0.75**2 * n)) ** 0.5
    A = np.hstack([same, np.ones((samples, 1))])
    want = np.linalg.solve((A * kernel[:, None]).T @ A + np.diag([1.0] * n + [0.0]), (A * kernel[:, None]).T @ score(sample)).sum()
    assert got.lime == pytest.approx(want, abs=1e-9)


def test_boosting_by_values_grows_the_trees_of_the_dense_one(monkeypatch):
    """Continuous columns, one of them twice and once mirrored, so that many splits are equally good: the same trees to the last bit, and
    no node is added up over all thresholds."""
    rng = np.random.default_rng(3)
    smooth = rng.normal(size=(400, 3))
    X = np.column_stack([np.arange(400) % 24, rng.integers(0, 2, (400, 2)), smooth, smooth[:, 0], -smooth[:, 1], np.ones(400)])
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * smooth[:, 0]))).astype(float)

    def dense(V, n_cuts, B, g, h, depth, ridge, min_child):
        return grow(B, np.repeat(np.arange(len(n_cuts)), n_cuts), g[None], h[None], depth, ridge=ridge, min_child=min_child)

    def refused(*args, **kw):
        raise AssertionError("added up over all thresholds")

    grow = learners._grow
    monkeypatch.setattr(learners, "_grow", refused)
    by_values = learners.xgboost(X, y, 1 - y, max_bin=64)(X)
    monkeypatch.setattr(learners, "_grow_bins", dense)
    assert np.array_equal(by_values, learners.xgboost(X, y, 1 - y, max_bin=64)(X))


def test_forest_adds_up_each_row_once_for_all_drawn_features(monkeypatch):
    """The rows of a level are added up by the bits of the features that their node has drawn, and once more where one of those has many
    thresholds; not for each of the three and for both weights."""
    rng = np.random.default_rng(9)
    X = np.column_stack([rng.integers(0, 24, 400), rng.integers(0, 2, (400, 9))]).astype(float)
    y = (rng.random(400) < 0.2 + 0.4 * X[:, 3]).astype(float)
    lengths, bincount = [], np.bincount

    def counted(x, *args, **kw):
        lengths.append(len(x))
        return bincount(x, *args, **kw)

    monkeypatch.setattr(np, "bincount", counted)
    learners.random_forest(X, y, 1 - y, max_depth=1, n_estimators=40)
    assert max(lengths) > 2_000 and sum(lengths) < 2 * max(lengths)


def test_forest_with_features_looked_up_in_parts_equals_the_dense_one(monkeypatch):
    """More drawn features than are looked up at once, and several with many thresholds."""
    rng = np.random.default_rng(11)
    X = np.column_stack([np.ones(200), rng.integers(0, 2, (200, 5)), rng.normal(size=(200, 2)).round(1), rng.integers(0, 2, 200), np.ones(200)]).astype(float)
    y = (rng.random(200) < 0.3 + 0.3 * X[:, 2]).astype(float)
    kw = {"n_estimators": 30, "max_features": 5}
    got = learners.fit(X, y, 1 - y, "random forest", **kw)(X)
    monkeypatch.setattr(learners, "MAX_CODES", 1)
    assert np.array_equal(got, learners.fit(X, y, 1 - y, "random forest", **kw)(X))
    f, design = learners._design(np.unique(X, axis=0))
    B = design(np.unique(X, axis=0))
    monkeypatch.setattr(learners, "_grow_counts", lambda codes, n_cuts, p, n, depth, m, rng: learners._grow(B, f, p, n, depth, n_features=m, rng=rng))
    assert np.array_equal(got, learners.fit(X, y, 1 - y, "random forest", **kw)(X))


def lots(n_fits=5):
    """Fits of unlike length, one with a column that does not vary and one with a column of two values where others have many."""
    rng, out = np.random.default_rng(13), []
    for i in range(n_fits):
        n = int(rng.integers(60, 300))
        smooth = rng.normal(size=(n, 2)).round(2)
        X = np.column_stack([rng.integers(0, 24, n) if i else rng.integers(0, 2, n), rng.integers(0, 2, (n, 2)), smooth, -smooth[:, 0]])
        X[:, 1] *= i != 1
        X = np.unique(X, axis=0)
        pos = rng.integers(0, 3, len(X)).astype(float)
        out.append((X, pos, rng.integers(1, 4, len(X)).astype(float)))
    return out


def test_boosting_several_fits_together_gives_the_trees_of_each(monkeypatch):
    """To the last bit, and each round grows one tree of all fits at once."""
    fits = lots()
    want = [learners.xgboost(*one, n_estimators=20, max_bin=32)(one[0]) for one in fits]
    calls, grow = [], learners._grow_lot
    monkeypatch.setattr(learners, "_grow_lot", lambda *a: calls.append(1) or grow(*a))
    got = list(learners.fit_many(fits, "xgboost", n_estimators=20, max_bin=32))
    assert len(calls) == 20
    assert all(np.array_equal(score(X), p) for score, (X, _, _), p in zip(got, fits, want, strict=True))


def test_forests_of_several_fits_grown_together_are_those_of_each(monkeypatch):
    """From the same draws, to the last bit; one fit has fewer features to draw from, and blocks of trees are grown for several fits."""
    fits = lots(7)
    fits[2][0][:, 3:] = 1.0
    want = [learners.random_forest(*one, n_estimators=90)(one[0]) for one in fits]
    n_blocks = [len(range(0, 90, 20_000 // len(X))) for X, _, _ in fits]
    calls, grow = [], learners._grow_forests
    monkeypatch.setattr(learners, "_grow_forests", lambda draws, rows, *a: calls.append(len(rows)) or grow(draws, rows, *a))
    got = list(learners.fit_many(fits, "random forest", n_estimators=90))
    assert sum(calls) == sum(n_blocks) and len(calls) < sum(n_blocks) / 2
    assert all(np.array_equal(score(X), p) for score, (X, _, _), p in zip(got, fits, want, strict=True))


def test_households_fitted_together_equal_one_by_one(spark):
    """Households that meet in one task, one without a number and one whose rows have one class, in batches that cut through them."""
    rng = np.random.default_rng(17)
    rows = []
    for h in (*range(12), None):
        for i in range(20):
            a, b, c, y = (int(v) for v in rng.integers(0, 2, 4))
            rows.append((h, D0 + timedelta(days=i), a, b, c, 0 if h == 4 else y))
    df = spark.createDataFrame(rows, "household_id int, day date, usage_lag_1 int, usage_lag_2 int, active_last_2_days int, usage int")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        out = models.walk_forward(df.coalesce(1), ["household_id"], models.USAGE_FEATURES, "usage", "day", "xgboost", "2024-01-10", "2024-01-12").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    got = {(r.household_id, r.date): (r.day, r.y, r.p, r.error) for r in out}
    assert len(out) == len(got) == 13 * 3
    for (h, day), (target, y, p, error) in got.items():
        own = [r for r in rows if r[0] == h]
        at = (day - D0).days
        X, truth = np.array([r[2:5] for r in own], float), np.array([r[5] for r in own], float)
        assert target == day + timedelta(days=1) and y == truth[at + 1]
        if h == 4:
            assert p is None and error == "one class in the training rows"
        else:
            want = learners.fit(X[3 : at + 1], truth[3 : at + 1], 1 - truth[3 : at + 1], "xgboost")(X[at + 1 : at + 2])[0]
            assert error is None and p == pytest.approx(want, abs=1e-12)


def test_xai_metrics_cover_all_dates(spark, tmp_path):
    """From the first date with two training days to the day before the last one, of 24 days of made-up events."""
    from loadshift.catalog import learned

    rng = np.random.default_rng(19)
    rows = []
    for user in (0, 7):
        for at in rng.choice(24 * 24, 300, replace=False):
            kind = ("view", "click", "purchase", "signup", "error")[int(rng.integers(0, 5))]
            rows.append((len(rows), datetime(2024, 1, 1) + timedelta(hours=int(at), minutes=5), user, kind, float(rng.integers(1, 90)), '{"k": %d}' % rng.integers(0, 9)))
        rows += [(len(rows) + i, datetime(2024, 1, 1) + timedelta(days=d), user, "view", 50.0, '{"k": 1}') for i, d in enumerate((0, 23))]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    explained = explain.reconstruct(learned._usage_explained(spark, str(tmp_path))).collect()
    keys = {(r.household_id, r.device) for r in explained}
    for k in keys:
        assert sorted(r.date for r in explained if (r.household_id, r.device) == k) == [D0 + timedelta(days=i) for i in range(4, 23)]
    got = {(r.household_id, r.device): r for r in learned.e8_xai_metrics(spark, str(tmp_path)).collect()}
    assert len(keys) > 1 and got.keys() == keys
    for k, r in got.items():
        mine = [x for x in explained if (x.household_id, x.device) == k and x.p is not None]
        assert r.lime_mae == (pytest.approx(np.mean([abs(x.p - x.lime) for x in mine]), abs=2e-6) if mine else None)
    assert sum(x.p is not None for x in explained) > 10 * len(keys)
