"""Usage models of every date from running counts per feature cell, without refits of history.

The three usage features are binary, so the training set of a date is eight cells. Running counts give every date's cells in one pass;
one row per (household, device, date) holds all that a fit or a neighbour search needs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadshift.operators import learners
from loadshift.operators.models import FEW_ROWS, LEAD_DAYS, NO_ROWS, ONE_CLASS, spread
from loadshift.operators.rates import USAGE_CELLS, usage_cell, usage_counts

KEYS = ["household_id", "device"]
#: The features of each cell: the bits of its number.
CELLS = (np.arange(USAGE_CELLS)[:, None] >> np.array([2, 1, 0])) & 1
#: Fits that are solved together.
BATCH = 2_000


def newton(n: np.ndarray, pos: np.ndarray, penalty: float = 1.0, intercept: bool = True, rounds: int = 100, design: np.ndarray = CELLS) -> np.ndarray:
    """Probabilities of all cells of logistic regressions, one for each row of cell counts; the intercept is not penalised. ``design``
    holds the features of each cell."""
    A = np.hstack([design, np.ones((USAGE_CELLS, 1))]) if intercept else design.astype(float)
    ridge = np.full(A.shape[1], penalty)
    if intercept:
        ridge[-1] = 0.0
    w = np.zeros((len(n), A.shape[1]))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w @ A.T, -35, 35)))
        gradient = (n * p - pos) @ A + ridge * w
        curvature = np.einsum("rc,ci,cj->rij", n * p * (1 - p), A, A) + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curvature, gradient[:, :, None])[:, :, 0]
        w -= step
        if not len(w) or np.abs(step).max() < 1e-10:
            break
    return 1 / (1 + np.exp(-np.clip(w @ A.T, -35, 35)))


def _dated(counts: DataFrame, first_date: str, last_date: str) -> DataFrame:
    dates = F.col("date").between(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))
    total = {"rows": F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x), "positives": F.aggregate("pos", F.lit(0).cast("bigint"), lambda a, x: a + x)}
    return counts.filter(dates & F.col("target_date").isNotNull()).withColumns(total)


def _error(neighbours: int = 0) -> Column:
    one_class = (F.col("positives") == 0) | (F.col("positives") == F.col("rows"))
    return F.when(F.col("rows") == 0, NO_ROWS).when(one_class, ONE_CLASS).when(F.col("rows") < neighbours, FEW_ROWS)


def logit_usage(features: DataFrame, first_date: str, last_date: str, penalty: float = 1.0, intercept: bool = True, rounds: int = 100) -> DataFrame:
    """household_id, device, date, day, y, p, error for every date: the regression on the rows up to the date, for the next day."""

    @F.pandas_udf("double")
    def probability(n: pd.Series, pos: pd.Series, cell: pd.Series) -> pd.Series:
        counts = [np.array(x.tolist(), float).reshape(-1, USAGE_CELLS) for x in (n, pos)]
        return pd.Series(newton(*counts, penalty, intercept, rounds)[np.arange(len(cell)), cell.to_numpy()])

    rows = _dated(usage_counts(features), first_date, last_date).withColumn("error", _error())
    rows = rows.withColumn("p", F.when(F.col("error").isNull(), probability("n", "pos", "next_cell")))
    return rows.select(*KEYS, "date", F.col("target_date").alias("day"), "y", "p", "error")


def logit_cells(features: DataFrame, first_date: str, last_date: str, penalty: float = 1.0, intercept: bool = True, rounds: int = 100) -> DataFrame:
    """household_id, device, date, n[8], pos[8], rate[8], next_cell, y: the probabilities that each date's regression gives all cells.
    Dates without a fit have no row."""

    @F.pandas_udf("array<double>")
    def rate(n: pd.Series, pos: pd.Series) -> pd.Series:
        return pd.Series(list(newton(*[np.array(x.tolist(), float).reshape(-1, USAGE_CELLS) for x in (n, pos)], penalty, intercept, rounds)))

    rows = _dated(usage_counts(features), first_date, last_date).filter(_error().isNull())
    return rows.select(*KEYS, "date", "n", "pos", rate("n", "pos").alias("rate"), "next_cell", "y")


def logit_sm_usage(features: DataFrame, first_date: str, last_date: str) -> DataFrame:
    """The same without penalty and intercept, at most 35 steps."""
    return logit_usage(features, first_date, last_date, 0.0, False, 35)


def knn_usage(features: DataFrame, first_date: str, last_date: str, neighbours: int = 10) -> DataFrame:
    """The share of used days among the nearest training rows; of equally far ones the latest count. p is NULL where there is no fit.

    A cell's rows are equally far from any other, so its last ``neighbours`` rows are all that can be near: they are kept for each
    cell and carried along the dates.
    """
    rows = features.select(*KEYS, F.col("day").alias("date"), "usage", usage_cell().alias("cell"))
    start = F.date_add(F.min("date").over(Window.partitionBy(*KEYS)), LEAD_DAYS)
    usable = F.when(F.col("date") >= start, F.struct(F.unix_date("date").alias("at"), F.col("usage").alias("y")))
    last = Window.partitionBy(*KEYS, "cell").orderBy("date").rowsBetween(-neighbours + 1, 0)
    upto = Window.partitionBy(*KEYS).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    recent = rows.withColumn("usable", usable).withColumn("recent", F.collect_list("usable").over(last))
    by_cell = [F.last(F.when(F.col("cell") == c, F.col("recent")), ignorenulls=True).over(upto) for c in range(USAGE_CELLS)]
    kept = recent.select(*KEYS, "date", F.array(*by_cell).alias("kept"))
    counts = _dated(usage_counts(features), first_date, last_date).withColumn("error", _error(neighbours))
    near = """flatten(transform(kept, (rows, c) -> transform(coalesce(rows, array()), r -> named_struct(
        'far', bit_count(cast(c ^ next_cell AS int)), 'age', -r.at, 'y', r.y))))"""
    nearest = F.expr(f"slice(array_sort({near}), 1, {neighbours})")
    out = counts.join(kept, [*KEYS, "date"]).withColumn("nearest", nearest)
    p = F.expr("aggregate(nearest, 0L, (s, r) -> s + r.y) / size(nearest)")
    return out.select(*KEYS, "date", F.col("target_date").alias("day"), "y", F.when(F.col("error").isNull(), p).alias("p"), "error")


# models without a closed form of counts: many fits at once --------------------------------------------


def _total(weights: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Row sums, added up in the order in which one fit adds up the cells it has seen."""
    in_turn = np.zeros(len(weights))
    for c in range(USAGE_CELLS):
        in_turn = in_turn + weights[:, c]
    return np.where(seen.all(axis=1), np.ascontiguousarray(weights).sum(axis=1), in_turn)


def ada(n: np.ndarray, pos: np.ndarray, learning_rate: float = 0.1, n_estimators: int = 100) -> np.ndarray:
    """``learners.ada`` for each row of cell counts: probabilities of all cells."""
    B, f, tiny = CELLS.astype(float), np.arange(CELLS.shape[1]), np.finfo(float).eps
    wp, wn = pos / n.sum(axis=1, keepdims=True), (n - pos) / n.sum(axis=1, keepdims=True)
    odds_sum, stumps, seen = np.zeros(n.shape), np.zeros(len(n)), n > 0
    live = np.arange(len(n))
    for _ in range(n_estimators):
        if not len(live):
            break
        p = learners._leaf_values(B, *learners._grow(B, f, wp, wp + wn, 1))
        clipped = np.clip(p, tiny, 1 - tiny)
        odds = np.log(clipped) - np.log(1 - clipped)
        odds_sum[live] += odds
        stumps[live] += 1
        going = (np.where(p <= 0.5, wp, wn) > 0).any(axis=1)
        live, odds = live[going], odds[going]
        wp, wn = wp[going] * np.exp(-0.5 * learning_rate * odds), wn[going] * np.exp(0.5 * learning_rate * odds)
        total = _total(wp + wn, seen[live])[:, None]
        wp, wn = wp / total, wn / total
    return 1 / (1 + np.exp(-odds_sum / stumps[:, None]))


def xgboost(n: np.ndarray, pos: np.ndarray, learning_rate: float = 0.1, reg_lambda: float = 1.0, n_estimators: int = 100) -> np.ndarray:
    """``learners.xgboost`` likewise. Three binary features allow three levels of splits."""
    B, f = CELLS.astype(float), np.arange(CELLS.shape[1])
    margin = np.zeros(n.shape)
    for _ in range(n_estimators):
        p = 1 / (1 + np.exp(-margin))
        split, value = learners._grow(B, f, pos - n * p, n * p * (1 - p), CELLS.shape[1], ridge=reg_lambda, min_child=1.0)
        margin = margin + learners._leaf_values(B, split, learning_rate * value)
    return 1 / (1 + np.exp(-margin))


def ebm(n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """``learners.ebm`` likewise: a feature that varies among a fit's rows has two bins, any other one. Fits whose features vary alike
    are solved together."""
    seen = n > 0
    varies = np.array([(seen[:, bit == 1].any(axis=1)) & (seen[:, bit == 0].any(axis=1)) for bit in CELLS.T]).T
    out = np.empty(n.shape)
    for pattern in np.unique(varies, axis=0):
        at = (varies == pattern).all(axis=1)
        bins = [np.eye(2)[bit] if v else np.ones((USAGE_CELLS, 1)) for v, bit in zip(pattern, CELLS.T)]
        out[at] = newton(n[at], pos[at], design=np.hstack(bins))
    return out


def random_forest(n: np.ndarray, pos: np.ndarray, n_estimators: int = 500, seed: int = 0) -> np.ndarray:
    """``learners.random_forest`` likewise, with its draws: of three features one may split a node. Counts are whole numbers, whose sums
    do not depend on the order."""
    return np.array([_forest(a, b, n_estimators, seed) for a, b in zip(n, pos)]).reshape(n.shape)


def _forest(n: np.ndarray, pos: np.ndarray, n_estimators: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    seen = np.flatnonzero(n > 0)
    X = CELLS[seen]
    varying = X.min(axis=0) < X.max(axis=0)
    weights = np.concatenate([pos[seen], n[seen] - pos[seen]])
    draw = rng.multinomial(int(round(weights.sum())), weights / weights.sum(), n_estimators).astype(float)
    g, h = np.zeros((2, n_estimators, USAGE_CELLS))
    g[:, seen] = draw[:, : len(seen)]
    h[:, seen] = g[:, seen] + draw[:, len(seen) :]
    n_features = np.flatnonzero(varying)[-1] + 1 if varying.any() else 0
    tree = np.arange(n_estimators)[:, None]
    node = np.zeros((n_estimators, USAGE_CELLS), dtype=int)  # of each cell, in heap order within its level
    value = np.broadcast_to((g.sum(axis=1) / h.sum(axis=1))[:, None], g.shape)
    open_ = np.ones((n_estimators, 1), dtype=bool)
    for level in range(CELLS.shape[1] if n_features else 0):
        width = 2**level
        rows = open_.sum()
        rank = np.zeros((n_estimators, width, n_features))
        rank[open_] = rng.random((rows, n_features))
        pick = rank.argmin(axis=2)
        at = tree * width + node
        chosen = pick.ravel()[at]
        right = CELLS.T[chosen, np.arange(USAGE_CELLS)]
        G, H, GR, HR = (np.bincount(at.ravel(), x.ravel(), n_estimators * width) for x in (g, h, g * right, h * right))
        GL, HL = G - GR, H - HR
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = GL**2 / HL + GR**2 / HR - G**2 / H
        splits = (HL > 0) & (HR > 0) & varying[pick.ravel()] & open_.ravel()
        splits = splits & (np.where(splits, gain, -1.0) > 1e-9)
        leaf = [np.divide(a, b, out=np.zeros_like(a), where=b > 0) for a, b in ((GL, HL), (GR, HR))]
        value = np.where(splits[at], np.where(right == 1, leaf[1][at], leaf[0][at]), value)
        node = 2 * node + np.where(splits[at], right, 0)
        open_ = np.repeat(splits.reshape(n_estimators, width), 2, axis=1)
    return value.sum(axis=0) / n_estimators


def usage_of_counts(features: DataFrame, first_date: str, last_date: str, fit: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """household_id, device, date, day, y, p, error: ``fit`` on the rows up to the date, for the next day. It takes the rows and positives
    of each cell, a row for each fit, and returns the probabilities of all cells."""

    @F.pandas_udf("double")
    def probability(n: pd.Series, pos: pd.Series, cell: pd.Series) -> pd.Series:
        n, pos = (np.array(x.tolist(), float).reshape(-1, USAGE_CELLS) for x in (n, pos))
        out = [fit(n[i : i + BATCH], pos[i : i + BATCH]) for i in range(0, len(n), BATCH)]
        return pd.Series(np.concatenate(out)[np.arange(len(cell)), cell.to_numpy()])

    cell = F.expr("cast(coalesce(usage_lag_1, 0) * 4 + coalesce(usage_lag_2, 0) * 2 + coalesce(active_last_2_days, 0) AS int)")
    rows = spread(features.select(*KEYS, "day", F.coalesce("usage", F.lit(0)).alias("y"), cell.alias("cell")), KEYS)
    start = F.date_add(F.min("day").over(Window.partitionBy(*KEYS)), LEAD_DAYS)
    rows = rows.withColumn("_ok", F.col("day") >= start)
    before = "OVER (PARTITION BY household_id, device ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    def running(value: str) -> Column:
        cells = [f"coalesce(sum(CASE WHEN _ok AND cell = {c} THEN {value} ELSE 0 END) {before}, 0L)" for c in range(USAGE_CELLS)]
        return F.expr(f"array({', '.join(cells)})")

    counts = rows.select(*KEYS, F.date_sub("day", 1).alias("date"), F.col("day").alias("target_date"), "y", "cell", running("1").alias("n"), running("y").alias("pos"))
    fitted = _dated(counts, first_date, last_date).withColumn("error", _error())
    done = fitted.filter("error IS NULL").withColumn("p", probability("n", "pos", "cell"))
    both = done.unionByName(fitted.filter("error IS NOT NULL").withColumn("p", F.lit(None).cast("double")))
    return both.select(*KEYS, "date", F.col("target_date").alias("day"), F.col("y").cast("int").alias("y"), "p", "error")
