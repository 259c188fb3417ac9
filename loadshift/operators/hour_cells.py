"""Activity models of every date from sparse running cells, without refits of history.

The activity features are discrete: 24 hours, 7 weekdays and three lag flags make 1,344 cells. A day changes at most 24 cells of a
household, so the training set of a date is kept as the cells' running sums, each valid from the day of its last change to the next one.
A sliding start takes a row away again by a change of opposite sign. One row per (household, date) holds the cells that occur, which is
all that a fit, a neighbour search or an attribution needs: the work per date is bounded by the cells, not by the history.
"""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadshift.operators.explain import IMPORTANCE, shapley_weights
from loadshift.operators.models import ACTIVITY_FEATURES, DAY_DUMMIES, FEW_ROWS, LEAD_DAYS, NO_ROWS, ONE_CLASS
from loadshift.session import spread

HOURS, WEEKDAYS, LAGS = 24, len(DAY_DUMMIES) + 1, 3
N_CELLS = HOURS * WEEKDAYS * 2**LAGS
N_FEATURES = len(ACTIVITY_FEATURES)
KEYS = ["household_id", "date"]
#: Fits that are solved together; their cells are laid out densely only then.
BATCH = 128


def feature_rows() -> np.ndarray:
    """The features of each cell, in the order of ``ACTIVITY_FEATURES``; weekday 0 is the one without a dummy."""
    cell = np.arange(N_CELLS)
    hour, weekday, flags = cell // (WEEKDAYS * 2**LAGS), cell // 2**LAGS % WEEKDAYS, cell % 2**LAGS
    dummies = weekday[:, None] == np.arange(1, WEEKDAYS)
    return np.column_stack([hour, dummies, flags[:, None] >> np.arange(LAGS - 1, -1, -1) & 1]).astype(float)


def cell_number() -> Column:
    weekday = " + ".join(f"coalesce({d}, 0) * {i}" for i, d in enumerate(DAY_DUMMIES, 1))
    flags = " + ".join(f"coalesce({f}, 0) * {2 ** (LAGS - 1 - i)}" for i, f in enumerate(ACTIVITY_FEATURES[-LAGS:]))
    return F.expr(f"cast((hour * {WEEKDAYS} + {weekday}) * {2**LAGS} + {flags} AS int)")


def _rows(table: DataFrame) -> DataFrame:
    return table.select("household_id", "hour_ts", F.to_date("hour_ts").alias("date"), cell_number().alias("cell"), F.coalesce("activity", F.lit(0)).alias("y"))


def _between(first_date: str, last_date: str) -> Column:
    return F.col("date").between(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))


def _carried(changes: DataFrame, first_date: str, last_date: str) -> DataFrame:
    """Rows that hold from their date to the day before the next row of the same household and cell, once for each date asked for."""
    until = F.lead("date").over(Window.partitionBy("household_id", "cell").orderBy("date"))
    span = F.struct(
        F.greatest("date", F.lit(first_date).cast("date")).alias("from"),
        F.least(F.coalesce(F.date_sub(until, 1), F.lit(last_date).cast("date")), F.lit(last_date).cast("date")).alias("to"),
    )
    held = changes.withColumn("_span", span).filter("_span.from <= _span.to")
    return held.withColumn("date", F.explode(F.sequence("_span.from", "_span.to"))).drop("_span")


def _usable(rows: DataFrame, train_days: int | None, floor: str | None) -> DataFrame:
    """The rows that ever train: from 3 days after a household's first row, or from ``floor`` on where the start slides."""
    if train_days is not None:
        return rows.filter(F.col("date") >= F.lit(floor).cast("date")) if floor else rows
    start = F.date_add(F.min("date").over(Window.partitionBy("household_id")), LEAD_DAYS)
    return rows.withColumn("_start", start).filter("date >= _start").drop("_start")


def training_cells(table: DataFrame, first_date: str, last_date: str, train_days: int | None = None, floor: str | None = None) -> DataFrame:
    """household_id, date, cells array of (cell, n, pos): the training set of each date, as ``models.train_mask`` marks it. Dates with an
    empty training set have no row."""
    daily = _rows(table).groupBy("household_id", "date", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    changes = _usable(daily, train_days, floor)
    if train_days is not None:
        # A day's rows come with their date and go with a later one: both from the same row, so the days are summed up once.
        both = f"inline(array(struct(date, n, pos), struct(date_add(date, {int(train_days) + 1}) AS date, -n AS n, -pos AS pos)))"
        changes = changes.selectExpr("household_id", "cell", both).groupBy("household_id", "date", "cell").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    upto = Window.partitionBy("household_id", "cell").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    running = changes.select("household_id", "cell", "date", F.sum("n").over(upto).alias("n"), F.sum("pos").over(upto).alias("pos"))
    held = _carried(running, first_date, last_date).filter("n > 0")
    return spread(held, KEYS).groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("cell", "n", "pos"))).alias("cells"))


def recent_rows(table: DataFrame, first_date: str, last_date: str, neighbours: int) -> DataFrame:
    """household_id, date, recent array of (hour_ts, cell, y): of each cell the last ``neighbours`` training rows. Rows of one cell are
    equally far from any other row, so no older one can be near."""
    rows = _usable(_rows(table), None, None)
    last = Window.partitionBy("household_id", "cell").orderBy("hour_ts").rowsBetween(-neighbours + 1, 0)
    lists = rows.withColumn("recent", F.collect_list(F.struct("hour_ts", "cell", "y")).over(last))
    daily = lists.groupBy("household_id", "cell", "date").agg(F.max_by("recent", "hour_ts").alias("recent"))
    held = spread(_carried(daily, first_date, last_date), KEYS)
    return held.groupBy(*KEYS).agg(F.flatten(F.collect_list("recent")).alias("recent"))


def _asked(table: DataFrame, first_date: str, last_date: str, targets: DataFrame | None = None) -> DataFrame:
    """household_id, date, asked array of (hour_ts, cell, y): the hours of the day after each date; of ``targets`` (household_id,
    hour_ts) only, if given."""
    rows = _rows(table)
    if targets is not None:
        rows = rows.join(targets.select("household_id", "hour_ts").distinct(), ["household_id", "hour_ts"], "left_semi")
    before = rows.withColumn("date", F.date_sub("date", 1)).filter(_between(first_date, last_date))
    return spread(before, KEYS).groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("hour_ts", "cell", "y"))).alias("asked"))


def _with_error(asked: DataFrame, trained: DataFrame, neighbours: int = 0) -> DataFrame:
    """Adds the cells of the training sets and why there is no fit, or NULL."""
    both = asked.join(trained, KEYS, "left")
    total = {v: F.expr(f"aggregate(coalesce(cells.{v}, array()), 0L, (a, x) -> a + x)") for v in ("n", "pos")}
    one_class = (total["pos"] == 0) | (total["pos"] == total["n"])
    error = F.when(total["n"] == 0, NO_ROWS).when(one_class, ONE_CLASS).when(total["n"] < neighbours, FEW_ROWS)
    return both.withColumn("error", error)


def newton(n: np.ndarray, pos: np.ndarray, penalty: float = 1.0, intercept: bool = True, rounds: int = 100) -> np.ndarray:
    """Weights of logistic regressions, one for each row of cell counts: features, then the intercept (0 without one), which is not
    penalised. A fit that has settled takes part in no further step."""
    A = feature_rows()
    A = np.hstack([A, np.ones((N_CELLS, 1))]) if intercept else A
    k = A.shape[1]
    # Of the products of two features many are the same or zero, since weekdays exclude each other.
    squares, place = np.unique((A[:, :, None] * A[:, None, :]).reshape(N_CELLS, k * k), axis=1, return_inverse=True)
    ridge = np.full(k, penalty)
    if intercept:
        ridge[-1] = 0.0
    w = np.zeros((len(n), k))
    live = np.arange(len(n))
    for _ in range(rounds):
        if not len(live):
            break
        p = 1 / (1 + np.exp(-np.clip(w[live] @ A.T, -35, 35)))
        gradient = (n[live] * p - pos[live]) @ A + ridge * w[live]
        curvature = ((n[live] * p * (1 - p)) @ squares)[:, place.ravel()].reshape(-1, k, k) + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curvature, gradient[:, :, None])[:, :, 0]
        w[live] -= step
        live = live[np.abs(step).max(axis=1) >= 1e-10]
    return w if intercept else np.hstack([w, np.zeros((len(w), 1))])


def _dense(cell: pd.Series, values: pd.Series) -> np.ndarray:
    out = np.zeros((len(cell), N_CELLS))
    for i, (at, value) in enumerate(zip(cell, values)):
        out[i, at] = value
    return out


def _weights_udf(penalty: float, intercept: bool, rounds: int):
    @F.pandas_udf("struct<weights: array<double>, seconds: double>")
    def weights(cell: pd.Series, n: pd.Series, pos: pd.Series) -> pd.DataFrame:
        parts = []
        for i in range(0, len(cell), BATCH):
            start = time.perf_counter()
            part = slice(i, i + BATCH)
            counts = [_dense(cell.iloc[part], values.iloc[part]) for values in (n, pos)]
            fitted = newton(*counts, penalty, intercept, rounds)
            parts.append(pd.DataFrame({"weights": list(fitted), "seconds": (time.perf_counter() - start) / len(fitted)}))
        return pd.concat(parts, ignore_index=True)

    return weights


def _score(cell: str) -> str:
    """P(active) of a cell by ``weights``, as a column expression."""
    weekday = f"{cell} DIV {2**LAGS} % {WEEKDAYS}"
    flags = " + ".join(f"({cell} DIV {2 ** (LAGS - 1 - i)} % 2) * weights[{N_FEATURES - LAGS + i}]" for i in range(LAGS))
    z = f"weights[0] * ({cell} DIV {WEEKDAYS * 2**LAGS}) + if({weekday} = 0, 0D, weights[cast({weekday} AS int)]) + {flags} + weights[{N_FEATURES}]"
    return f"1 / (1 + exp(-greatest(-35D, least(35D, {z}))))"


def fits(table: DataFrame, first_date: str, last_date: str, targets: DataFrame | None = None, train_days: int | None = None, floor: str | None = None,
         penalty: float = 1.0, intercept: bool = True, rounds: int = 100) -> DataFrame:
    """household_id, date, asked, cells, error, weights, seconds: one regression per household and date. seconds is a fit's share of the
    time of the fits solved with it."""
    rows = _with_error(_asked(table, first_date, last_date, targets), training_cells(table, first_date, last_date, train_days, floor))
    fitted = rows.filter("error IS NULL").withColumn("_fit", _weights_udf(penalty, intercept, rounds)("cells.cell", "cells.n", "cells.pos"))
    fitted = fitted.select(*rows.columns, "_fit.weights", "_fit.seconds")
    return fitted.unionByName(rows.filter("error IS NOT NULL"), allowMissingColumns=True)


def logit_activity(table: DataFrame, first_date: str, last_date: str, **args) -> DataFrame:
    """household_id, date, hour_ts, y, p, error: the regression on the rows up to a date, for each hour of the next day. Without a fit p
    is NULL and error says why."""
    return test_rows(fits(table, first_date, last_date, **args))


def logit_sm_activity(table: DataFrame, first_date: str, last_date: str, **args) -> DataFrame:
    """The same without penalty and intercept, at most 35 steps."""
    return logit_activity(table, first_date, last_date, penalty=0.0, intercept=False, rounds=35, **args)


def test_rows(fitted: DataFrame) -> DataFrame:
    each = fitted.select(*KEYS, "error", "weights", F.inline("asked"))
    return each.select(*KEYS, "hour_ts", F.col("y").cast("int").alias("y"), F.expr(f"if(error IS NULL, {_score('cell')}, NULL)").alias("p"), "error")


def train_cells(fitted: DataFrame) -> DataFrame:
    """household_id, date, p, n_pos, n_neg: the training rows of each date by cell, scored by the date's model."""
    each = fitted.filter("error IS NULL").select(*KEYS, "weights", F.inline("cells"))
    return each.select(*KEYS, F.expr(_score("cell")).alias("p"), F.col("pos").alias("n_pos"), (F.col("n") - F.col("pos")).alias("n_neg"))


def all_cells(fitted: DataFrame, table: DataFrame) -> DataFrame:
    """The same for all rows of the household, whatever their date: each date's model meets the household's cells, at most 1,344."""
    counts = _rows(table).groupBy("household_id", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    whole = counts.groupBy("household_id").agg(F.collect_list(F.struct("cell", "n", "pos")).alias("cells"))
    return train_cells(fitted.drop("cells").join(whole, "household_id"))


def knn_activity(table: DataFrame, first_date: str, last_date: str, neighbours: int = 10) -> DataFrame:
    """The share of active hours among the nearest training hours; of equally far ones the latest count."""

    @F.pandas_udf("array<double>")
    def share(cell: pd.Series, y: pd.Series, asked: pd.Series) -> pd.Series:
        X = feature_rows()
        out = []
        for cells, flags, hours in zip(cell, y, asked):
            square = (X[cells] ** 2).sum(axis=1) - 2 * X[hours] @ X[cells].T
            # Whole numbers: the distance first (without the asked hour's own square, which all share), then the place.
            far = square.astype(np.int64) * len(cells) + np.arange(len(cells))
            near = np.argpartition(far, neighbours - 1, axis=1)[:, :neighbours]
            out.append(flags[near].mean(axis=1))
        return pd.Series(out)

    rows = _with_error(_asked(table, first_date, last_date), training_cells(table, first_date, last_date), neighbours).drop("cells")
    found = rows.join(recent_rows(table, first_date, last_date, neighbours), KEYS, "left")
    found = found.withColumn("recent", F.sort_array("recent", asc=False))
    usable = found.filter("error IS NULL").withColumn("p", share("recent.cell", "recent.y", "asked.cell")).drop("recent")
    both = usable.unionByName(found.filter("error IS NOT NULL").drop("recent"), allowMissingColumns=True)
    each = both.select(*KEYS, "error", "p", F.posexplode("asked").alias("_at", "_hour"))
    return each.select(*KEYS, "_hour.hour_ts", F.col("_hour.y").cast("int").alias("y"), F.get("p", F.col("_at")).alias("p"), "error")


def explain_activity(table: DataFrame, first_date: str, last_date: str, targets: DataFrame | None = None) -> DataFrame:
    """household_id, date, hour_ts, y, p, base_value, importance, seconds: exact Shapley values of the regression at the hours asked for.

    All coalitions of the ten features meet the training cells, weighted by their rows, in two small products. seconds is the time of the
    attribution and its share of the fit. Where no model can be fitted, y stays and the rest is NULL.
    """

    @F.pandas_udf(f"array<struct<p: double, base_value: double, importance: {IMPORTANCE}, seconds: double>>")
    def attribute(weights: pd.Series, cells: pd.Series, rows: pd.Series, asked: pd.Series) -> pd.Series:
        X = feature_rows()
        masks = (np.arange(2**N_FEATURES)[:, None] >> np.arange(N_FEATURES)) & 1
        size = masks.sum(axis=1)
        gain = np.array([*shapley_weights(N_FEATURES), 0.0])
        without = [np.flatnonzero(masks[:, i] == 0) for i in range(N_FEATURES)]
        out = []
        low, high, half = np.exp(-35), np.exp(35), N_FEATURES // 2
        for w, cell, n, hours in zip(weights, cells, rows, asked):
            # What the features outside a coalition add, for every training cell: odds against, which those inside multiply.
            begun = time.perf_counter()
            # The odds of a coalition are those of its first features times those of the others.
            terms = X[cell] * w[:-1]
            first = np.exp(-np.clip((1 - masks[: 2**half, :half]) @ terms[:, :half].T, -170, 170))
            others = np.exp(-np.clip((1 - masks[:: 2**half, half:]) @ terms[:, half:].T + w[-1], -170, 170))
            outside = (others[:, None, :] * first).reshape(len(masks), -1)
            most, least, odds = outside.max(), outside.min(), np.empty_like(outside)
            found, share = [], (time.perf_counter() - begun) / max(len(hours), 1)
            for h in hours:
                start = time.perf_counter() - share
                inside = np.exp(-np.clip(masks @ (X[h] * w[:-1]), -340, 340))
                np.multiply(outside, inside[:, None], out=odds)
                if most * inside.max() > high or least * inside.min() < low:
                    np.clip(odds, low, high, out=odds)
                odds += 1
                value = np.divide(1, odds, out=odds) @ (n / n.sum())
                phi = [float((gain[size[s]] * (value[s | (1 << i)] - value[s])).sum()) for i, s in enumerate(without)]
                items = [{"feature": f, "importance": v} for f, v in zip(ACTIVITY_FEATURES, phi)]
                found.append({"p": float(value[-1]), "base_value": float(value[0]), "importance": items, "seconds": time.perf_counter() - start})
            out.append(found)
        return pd.Series(out)

    rows = fits(table, first_date, last_date, targets)
    done = rows.filter("error IS NULL").withColumn("_e", attribute("weights", "cells.cell", "cells.n", "asked.cell"))
    both = done.unionByName(rows.filter("error IS NOT NULL"), allowMissingColumns=True)
    each = both.select(*KEYS, "_e", (F.col("seconds") / F.size("asked")).alias("_fit"), F.posexplode("asked").alias("_at", "_hour"))
    found = each.withColumn("_e", F.get("_e", F.col("_at")))
    seconds = (F.col("_e.seconds") + F.col("_fit")).alias("seconds")
    return found.select(*KEYS, "_hour.hour_ts", F.col("_hour.y").cast("int").alias("y"), "_e.p", "_e.base_value", "_e.importance", seconds)
