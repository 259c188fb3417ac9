"""Walk-forward models: one fit per household (and device) and date.

The unit of work is one household's feature rows, which are bounded by the clock (24 a day), so they are
shuffled once by key and all dates of the key are fitted in place: nothing is copied per date. Fits of one
task, of several households too, are solved together as far as ``FITTED_ROWS`` allows. Heavy
models can spread a key's dates over ``chunks`` tasks. A training set too large for one task goes
through ``fit_table``, which trains a distributed Spark ML model instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadshift.operators import learners
from loadshift.session import spread

DAY_DUMMIES = [f"day_name_{d}" for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Saturday", "Sunday")]
ACTIVITY_FEATURES = ["hour", *DAY_DUMMIES, "activity_lag_24", "activity_lag_48", "activity_lag_72"]
USAGE_FEATURES = ["usage_lag_1", "usage_lag_2", "active_last_2_days"]
LEAD_DAYS = 3
# Distinct training rows and rows to predict whose fits are solved together, so memory does not grow with the households of a task.
FITTED_ROWS = 16_384
NO_ROWS, ONE_CLASS, FEW_ROWS = "no training rows", "one class in the training rows", "fewer training rows than neighbours"


def train_mask(day, date, train_days=None, floor=None):
    """Training days of ``date``: from 3 days after the first row, or the last ``train_days`` days."""
    if train_days is None:
        start = day.min() + np.timedelta64(LEAD_DAYS, "D")
    else:
        start = date - np.timedelta64(train_days, "D")
        start = max(start, np.datetime64(floor, "D")) if floor else start
    return (day >= start) & (day <= date)


def _prepare(pdf, features, label, ts):
    pdf = pdf.sort_values(ts)
    day = pdf[ts].to_numpy().astype("datetime64[D]")
    X = pdf[features].to_numpy(dtype=float)
    return pdf, day, np.nan_to_num(X), pdf[label].fillna(0).to_numpy(dtype=float)


def _counts(cell, y, rows, n_cells):
    """Positives and rows per cell among the marked rows."""
    return np.bincount(cell[rows], y[rows], n_cells), np.bincount(cell[rows], minlength=n_cells).astype(float)


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, from batches of rows that lie together by key."""
    kept = None
    for batch in batches:
        rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        # NULL is a key, and not equal to itself in pandas.
        before = rows[keys].shift()
        ends = np.flatnonzero(((rows[keys] != before) & ~(rows[keys].isna() & before.isna())).any(axis=1).to_numpy()[1:]) + 1
        for start, end in zip([0, *ends], ends):
            yield rows.iloc[start:end]
        kept = rows.iloc[ends[-1] if len(ends) else 0 :]
    if kept is not None and len(kept):
        yield kept


def untrainable(y, model_type, args) -> str | None:
    """Why no model can be fitted to these labels, or None."""
    if not len(y):
        return NO_ROWS
    if len(np.unique(y)) < 2:
        return ONE_CLASS
    return FEW_ROWS if model_type == "knn" and len(y) < args.get("n_neighbors", 10) else None


def walk_forward(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    label: str,
    ts: str,
    model_type: str,
    first_date: str,
    last_date: str,
    scope: str = "test",
    train_days: int | None = None,
    floor: str | None = None,
    chunks: int = 1,
    **args,
) -> DataFrame:
    """Fit on the days up to each date and score.

    scope 'test': one row per row of the day after the date (keys, date, ts, y, p, error); where no fit is possible, p is NULL and error
    says why.
    scope 'train' / 'all': score cells (keys, date, p, n_pos, n_neg) of the training rows / of all rows.
    There, dates whose training set has a single class, or too few rows, have no score and no rows.
    """
    if model_type not in learners.LEARNERS:
        raise ValueError(f"unknown model type {model_type!r}")
    dates = np.arange(np.datetime64(first_date, "D"), np.datetime64(last_date, "D") + 1)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    head = ", ".join(f"`{k}` {fields[k]}" for k in keys)
    tail = f"`{ts}` {fields[ts]}, y int, p double, error string" if scope == "test" else "p double, n_pos bigint, n_neg bigint"
    columns = [*keys, "date", ts, "y", "p", "error"] if scope == "test" else [*keys, "date", "p", "n_pos", "n_neg"]

    def one_group(pdf: pd.DataFrame) -> Iterator[tuple[dict, tuple | None, np.ndarray | None]]:
        """For each date its rows, what to fit and the rows to predict; where no fit is possible, only its rows."""
        chunk = int(pdf["_chunk"].iloc[0])
        key = {k: pdf[k].iloc[0] for k in keys}
        pdf, day, X, y = _prepare(pdf, features, label, ts)
        cells, at = learners.merge_rows(X, model_type)
        for date in dates[chunk::chunks]:
            train, test = train_mask(day, date, train_days, floor), day == date + 1
            if not test.any():
                continue
            part = key | {"date": date.item()}
            if scope == "test":
                part |= {ts: pdf.loc[test, ts].to_numpy(), "y": y[test].astype("int32")}
            error = untrainable(y[train], model_type, args)
            if error:
                if scope == "test":
                    yield part | {"p": np.nan, "error": error}, None, None
                continue
            pos, n = _counts(at, y, train, len(cells))
            seen = n > 0
            fit = cells[seen], pos[seen], (n - pos)[seen]
            if scope == "test":
                yield part | {"error": None}, fit, X[test]
            else:
                if scope == "all":
                    pos, n = _counts(at, y, np.ones(len(y), dtype=bool), len(cells))
                used = n > 0
                yield part | {"n_pos": pos[used].astype("int64"), "n_neg": (n - pos)[used].astype("int64")}, fit, cells[used]

    def predicted(waiting: list) -> pd.DataFrame:
        scores = learners.fit_many([fit for _, fit, _ in waiting if fit], model_type, **args)
        parts = [pd.DataFrame(part | {"p": next(scores)(asked)} if fit else part) for part, fit, asked in waiting]
        return pd.concat(parts)[columns]

    def all_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size = [], 0
        for pdf in _runs(batches, [*keys, "_chunk"]):
            for part, fit, asked in one_group(pdf):
                more = len(fit[0]) + len(asked) if fit else len(part[ts])
                if waiting and size + more > FITTED_ROWS:
                    yield predicted(waiting)
                    waiting, size = [], 0
                waiting.append((part, fit, asked))
                size += more
        if waiting:
            yield predicted(waiting)

    chunk = F.explode(F.array(*[F.lit(i) for i in range(chunks)])).alias("_chunk")
    needed = spread(df.select(*keys, ts, *features, label, chunk), [*keys, "_chunk"])
    out = needed.sortWithinPartitions(*keys, "_chunk").mapInPandas(all_groups, f"{head}, date date, {tail}")
    # pandas has no NULL among numbers.
    return out.withColumn("p", F.when(~F.isnan("p"), F.col("p"))) if scope == "test" else out


def activity_walk_forward(table: DataFrame, model_type: str, first_date: str, last_date: str, **kw) -> DataFrame:
    names = kw.pop("features", ACTIVITY_FEATURES)
    return walk_forward(
        table, ["household_id"], names, "activity", "hour_ts", model_type, first_date, last_date, **kw
    )


def usage_walk_forward(table: DataFrame, model_type: str, first_date: str, last_date: str, **kw) -> DataFrame:
    names = kw.pop("features", USAGE_FEATURES)
    return walk_forward(
        table, ["household_id", "device"], names, "usage", "day", model_type, first_date, last_date, **kw
    )


def usage_split(df: DataFrame, date: str, train_start: str = "") -> tuple[DataFrame, DataFrame]:
    """Training rows [start, date] and the test row of the next day, reduced to the model's columns."""
    cols = df.select("household_id", "device", "day", "usage", *USAGE_FEATURES)
    if train_start:
        start = F.lit(train_start).cast("date")
    else:
        start = F.date_add(F.min("day").over(Window.partitionBy("household_id", "device")), LEAD_DAYS)
    end = F.lit(date).cast("date")
    marked = cols.withColumn("_start", start)
    train = marked.filter((F.col("day") >= F.col("_start")) & (F.col("day") <= end)).drop("_start")
    return train, cols.filter(F.col("day") == F.date_add(end, 1))


def activity_split(
    df: DataFrame, date: str, train_start: int | str = -30, test_days: int | None = 1, floor: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training hours [start, end of date] and the test hours from the next day on; NULL features become 0.

    ``train_start``: days relative to the date (never before ``floor``), a date, or '' for 3 days after
    the first row. ``test_days`` None keeps everything after the date.
    """
    end = F.date_add(F.lit(date).cast("date"), 1).cast("timestamp")
    filled = df.na.fill(0, [c for c in df.columns if c not in ("household_id", "hour_ts")])
    if isinstance(train_start, int):
        start = F.date_add(F.lit(date).cast("date"), train_start)
        start = F.greatest(start, F.lit(floor).cast("date")) if floor else start
    elif train_start:
        start = F.lit(train_start).cast("date")
    else:
        start = F.date_add(F.to_date(F.min("hour_ts").over(Window.partitionBy("household_id"))), LEAD_DAYS)
    marked = filled.withColumn("_start", start.cast("timestamp"))
    train = marked.filter((F.col("hour_ts") >= F.col("_start")) & (F.col("hour_ts") < end)).drop("_start")
    test = filled.filter(F.col("hour_ts") >= end)
    if test_days is not None:
        test = test.filter(F.col("hour_ts") < end + F.make_dt_interval(F.lit(test_days)))
    return train, test


def estimator(model_type: str, n_rows: int, features: list[str], label: str) -> Pipeline:
    """The distributed Spark ML counterpart of a model name, for one large training table."""
    columns = {"featuresCol": "features", "labelCol": label}
    if model_type == "ebm":
        hot = OneHotEncoder(inputCols=features, outputCols=[f"{f}_hot" for f in features], handleInvalid="keep")
        stages = [hot, VectorAssembler(inputCols=hot.getOutputCols(), outputCol="features")]
    else:
        stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")]
    # sklearn's C = 1 penalises the summed loss, Spark's regParam the mean one.
    ridge = {"regParam": 1.0 / max(n_rows, 1), "elasticNetParam": 0.0, "standardization": False, "tol": 1e-9}
    models = {
        "logit": lambda: LogisticRegression(**columns, **ridge),
        "ebm": lambda: LogisticRegression(**columns, **ridge),
        "logit_sm": lambda: LogisticRegression(**columns, regParam=0.0, fitIntercept=False, standardization=False),
        "random forest": lambda: RandomForestClassifier(
            **columns, numTrees=500, maxDepth=10, featureSubsetStrategy="sqrt", seed=0
        ),
        "xgboost": lambda: GBTClassifier(**columns, stepSize=0.1, maxDepth=6, maxIter=100, seed=0),
    }
    if model_type not in models:
        raise ValueError(f"no distributed model for {model_type!r}")
    return Pipeline(stages=[*stages, models[model_type]()])


def fit_table(train: DataFrame, features: list[str], label: str, model_type: str) -> PipelineModel:
    data = train.select(*features, F.col(label).cast("double").alias(label))
    return estimator(model_type, data.count() if "logit" in model_type or model_type == "ebm" else 1, features, label).fit(data)


def predict_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add p = P(class 1)."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("p"))
