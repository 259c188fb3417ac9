"""Feature attributions and the sentences built from them."""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.operators import learners
from loadshift.operators.models import USAGE_FEATURES, _prepare, spread, train_mask, untrainable

IMPORTANCE = "array<struct<feature:string,importance:double>>"
# Labels of the weather columns in sentences.
WEATHER_LABELS = {
    "dwpt": "dewing point",
    "rhum": "relative humidity",
    "temp": "temperature",
    "wdir": "wind direction",
    "wspd": "windspeed",
}


def shapley_weights(n: int) -> list[float]:
    """Weight of a coalition of size s when one more of n features joins it."""
    return [factorial(s) * factorial(n - s - 1) / factorial(n) for s in range(n)]


# cell models: everything in Column expressions ----------------------------------------------------


def usage_shapley(rated: DataFrame) -> DataFrame:
    """Exact Shapley values of the three usage features for tomorrow's row, from n[8] and rate[8].

    A cell number is its three feature bits, so the row mixed from the explained cell x and a background
    cell b under a coalition is (x AND mask) OR (b AND NOT mask): no rows are exploded.
    """
    def coalition(mask: int) -> str:
        terms = [f"get(n, {b}) * get(rate, (next_cell & {mask}) + {b & ~mask & 7})" for b in range(8)]
        return f"({' + '.join(terms)}) / total"

    bits = dict(zip(USAGE_FEATURES, (4, 2, 1)))
    weights = shapley_weights(3)

    def contribution(bit: int) -> str:
        without = [m for m in range(8) if not m & bit]
        return " + ".join(f"(get(v, {m | bit}) - get(v, {m})) * {weights[bin(m).count('1')]!r}D" for m in without)

    ready = rated.filter("target_date IS NOT NULL").selectExpr("*", "aggregate(n, 0L, (acc, x) -> acc + x) AS total")
    valued = ready.filter("total > 0").selectExpr("*", f"array({', '.join(coalition(m) for m in range(8))}) AS v")
    items = [f"named_struct('feature', '{name}', 'importance', {contribution(bit)})" for name, bit in bits.items()]
    return valued.selectExpr(
        "household_id",
        "device",
        "date",
        "target_date",
        "next_cell",
        "y",
        "get(rate, next_cell) AS p",
        "get(v, 0) AS base_value",
        f"array({', '.join(items)}) AS importance",
    )


def reconstruct(explained: DataFrame) -> DataFrame:
    """shap = base value + sum of the contributions; equals the model's prediction."""
    return explained.withColumn(
        "shap", F.expr("base_value + aggregate(importance, 0D, (acc, s) -> acc + s.importance)")
    )


def sorted_importance(importance: Column | str) -> Column:
    """Descending by importance, feature name on ties."""
    items = F.transform(
        importance, lambda s: F.struct((-s["importance"]).alias("k"), s["feature"].alias("feature"), s["importance"].alias("importance"))
    )
    return F.transform(F.array_sort(items), lambda s: F.struct(s["feature"].alias("feature"), s["importance"].alias("importance")))


# any model: grouped by household ------------------------------------------------------------------


def explain(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    label: str,
    ts: str,
    model_type: str,
    first_date: str,
    last_date: str,
    targets: DataFrame | None = None,
    lime_samples: int = 5000,
    seed: int = 0,
    **args,
) -> DataFrame:
    """Fit per date and explain rows of the day after: y, p, base_value, importance and the LIME value, all NULL where no fit is possible.

    Shapley values enumerate all coalitions of the features against all training rows. ``targets``
    (keys + ts) limits the explained rows, e.g. to the recommended hours. The group is one household's
    hours; Spark spreads the households.
    """
    dates = np.arange(np.datetime64(first_date, "D"), np.datetime64(last_date, "D") + 1)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    head = ", ".join(f"`{k}` {fields[k]}" for k in keys)
    columns = [*keys, "date", ts, "y", "p", "base_value", "importance", "lime"]
    schema = f"{head}, date date, `{ts}` {fields[ts]}, y int, p double, base_value double, importance {IMPORTANCE}, lime double"
    n = len(features)
    masks = (np.arange(2**n)[:, None] >> np.arange(n)) & 1 == 1
    size = masks.sum(axis=1)
    weights = np.array([*shapley_weights(n), 0.0])

    def shapley(score, x, background, share):
        mixed = np.where(masks[:, None, :], x, background[None, :, :]).reshape(-1, n)
        value = score(mixed).reshape(len(masks), -1) @ share
        phi = np.empty(n)
        for i in range(n):
            without = np.flatnonzero(~masks[:, i])
            phi[i] = (weights[size[without]] * (value[without | (1 << i)] - value[without])).sum()
        return value[0], phi

    def lime(score, x, X, rng):
        known = [np.unique(X[:, j], return_inverse=True) for j in range(n)]
        drawn = [rng.choice(place, lime_samples)[1:] for _, place in known]
        count, shape = np.ones(lime_samples), [len(v) for v, _ in known]
        if np.prod(shape, dtype=float) <= lime_samples:
            # Few values: equal samples are one row with their number.
            number = np.bincount(np.ravel_multi_index(drawn, shape))
            drawn = np.unravel_index(np.flatnonzero(number), shape)
            count = np.append(1.0, number[number > 0])
        sample = np.vstack([x, np.column_stack([v[at] for (v, _), at in zip(known, drawn)])])
        same = (sample == x).astype(float)
        kernel = count * np.exp(-(n - same.sum(axis=1)) / (0.75**2 * n)) ** 0.5
        A = np.hstack([same, np.ones((len(sample), 1))])
        ridge = np.diag([1.0] * n + [0.0])
        return np.linalg.solve((A * kernel[:, None]).T @ A + ridge, (A * kernel[:, None]).T @ score(sample)).sum()

    def one_group(pdf: pd.DataFrame) -> pd.DataFrame:
        key = [pdf[k].iloc[0] for k in keys]
        pdf, day, X, y = _prepare(pdf, features, label, ts)
        wanted = pdf["_explain"].to_numpy(dtype=bool)
        times = pdf[ts].to_numpy()
        rng = np.random.default_rng(seed)
        out = []
        for date in dates:
            train, test = train_mask(day, date), (day == date + 1) & wanted
            if not test.any():
                continue
            if untrainable(y[train], model_type, args):
                out += [[*key, date.item(), times[i], int(y[i]), None, None, None, None] for i in np.flatnonzero(test)]
                continue
            T = X[train]
            score = learners.fit(T, y[train], 1 - y[train], model_type, **args)
            # Every training row is background; equal rows are one cell with their number.
            cells, count = np.unique(T, axis=0, return_counts=True)
            for i in np.flatnonzero(test):
                base, phi = shapley(score, X[i], cells, count / count.sum())
                near = lime(score, X[i], T, rng) if lime_samples else None
                items = [{"feature": f, "importance": float(v)} for f, v in zip(features, phi)]
                p = float(score(X[i : i + 1])[0])
                out.append([*key, date.item(), times[i], int(y[i]), p, float(base), items, near])
        return pd.DataFrame(out, columns=columns)

    flagged = df.select(*keys, ts, *features, label)
    if targets is None:
        flagged = flagged.withColumn("_explain", F.lit(True))
    else:
        marks = targets.select(*keys, ts).distinct().withColumn("_explain", F.lit(True))
        flagged = flagged.join(marks, [*keys, ts], "left").withColumn("_explain", F.coalesce("_explain", F.lit(False)))
    return spread(flagged, keys).groupBy(*keys).applyInPandas(one_group, schema)


# sentences ----------------------------------------------------------------------------------------
# The texts are fixed values, spelling included.


def _value_of(importance: str, feature: str) -> Column:
    return F.expr(f"get(filter({importance}, s -> s.feature = '{feature}'), 0).importance")


def weather_clause(importance: str, values: dict[str, Column]) -> Column:
    """The one or two weather columns that speak most for the prediction."""
    items = F.array(
        *[
            F.struct(
                (-_value_of(importance, name)).alias("k"),
                F.lit(i).alias("i"),
                F.concat(F.lit(WEATHER_LABELS[name] + ":"), F.round(values[name], 2).cast("string")).alias("text"),
            )
            for i, name in enumerate(WEATHER_LABELS)
        ]
    )
    top = F.slice(F.array_sort(items), 1, 2)
    one = F.concat(F.lit("The weather condition ("), top[0]["text"], F.lit(") support that recommendation."))
    two = F.concat(
        F.lit("The weather conditions ("), top[0]["text"], F.lit(", "), top[1]["text"], F.lit(") support that recommendation.")
    )
    return F.when(top[1]["k"] <= 0, two).when(top[0]["k"] <= 0, one).otherwise("")


def activity_sentence(
    importance: str, lags: list[Column], weather: dict[str, Column] | None = None, compat: bool = False
) -> Column:
    """Why the resident is expected to be active.

    lags: activity 24, 48 and 72 hours before the explained hour. With ``compat`` the word "not" needs
    lags 24 and 48 set and 72 unset, and the weekday clause follows the last day of the list alone.
    """
    lag24, lag48, lag72 = [_value_of(importance, f"activity_lag_{k}") for k in (24, 48, 72)]
    if compat:
        inactive = (lags[0] != 0) & (lags[1] != 0) & (lags[2] == 0)
    else:
        inactive = (lags[0] == 0) & (lags[1] == 0) & (lags[2] == 0)
    strongest = F.greatest(lag24, lag48, lag72)
    period = F.when(lag24 == strongest, "day").when(lag48 == strongest, "two days").otherwise("three days")
    part1 = F.when(
        strongest >= 0,
        F.concat(
            F.lit("We believe you are active today since you were "),
            F.when(inactive, "not ").otherwise(""),
            F.lit("active during the last "),
            period,
            F.lit("."),
        ),
    ).otherwise("")
    days = ["Sunday"] if compat else ["Monday", "Tuesday", "Wednesday", "Thursday", "Saturday", "Sunday"]
    weekday = F.greatest(*[_value_of(importance, f"day_name_{d}") for d in days], F.lit(float("-inf"))) >= 0
    hour = _value_of(importance, "hour") >= 0
    part3 = (
        F.when(weekday & hour, "The weekday and hour strenghtens that prediction.")
        .when(weekday, "The weekday strenghtens that prediction.")
        .when(hour, "The hour strenghtens that prediction.")
        .otherwise("")
    )
    part2 = weather_clause(importance, weather) if weather else F.lit("")
    start = F.lit("We based the recommendation on your past activity and usage of the device. ")
    return F.concat(start, part1, part2, part3)


def usage_sentence(
    importance: str, active_last_2_days: Column, weather: dict[str, Column] | None = None, compat: bool = False
) -> Column:
    """Why the device is expected to be used."""
    lag1, lag2 = _value_of(importance, "usage_lag_1"), _value_of(importance, "usage_lag_2")
    word = F.when(active_last_2_days == 0, "not" if compat else "not ").otherwise("")
    period = F.when(lag1 >= lag2, "day").otherwise("two days")
    part1 = F.when(
        (lag1 >= 0) | (lag2 >= 0), F.concat(F.lit(" and have used the device in the last "), period)
    ).otherwise("")
    start = F.concat(
        F.lit("We believe you are likely to use the device in the near future since you were "),
        word,
        F.lit("active during the last 2 days"),
    )
    part2 = weather_clause(importance, weather) if weather else F.lit("")
    return F.concat(start, part1, F.lit("."), part2)
