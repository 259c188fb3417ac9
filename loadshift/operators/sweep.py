"""Threshold search whose work does not follow the number of pairs.

What a (household, device, date) recommends changes only where the activity threshold passes one of the day's 24 probabilities, and is
dropped where the usage threshold passes the usage probability. Its results are thus at most 24 rectangles of the grid. Each sends its
values to the corner where it begins and takes them back where it ends; running sums over the grid then give every pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadshift.operators.backtest import PAIR, evaluate, summarise
from loadshift.operators.recommend import recommend
from loadshift.session import spread

#: Amounts are added as decimals, so that what is taken back cancels exactly. An amount beyond 16 digits before the point is an error.
AMOUNT = "decimal(28,12)"
SUMS = {
    "n_recommendations": "1L",
    "n_known": "if(acceptable IS NULL, 0L, 1L)",
    "n_relative": "if(relative_savings IS NULL, 0L, 1L)",
    "acceptable": f"cast(coalesce(acceptable, 0) AS {AMOUNT})",
    "savings": f"cast(coalesce(acceptable * savings, 0) AS {AMOUNT})",
    "relative": f"cast(coalesce(relative_savings, 0) AS {AMOUNT})",
}


def _array(values: list[float]) -> str:
    return f"array({', '.join(f'{v!r}D' for v in values)})"


def _sorted(values: list[float]) -> list[float]:
    if not values:
        raise ValueError("no thresholds")
    return sorted({float(v) for v in values})


def stretches(inputs: DataFrame, activity: list[float], usage: list[float]) -> DataFrame:
    """inputs plus `at`, `a_start`, `a_end`, `u_end`: the activity thresholds with places a_start to a_end - 1 give the result of the
    threshold `at`, for the first u_end usage thresholds. Each input row has one more row without `at`, which recommends nothing."""
    ends = f"""transform(array_sort(array_distinct(filter(probs, p -> p IS NOT NULL))),
        p -> named_struct('at', p, 'a_end', size(filter({_array(activity)}, t -> t <= p))))"""
    spans = """concat(filter(transform(coalesce(ends, array()), (e, i) -> named_struct('at', e.at,
        'a_start', if(i = 0, 0, coalesce(get(ends, i - 1).a_end, 0)), 'a_end', e.a_end)), s -> s.a_start < s.a_end AND u_end > 0),
        array(named_struct('at', CAST(NULL AS DOUBLE), 'a_start', 0, 'a_end', 0)))"""
    rows = inputs.select("*", F.expr(f"size(filter({_array(usage)}, t -> t <= usage_p)) AS u_end"), F.expr(f"{ends} AS ends"))
    return rows.select(*inputs.columns, "u_end", F.expr(f"inline({spans})"))


def corners(inputs: DataFrame, activity: list[float], usage: list[float]) -> DataFrame:
    """household_id, a, u (places of thresholds) and the sums that begin there; a pair's totals are those of all corners with a
    smaller or equal `a` and a larger or equal `u`. Every household has the corner (0, 0)."""
    results = evaluate(recommend(stretches(inputs, activity, usage), "at", "usage_p"), keep=("a_start", "a_end", "u_end"))
    corner = "named_struct('a', {}, 'u', {}, 'sign', {})"
    begin, end, none = corner.format("a_start", "u_end - 1", 1), corner.format("a_end", "u_end - 1", -1), corner.format(0, 0, 0)
    moves = f"""inline(if(recommendation IS NULL, array({none}), filter(array({begin}, {end}), c -> c.a < {len(activity)})))"""
    moved = results.select("household_id", "acceptable", "savings", "relative_savings", F.expr(moves))
    signed = {name: F.expr(f"CASE sign WHEN 1 THEN {v} WHEN -1 THEN -{v} ELSE 0 * {v} END") for name, v in SUMS.items()}
    return moved.groupBy("household_id", "a", "u").agg(*[F.sum(v).alias(name) for name, v in signed.items()])


def sweep(inputs: DataFrame, activity_thresholds: list[float], usage_thresholds: list[float]) -> DataFrame:
    """household_id, activity_threshold, usage_threshold, n_recommendations, acceptable, total_savings, relative_savings_mean of every
    pair: the columns of ``backtest.summarise`` but the median, which sums do not give.

    The rows that are shuffled follow the inputs and, once, the result; a household's grid is one window. Repeated thresholds count
    once. Rows without probabilities recommend nothing; a household whose rows all do has zeros. No inputs give no rows.
    """
    activity, usage = _sorted(activity_thresholds), _sorted(usage_thresholds)
    found = corners(inputs, activity, usage)
    zeros = ", ".join(f"'{name}', `{name}` - `{name}`" for name in SUMS)
    own = ", ".join(f"'{name}', `{name}`" for name in SUMS)
    # The corner (0, 0), there for each household, brings the whole grid along.
    grid = f"""flatten(transform(sequence(0, {len(activity) - 1}), a -> transform(sequence(0, {len(usage) - 1}),
        u -> named_struct('a', a, 'u', u, {zeros}))))"""
    itself = f"array(named_struct('a', a, 'u', u, {own}))"
    filled = found.select("household_id", F.expr(f"inline(if(a = 0 AND u = 0, concat({itself}, {grid}), {itself}))"))
    cells = spread(filled, ["household_id"]).groupBy("household_id", "a", "u").agg(*[F.sum(n).alias(n) for n in SUMS])
    upward = Window.partitionBy("household_id", "u").orderBy("a")
    downward = Window.partitionBy("household_id", "a").orderBy(F.col("u").desc())
    for order in (upward, downward):
        cells = cells.select("household_id", "a", "u", *[F.sum(n).over(order).alias(n) for n in SUMS])
    return cells.select(
        "household_id",
        F.expr(f"get({_array(activity)}, a) AS {PAIR[0]}"),
        F.expr(f"get({_array(usage)}, u) AS {PAIR[1]}"),
        "n_recommendations",
        F.expr("cast(acceptable AS double) / nullif(n_known, 0) AS acceptable"),
        F.expr("cast(savings AS double) AS total_savings"),
        F.expr("cast(relative AS double) / nullif(n_relative, 0) AS relative_savings_mean"),
    )


def summary_at(inputs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The whole summary, median included, of one pair (household_id, activity_threshold, usage_threshold) for each household."""
    return summarise(evaluate(recommend(inputs.join(pairs.select("household_id", *PAIR), "household_id"), *PAIR)))
