"""Scores of predictions and profiles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadshift.functions.expressions import safe_name
from loadshift.functions.metrics import array_metric, mse
from loadshift.operators.runs import profiles_by_date, run_vectors
from loadshift.session import spread


def auc_from_counts(cells: DataFrame, keys: list[str], score: str = "p") -> DataFrame:
    """ROC AUC per key from (score, n_pos, n_neg) rows; ties count half; NULL for a single class.

    Rows of equal score are merged before the window, which then sees one row per distinct score.
    """
    merged = (
        cells.filter(F.col(score).isNotNull())
        .groupBy(*keys, score)
        .agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))
    )
    below = Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = merged.withColumn("_below", F.coalesce(F.sum("n_neg").over(below), F.lit(0)))
    wins = F.sum(F.col("n_pos") * (F.col("_below") + F.col("n_neg") / 2))
    pos, neg = F.sum("n_pos"), F.sum("n_neg")
    return ranked.groupBy(*keys).agg(
        F.when((pos > 0) & (neg > 0), wins / (pos * neg)).alias("auc"),
        (pos + neg).cast("bigint").alias("n"),
    )


@dataclass(frozen=True)
class CellMetric:
    """A score function of a user, as a mergeable aggregate over weighted cells (p, n_pos, n_neg): each of ``sums`` starts at zero, adds
    up over cells and merges by addition, wherever the cells lie; ``finish`` turns the sums into the score."""

    sums: dict[str, Callable[[Column, Column, Column], Column]]
    finish: Callable[[dict[str, Column]], Column]

    def over(self, cells: DataFrame, keys: list[str], score: str = "p") -> DataFrame:
        """keys, auc (the score, by the name that built-in scores have) and n per key; cells without a prediction are left out."""
        seen = cells.filter(F.col(score).isNotNull())
        parts = [F.coalesce(F.sum(f(F.col(score), F.col("n_pos"), F.col("n_neg"))), F.lit(0.0)).alias(f"_{name}") for name, f in self.sums.items()]
        summed = seen.groupBy(*keys).agg(*parts, F.sum(F.col("n_pos") + F.col("n_neg")).cast("bigint").alias("n"))
        return summed.select(*keys, self.finish({name: F.col(f"_{name}") for name in self.sums}).alias("auc"), "n")


def brier() -> CellMetric:
    """Mean squared distance of predictions and outcomes."""
    gap = {"gap": lambda p, pos, neg: pos * (1 - p) * (1 - p) + neg * p * p, "n": lambda p, pos, neg: pos + neg}
    return CellMetric(gap, lambda s: F.when(s["n"] > 0, s["gap"] / s["n"]))


def cell_score(cells: DataFrame, keys: list[str], metric: CellMetric | None = None) -> DataFrame:
    """keys, auc, n: ROC AUC, or a user's metric, of weighted cells."""
    return auc_from_counts(cells, keys) if metric is None else metric.over(cells, keys)


def auc(rows: DataFrame, keys: list[str], y: str = "y", score: str = "p") -> DataFrame:
    counted = rows.filter(F.col(y).isNotNull()).select(
        *keys, score, F.col(y).cast("bigint").alias("n_pos"), (1 - F.col(y)).cast("bigint").alias("n_neg")
    )
    return auc_from_counts(counted, keys, score)


def walk_forward_auc(
    test: DataFrame, train_cells: DataFrame, keys: list[str], start: str, end: str, inclusive: bool = True, metric: CellMetric | None = None
) -> DataFrame:
    """Mean train AUC, or ``metric``, over the dates and one pooled test AUC per key; dates in [start, end] or (start, end)."""

    def within(df: DataFrame) -> DataFrame:
        d, lo, hi = F.col("date"), F.lit(start).cast("date"), F.lit(end).cast("date")
        return df.filter(d.between(lo, hi) if inclusive else (d > lo) & (d < hi))

    per_date = cell_score(within(train_cells), [*keys, "date"], metric)
    train = per_date.groupBy(*keys).agg(F.avg("auc").alias("auc_train"), F.count("auc").alias("n_dates"))
    tested = within(test).filter("y IS NOT NULL").select(*keys, "p", F.col("y").cast("bigint").alias("n_pos"), (1 - F.col("y")).cast("bigint").alias("n_neg"))
    pooled = cell_score(tested, keys, metric).select(*keys, F.col("auc").alias("auc_test"), F.col("n").alias("n_test"))
    return train.join(pooled, keys, "full_outer")


def load_errors(load: DataFrame, profile_input: DataFrame, metric: str | Callable = "mse") -> DataFrame:
    """Per run: the metric of its 24 loads against the profile known on the day it started (zeros if none).

    ``load`` holds all hours (the truth); ``profile_input`` the same hours without an incomplete first day.
    """
    keys = ["household_id", "device", "date"]
    truth = spread(run_vectors(load).withColumn("date", F.to_date("run_start")), keys)
    profiles = profiles_by_date(profile_input).select(
        "household_id", "device", "date", F.col("load").alias("profile")
    )
    zeros = F.array_repeat(F.lit(0.0), 24)
    joined = truth.join(spread(profiles, keys), keys, "left")
    error = array_metric(metric)(F.col("load"), F.coalesce("profile", zeros))
    return joined.select("household_id", "device", "run_start", error.alias("error"))


def load_score(errors: DataFrame) -> DataFrame:
    return errors.groupBy("household_id", "device").agg(F.avg("error").alias("error"), F.count("error").alias("n_runs"))


def agent_scores(activity: DataFrame, usage: DataFrame, load: DataFrame) -> DataFrame:
    """household_id, agent, device, score: one AUC for activity, an AUC and an error per device."""
    return (
        activity.select("household_id", F.lit("activity_auc").alias("agent"), F.lit("-").alias("device"), F.col("auc").alias("score"))
        .unionByName(usage.select("household_id", F.lit("usage_auc").alias("agent"), "device", F.col("auc").alias("score")))
        .unionByName(load.select("household_id", F.lit("load_mse").alias("agent"), "device", F.col("error").alias("score")))
    )


def scores_by_position(scores: DataFrame, devices: list[str]) -> DataFrame:
    """Household x (score, device position) table; the device list is the configured order."""
    names = ["activity_auc"] + [f"{s}_{i}" for s in ("usage_auc", "load_mse") for i in range(len(devices))]
    position = F.array_position(F.array(*[F.lit(d) for d in devices]), F.col("device")) - 1
    column = F.when(F.col("device") == "-", F.col("agent")).otherwise(
        F.concat_ws("_", "agent", position.cast("string"))
    )
    return scores.withColumn("_column", column).groupBy("household_id").pivot("_column", names).agg(F.first("score"))


# cold start ---------------------------------------------------------------------------------------


def activity_cold_start(rates: DataFrame, last: str, metric: CellMetric | None = None) -> DataFrame:
    """AUC, or ``metric``, per household and date of that date's model on all rows from the training start to ``last``.

    Every date's model is scored on 24 cells weighted by how often they were active and inactive.
    """
    end = F.lit(last).cast("date")
    w = Window.partitionBy("household_id", "hour")
    in_range = (F.col("date") >= F.col("start_date")) & (F.col("date") <= end)
    weighted = rates.withColumn("n_pos", F.sum(F.when(in_range, F.col("truth"))).over(w)).withColumn(
        "n_neg", F.sum(F.when(in_range, 1 - F.col("truth"))).over(w)
    )
    scored = weighted.filter((F.col("date") >= F.col("start_date")) & (F.col("date") < end)).select("household_id", "date", "p", "n_pos", "n_neg")
    return cell_score(spread(scored, ["household_id", "date"]), ["household_id", "date"], metric).select(
        "household_id", F.lit("activity").alias("agent"), "date", F.col("auc").alias("score")
    )


def usage_cold_start(rated: DataFrame, last: str, metric: CellMetric | None = None) -> DataFrame:
    """AUC, or ``metric``, per household, device and date over the 8 feature cells, weighted by all trained rows up to ``last``."""
    end = F.lit(last).cast("date")
    whole = Window.partitionBy("household_id", "device")
    final = F.max_by(F.struct("n", "pos"), F.when(F.col("date") <= end, F.col("date"))).over(whole)
    trained = rated.withColumn("_all", final).filter(F.col("date") < end).filter("exists(n, x -> x > 0)")
    cells = "inline(arrays_zip(rate, _all.pos, zip_with(_all.n, _all.pos, (a, b) -> a - b))) AS (p, n_pos, n_neg)"
    seen = trained.selectExpr("household_id", "device", "date", cells).filter("n_pos + n_neg > 0")
    return cell_score(spread(seen, ["household_id", "device", "date"]), ["household_id", "device", "date"], metric).select(
        "household_id",
        F.concat(F.lit("usage_"), safe_name("device")).alias("agent"),
        "date",
        F.col("auc").alias("score"),
    )


def load_cold_start(profiles: DataFrame, last: str, metric: Callable[[Column, Column], Column] = mse) -> DataFrame:
    """Error per household, device and date of that date's profile against the last profile."""
    whole = Window.partitionBy("household_id", "device")
    upto = profiles.filter(F.col("date") <= F.lit(last).cast("date"))
    with_last = upto.withColumn("_last", F.max_by("load", "date").over(whole))
    return with_last.select(
        "household_id",
        F.concat(F.lit("load_"), safe_name("device")).alias("agent"),
        "date",
        metric(F.col("_last"), F.col("load")).alias("score"),
    )


def agent_names(devices: list[str]) -> list[str]:
    safe = [d.replace(".", "_").replace("(", "").replace(")", "").lower() for d in devices]
    return ["activity"] + [f"usage_{d}" for d in safe] + [f"load_{d}" for d in safe]


def cold_start_table(scores: DataFrame, agents: list[str]) -> DataFrame:
    """(household, date) x agent, ordered columns: activity, usage_*, load_*."""
    return scores.groupBy("household_id", "date").pivot("agent", agents).agg(F.first("score"))


def cold_start_days(table: DataFrame, agents: list[str], tolerances: list[float]) -> DataFrame:
    """household_id, tolerance, agent, days: the first day from which all later scores are good enough.

    activity and usage must exceed max * (1 - tolerance), load must stay below the tolerance; a missing
    score is not good enough; never means one day more than there are. 'framework' is the slowest agent.
    """
    w = Window.partitionBy("household_id").orderBy("date")
    long = table.withColumn("_day", F.row_number().over(w)).unpivot(
        ["household_id", "_day"], agents, "agent", "score"
    )
    best = long.withColumn("_best", F.max("score").over(Window.partitionBy("household_id", "agent")))
    tried = best.withColumn("tolerance", F.explode(F.array(*[F.lit(float(t)) for t in tolerances])))
    limit = F.col("_best") * (1 - F.col("tolerance"))
    good = F.when(F.startswith("agent", F.lit("load")), F.col("score") < F.col("tolerance")).otherwise(
        F.col("score") > limit
    )
    bad_day = F.when(~F.coalesce(good, F.lit(False)), F.col("_day"))
    days = tried.groupBy("household_id", "tolerance", "agent").agg(
        (F.coalesce(F.max(bad_day), F.lit(0)) + 1).cast("int").alias("days")
    )
    # The slowest agent joins the others in their row, at most one entry an agent: a second branch would score everything twice.
    each = days.groupBy("household_id", "tolerance").agg(F.collect_list(F.struct("agent", "days")).alias("_each"), F.max("days").alias("_slowest"))
    return each.selectExpr("household_id", "tolerance", "inline(concat(_each, array(struct('framework' AS agent, _slowest AS days))))").select(*days.columns[:2], "agent", "days")


def cold_start_summary(days: DataFrame, devices: list[str]) -> DataFrame:
    """(household, tolerance) x agent and device position."""
    safe = [d.replace(".", "_").replace("(", "").replace(")", "").lower() for d in devices]
    agents = agent_names(devices) + ["framework"]
    wide = days.groupBy("household_id", "tolerance").pivot("agent", agents).agg(F.first("days"))
    names = {f"{a}_{d}": f"{a}_{i}" for a in ("usage", "load") for i, d in enumerate(safe)}
    return wide.withColumnsRenamed(names)


# explanation quality ------------------------------------------------------------------------------


def xai_metrics(rows: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """Per key, for the explainers 'lime' and 'shap': AUC against the truth, AUC of the binarised values
    against the binarised predictions, and the mean absolute difference to the predictions.

    rows: keys, y, p, lime, shap.
    """

    def flag(c: str) -> Column:
        return (F.col(c) > threshold).cast("bigint")

    blocks = []
    for name in ("lime", "shap"):
        truth = auc(rows, keys, "y", name).select(*keys, F.col("auc").alias(f"{name}_auc_true"))
        binary = rows.select(*keys, flag("p").alias("_p"), flag(name).alias("_x"))
        pred = auc(binary, keys, "_p", "_x").select(*keys, F.col("auc").alias(f"{name}_auc_pred"))
        mae = rows.groupBy(*keys).agg(F.avg(F.abs(F.col("p") - F.col(name))).alias(f"{name}_mae"))
        blocks += [truth, pred, mae]
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), blocks)
