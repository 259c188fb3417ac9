"""The stage store, the hourly base, dates that follow the data, candidates without number, and the size of plans."""

import os
import re

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import TABLES, compare, connect
from loadshift import fixtures as fx
from loadshift.catalog.features import CONFIG, prepared
from loadshift.operators import features, hourly
from loadshift.plans import stages
from loadshift.session import scratch_dir
from loadshift.sources import store

ROW = "household_id int, x double"
DATED = "household_id int, date date, x double"


def table(spark, rows, schema=ROW):
    return spark.createDataFrame(rows, schema)


def content(spark, path, household=None, columns=("activity_model", "household_id", "x")):
    rows = store.load(spark, path, ["output"], household)["output"].select(*columns).collect()
    return sorted(map(tuple, rows), key=str)


def test_runs_keep_other_models_and_households(spark):
    path = scratch_dir(spark)
    one = table(spark, [(1, 1.0), (2, 2.0)])
    store.dump(path, {"output": one}, "knn", "rate", False)
    store.dump(path, {"output": one}, "logit", "rate", False)
    store.dump(path, {"output": table(spark, [(3, 3.0)])}, "knn", "rate", False)
    assert content(spark, path) == [("knn", 1, 1.0), ("knn", 2, 2.0), ("knn", 3, 3.0), ("logit", 1, 1.0), ("logit", 2, 2.0)]


def test_households_of_one_bucket_keep_each_other(spark):
    path = scratch_dir(spark)
    number = {r.h: r.b for r in spark.range(2000).select(F.col("id").cast("int").alias("h")).select("h", store.bucket("h").alias("b")).collect()}
    a, b = next((x, y) for x in number for y in number if x < y and number[x] == number[y])
    for h in (a, b):
        store.dump(path, {"output": table(spark, [(h, float(h))])}, "knn", "rate", False)
    assert content(spark, path) == sorted([("knn", a, float(a)), ("knn", b, float(b))], key=str)
    assert content(spark, path, b) == [("knn", b, float(b))]


def test_newest_run_wins_by_household_and_date(spark):
    path = scratch_dir(spark)
    days = [F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-02")]

    def rows(*triples):
        flat = table(spark, [(h, d, x) for h, d, x in triples], "household_id int, d int, x double")
        return flat.select("household_id", F.when(F.col("d") == 1, days[0]).otherwise(days[1]).alias("date"), "x")

    store.dump(path, {"output": rows((1, 1, 1.0), (1, 1, 2.0), (1, 2, 3.0), (2, 1, 4.0))}, "knn", "rate", False)
    store.dump(path, {"output": rows((1, 1, 9.0)).withColumn("extra", F.lit("e"))}, "knn", "rate", False)
    got = content(spark, path, columns=("household_id", "date", "x", "extra"))
    assert [(h, str(d), x, e) for h, d, x, e in got] == [(1, "2024-01-01", 9.0, "e"), (1, "2024-01-02", 3.0, None), (2, "2024-01-01", 4.0, None)]
    before = content(spark, path)
    store.compact(spark, path, "output")
    assert content(spark, path) == before and len(store.runs(spark, path)) == 3


def test_a_write_that_fails_changes_nothing(spark):
    path = scratch_dir(spark)
    assert store.runs(spark, path) == []
    with pytest.raises(ValueError, match="no run"):
        store.load(spark, path, ["output"])
    store.dump(path, {"output": table(spark, [(1, 1.0)])}, "knn", "rate", False)
    broken = table(spark, [(1, 7.0), (2, 8.0)]).withColumn("x", F.when(F.col("household_id") == 2, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        store.dump(path, {"scores": table(spark, [(1, 5.0)]), "output": broken}, "knn", "rate", False)
    assert content(spark, path) == [("knn", 1, 1.0)] and len(store.runs(spark, path)) == 1
    with pytest.raises(ValueError, match="scores"):
        store.load(spark, path, ["scores"])


def test_empty_runs_and_configs(spark):
    path = scratch_dir(spark)
    run = store.dump(path, {"output": table(spark, []), "config": spark.sql("SELECT 1 AS household_id, map('a', 'b') AS settings")}, "knn", "rate", True, "f1")
    assert store.find(spark, path, "f1") == run and store.find(spark, path, "f2") is None and store.find(spark, path, None) is None
    assert content(spark, path) == [] and store.read(spark, path, "output", run).count() == 0
    assert store.load(spark, path, ["config"])["config"].first().settings == {"a": "b"}
    store.dump(path, {"output": table(spark, [(1, 1.0)])}, "knn", "rate", True)
    assert content(spark, path) == [("knn", 1, 1.0)]


def test_second_run_reads_no_event(spark, sf):
    path, span = scratch_dir(spark), fx.span(spark, sf)
    names = table(spark, [(0, "purchase", "p")], "household_id int, entity_id string, friendly_name string")

    def run(config):
        frames = fx.readings(spark, sf), fx.households(spark, sf), fx.prices(spark, sf), fx.households(spark, sf).select("household_id", F.lit("purchase").alias("entity_id"), F.lit("p").alias("friendly_name"))
        return stages.run(spark, *frames, config, span.today, span.first, span.last, path, timezone="UTC")

    first = run(CONFIG)["recommendations"]
    count = len(store.runs(spark, f"{path}/recommendations"))
    second = run(CONFIG)["recommendations"]
    assert second.inputFiles() == first.inputFiles() and not any("events" in f for f in second.inputFiles())
    assert len(store.runs(spark, f"{path}/recommendations")) == count == 1
    run(CONFIG.with_thresholds(0.2, 0.4))
    assert len(store.runs(spark, f"{path}/recommendations")) == 2
    assert store.sources_fingerprint(names) is None


def test_base_gives_the_means_of_every_group(spark, sf):
    readings = fx.readings(spark, sf)
    groups = [fx.ACTIVE, fx.SHIFTABLE, ["signup", "it's"]]
    base = hourly.hourly_base(readings, groups)
    for g, devices in enumerate(groups):
        for switches in (False, True):
            want = hourly.hourly_means(readings, devices, switches)
            got = hourly.means_of_base(base, groups, g, switches)
            assert got.columns == want.columns
            rounded = [[F.round(c, 9) if c.startswith("v") else F.col(c) for c in df.columns] for df in (got, want)]
            a, b = got.select(*rounded[0]), want.select(*rounded[1])
            assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_candidates_without_number(spark, sf):
    """A thousand candidates, unsorted and repeated, against one at a time; values equal to a candidate reach it."""
    readings, today = fx.readings(spark, sf), fx.span(spark, sf).today
    many = [float(t) for t in range(1000, 0, -1)] + [30.0, -1.0]
    got = features.threshold_profile(readings, fx.ACTIVE, many, today)
    assert got.select("threshold").distinct().count() == 1001
    for t in (-1.0, 30.0, 1000.0):
        alone = features.threshold_profile(readings, fx.ACTIVE, [t], today)
        assert sorted(map(tuple, got.filter(F.col("threshold") == t).collect())) == sorted(map(tuple, alone.collect()))
    edge = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 9.0)], "v double").select(features.candidates_reached("v", [1.0, 2.0, 3.0]).alias("n"))
    assert [r.n for r in edge.collect()] == [0, 1, 1, 2, 3]


@pytest.fixture(scope="module")
def two_months(sf, tmp_path_factory):
    """The given tables with all events once more, 31 days later."""
    folder = str(tmp_path_factory.mktemp("two_months"))
    for t in TABLES:
        if t != "events":
            os.symlink(f"{sf}/{t}.parquet", f"{folder}/{t}.parquet")
    events = pq.read_table(f"{sf}/events.parquet")
    place = events.schema.get_field_index("ts")
    later = pc.add(events["ts"], pa.scalar(31 * 86400 * 10**6, pa.duration("us")).cast(pa.duration(events.schema.field("ts").type.unit)))
    pq.write_table(pa.concat_tables([events, events.set_column(place, "ts", later.cast(events.schema.field("ts").type))]), f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["r8_recommendations_on_dates", "r13_a17_grid_search", "e2_usage_walk_forward", "w10_cold_start_days", "m4_knn_usage"])
def test_dates_follow_the_data(spark, two_months, name):
    assert fx.span(spark, two_months).last.startswith("2024-02-2") or fx.span(spark, two_months).last.startswith("2024-03")
    assert compare(entry.queries()[name](spark, two_months), connect(two_months), entry.oracle_sql()[name]) == "ok"


SMALL = ["r6_recommend_by_device", "r7_j6_recommendation_table", "r8_recommendations_on_dates", "r9_sentences", "r11_back_test", "r12_evaluate_pair", "r13_a17_grid_search", "w10_cold_start_days", "e6_cold_start_scores"]


@pytest.mark.parametrize("name", SMALL)
def test_plans_stay_small(spark, sf, name):
    """From one written base: prices and households (and what is asked for) are all that is still read from the events."""
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    scans = len(re.findall(r"FileScan parquet .*event_type", plan))
    shuffles = len(re.findall(r"Exchange hashpartitioning", plan))
    assert scans <= 2 + name.startswith("r8") and shuffles <= 12, (scans, shuffles)


def test_prepared_tables_equal_those_from_readings(spark, sf):
    span = fx.span(spark, sf)
    direct, stored = stages.prepare(fx.readings(spark, sf), CONFIG, span.today), prepared(spark, sf)
    for a, b in zip((direct.activity, direct.usage), (stored.activity, stored.usage)):
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    rows = [df.select("household_id", "device", "hour_ts", F.round("load", 9)).collect() for df in (direct.load, stored.load)]
    assert sorted(map(tuple, rows[0])) == sorted(map(tuple, rows[1]))


def test_exact_quantiles_without_a_buffer(spark):
    """Ties, few values, NULLs and keys that are split by ranges, against numpy's linear interpolation."""
    import numpy as np

    from loadshift.operators import clean

    rng = np.random.default_rng(3)
    groups = {"many": rng.normal(size=30_000), "ties": rng.integers(0, 3, 25_000).astype(float), "skew": rng.exponential(size=21_000) ** 5, "two": np.array([1.0, 4.0]), "one": np.array([7.0]), "flat": np.zeros(500)}
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("one", None), ("none", None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    groups[None] = np.array([3.0, 5.0])
    for whole in (0, 1000, clean.WHOLE):
        small = [k for k in groups if len(groups[k]) <= max(whole, 1)] if whole else []
        got = {r.k: (r.q0, r.q1) for r in clean.exact_quantiles(df, ["k"], "x", [0.25, 0.75], max(whole, 600)).collect()}
        assert set(got) == set(groups) and len(small) <= len(groups)
        for k, values in groups.items():
            assert got[k] == pytest.approx(tuple(np.quantile(values, [0.25, 0.75])), rel=1e-12), k
    assert clean.exact_quantiles(df.limit(0), ["k"], "x", [0.5]).count() == 0


def test_labels_are_read_in_blocks(spark, tmp_path):
    """Lines of a long section, many splits: every entry has the house above it."""
    from loadshift.sources import households

    lines, want = ["entries before any house: 1.Nothing"], set()
    for h in range(1, 40):
        lines.append(f"House {h}")
        for i in range(10):
            lines.append(f"\t{i}.Label {h} {i}, ")
            want.add((h, f"Appliance{i}", f"Label {h} {i}"))
        lines += ["filler"] * 50
    (tmp_path / "labels.txt").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert spark.read.text(str(tmp_path / "labels.txt")).rdd.getNumPartitions() > 4
        assert {tuple(r) for r in households.read_labels(spark, str(tmp_path / "labels.txt")).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
