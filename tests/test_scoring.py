from __future__ import annotations

import math
from datetime import UTC, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from gaugeline.operators import ordering
from gaugeline.operators.detectors import DEFAULT_REGISTRY, EWMA, MAD, Registry, detector_config
from gaugeline.operators.scoring import (
    detector_costs,
    rolling_mad,
    rolling_median,
    score,
    warm_detectors,
    window_points,
)

BEGIN = datetime(2024, 1, 1, tzinfo=UTC)


def frame(spark, series):
    rows = []
    for (machine, name), values in series.items():
        for i, value in enumerate(values):
            rows.append((f"{machine}-{name}-{i:05d}", machine, name, BEGIN + timedelta(seconds=i), float(value)))
    np.random.default_rng(3).shuffle(rows)
    rows = [(str(a), str(b), str(c), d, float(e)) for a, b, c, d, e in rows]
    return spark.createDataFrame(
        rows, "metric_id string, machine_id string, name string, timestamp timestamp, value double"
    )


def skewed_series():
    """One series with most of the rows, several short ones, some unscored."""
    rng = np.random.default_rng(11)
    hot = np.round(rng.normal(50, 8, 1_100), 2)
    hot[rng.random(1_100) < 0.04] += 70
    series = {("m1", brute.CPU): hot.tolist()}
    for i in range(12):
        series[f"m{i}", brute.MEMORY] = np.round(rng.normal(5e8, 2e6, 5 + 9 * i), 0).tolist()
        series[f"m{i}", "nab.trace"] = np.round(rng.exponential(3, 30), 1).tolist()
        series[f"m{i}", "system.uptime"] = list(range(20))
        series[f"m{i}", "nab"] = [1.0] * 30
    series["flat", "nab.flat"] = [5.0] * 40 + [5.1] + [5.0] * 30
    return series


def collected(evaluations):
    return {
        (r["machine_id"], r["metric_name"], int(r["metric_id"].rsplit("-", 1)[1]), r["algorithm"]): r
        for r in evaluations.collect()
    }


def test_score_equals_plain_rules_on_a_skewed_table(spark, small_chunks):
    series = skewed_series()
    got = collected(score(frame(spark, series)))
    expected = list(brute.evaluations(series))
    assert len(got) == len(expected)
    for machine, name, i, algorithm, baseline, lower, upper, flagged in expected:
        row = got[machine, name, i, algorithm]
        assert row["baseline"] == pytest.approx(baseline, rel=1e-9)
        assert row["upper"] == pytest.approx(upper, rel=1e-9, abs=1e-9)
        assert row["is_anomaly"] == flagged
        assert (row["lower"] is None) == (lower is None)
        assert row["timestamp"].replace(tzinfo=UTC) == BEGIN + timedelta(seconds=i)


def test_chunks_are_bounded_and_dense_whatever_the_skew(spark, small_chunks):
    samples = frame(spark, {("m", "nab.hot"): range(2_000), ("n", "nab.cold"): range(3)})
    ordered = ordering.order_rows(samples, ["machine_id", "name", "timestamp", "metric_id"])
    rows = ordered.rows.orderBy("_pos").collect()
    assert [r["_pos"] for r in rows] == list(range(2_003)) and ordered.total == 2_003
    assert [r["value"] for r in rows] == [*map(float, range(2_000)), 0.0, 1.0, 2.0]
    chunks = ordering.with_chunks(ordered, 30, 64).groupBy("_chunk").agg(
        F.count("*").alias("rows"), F.count_if("_own").alias("own"), F.min("_pos").alias("first")
    )
    for row in chunks.collect():
        assert row["own"] <= 64 and row["rows"] <= 94
        assert row["first"] == max(0, row["_chunk"] * 64 - 30)


@pytest.mark.parametrize("halo", [0, 1, 7, 90])
def test_rows_see_exactly_the_rows_before_them(spark, halo, monkeypatch):
    """Files of 20 rows, partitions of fewer rows than the halo, empty ones, and one of many files."""
    monkeypatch.setattr(ordering, "RUN_ROWS", 20)
    samples = spark.range(500).select((F.floor(F.sqrt("id") / 3)).alias("a"), "id").repartition(5)

    def kernel(table):
        ids, own = table.column("id").to_numpy(), table.column("_own").to_numpy(zero_copy_only=False)
        assert (np.diff(ids) == 1).all()
        seen = np.minimum(np.arange(len(ids)), halo)[own]
        return pa.table({"id": ids[own], "seen": pa.array(seen, pa.int64())})

    got = ordering.over_runs(samples, ["a", "id"], halo, kernel, "id long, seen long").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(i, min(i, halo)) for i in range(500)]


def test_scoring_shuffles_once(spark):
    plan = score(frame(spark, skewed_series()))._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert [key.split("#")[0] for key in keys] == ["_edge"], plan  # only rows at the borders of files
    assert "rangepartitioning" not in plan  # that one has been written


def test_stored_replays_are_collapsed_where_samples_are_sorted(spark, small_chunks, monkeypatch):
    """Of a sample's rows the one inserted last counts, of several inserted at one time the one added last; one shuffle does it."""
    plans, write = [], ordering.materialise

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **options)

    first = frame(spark, skewed_series()).withColumns({"inserted_at": F.col("timestamp"), "insert_seq": F.lit(0).cast("long")})
    copied = first.where(F.col("metric_id").endswith("3"))
    tied = copied.withColumns({"value": F.col("value") + 7, "insert_seq": F.lit(1).cast("long")})
    older = copied.withColumns({"value": F.lit(-1.0), "inserted_at": F.col("timestamp") - F.make_dt_interval(secs=F.lit(9))})
    raw = tied.unionByName(first).unionByName(older.withColumn("insert_seq", F.lit(2).cast("long")))
    monkeypatch.setattr(ordering, "materialise", noted)
    got = collected(score(raw, version="inserted_at"))
    (plan,) = plans
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
    value = F.when(F.col("metric_id").endswith("3"), F.col("value") + 7).otherwise(F.col("value"))
    assert got == collected(score(first.withColumn("value", value).drop("inserted_at", "insert_seq")))


def test_ordering_an_empty_table(spark):
    samples = frame(spark, {("m", "nab.hot"): [1.0]}).where("false")
    assert score(samples).collect() == []


BASELINE = [10, 11, 12, 11, 10] * 4
IDLE = [11, 11.2, 10.9] * 7
MEMORY = [492_700_000 + 4096 * (i % 5) for i in range(20)]
TRACE = [0.10, 0.11, 0.12, 0.11, 0.10] * 4


@pytest.mark.parametrize(
    ("name", "values", "flags"),
    [
        (brute.CPU, [*BASELINE, 11], {"ewma": False, "mad": False}),
        (brute.CPU, [*BASELINE, 90], {"ewma": True, "mad": True}),
        (brute.CPU, [*BASELINE, -50], {"ewma": False, "mad": True}),
        (brute.CPU, [11] * 11, {"ewma": False}),
        (brute.CPU, [11], {}),
        (brute.CPU, [*IDLE, 19], {"ewma": False, "mad": False}),
        (brute.CPU, [*IDLE, 22], {"ewma": True, "mad": True}),
        (brute.MEMORY, [*MEMORY, 492_700_000 + 32 * 1024], {"ewma": False, "mad": False}),
        (brute.MEMORY, [*MEMORY, 492_700_000 - 32 * 1024], {"ewma": False, "mad": False}),
        (brute.MEMORY, [*MEMORY, 560_000_000], {"ewma": True, "mad": True}),
        ("nab.series", [*TRACE, 0.5], {"ewma": True, "mad": True}),
        ("nab.", [*TRACE, 0.5], {"ewma": True, "mad": True}),
        ("nab.series", [5] * 30, {"ewma": False, "mad": False}),
        ("nab", [*TRACE, 0.5], {}),
        ("NAB.x", [*TRACE, 0.5], {}),
        ("system.memory.limit", [*BASELINE, 90], {}),
        ("system.uptime", [*BASELINE, 90], {}),
    ],
)
def test_scoring_per_metric(spark, name, values, flags):
    got = collected(score(frame(spark, {("m", name): values})))
    last = {a: r["is_anomaly"] for (_, _, i, a), r in got.items() if i == len(values) - 1}
    assert last == flags


def test_an_evaluation_carries_its_samples_keys(spark):
    got = collected(score(frame(spark, {("m7", brute.CPU): [*BASELINE, 90]})))
    row = got["m7", brute.CPU, 20, "mad"]
    assert (row["baseline"], round(row["lower"], 9), round(row["upper"], 9)) == (11.0, 1.0, 21.0)
    assert row["metric_id"] == f"m7-{brute.CPU}-00020"


def test_arrival_order_can_differ_from_time(spark):
    values = [float(v) for v in range(40)]
    samples = frame(spark, {("m", "nab.x"): values}).withColumn("partition", F.lit(0))
    reverse = samples.withColumn("offset", -F.unix_seconds("timestamp"))
    got = collected(score(reverse, order=("partition", "offset")))
    assert got["m", "nab.x", 0, "mad"]["baseline"] == pytest.approx(19.5)
    assert ("m", "nab.x", 39, "mad") not in got


def test_another_window_and_registry(spark, small_chunks):
    registry = Registry().register("x", [MAD()]).register("y.", [EWMA(0.0)], is_prefix=True)
    series = {("m", "x"): list(range(200)), ("m", "y.1"): list(range(200)), ("m", brute.CPU): list(range(200))}
    got = collected(score(frame(spark, series), window=30, registry=registry))
    assert {(name, algorithm) for _, name, _, algorithm in got} == {("x", "mad"), ("y.1", "ewma")}
    assert got["m", "x", 150, "mad"]["baseline"] == pytest.approx(135.5)
    assert registry.rule_for("y.1").is_prefix and registry.rule_for("y") is None


def test_costs_count_every_call(spark):
    rows = detector_costs(frame(spark, {("m", brute.CPU): [*BASELINE, 90]})).collect()
    assert {r["algorithm"]: r["calls"] for r in rows} == {"ewma": 11, "mad": 2}
    assert all(r["micros"] > 0 for r in rows)


def test_window_statistics_agree(spark, small_chunks):
    values = [float((i * 37) % 101) for i in range(500)]
    samples = frame(spark, {("m", "nab.x"): values})
    index = lambda r: int(r["metric_id"].rsplit("-", 1)[1])
    points = {index(r): r["points"] for r in window_points(samples).collect()}
    medians = {index(r): r["median"] for r in rolling_median(samples).collect()}
    spreads = {index(r): r for r in rolling_mad(samples).collect()}
    for i in range(500):
        window = values[max(0, i - 359) : i + 1]
        middle = float(np.median(window))
        distances = np.abs(np.array(window) - middle)
        assert points[i] == len(window) and medians[i] == middle
        assert spreads[i]["median"] == middle and spreads[i]["mad"] == float(np.median(distances))
        assert spreads[i]["mean_deviation"] == pytest.approx(float(np.mean(distances)))


def test_warm_up_and_configuration(spark):
    samples = frame(spark, {("m", brute.CPU): [1.0] * 25, ("m", "other"): [1.0] * 25})
    warm = warm_detectors(samples).groupBy("algorithm").count().collect()
    assert {r["algorithm"]: r["count"] for r in warm} == {"ewma": 15, "mad": 6}
    config = detector_config(samples).groupBy("algorithm").agg(F.max("min_deviation").alias("least")).collect()
    assert {r["algorithm"]: r["least"] for r in config} == {"ewma": 10.0, "mad": 10.0}
    assert DEFAULT_REGISTRY.algorithms() == ["ewma", "mad"]
    assert not math.isnan(samples.count())
