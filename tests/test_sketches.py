from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import lifecycle, panels, sketches
from gaugeline.sources.tables import open_tables

DAY = datetime(2024, 3, 1, tzinfo=UTC)


def samples(spark, n, first=0):
    """Two days of one dominant and two small series, with values in no order and some replays."""
    rows = spark.range(first, first + n, 1, 4).select(
        F.concat(F.lit("id"), "id").alias("metric_id"),
        F.when(F.col("id") % 50 == 0, "small").when(F.col("id") % 977 == 1, "tiny").otherwise("hot").alias("machine_id"),
        F.lit("cpu").alias("name"),
        (F.lit(DAY).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 37 % 172_000)).alias("timestamp"),
        F.lit("gauge").alias("type"), F.lit("%").alias("unit"),
        F.when(F.col("id") % 991 != 5, F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7.0).alias("value"),
        F.expr("map('k', '1')").alias("attributes"),
    )
    return rows.withColumn("inserted_at", F.col("timestamp") + F.make_dt_interval(secs=F.pmod(F.xxhash64("metric_id"), F.lit(3_000))))


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path / "store")
    lifecycle.create_tables(spark, root, register=False)
    rows = samples(spark, 60_000)
    lifecycle.append(rows, root, "metrics")
    lifecycle.append(rows.where("metric_id like '%7'"), root, "metrics", insert_seq=1)
    return root


def compare(spark, root):
    t = open_tables(spark, root)
    want = {r["machine_id"]: r.asDict() for r in panels.series_summary(t).collect()}
    got = {r["machine_id"]: r.asDict() for r in sketches.series_summary(spark, root).collect()}
    values = t.final("metrics").where("value is not null")
    assert got.keys() == want.keys()
    for machine, row in got.items():
        of = sorted(r["value"] for r in values.where(F.col("machine_id") == machine).select("value").collect())
        assert row["samples"] == len(of)
        assert [row[c] for c in ("latest", "min", "max")] == [want[machine][c] for c in ("latest", "min", "max")]
        assert row["mean"] == pytest.approx(want[machine]["mean"])
        below, upto = sum(v < row["p95"] for v in of), sum(v <= row["p95"] for v in of)
        slack = 2 * sketches.RANK_ERROR * len(of) + 1
        assert below <= 0.95 * len(of) + slack and upto >= 0.95 * len(of) - slack


def test_summary_from_states_follows_the_rows(spark, root):
    compare(spark, root)  # nothing stored: states are made on the way
    lifecycle.compact(spark, root, "metrics")
    sketches.store_states(spark, root)
    compare(spark, root)
    lifecycle.append(samples(spark, 500, first=60_000), root, "metrics")  # unsettles the first day
    compare(spark, root)
    lifecycle.compact(spark, root, "metrics")
    sketches.store_states(spark, root)
    compare(spark, root)


def test_states_spare_the_rows(spark, root):
    lifecycle.compact(spark, root, "metrics")
    sketches.store_states(spark, root)
    before = sketches.series_summary(spark, root).drop("p95").orderBy("machine_id").collect()
    _, valid = sketches._kept(spark, root, "values", open_tables(spark, root).settled["metrics"])
    assert sorted(valid) == ["date=2024-03-01", "date=2024-03-02"]
    spark.sparkContext.setJobGroup("states", "states")
    try:
        again = sketches.series_summary(spark, root).drop("p95").orderBy("machine_id").collect()
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert again == before
    status, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for job in status.getJobIdsForGroup("states") for s in status.getJobInfo(job).stageIds}
    assert sum(store.lastStageAttempt(s).inputRecords() for s in stages) <= 50  # states, no samples


def test_delays_from_states(spark, root):
    lifecycle.compact(spark, root, "metrics")
    sketches.store_states(spark, root)
    lifecycle.append(samples(spark, 200, first=60_000), root, "metrics")
    t = open_tables(spark, root)
    delays: dict = {}
    for r in t.metrics.select("timestamp", "inserted_at").collect():
        delays.setdefault(r["inserted_at"].replace(second=0, microsecond=0), []).append(
            (r["inserted_at"] - r["timestamp"]).total_seconds()
        )
    got = {r["time"]: r for r in sketches.ingest_delay(spark, root).collect()}
    assert got.keys() == delays.keys() and got.keys() == {r["time"] for r in panels.ingest_delay(t).collect()}
    for time, row in got.items():
        of = delays[time]
        assert row["samples"] == len(of)
        for p in (0.5, 0.95):
            q, slack = row[f"p{round(100 * p)}"], 2 * sketches.RANK_ERROR * len(of) + 1
            assert sum(v < q - 1e-6 for v in of) <= p * len(of) + slack
            assert sum(v <= q + 1e-6 for v in of) >= p * len(of) - slack
