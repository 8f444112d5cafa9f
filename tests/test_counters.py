from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import counters as ct
from gaugeline.schemas import COUNTERS_TABLE

START = datetime(2024, 1, 1, tzinfo=UTC)
ALL = (START, START + timedelta(days=2))


def table(spark, *series):
    rows = [
        (START + timedelta(seconds=15 * i), name, labels, float(v))
        for name, labels, values in series
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, COUNTERS_TABLE)


def test_increase_survives_resets_and_skew(spark, small_chunks):
    long = [v % 50 for v in range(1_000)]
    c = table(
        spark,
        ("sent", {"topic": "a"}, long),
        ("sent", {"topic": "b", "host": "x"}, [5, 7, 1, 4]),
        ("sent", {"host": "y", "topic": "b"}, [1, 1, 3]),
        ("other", {"topic": "a"}, [0, 100]),
    )
    got = {r["topic"]: r["increase"] for r in ct.counter_increase(c, "sent", ALL, by=["topic"]).collect()}
    expected = sum(b if b < a else b - a for a, b in zip(long[:-1], long[1:], strict=True))
    assert got == {"a": float(expected), "b": 2.0 + 1 + 3 + 2}
    within = (START + timedelta(seconds=15), START + timedelta(seconds=45))
    only_b = ct.counter_increase(c, "sent", within, ct.label_equals("topic", "b"))
    assert only_b.first()["increase"] == 1.0 + 3 + 2
    assert ct.counter_increase(c, "never", ALL).first()["increase"] == 0.0


def test_labels_match_as_a_whole(spark):
    c = table(spark, *[("sent", {"topic": t}, [0, 1]) for t in ("raw", "raw_dlq", "dlq", "raw_dlq_2")])
    dead = ct.counter_increase(c, "sent", ALL, ct.label_matches("topic", ".*_dlq"), by=["topic"])
    assert [r["topic"] for r in dead.collect()] == ["raw_dlq"]
    assert ct.counter_increase(c, "sent", ALL, ~ct.label_equals("topic", "raw")).first()["increase"] == 3.0


def test_rate_per_bucket(spark):
    c = table(spark, ("sent", {"topic": "a"}, [0, 3, 6, 9, 12, 12]))
    rates = ct.counter_rate(c, "sent", ALL, 60, by=["topic"]).orderBy("time").collect()
    assert [r["rate"] for r in rates] == [9 / 60, 3 / 60]


@pytest.mark.parametrize(("q", "expected"), [(0.5, 0.1 + 0.4 * (6 - 4) / (10 - 4)), (0.95, 1.0), (0.1, 0.03)])
def test_histogram_quantile(spark, q, expected):
    buckets = [("0.1", 4), ("0.5", 10), ("1", 10), ("+Inf", 12)]
    c = table(spark, *[("secs", {"table": "m", "le": le}, [0, n]) for le, n in buckets], ("secs", {"table": "z", "le": "1"}, [4, 4]))
    rows = ct.histogram_quantile(c, "secs", q, ALL, ["table"]).collect()
    assert [r["table"] for r in rows] == ["m"]
    assert rows[0]["quantile"] == pytest.approx(expected)


def test_mean_cost_and_gauges(spark):
    c = table(
        spark,
        ("micros", {"algorithm": "mad"}, [0, 100]),
        ("calls", {"algorithm": "mad"}, [0, 20]),
        ("micros", {"algorithm": "new"}, [5, 5]),
        ("calls", {"algorithm": "new"}, [5, 5]),
        ("lag", {"task": "1"}, [9, 2]),
        ("lag", {"task": "2"}, [1, 4]),
        ("up", {"job": "a", "instance": "1"}, [1, 1]),
        ("up", {"job": "a", "instance": "2"}, [1, 0]),
        ("up", {"job": "b"}, [0, 1]),
    )
    cost = {r["algorithm"]: r["mean_cost"] for r in ct.mean_cost(c, "micros", "calls", ALL, ["algorithm"]).collect()}
    assert cost == {"mad": 5.0, "new": None}
    now = START + timedelta(seconds=20)
    assert ct.gauge_max(c, "lag", now).first()["value"] == 4.0
    assert ct.gauge_max(c, "lag", START + timedelta(hours=1)).first()["value"] is None
    assert [ct.up_or_zero(c, j, now).first()["value"] for j in ("a", "b", "c")] == [0.0, 1.0, 0.0]
    assert c.where(F.col("name") == "up").count() == 6
