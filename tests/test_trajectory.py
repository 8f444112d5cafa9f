from __future__ import annotations

import numpy as np
import pytest

import brute
from gaugeline.operators import trajectory as tr
from test_scoring import frame


def index(row):
    return int(row["metric_id"].rsplit("-", 1)[1])


@pytest.fixture
def series():
    rng = np.random.default_rng(2)
    hot = np.round(rng.normal(50, 5, 700), 2)
    hot[rng.random(700) < 0.05] += 80
    return {
        ("m1", "cpu"): hot.tolist(),
        ("m2", "cpu"): np.round(rng.normal(30, 1, 40), 2).tolist(),
        ("m2", "mem"): [5.0] * 90,
        ("m3", "cpu"): [1.0],
    }


@pytest.fixture(params=[512, 3])
def guess_rows(request, monkeypatch):
    """With 3 rows every guess is wrong, so that chunks have to be run again."""
    monkeypatch.setattr(tr, "GUESS_ROWS", request.param)


def test_trajectory_equals_one_pass(spark, small_chunks, guess_rows, series):
    got = {(r["machine_id"], r["name"], index(r)): r for r in tr.ewma_trajectory(frame(spark, series)).collect()}
    assert len(got) == sum(map(len, series.values()))
    for (machine, name), values in series.items():
        for i, (average, threshold, flagged) in enumerate(brute.trajectory(values)):
            row = got[machine, name, i]
            assert row["average"] == pytest.approx(average, rel=1e-9)
            assert row["anomaly"] == flagged
            assert row["threshold"] == (None if threshold is None else pytest.approx(threshold, rel=1e-9))


def test_a_locked_average_is_followed_through_all_chunks(spark, small_chunks):
    """Without damping a jump is never learned: the state at the end of a chunk depends on its start for ever."""
    values = [10.0, 10.5] * 40 + [100.0 + i % 3 for i in range(200)]
    rows = tr.ewma_trajectory(frame(spark, {("m", "cpu"): values}), damping=0.0).collect()
    expected = brute.trajectory(values, damping=0.0)
    assert {index(r): r["anomaly"] for r in rows} == {i: e[2] for i, e in enumerate(expected)}
    assert {index(r): pytest.approx(r["average"]) for r in rows} == {i: e[0] for i, e in enumerate(expected)}


def test_sweep_counts_flags_per_setting(spark, small_chunks, series):
    settings = [tr.Settings(), tr.Settings(alpha=0.5, multiplier=2.0, min_deviation=1.0), tr.Settings(damping=1.0)]
    rows = tr.ewma_sweep(frame(spark, series), settings).collect()
    assert len(rows) == len(settings) * len(series)
    for r in rows:
        values = series[r["machine_id"], r["name"]]
        expected = brute.trajectory(values, r["alpha"], r["multiplier"], r["min_deviation"], r["damping"])
        assert (r["readings"], r["flagged"]) == (len(values), sum(e[2] for e in expected))


def test_flagged_readings_only(spark, series):
    rows = tr.ewma_flagged(frame(spark, series)).collect()
    expected = {(m, n, i) for (m, n), v in series.items() for i, e in enumerate(brute.trajectory(v)) if e[2]}
    assert {(r["machine_id"], r["name"], index(r)) for r in rows} == expected


@pytest.mark.parametrize("span", [None, 30])
def test_span_average(spark, small_chunks, series, span):
    got = {(r["machine_id"], r["name"], index(r)): r["average"] for r in tr.ewma_span(frame(spark, series), span).collect()}
    expected = {}
    for (machine, name), values in series.items():
        weight = 2 / ((span or len(values)) + 1)
        average = values[0]
        expected[machine, name, 0] = average
        for i, value in enumerate(values[1:], start=1):
            average = weight * value + (1 - weight) * average
            if not value > 3 * average:
                expected[machine, name, i] = average
    assert set(got) == set(expected)
    assert all(got[k] == pytest.approx(v, rel=1e-9) for k, v in expected.items())


def test_a_sweep_is_handed_no_more_than_it_counts(spark, series):
    """Ids and times stay out of Python, and of a sweep's traces only the flags are kept."""
    plan = tr.ewma_sweep(frame(spark, series), [tr.Settings()])._jdf.queryExecution().executedPlan().toString()
    assert "value" in plan and "metric_id" not in plan and "timestamp" not in plan
    traces = tr.Traces(10, 2, flags=True)
    assert traces.flagged.shape == (10, 2) and traces.average is None and traces.threshold is None
