from __future__ import annotations

import numpy as np
import pytest

import brute
from gaugeline.operators import scoring
from gaugeline.operators.detectors import EWMA, MAD, OneWindow, Windows
from gaugeline.operators.scoring import score_values, window_blocks



def judge(detector, window):
    bands = detector.evaluate(Windows.of(window))
    lower = None if bands.lower is None else bands.lower[0]
    return bands.baseline[0], lower, bands.upper[0], bool(bands.is_anomaly[0])


def drawn(seed, n, level=200.0, spread=8.0):
    return np.round(np.random.default_rng(seed).normal(level, spread, n), 3).tolist()


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize(("least", "relative"), [(0.0, 0.0), (3.0, 0.0), (0.0, 0.05), (40.0, 0.01)])
def test_one_window_equals_the_plain_rule(seed, least, relative):
    rng = np.random.default_rng(100 + seed)
    window = drawn(seed, int(rng.integers(11, 80)))
    for newest in (*rng.normal(200, 40, 6).tolist(), 200.0, 1e6, -1e6):
        for detector, rule in ((MAD(least, relative), brute.mad), (EWMA(least, relative), brute.ewma)):
            got, want = judge(detector, [*window, newest]), rule([*window, newest], least, relative)
            assert got[0] == pytest.approx(want[0], rel=1e-12)
            assert got[2] == pytest.approx(want[2], rel=1e-12)
            assert got[1] == (None if want[1] is None else pytest.approx(want[1], rel=1e-12))
            assert got[3] == want[3]


@pytest.mark.parametrize("n", [6, 11, 40])
def test_mad_of_a_flat_window(n):
    level = 7.25
    assert judge(MAD(), [level] * n) == (level, level, level, False)
    assert judge(MAD(1.5), [level] * n) == (level, level - 1.5, level + 1.5, False)
    # One value that differs by d has mean deviation d / n, which stands in for the median deviation of 0.
    baseline, lower, upper, flagged = judge(MAD(), [level] * (n - 1) + [level + 2])
    margin = 3.5 * 1.253314 * 2 / n
    assert (baseline, lower, upper) == (level, pytest.approx(level - margin), pytest.approx(level + margin))
    assert flagged == (2 >= margin)


def test_mad_of_evenly_spaced_values():
    # 2k + 1 values with step h: the median deviation is h * ceil(k / 2).
    for k, h in ((3, 1.0), (4, 0.5), (9, 2.0)):
        values = [h * i for i in range(2 * k + 1)]
        margin = 3.5 * 1.4826 * h * -(-(k + 1) // 2 if k % 2 else -k // 2)
        baseline, lower, upper, flagged = judge(MAD(), values)
        assert (baseline, lower, upper) == (h * k, pytest.approx(h * k - margin), pytest.approx(h * k + margin))
        assert not flagged


def test_mad_flags_both_directions_at_the_edge():
    window = [50.0] * 21
    for sign in (-1, 1):
        assert judge(MAD(4.0), [*window, 50 + 4 * sign])[3]
        assert not judge(MAD(4.0), [*window, 50 + 3.99 * sign])[3]


@pytest.mark.parametrize("rest", [11, 25, 80])
def test_ewma_forgets_its_start(rest):
    # The first value counts (1 - alpha) for each later one.
    baseline, lower, _, _ = judge(EWMA(), [90.0] + [30.0] * rest)
    assert baseline == pytest.approx(30 + 60 * 0.9 ** (rest - 1), rel=1e-12) and lower is None


@pytest.mark.parametrize(("jump", "weight"), [(3.0, 0.01), (0.75, 0.1)])
def test_ewma_damps_what_is_out(jump, weight):
    after = 7
    baseline = judge(EWMA(1.0), [20.0] * 15 + [20.0 + jump] + [20.0] * after)[0]
    assert baseline == pytest.approx(20 + weight * jump * 0.9 ** (after - 1), rel=1e-9)


def test_ewma_band_and_edge_of_a_flat_window():
    flat = [64.0] * 30
    for newest, flagged in ((66.0, False), (66.0625, True), (0.0, False)):
        baseline, lower, upper, got = judge(EWMA(2.0), [*flat, newest])
        assert (baseline, lower, upper, got) == (64.0, None, 66.0, flagged)
    assert judge(EWMA(0.0, 0.25), [*flat, 80.0])[1:] == (None, 80.0, False)
    assert judge(EWMA(0.0), [*flat, 64.0625])[3] and not judge(EWMA(0.0), [*flat, 63.0])[3]


def test_ewma_needs_enough_values():
    with pytest.raises(ValueError, match="10 of the 11 values"):
        judge(EWMA(), drawn(1, 10))


@pytest.mark.parametrize("block_rows", [5, 4_096])
@pytest.mark.parametrize("name", [brute.CPU, brute.MEMORY, "nab.x"])
def test_blocks_agree_with_one_window_at_a_time(name, block_rows, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(7)
    values = np.round(rng.normal(100, 15, 900), 1)
    values[rng.random(900) < 0.05] += 200
    values[300:420] = 100.0
    starts = np.where(np.arange(900) < 400, 0, 400)
    least, relative = brute.floors(name)
    for detector, rule, enough in ((MAD(least, relative), brute.mad, 20), (EWMA(least, relative), brute.ewma, 11)):
        rows = np.flatnonzero(np.arange(900) - starts + 1 >= enough)
        for block, windows in window_blocks(values, starts, rows, 360):
            bands = detector.evaluate(windows)
            for k, i in enumerate(block):
                window = values[max(starts[i], i - 359) : i + 1].tolist()
                baseline, lower, upper, flagged = rule(window, least, relative)
                assert bands.baseline[k] == pytest.approx(baseline, rel=1e-9)
                assert bands.upper[k] == pytest.approx(upper, rel=1e-9)
                assert bool(bands.is_anomaly[k]) == flagged
                assert (bands.lower is None) == (lower is None)


@pytest.mark.parametrize("block_rows", [5, 4_096])
def test_nan_is_contained_in_its_window(block_rows, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_ROWS", block_rows)
    values = np.array([1.0, 2.0] * 15 + [np.nan] + [1.0, 2.0] * 200)
    starts = np.zeros(len(values), dtype=int)
    rows = np.arange(20, len(values))
    for detector in (MAD(), EWMA()):
        for block, windows in window_blocks(values, starts, rows, 360):
            bands = detector.evaluate(windows)
            touched = (block > 30) & (block - 359 <= 30)
            assert np.isnan(bands.baseline[touched]).all()
            assert not bands.is_anomaly[touched].any()
            assert not np.isnan(bands.baseline[block - 359 > 30]).any()


def test_own_detector_for_one_window():
    detector = OneWindow("last", 3, lambda w: (w[0], None, w[-1], w[-1] > w[0]))
    bands = detector.evaluate(Windows.of([1.0, 2.0, 3.0], [5.0, 4.0]))
    assert bands.baseline.tolist() == [1.0, 5.0]
    assert bands.upper.tolist() == [3.0, 4.0]
    assert bands.is_anomaly.tolist() == [True, False]
    assert bands.lower is None


def test_nothing_to_score():
    from gaugeline.operators.detectors import DEFAULT_REGISTRY

    empty = np.empty(0)
    assert not list(
        score_values(empty, empty.astype(int), empty.astype(bool), [], empty.astype(int), DEFAULT_REGISTRY, 360)
    )
