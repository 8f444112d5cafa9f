from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import vectors, whitening

ROWS = "vec_id long, embedding array<double>, x string, n string, y int, copies int"


def plain(rows, counted=False, most=4):
    """The contract in exact whole numbers where it says so, by numpy on one list."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    length = max(Counter(len(v) for _, v in good).items(), key=lambda e: (e[1], e[0]))[0]
    x = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in good if len(v) == length]
    copies = Counter(v for _, v in x)
    points = sorted(copies)
    weight = [copies[p] if counted else 1 for p in points]
    n = sum(weight)
    sums = [sum(w * p[k] for w, p in zip(weight, points, strict=True)) for k in range(length)]
    centred = np.array(points, float) - np.array(sums) / n
    v = (centred * np.array(weight)[:, None]).T @ centred / n
    values, columns = np.linalg.eigh(v)
    out = {}
    for i, p in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(p, sums, strict=True))
        for k in range(min(most, length)):
            if values[-1 - k] > 1e-11 * values[-1]:
                y = (np.array(p, float) - np.array(sums) / n) @ columns[:, -1 - k] / math.sqrt(values[-1 - k])
                out.setdefault((i, k + 1), []).append((n, deviation, y, values[-1 - k] / np.trace(v)))
    return out


def check(spark, rows, counted=False):
    df = spark.createDataFrame([(i, v, "a", "b", 1, 2) for i, v in rows], ROWS)
    found = whitening.by_component(*whitening.whiten(df, counted=counted)).collect()
    expected = plain(rows, counted)
    got = {}
    for r in found:
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
        assert 0 <= r["identity_error"] < 1e-9
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in expected.items()}
    signs = {}
    for key, values in expected.items():
        for r, (n, deviation, y, explained) in zip(got[key], values, strict=True):
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["explained"] == pytest.approx(explained, rel=1e-9)
            sign = signs.setdefault(key[1], math.copysign(1, r["whitened"] * y) if abs(y) > 1e-6 else None)
            assert r["whitened"] == pytest.approx(y * (sign or 1), abs=1e-7)


@pytest.fixture
def rows():
    rng = np.random.default_rng(5)
    made = rng.normal(0, [0.5, 0.3, 0.2, 0.1, 0.05, 0.02], (60, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    rows += [(100 + i, [0.25, -0.0, 0.0, 1e-9, -1e-9, 0.5]) for i in range(30)]  # one vector for a third of all rows
    rows += [(3, rows[3][1]), (None, rows[7][1])]
    return rows


@pytest.mark.parametrize("counted", [False, True])
def test_equals_the_plain_computation(spark, rows, counted):
    check(spark, rows, counted)


def test_vectors_that_cannot_take_part(spark, rows):
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [math.nan] * 6, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    check(spark, rows + [(500 + i, v) for i, v in enumerate(bad)])


def test_deviations_beyond_64_bits_are_exact(spark):
    huge = [(i, [float(2**40 + i * 2**30), float(i % 3), -float(i)]) for i in range(12)]
    df = spark.createDataFrame([(i, v, "a", "b", 1, 2) for i, v in huge], ROWS)
    found, fit, _ = whitening.whiten(df)
    expected = {i: d for (i, k), [(_, d, _, _)] in plain(huge).items() if k == 1}
    assert {r["vec_id"]: int(r["deviation"]) for r in found.collect()} == expected
    assert max(expected.values()) > 2**63
    shown = whitening.by_component(found, fit, 0.0).filter("component = 1").collect()
    assert {r["vec_id"]: r["deviation"] for r in shown} == {i: d if d < 2**63 else None for i, d in expected.items()}


def test_without_spread_there_is_no_component(spark):
    same = spark.createDataFrame([(i, [0.5, 0.5], "a", "b", 1, 2) for i in range(5)], ROWS)
    found, fit, error = whitening.whiten(same)
    assert [(r["deviation"], r["y"]) for r in found.collect()] == [(0, [])] * 5 and error == 0.0
    assert whitening.by_component(found, fit, error).count() == 0
    line = spark.createDataFrame([(i, [i / 256, 2 * i / 256], "a", "b", 1, 2) for i in range(9)], ROWS)
    assert {r["component"] for r in whitening.by_component(*whitening.whiten(line)).collect()} == {1}


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    result = whitening.by_component(*whitening.whiten(empty))
    assert result.collect() == []
    assert [f.simpleString() for f in result.schema][:5] == [
        "vec_id:bigint", "component:int", "n:bigint", "deviation:bigint", "whitened:double",
    ]


def test_common_keys_are_few(spark):
    found = spark.createDataFrame([(k, 600 if k < 2 else 1) for k in range(1000)], "k int, copies int")
    rows = spark.createDataFrame([(k % 2 if i < 1200 else k,) for i, k in enumerate([*range(1200), *range(2, 1000)])], "k int")
    both = vectors.attached(rows, found, "k", found["copies"], 2198)
    assert both.count() == rows.count()
    assert "BroadcastHashJoin" in both._jdf.queryExecution().toString()
