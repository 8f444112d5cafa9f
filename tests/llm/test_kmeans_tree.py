from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import kmeans_tree as kt

ROWS = "vec_id long, embedding array<double>, id string, c int, leaf int, q int, copies int"


def made(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2, 3, 4) for i, v in rows], ROWS)


def takes_part(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k=5):
    """All candidates of each query in order of nearness, ties to the smaller id."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and takes_part(v)}
    length = max(Counter(len(v) for _, v in rows if takes_part(v)).items(), key=lambda e: (e[1], e[0]))[0]
    good = sorted((i, v) for i, v in good if len(v) == length)
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = []
    for i, v in queries:
        score = kt.cosines(np.repeat([v], len(m), axis=0), m)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out.append((i, [(int(ids[j]), score[j]) for j in order]))
    return out


def answered(df):
    got = {}
    for r in df.orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    points = centres[rng.integers(0, 30, 3000)] + rng.normal(0, 0.6, (3000, 16))
    return [(i, v.tolist()) for i, v in enumerate(points)]


def test_recall_and_scores(spark, clustered):
    queries = [r for r in clustered if r[0] % 10 == 0]
    got = answered(kt.search(made(spark, clustered), made(spark, queries), leaf_rows=40))
    expected = brute(clustered, queries)
    hits = sum(len({j for j, _ in near} & {j for _, j, _ in got[i]}) for i, near in expected)
    assert hits >= 0.9 * 5 * len(expected)
    vectors = dict(clustered)
    for i, rows in got.items():
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5] and i not in {j for _, j, _ in rows}
        assert [(s, -j) for _, j, s in rows] == sorted([(s, -j) for _, j, s in rows], reverse=True)
        for _, j, s in rows:
            assert s == pytest.approx(np.dot(vectors[i], vectors[j]) / np.linalg.norm(vectors[i]) / np.linalg.norm(vectors[j]), abs=1e-14)


def test_a_bounded_sample_indexes_every_row(spark, clustered, monkeypatch):
    monkeypatch.setattr(kt, "CELL_POINTS", 50)
    monkeypatch.setattr(kt, "CELL_QUERIES", 7)
    queries = [r for r in clustered if r[0] % 20 == 0]
    got = answered(kt.search(made(spark, clustered), made(spark, queries), leaf_rows=40, sample=300))
    expected = brute(clustered, queries)
    hits = sum(len({j for j, _ in near} & {j for _, j, _ in got[i]}) for i, near in expected)
    assert hits >= 0.9 * 5 * len(expected)
    assert len(got) == len(queries)


def test_visits_are_widened_to_the_wanted_recall(clustered):
    u = kt.units(np.array([v for _, v in clustered])).astype(np.float32)
    tree = kt.grow(u, 40)
    leaf = tree.place(u)
    sizes = np.bincount(leaf, minlength=tree.leaves)
    assert tree.leaves > 50 and sorted(tree.bins(u[0])) == list(range(tree.leaves))
    asked = np.array([v for _, v in clustered[:60]])
    near = np.argsort(-(u[:60] @ u.T), axis=1)[:, 1:6]
    found = [(of, int(leaf[j])) for of in range(60) for j in near[of]]
    visits = [kt.calibrate(tree, sizes, asked, found, recall) for recall in (0.3, 0.9, 1.0)]
    assert visits[0] < visits[1] <= visits[2] <= 2 * tree.leaves
    reached = np.mean([leaf[j] in list(tree.bins(u[of]))[: visits[1]] for of in range(60) for j in near[of]])
    assert reached >= 0.9


def test_copies_ties_and_what_takes_no_part(spark):
    rng = np.random.default_rng(8)
    rows = [(1000 + i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(i, [1.0, 2.0, -0.5, 0.25]) for i in range(200)]  # one vector for most rows
    rows += [(300 + i, [2.0, 4.0, -1.0, 0.5]) for i in range(3)]  # the same direction, exactly
    rows += [(500, [1e-200, 2e-200, 0.0, 1e-201]), (501, [1e200, 1e200, 0.0, 0.0])]
    bad = [None, [], [0.0] * 4, [math.nan, 1.0, 1.0, 1.0], [math.inf, 0.0, 0.0, 0.0], [None, 1.0, 1.0, 1.0], [1.0, 2.0]]
    queries = [r for r in rows if r[0] % 50 == 0]
    all_rows = rows + [(2000 + i, v) for i, v in enumerate(bad)] + [(None, [1.0, 1.0, 1.0, 1.0]), rows[0]]
    asked = queries + [(2000 + i, v) for i, v in enumerate(bad)] + [(None, [1.0, 1.0, 1.0, 1.0])]
    got = answered(kt.search(made(spark, all_rows), made(spark, asked), recall=1.0))
    assert got == {i: [(r + 1, j, s) for r, (j, s) in enumerate(near)] for i, near in brute(all_rows, queries)}


def test_fewer_candidates_than_neighbours(spark):
    rows = [(50 * i, [1.0, float(i)]) for i in range(3)]
    got = answered(kt.search(made(spark, rows), made(spark, rows), leaf_rows=1))
    assert {i: [j for _, j, _ in near] for i, near in got.items()} == {i: [j for j, _ in near] for i, near in brute(rows, rows)}
    alone = rows[:1]
    assert kt.search(made(spark, alone), made(spark, alone)).collect() == []


def test_repeated_queries_and_empty_tables(spark, clustered):
    some = clustered[:200]
    got = kt.search(made(spark, some), made(spark, [some[0], some[0]]), recall=1.0)
    assert Counter(r["rank"] for r in got.collect()) == dict.fromkeys(range(1, 6), 2)
    empty = made(spark, [])
    result = kt.search(empty, empty)
    assert result.collect() == [] and result.columns == ["query_id", "rank", "vec_id", "score"]
    assert kt.search(made(spark, some), empty).collect() == []
