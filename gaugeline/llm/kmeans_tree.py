"""Nearest neighbours by cosine from a hierarchical k-means tree, searched best bin first.

The tree is fitted on the driver, on a bounded sample of the different vectors (`SAMPLE` of them, and `SAMPLE_NUMBERS` entries):
unit vectors are split into `BRANCH` clusters, each of these again, until a leaf holds `LEAF_SAMPLE` of the sample or stands for
`LEAF_ROWS` vectors. Then every vector is dealt to its leaf. Rows of one vector are one point with the least ids that a query
could be answered with, cut down before the shuffle, so copies cost nothing.

A query goes down to the nearest leaf and puts the branches that it passes by into a priority queue, from which it goes on
with the nearest one. How many leaves it visits is calibrated: for some queries (`CALIBRATION`) the true neighbours are found
among all points, and the visits are widened until the leaves that hold them reach the wanted recall. A query visits more leaves
if those hold too few points to answer it.

Queries travel to their leaves; neighbouring leaves are grouped, so that a query of many leaves is sent once for each group. A
group with many points or many queries is cut into cells of at most about `CELL_POINTS` and `CELL_QUERIES`, every part of the
queries meeting every part of the points, so no cell is unbounded and none is cut short. A cell gives the best of each query
among the leaves that it visits, by cosines in double precision of the original vectors.

Defined results: vectors that are null, empty, zero, hold null, NaN or infinite entries or are not of the commonest length (of
equals the longest), and rows with a null id, take no part; rows of a query's own id are not its neighbours; of several rows with
one id and one vector one counts; a repeated query is answered each time; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import stored
from gaugeline.llm.vectors import attached, matrix, usable

SAMPLE = 65_536
SAMPLE_NUMBERS = 8_000_000
LEAF_SAMPLE = 16
LEAF_ROWS = 512
BRANCH = 12
ROUNDS = 8
CALIBRATION = 256
RECALL = 0.96
CELL_POINTS = 32_768
CELL_QUERIES = 4_096
#: Queries, and points of a leaf, compared at a time.
BLOCK = 256
#: Cosines closer than this may change places when computed exactly.
CLOSE = 1e-9


def units(c: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by powers of two first, so that no square is lost."""
    c = _scaled(c)
    return c / np.sqrt((c * c).sum(axis=1, keepdims=True))


def _scaled(c: np.ndarray) -> np.ndarray:
    c = c.astype(float)
    _, exponent = np.frexp(np.abs(c).max(axis=1, keepdims=True))
    return np.ldexp(c, -exponent)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, which depends on the two vectors alone."""
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


@dataclass
class Tree:
    """Nodes with their centres; the root is node 0. `children` is empty for leaves, which `leaf` numbers (else -1)."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def place(self, u: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: down the nearest centres."""
        out = np.zeros(len(u), np.int32)
        waiting = [(0, np.arange(len(u)))]
        while waiting:
            node, rows = waiting.pop()
            below = self.children[node]
            if not len(below):
                out[rows] = self.leaf[node]
                continue
            nearest = (u[rows] @ self.centres[below].T).argmax(axis=1)
            waiting += [(int(child), rows[nearest == k]) for k, child in enumerate(below) if (nearest == k).any()]
        return out

    def bins(self, u: np.ndarray) -> Iterator[int]:
        """The leaves in the order in which a unit vector's search visits them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while len(below := self.children[node]):
                near = self.centres[below] @ u
                best = int(near.argmax())
                for k, child in enumerate(below.tolist()):
                    if k != best:
                        heapq.heappush(queue, (-float(near[k]), child))
                node = int(below[best])
            yield int(self.leaf[node])


def _clusters(u: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cluster of each unit vector by k-means on the sphere; clusters that lose all vectors vanish."""
    centres = u[rng.choice(len(u), k, replace=False)]
    for _ in range(ROUNDS):
        of = (u @ centres.T).argmax(axis=1)
        sums = np.zeros((len(centres), u.shape[1]))
        np.add.at(sums, of, u)
        length = np.sqrt((sums * sums).sum(axis=1))
        sums, length = sums[length > 0], length[length > 0]
        if not len(length):
            break
        centres = (sums / length[:, None]).astype(u.dtype)
    return (u @ centres.T).argmax(axis=1)


def grow(sample: np.ndarray, leaf_size: int, branch: int = BRANCH, seed: int = 11) -> Tree:
    """A tree over unit vectors whose leaves hold about `leaf_size` of them at most."""
    rng = np.random.default_rng(seed)
    centres, children, leaf = [], [], []

    def add(rows: np.ndarray) -> int:
        centre = sample[rows].sum(axis=0, dtype=float)
        length = np.sqrt(centre @ centre)
        centres.append(centre / length if length else sample[rows[0]])
        children.append(np.zeros(0, np.int64))
        leaf.append(-1)
        return len(leaf) - 1

    waiting, numbered = [(add(np.arange(len(sample))), np.arange(len(sample)))], 0
    while waiting:
        node, rows = waiting.pop()
        parts = []
        if len(rows) > leaf_size:
            of = _clusters(sample[rows], min(branch, -(-len(rows) // leaf_size)), rng)
            parts = [rows[of == k] for k in np.unique(of)]
        if len(parts) > 1:
            made = [(add(part), part) for part in parts]
            children[node] = np.array([n for n, _ in made])
            waiting += made
        else:
            leaf[node] = numbered
            numbered += 1
    return Tree(np.array(centres, np.float32), children, np.array(leaf))


def _points(vectors: DataFrame, id_: str, column: str, k: int) -> DataFrame:
    """`c, ids`: the different vectors, each with the k + 1 least of its ids."""
    rows = named(vectors, id_, column)
    again = stored(rows.groupBy("id").count().filter("count > 1").select("id"), "repeated-ids")
    if not again.isEmpty():
        rows = rows.join(again, "id", "left_anti").unionByName(rows.join(again, "id", "left_semi").distinct())
    order = F.row_number().over(Window.partitionBy("c").orderBy("id"))
    least = rows.withColumn("_at", order).filter(F.col("_at") <= k + 1)  # cut down before the shuffle, too
    return least.groupBy("c").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def named(vectors: DataFrame, id_: str, column: str) -> DataFrame:
    """`id, c` of the rows that take part."""
    rows = usable(vectors, id_, column).select(F.col(id_).alias("id"), "c")
    return rows.filter(F.col("id").isNotNull() & F.exists("c", lambda x: x != 0))


def fit(points: DataFrame, n: int, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE) -> Tree:
    """A tree for the n points, from a sample of them by a hash of the vector."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = units(matrix(batch.column("c"))).astype(np.float32) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in u], pa.binary())], ["u"])

    width = points.select(F.size("c").alias("d")).first()["d"]
    most = max(1, min(sample, SAMPLE_NUMBERS // width))
    share = min(1.0, 1.1 * most / n)
    hash_ = F.xxhash64("c")
    drawn = points.filter(F.pmod(hash_, F.lit(1_000_000)) < share * 1_000_000) if share < 1 else points
    rows = drawn.orderBy(hash_).limit(most).mapInArrow(shrink, "u binary").collect()
    u = np.array([np.frombuffer(r["u"], np.float32) for r in rows]) if rows else np.eye(1, width, dtype=np.float32)
    u = u[np.lexsort(u.T)]
    return grow(u, max(LEAF_SAMPLE if share < 1 else 1, -(-leaf_rows * len(u) // n)))


def _placed(points: DataFrame, tree: Tree) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(tree.place(units(matrix(batch.column("c"))).astype(np.float32)))
                yield pa.RecordBatch.from_arrays([leaf, *batch.columns], ["leaf", *batch.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInArrow(work, f"leaf int, {kinds}")


def _top(q: np.ndarray, p: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of p) that hold the k nearest of each q, and what lies as near as the last of them."""
    near = units(q) @ units(p).T
    if near.shape[1] > k:
        last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        return np.nonzero(near >= last[:, None] - CLOSE)
    return np.nonzero(np.ones_like(near, bool))


def true_leaves(placed: DataFrame, asked: np.ndarray, k: int) -> list[tuple[int, int]]:
    """For each of a bounded number of vectors its k nearest other points among all: (number of the vector, leaf)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, leaf = matrix(batch.column("c")), batch.column("leaf").to_numpy()
            for at in range(0, len(p), 16 * BLOCK):
                part = p[at : at + 16 * BLOCK]
                of, hit = _top(asked, part, k + 1)
                score = cosines(asked[of], part[hit])
                other = (asked[of] != part[hit]).any(axis=1)
                columns = [pa.array(of[other].astype(np.int32)), pa.array(leaf[at + hit[other]]), pa.array(score[other])]
                yield pa.RecordBatch.from_arrays(columns, ["of", "leaf", "score"])

    found = placed.select("leaf", "c").mapInArrow(work, "of int, leaf int, score double")
    at = F.row_number().over(Window.partitionBy("of").orderBy(F.desc("score"), "leaf"))
    rows = found.withColumn("_at", at).filter(F.col("_at") <= k).select("of", "leaf").collect()  # k a vector at most
    return [(r["of"], r["leaf"]) for r in rows]


def calibrate(tree: Tree, sizes: np.ndarray, asked: np.ndarray, found: list[tuple[int, int]], recall: float) -> int:
    """The number of leaves to visit for the wanted recall, from the leaves that hold the true neighbours of some vectors."""
    u = units(asked).astype(np.float32)
    wanted: dict[int, list[int]] = {}
    for of, leaf in found:
        wanted.setdefault(of, []).append(leaf)
    ranks = []
    for of, leaves in wanted.items():
        left, visit = list(leaves), 0
        for leaf in tree.bins(u[of]):
            visit += sizes[leaf] > 0
            ranks += [visit] * left.count(leaf)
            left = [x for x in left if x != leaf]
            if not left:
                break
    visits, ranks = 1, np.array(ranks)
    while len(ranks) and (ranks <= visits).mean() < recall:
        visits += max(1, visits // 8)
    return visits


def grouped(sizes: np.ndarray, most: int) -> np.ndarray:
    """The group of each leaf: neighbours, as long as they hold at most `most` points together."""
    out, group, held = np.zeros(len(sizes), np.int32), 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            group, held = group + 1, 0
        out[leaf], held = group, held + size
    return out


def _routed(asked: DataFrame, tree: Tree, sizes: np.ndarray, group: np.ndarray, visits: int, k: int) -> DataFrame:
    """`group, q, c, leaves`: every query once for each group of leaves that it visits some of."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, groups, leaves = [], [], []
            for at, u in enumerate(units(matrix(batch.column("c"))).astype(np.float32)):
                chosen, held = {}, 0
                for visited, leaf in enumerate(x for x in tree.bins(u) if sizes[x]):
                    if visited >= visits and held > k:
                        break
                    held += sizes[leaf]
                    chosen.setdefault(int(group[leaf]), []).append(leaf)
                rows += [at] * len(chosen)
                groups += chosen
                leaves += chosen.values()
            took = batch.take(pa.array(rows))
            columns = [pa.array(groups, pa.int32()), took.column("q"), took.column("c"), pa.array(leaves, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["group", "q", "c", "leaves"])

    kind = asked.schema["c"].dataType.simpleString()
    return asked.select("q", "c").mapInArrow(work, f"group int, q long, c {kind}, leaves array<int>")


def _best(of: np.ndarray, score: np.ndarray, id_: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of each query, of equals those with the least ids."""
    order = np.lexsort((id_, -score, of))
    of, score, id_ = of[order], score[order], id_[order]
    begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])[: len(of)]
    kept = np.arange(len(of)) - np.repeat(begins, np.diff(np.r_[begins, len(of)])) < k
    return of[kept], score[kept], id_[kept]


def _in_cells(placed: DataFrame, routed: DataFrame, group: np.ndarray, sizes: np.ndarray, k: int) -> DataFrame:
    """`q, id, score`: the k + 1 nearest that each cell has for each of its queries."""
    spark = placed.sparkSession
    held = np.bincount(group, sizes).astype(int).tolist()
    parts = spark.createDataFrame([(g, -(-n // CELL_POINTS)) for g, n in enumerate(held) if n], "group int, rs int")
    calls = routed.groupBy("group").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("qs"))
    # A row per group at most, so no more than the tree has leaves.
    cells = F.broadcast(stored(parts.join(calls, "group"), "cells"))
    names = F.broadcast(spark.createDataFrame(list(enumerate(group.tolist())), "leaf int, group int"))

    def dealt(rows: DataFrame, mine: str, others: str, by: Column, *columns: str) -> DataFrame:
        spread = rows.join(cells, "group").withColumn(mine, F.pmod(F.xxhash64(by), F.col(mine)).cast("int"))
        return spread.withColumn(others, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).select("group", "rs", "qs", *columns)

    here = dealt(placed.join(names, "leaf"), "rs", "qs", F.col("c"), "leaf", "c", "ids")
    there = dealt(routed, "qs", "rs", F.col("q"), "q", "c", "leaves")

    def meet(points: pa.Table, queries: pa.Table) -> pa.Table:
        points, queries = points.combine_chunks(), queries.combine_chunks()
        name = queries.column("q").to_numpy()
        out = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        if points.num_rows and queries.num_rows:
            p, q = matrix(points.column("c").chunk(0)), matrix(queries.column("c").chunk(0))
            ids, leaf = points.column("ids").chunk(0), points.column("leaf").to_numpy()
            starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            visited = queries.column("leaves").chunk(0)
            call = np.repeat(np.arange(len(q)), np.diff(visited.offsets.to_numpy()))
            called = visited.flatten().to_numpy()
            for one in np.unique(leaf):
                mine, askers = np.flatnonzero(leaf == one), call[called == one]
                for at in range(0, len(askers), BLOCK):
                    some = askers[at : at + BLOCK]
                    of, hit = _top(q[some], p[mine], k + 1)
                    of, hit = some[of], mine[hit]
                    score = cosines(q[of], p[hit])
                    many = starts[hit + 1] - starts[hit]  # every id of a point is a neighbour of its own
                    which = np.repeat(starts[hit], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    out.append(_best(name[np.repeat(of, many)], np.repeat(score, many), flat[which], k + 1))
        of, score, id_ = _best(*map(np.concatenate, zip(*out, strict=True)), k + 1)
        return pa.table({"q": of, "id": id_, "score": score})

    keys = ("group", "rs", "qs")
    return here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(meet, "q long, id long, score double")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_: str = "vec_id", column: str = "embedding",
           recall: float = RECALL, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE) -> DataFrame:
    """`query_id, rank, id_, score`: the k nearest found among `vectors` for every row of `queries`, both with `id_` and `column`."""
    result = f"query_id long, rank int, {id_} long, score double"
    points = stored(_points(vectors, id_, column, k), "points")
    wanted = named(queries, id_, column)
    asked = wanted.groupBy("c").agg(F.count("*").alias("copies")).withColumn("q", F.monotonically_increasing_id())
    asked = stored(asked, "different-queries")
    n, total = points.count(), asked.agg(F.sum("copies")).first()[0]
    if not n or not total:
        return vectors.sparkSession.createDataFrame([], result)
    tree = fit(points, n, leaf_rows, sample)
    placed = stored(_placed(points, tree), "placed")
    sizes = np.zeros(tree.leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():  # a row per leaf
        sizes[row["leaf"]] = row["count"]
    drawn = asked.orderBy(F.xxhash64("c"), "q").limit(CALIBRATION).select("c").collect()
    trial = np.array([r["c"] for r in drawn])
    visits = calibrate(tree, sizes, trial, true_leaves(placed, trial, k), recall)
    group = grouped(sizes, CELL_POINTS)
    routed = stored(_routed(asked, tree, sizes, group, visits, k), "routed")
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    best = _in_cells(placed, routed, group, sizes, k).withColumn("_at", best).filter(F.col("_at") <= k + 1)
    lists = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("_at", "id", "score"))).alias("found"))
    answers = stored(asked.join(lists, "q").select("c", "copies", "found"), "answers")
    rows = attached(wanted.select(F.col("id").alias("query_id"), "c"), answers, "c", F.col("copies"), total)
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    rows = rows.select("query_id", F.posexplode(others).alias("at", "x"))
    return rows.select(
        F.col("query_id").cast("long").alias("query_id"), (F.col("at") + 1).alias("rank"), F.col("x.id").alias(id_), F.col("x.score").alias("score")
    )
