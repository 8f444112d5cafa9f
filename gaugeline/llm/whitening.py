"""Whitening of quantised embeddings by a covariance over distinct vectors, weighted by their multiplicity or by one.

Entries c become whole numbers x = floor(scale * c). Rows of the same x vector are grouped (copies combine before the
shuffle, so a vector that a third of all rows have is a row per task there) and form the fit list: each distinct vector
with weight one, or with its number of rows. Everything else is done once per distinct vector:

1. Sums per dimension, as exact whole numbers.
2. The covariance by a weighted product of centred rows; a task holds one d x d matrix, and partial matrices are added
   up row by row in the cluster. The driver sees d sums and one d x d matrix, and takes its eigenvectors.
3. The distance from the mean, in whole numbers, and the projections over the roots of the eigenvalues.

Then every row gets what was found for its vector; a vector that is common among the rows is broadcast for that
(`vectors.attached`).

Defined results: rows whose vector is null, empty, or holds null, NaN or infinite entries, or is not of the commonest length
(of equals the longest), are left out; entries beyond a 64-bit number take its nearest end; rows with a null id and repeated
rows are returned each; a component is returned if its eigenvalue exceeds `LEAST` times the greatest, so none for a single
distinct vector; a deviation of more than 38 digits is null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored
from gaugeline.llm.vectors import attached, matrix, usable

SCALE = 256.0
MOST = 4
#: Share of the greatest eigenvalue below which double precision cannot tell one from zero to four digits.
LEAST = 1e-11

_EXACT = pa.decimal128(38, 0)
_BOUND = 1 << 63


@dataclass
class Fit:
    """What the fit list says: its weight, the sums per dimension, eigenvalues (falling), unit eigenvectors as rows."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray

    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def quantised(vectors: DataFrame, id_: str, column: str, scale: float = SCALE) -> DataFrame:
    """`id_` and `x`, the vector in whole numbers."""
    return usable(vectors, id_, column).select(id_, F.transform("c", lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def _weights(batch: pa.RecordBatch, counted: bool) -> np.ndarray:
    copies = batch.column("copies").to_numpy()
    return copies if counted else np.ones_like(copies)


def _reach(x: np.ndarray) -> int:
    """The greatest absolute value, as a Python number."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _sums(points: DataFrame, counted: bool) -> tuple[int, list[int]]:
    """The weight of the fit list and its exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = 0, None
        for batch in batches:
            x, w = matrix(batch.column("x")), _weights(batch, counted)
            if not len(x):
                continue
            weight += int(w.sum())
            if _reach(x) * int(w.sum()) >= _BOUND:
                x, w = x.astype(object), w.astype(object)
            part = [int(s) for s in (x * w[:, None]).sum(axis=0)]
            total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        if total is not None:
            numbers = pa.array([Decimal(t) for t in [weight, *total]], _EXACT)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total) + 1), pa.int32()), numbers], ["dim", "total"])

    parts = points.mapInArrow(add, "dim int, total decimal(38,0)")
    weight, *sums = [int(r["total"]) for r in parts.groupBy("dim").agg(F.sum("total").alias("total")).orderBy("dim").collect()]
    return weight, sums


def _covariance(points: DataFrame, mean: np.ndarray, weight: int, counted: bool) -> np.ndarray:
    """The weighted product of the centred rows, over the weight."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                centred = matrix(batch.column("x")) - mean
                part = (centred * _weights(batch, counted)[:, None]).T @ centred
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total))], ["dim", "part"])

    def add(rows: pa.Table) -> pa.Table:
        total = matrix(rows.column("part").combine_chunks()).sum(axis=0)
        return pa.table({"dim": rows.column("dim").slice(0, 1), "total": pa.array([total])})

    parts = points.mapInArrow(multiply, "dim int, part array<double>").groupBy("dim").applyInArrow(add, "dim int, total array<double>")
    rows = parts.orderBy("dim").collect()  # d rows of d numbers
    both = np.array([r["total"] for r in rows]) / weight
    return (both + both.T) / 2


def fit(points: DataFrame, counted: bool = False, most: int = MOST) -> Fit:
    """The eigenvectors of the covariance of `points` (`x, copies`; at least one); with `counted` a point weighs its copies."""
    n, sums = _sums(points, counted)
    found = Fit(n, sums, 0.0, np.zeros(0), np.zeros((0, len(sums))))
    covariance = _covariance(points, found.mean(), n, counted)
    values, columns = np.linalg.eigh(covariance)
    values, rows = values[::-1], columns.T[::-1]
    kept = np.flatnonzero(values[:most] > LEAST * max(values[0], 0.0))
    return Fit(n, sums, float(np.trace(covariance)), values[kept], rows[kept])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Per row the exact sum of (n * x - S) squared."""
    reach = n * _reach(x) + max(map(abs, sums), default=0)
    if len(sums) * reach * reach < _BOUND:
        apart = n * x.astype(np.int64) - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = n * x.astype(object) - np.array(sums, object)
    return (apart * apart).sum(axis=1).tolist()


def whitened(points: DataFrame, found: Fit) -> DataFrame:
    """`x, copies, deviation, y`: every distinct vector's distance from the mean and its whitened components."""
    mean, project = found.mean(), (found.components / np.sqrt(found.values)[:, None]).T

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"))
            if not len(x):
                continue
            apart = [Decimal(v) if v < 10**38 else None for v in deviations(x, found.n, found.sums)]
            y = pa.array(list((x - mean) @ project), pa.list_(pa.float64()))
            columns = [batch.column("x"), batch.column("copies"), pa.array(apart, _EXACT), y]
            yield pa.RecordBatch.from_arrays(columns, ["x", "copies", "deviation", "y"])

    return points.mapInArrow(work, "x array<bigint>, copies long, deviation decimal(38,0), y array<double>")


def identity_error(done: DataFrame, found: Fit, counted: bool = False) -> float:
    """How far the covariance of the whitened points is from the identity, by the largest entry."""
    k = len(found.values)
    if not k:
        return 0.0
    weight = F.col("copies") if counted else F.lit(1)
    means = done.agg(*[F.sum(F.col("y")[i] * weight) / found.n for i in range(k)]).first()
    apart = [F.col("y")[i] - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    got = done.agg(*[F.sum(apart[i] * apart[j] * weight) / found.n for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(got, pairs, strict=True))


def whiten(vectors: DataFrame, id_: str = "vec_id", column: str = "embedding", scale: float = SCALE, counted: bool = False,
           most: int = MOST) -> tuple[DataFrame, Fit | None, float]:
    """`id_, x, copies, deviation, y` of every usable row, the fit (None without rows), and the identity error."""
    rows = quantised(vectors, id_, column, scale)
    points = stored(rows.groupBy("x").agg(F.count("*").alias("copies")), "points")
    total = points.agg(F.sum("copies")).first()[0]
    if not total:
        empty = points.withColumns({"deviation": F.lit(None).cast("decimal(38,0)"), "y": F.array().cast("array<double>")})
        return rows.join(empty, "x"), None, 0.0
    found = fit(points, counted, most)
    done = stored(whitened(points, found), "whitened")
    return attached(rows, done, "x", F.col("copies"), total), found, identity_error(done, found, counted)


def by_component(rows: DataFrame, found: Fit | None, error: float, id_: str = "vec_id") -> DataFrame:
    """A row per vector and component: n, deviation (null beyond 64 bits), whitened, explained, identity_error."""
    shares = F.array(*[F.lit(s) for s in found.explained()] if found else []).cast("array<double>")
    spread = rows.select(F.col(id_), F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("y").alias("at", "whitened"))
    return spread.select(
        id_,
        (F.col("at") + 1).alias("component"),
        F.lit(found.n if found else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
