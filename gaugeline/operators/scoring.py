"""Samples to evaluations: one row per scored sample and warm detector, anomalous or not."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators.detectors import (
    DEFAULT_REGISTRY,
    WINDOW_POINTS,
    Bands,
    Registry,
    Windows,
    detector_config,
    rolling_spread,
)
from gaugeline.operators.ordering import Kernel, over_runs
from gaugeline.schemas import INSERT_SEQ

SERIES = ("machine_id", "name")
DEFAULT_ORDER = ("timestamp", "metric_id")

# Windows handed to a detector at a time.
BLOCK_ROWS = 4_096

# Told the detector's name, the number of windows and the seconds they took.
Observer = Callable[[str, int, float], None]


def evaluation_schema(samples: DataFrame) -> T.StructType:
    """The evaluation record, with the sample's own kind of time."""
    return T.StructType(
        [
            T.StructField("metric_id", T.StringType()),
            T.StructField("machine_id", T.StringType()),
            T.StructField("metric_name", T.StringType()),
            T.StructField("timestamp", samples.schema["timestamp"].dataType),
            T.StructField("algorithm", T.StringType()),
            T.StructField("baseline", T.DoubleType()),
            T.StructField("lower", T.DoubleType()),
            T.StructField("upper", T.DoubleType()),
            T.StructField("is_anomaly", T.BooleanType()),
        ]
    )


def window_blocks(
    values: np.ndarray, series_start: np.ndarray, rows: np.ndarray, window: int
) -> Iterator[tuple[np.ndarray, Windows]]:
    """The windows that end at `rows`, never reaching behind the row's `series_start`, in blocks of bounded size."""
    for at in range(0, len(rows), BLOCK_ROWS):
        block = rows[at : at + BLOCK_ROWS]
        first = np.maximum(series_start[block], block - window + 1)
        yield block, Windows(values, first, block - first + 1)


def score_values(
    values: np.ndarray,
    series_start: np.ndarray,
    own: np.ndarray,
    names: list[str],
    name_codes: np.ndarray,
    registry: Registry,
    window: int,
    observe: Observer | None = None,
) -> Iterator[tuple[np.ndarray, str, Bands]]:
    """Score the `own` rows of a run of values in series order, all rows under one rule together."""
    codes_by_rule: dict = {}
    for code, name in enumerate(names):
        rule = registry.rule_for(name)
        if rule is not None:
            codes_by_rule.setdefault(rule.pattern, (rule, []))[1].append(code)
    points = np.minimum(np.arange(len(values)) - series_start + 1, window)
    for rule, codes in codes_by_rule.values():
        ruled = own & np.isin(name_codes, codes)
        for detector in rule.detectors:
            warm = np.flatnonzero(ruled & (points >= detector.min_points))
            for block, windows in window_blocks(values, series_start, warm, window):
                started = time.perf_counter()
                bands = detector.evaluate(windows)
                if observe:
                    observe(detector.name, len(block), time.perf_counter() - started)
                yield block, detector.name, bands


def _flat(table: pa.Table, column: str) -> pa.Array:
    chunked = table.column(column)
    return chunked.combine_chunks() if isinstance(chunked, pa.ChunkedArray) else chunked


def series_starts(table: pa.Table, columns: tuple[str, ...] = SERIES) -> np.ndarray:
    """Per row of a sorted table the index of the first row of its series."""
    fresh = np.zeros(table.num_rows, dtype=bool)
    fresh[:1] = True
    for column in columns:
        values = _flat(table, column)
        fresh[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    return np.maximum.accumulate(np.where(fresh, np.arange(table.num_rows), 0))


def score_table(
    table: pa.Table, registry: Registry, window: int, observe: Observer | None = None, timed: bool = False
) -> pa.Table:
    """Evaluations of the `_own` rows of a run of rows in order; with `timed` the time that each took, as `_micros`."""
    spent: list[float] = []

    def watch(name: str, rows: int, seconds: float) -> None:
        spent.append(1e6 * seconds / max(rows, 1))
        if observe:
            observe(name, rows, seconds)

    values = _flat(table, "value").to_numpy(zero_copy_only=False)
    encoded = pc.dictionary_encode(_flat(table, "name"))
    rows, algorithms, baseline, lower, upper, flagged, no_lower = [], [], [], [], [], [], []
    for block, algorithm, bands in score_values(
        values,
        series_starts(table),
        _flat(table, "_own").to_numpy(zero_copy_only=False),
        encoded.dictionary.to_pylist(),
        encoded.indices.to_numpy(zero_copy_only=False),
        registry,
        window,
        watch,
    ):
        rows.append(block)
        algorithms.extend([algorithm] * len(block))
        baseline.append(bands.baseline)
        lower.append(np.zeros(len(block)) if bands.lower is None else bands.lower)
        no_lower.append(np.full(len(block), bands.lower is None))
        upper.append(bands.upper)
        flagged.append(bands.is_anomaly)

    def column(parts: list[np.ndarray], kind: type) -> np.ndarray:
        return np.concatenate(parts) if parts else np.empty(0, dtype=kind)

    taken = table.take(pa.array(column(rows, np.int64)))
    result = pa.table(
        {
            "metric_id": taken["metric_id"],
            "machine_id": taken["machine_id"],
            "metric_name": taken["name"],
            "timestamp": taken["timestamp"],
            "algorithm": pa.array(algorithms, pa.string()),
            "baseline": pa.array(column(baseline, float), pa.float64()),
            "lower": pa.array(column(lower, float), pa.float64(), mask=column(no_lower, bool)),
            "upper": pa.array(column(upper, float), pa.float64()),
            "is_anomaly": pa.array(column(flagged, bool), pa.bool_()),
        }
    )
    if timed:
        each = [np.full(len(block), micros) for block, micros in zip(rows, spent, strict=True)]
        result = result.append_column("_micros", pa.array(column(each, float), pa.float64()))
    return result


def over_series(
    samples: DataFrame,
    window: int,
    kernel: Kernel,
    schema: T.StructType | str,
    order: tuple[str, ...] = DEFAULT_ORDER,
    registry: Registry | None = DEFAULT_REGISTRY,
    version: str | None = None,
) -> DataFrame:
    """What `kernel` gives for the samples, series by series, each with the `window - 1` rows before it.

    With a registry, samples that no detector scores are dropped first: they take no part in any window.
    """
    rows = samples if registry is None else samples.where(registry.is_scored(F.col("name")))
    wanted = list(dict.fromkeys([*SERIES, *order, "metric_id", "timestamp", "value"]))
    if version:
        wanted += [c for c in (version, INSERT_SEQ) if c in samples.columns]
    return over_runs(rows.select(*wanted), [*SERIES, *order], window - 1, kernel, schema, version)


def score(
    samples: DataFrame,
    *,
    window: int = WINDOW_POINTS,
    order: tuple[str, ...] = DEFAULT_ORDER,
    registry: Registry = DEFAULT_REGISTRY,
    observe: Observer | None = None,
    timed: bool = False,
    version: str | None = None,
) -> DataFrame:
    """Evaluations of deduplicated samples; with `timed` the microseconds that each took, as `_micros`. `order` is the order of arrival within a series, unique per row:
    `("partition", "offset")` where samples carry them, else time and id.

    Samples that are read as stored need not be deduplicated: with their `version`, the last of a sample's rows is picked
    where they are sorted anyway. Its copies meet in one task, so for keys with very many copies collapse them before.
    """

    def kernel(table: pa.Table) -> pa.Table:
        return score_table(table, registry, window, observe, timed)

    schema = evaluation_schema(samples)
    if timed:
        schema = schema.add("_micros", T.DoubleType())
    return over_series(samples, window, kernel, schema, order, registry, version)


def detector_costs(
    samples: DataFrame,
    window: int = WINDOW_POINTS,
    order: tuple[str, ...] = DEFAULT_ORDER,
    registry: Registry = DEFAULT_REGISTRY,
) -> DataFrame:
    """Per detector the `calls` and `micros` that scoring the samples takes.

    Every run of rows reports its own as rows, so a task that is run again is not counted twice.
    """

    def kernel(table: pa.Table) -> pa.Table:
        noted: list[tuple[str, int, float]] = []
        score_table(table, registry, window, lambda *seen: noted.append(seen))
        algorithms, calls, seconds = zip(*noted, strict=True) if noted else ((), (), ())
        micros = pa.array([second * 1e6 for second in seconds], pa.float64())
        return pa.table({"algorithm": pa.array(algorithms, pa.string()), "calls": pa.array(calls, pa.int64()), "micros": micros})

    noted = over_series(samples, window, kernel, "algorithm string, calls long, micros double", order, registry)
    return noted.groupBy("algorithm").agg(F.sum("calls").alias("calls"), F.sum("micros").alias("micros"))


def _sample_schema(samples: DataFrame, **more: T.DataType) -> T.StructType:
    fields = [T.StructField(c, samples.schema[c].dataType) for c in ("metric_id", *SERIES, "timestamp", "value")]
    return T.StructType([*fields, *[T.StructField(name, kind) for name, kind in more.items()]])


def _own(table: pa.Table) -> np.ndarray:
    return np.flatnonzero(_flat(table, "_own").to_numpy(zero_copy_only=False))


def _with_columns(table: pa.Table, rows: np.ndarray, **columns: pa.Array) -> pa.Table:
    result = table.take(pa.array(rows, pa.int64())).select(["metric_id", *SERIES, "timestamp", "value"])
    for name, column in columns.items():
        result = result.append_column(name, column)
    return result


def window_points(
    samples: DataFrame, window: int = WINDOW_POINTS, order: tuple[str, ...] = DEFAULT_ORDER
) -> DataFrame:
    """Per scored sample the number of values in its window."""

    def kernel(table: pa.Table) -> pa.Table:
        own = _own(table)
        points = np.minimum(own - series_starts(table)[own] + 1, window)
        return _with_columns(table, own, points=pa.array(points, pa.int64()))

    return over_series(samples, window, kernel, _sample_schema(samples, points=T.LongType()), order)


def warm_detectors(samples: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Per scored sample the detectors that have enough values to speak."""
    points = window_points(samples)
    return detector_config(points, registry).where(F.col("points") >= F.col("min_points")).drop("pattern")


def rolling_median(
    samples: DataFrame, window: int = WINDOW_POINTS, order: tuple[str, ...] = DEFAULT_ORDER
) -> DataFrame:
    return rolling_mad(samples, window, order).select("metric_id", *SERIES, "timestamp", "value", "median")


def rolling_mad(samples: DataFrame, window: int = WINDOW_POINTS, order: tuple[str, ...] = DEFAULT_ORDER) -> DataFrame:
    """Rolling median, the median of the deviations from it, and their mean, which stands in for it when it is 0."""
    names = ("median", "mad", "mean_deviation")

    def kernel(table: pa.Table) -> pa.Table:
        values = _flat(table, "value").to_numpy(zero_copy_only=False)
        blocks = window_blocks(values, series_starts(table), _own(table), window)
        parts = [(block, *rolling_spread(windows)) for block, windows in blocks]
        rows, *found = (np.concatenate(column) for column in zip(*parts, strict=True)) if parts else (np.empty(0, int),) * 4
        return _with_columns(table, rows, **{n: pa.array(c, pa.float64()) for n, c in zip(names, found, strict=True)})

    return over_series(samples, window, kernel, _sample_schema(samples, **dict.fromkeys(names, T.DoubleType())), order)
