"""Detectors over many windows at once, and the rules that say which metric gets which.

A detector sees a block of windows, one per scored sample. Its answer for a sample depends on that sample's window
alone, the scored value included.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from typing import Protocol

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The window, the detectors' constants and the floors of each metric.
WINDOW_POINTS = 360

MAD_MIN_POINTS = 20
MAD_SIGMA = 1.4826
MAD_MEAN_SIGMA = 1.253314
MAD_THRESHOLD = 3.5

EWMA_ALPHA = 0.1
EWMA_WARMUP_READINGS = 10
EWMA_MIN_POINTS = 11
EWMA_MULTIPLIER = 3.0
EWMA_MIN_DEVIATION = 10.0
EWMA_DAMPING = 0.1
EWMA_THRESHOLD = 1.0

CPU_METRIC = "system.cpu.utilization"
MEMORY_METRIC = "system.memory.usage"
REPLAYED_PREFIX = "nab."
CPU_MIN_DEVIATION = 10.0
MEMORY_MIN_RELATIVE = 0.02


class Windows:
    """A block of windows cut from one array: window i is `lengths[i]` values from `first[i]` on, oldest first."""

    def __init__(self, source: np.ndarray, first: np.ndarray, lengths: np.ndarray):
        self.first, self.lengths = first, lengths
        self.width = int(lengths.max())
        self.source = np.append(source, np.full(self.width - 1, np.nan))
        self._adjacent = bool((np.diff(first) == 1).all())

    @classmethod
    def of(cls, *windows: list[float]) -> Windows:
        lengths = np.array([len(w) for w in windows])
        return cls(np.array([v for w in windows for v in w], dtype=float), np.cumsum(lengths) - lengths, lengths)

    def __len__(self) -> int:
        return len(self.lengths)

    def step(self, k: int) -> np.ndarray:
        """Value k of every window; anything where a window is shorter."""
        if self._adjacent:
            return self.source[self.first[0] + k : self.first[-1] + k + 1]
        return self.source[self.first + k]

    def newest(self) -> np.ndarray:
        return self.source[self.first + self.lengths - 1]

    def matrix(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Windows `begin` to `end` as rows; the cells after a shorter window are NaN."""
        first, lengths = self.first[begin:end], self.lengths[begin:end]
        rows = np.lib.stride_tricks.sliding_window_view(self.source, self.width)[first]
        if lengths.min() < self.width:
            rows[np.arange(self.width)[None, :] >= lengths[:, None]] = np.nan
        return rows

    def lists(self) -> Iterator[list[float]]:
        for begin, length in zip(self.first, self.lengths, strict=True):
            yield self.source[begin : begin + length].tolist()


@dataclass(frozen=True)
class Bands:
    """Per window the line, its band and whether the newest value is outside. No `lower` means no lower band."""

    baseline: np.ndarray
    lower: np.ndarray | None
    upper: np.ndarray
    is_anomaly: np.ndarray


class Detector(Protocol):
    name: str
    min_points: int
    min_deviation: float
    min_relative: float

    def evaluate(self, windows: Windows) -> Bands: ...


def _medians(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Median of each row's first `lengths` cells, NaN if one of them is; the cells after them must be NaN."""
    width = values.shape[1]
    whole = lengths == width
    if whole.all():
        middle = width // 2
        split = np.partition(values, middle, axis=1)
        upper = split[:, middle]
        lower = upper if width % 2 else split[:, :middle].max(axis=1)
        return np.where(np.isnan(values.max(axis=1)), np.nan, (lower + upper) / 2)
    result = np.empty(len(lengths))
    if whole.any():
        result[whole] = _medians(values[whole], lengths[whole])
    short = lengths[~whole]
    ranked = np.sort(values[~whole], axis=1)
    rows = np.arange(len(short))
    middles = (ranked[rows, (short - 1) // 2] + ranked[rows, short // 2]) / 2
    result[~whole] = np.where(np.isnan(ranked[rows, short - 1]), np.nan, middles)
    return result


# Rows of the window matrix handled at a time: 128 x 360 doubles stay in a core's cache.
_MATRIX_ROWS = 128


def rolling_spread(windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window the median, the median deviation from it and the mean deviation."""
    parts = []
    with np.errstate(all="ignore"):
        for at in range(0, len(windows), _MATRIX_ROWS):
            rows, lengths = windows.matrix(at, at + _MATRIX_ROWS), windows.lengths[at : at + _MATRIX_ROWS]
            median = _medians(rows, lengths)
            rows -= median[:, None]
            np.abs(rows, out=rows)
            mean = np.nansum(rows, axis=1) / lengths
            parts.append((median, _medians(rows, lengths), np.where(np.isnan(median), np.nan, mean)))
    median, spread, mean = (np.concatenate(column) for column in zip(*parts, strict=True))
    return median, spread, mean


@dataclass(frozen=True)
class MAD:
    """Modified z-score of the newest value against the median of its window, in both directions."""

    min_deviation: float = 0.0
    min_relative: float = 0.0
    name: str = "mad"
    min_points: int = MAD_MIN_POINTS

    def evaluate(self, windows: Windows) -> Bands:
        median, deviation, mean_deviation = rolling_spread(windows)
        with np.errstate(all="ignore"):
            spread = np.where(deviation == 0, MAD_MEAN_SIGMA * mean_deviation, MAD_SIGMA * deviation)
            floor = np.fmax(self.min_deviation, self.min_relative * np.abs(median)) / MAD_THRESHOLD
            scale = np.maximum(spread, floor)
            margin = MAD_THRESHOLD * scale
            newest = np.abs(windows.newest() - median)
            flagged = (scale > 0) & (newest / scale >= MAD_THRESHOLD)
            return Bands(median, median - margin, median + margin, flagged)


@dataclass(frozen=True)
class EWMA:
    """Rise of the newest value above a weighted average that starts at the oldest value of the window.

    The average is worked out anew for every window: where the window slides, its starting value moves too.
    """

    min_deviation: float = EWMA_MIN_DEVIATION
    min_relative: float = 0.0
    name: str = "ewma"
    min_points: int = EWMA_MIN_POINTS

    def evaluate(self, windows: Windows) -> Bands:
        lengths = windows.lengths
        if lengths.min() < self.min_points:
            raise ValueError(f"the shortest window holds {lengths.min()} of the {self.min_points} values that {self.name} starts from")
        ending = {int(k): np.flatnonzero(lengths == k) for k in np.unique(lengths)}
        size = len(windows)
        baseline, upper, flagged = np.empty(size), np.empty(size), np.zeros(size, dtype=bool)
        average, variance = windows.step(0).copy(), np.zeros(size)
        rise, scale, floor, work = np.empty(size), np.empty(size), np.empty(size), np.empty(size)
        damped = EWMA_ALPHA * EWMA_DAMPING
        with np.errstate(all="ignore"):
            for index in range(1, windows.width):
                np.subtract(windows.step(index), average, out=rise)
                np.sqrt(variance, out=scale)
                scale *= EWMA_MULTIPLIER
                if self.min_relative:
                    np.abs(average, out=floor)
                    floor *= self.min_relative
                    np.maximum(scale, np.fmax(floor, self.min_deviation, out=floor), out=scale)
                elif self.min_deviation:
                    np.maximum(scale, self.min_deviation, out=scale)
                # Without any scale a rise is infinitely far out, a fall as far below, and no change is not a number.
                over = np.divide(rise, scale, out=work) > EWMA_THRESHOLD
                done = ending.get(index + 1)
                if done is not None:
                    baseline[done] = average[done]
                    upper[done] = average[done] + EWMA_THRESHOLD * scale[done]
                    flagged[done] = over[done]
                if index >= EWMA_WARMUP_READINGS:
                    alpha, rest = np.where(over, damped, EWMA_ALPHA), np.where(over, 1 - damped, 1 - EWMA_ALPHA)
                else:
                    alpha, rest = EWMA_ALPHA, 1 - EWMA_ALPHA
                average += np.multiply(alpha, rise, out=work)
                np.multiply(rise, rise, out=work)
                work *= alpha
                variance += work
                variance *= rest
        return Bands(baseline, None, upper, flagged)


@dataclass(frozen=True)
class OneWindow:
    """A detector written for a single window: `judge(values) -> (baseline, lower or None, upper, is_anomaly)`."""

    name: str
    min_points: int
    judge: Callable[[list[float]], tuple[float, float | None, float, bool]]
    min_deviation: float = 0.0
    min_relative: float = 0.0

    def evaluate(self, windows: Windows) -> Bands:
        answers = [self.judge(window) for window in windows.lists()]
        baseline, lower, upper, flagged = zip(*answers, strict=True)
        low = np.array([np.nan if v is None else v for v in lower], dtype=float)
        return Bands(
            np.array(baseline, dtype=float),
            None if all(v is None for v in lower) else low,
            np.array(upper, dtype=float),
            np.array(flagged, dtype=bool),
        )


@dataclass(frozen=True)
class MeanMultiple:
    """Flags what exceeds a multiple of its window's mean."""

    name: str
    min_points: int
    factor: float
    min_deviation: float = 0.0
    min_relative: float = 0.0

    def evaluate(self, windows: Windows) -> Bands:
        total = np.zeros(len(windows))
        for k in range(windows.width):
            total += np.where(k < windows.lengths, windows.step(k), 0.0)
        mean = total / windows.lengths
        return Bands(mean, None, self.factor * mean, windows.newest() > self.factor * mean)


@dataclass(frozen=True)
class Rule:
    pattern: str
    is_prefix: bool
    detectors: tuple[Detector, ...]


@dataclass(frozen=True)
class Registry:
    """Which detectors score a metric: prefixes are tried first, then exact names; anything else is not scored."""

    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def register(self, pattern: str, detectors: list[Detector], is_prefix: bool = False) -> Registry:
        kept = tuple(r for r in self.rules if (r.pattern, r.is_prefix) != (pattern, is_prefix))
        return replace(self, rules=(*kept, Rule(pattern, is_prefix, tuple(detectors))))

    def _ranked(self) -> list[Rule]:
        return sorted(self.rules, key=lambda rule: not rule.is_prefix)

    def rule_for(self, name: str) -> Rule | None:
        for rule in self._ranked():
            if name.startswith(rule.pattern) if rule.is_prefix else name == rule.pattern:
                return rule
        return None

    def matched_pattern(self, name: Column) -> Column:
        """The pattern of the rule that applies to `name`, null for an unscored metric."""
        result = F.lit(None).cast("string")
        for rule in reversed(self._ranked()):
            hit = F.startswith(name, F.lit(rule.pattern)) if rule.is_prefix else name == F.lit(rule.pattern)
            result = F.when(hit, F.lit(rule.pattern)).otherwise(result)
        return result

    def is_scored(self, name: Column) -> Column:
        return F.coalesce(self.matched_pattern(name).isNotNull(), F.lit(False))

    def config_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (rule.pattern, d.name, int(d.min_points), float(d.min_deviation), float(d.min_relative))
            for rule in self.rules
            for d in rule.detectors
        ]
        return spark.createDataFrame(
            rows, "pattern string, algorithm string, min_points int, min_deviation double, min_relative double"
        )

    def algorithms(self) -> list[str]:
        return sorted({d.name for rule in self.rules for d in rule.detectors})


DEFAULT_REGISTRY = (
    Registry()
    .register(CPU_METRIC, [MAD(min_deviation=CPU_MIN_DEVIATION), EWMA(min_deviation=CPU_MIN_DEVIATION)])
    .register(
        MEMORY_METRIC,
        [MAD(min_relative=MEMORY_MIN_RELATIVE), EWMA(min_deviation=0.0, min_relative=MEMORY_MIN_RELATIVE)],
    )
    .register(REPLAYED_PREFIX, [MAD(), EWMA(min_deviation=0.0)], is_prefix=True)
)


def detector_config(samples: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Each scored sample with each of its detectors and their floors."""
    config = registry.config_frame(samples.sparkSession)
    return samples.withColumn("pattern", registry.matched_pattern(F.col("name"))).join(
        F.broadcast(config), "pattern"  # a row per registered detector
    )
