"""Scoring a stream: per series the last values are kept as state, and every scored sample is judged as it arrives.

Two ways, with the same results. `score_stream` keeps the values in Spark's state store, keyed by series: for live
data, where a trigger lets in a few rows of each series. `start_bulk_scoring` keeps them in a small table beside the
checkpoint and scores each micro-batch like a table, cut into even chunks whatever the series: for a backlog, or where
one series may fill a large part of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gaugeline.functions.scalars import epoch_to_timestamp
from gaugeline.operators.detectors import DEFAULT_REGISTRY, WINDOW_POINTS, Registry
from gaugeline.operators.scoring import DEFAULT_ORDER, SERIES, Observer, evaluation_schema, score, score_values
from gaugeline.session import delete_path, materialise, release
from gaugeline.streaming.sinks import JobCounters

WATERMARK = "5 seconds"


def _numbers(values: np.ndarray, missing: bool = False) -> pd.arrays.FloatingArray:
    """Doubles in which not a number stays one, apart from null."""
    return pd.arrays.FloatingArray(values, np.full(len(values), missing))


def score_stream(
    samples: DataFrame,
    *,
    watermark: str = WATERMARK,
    window: int = WINDOW_POINTS,
    order: tuple[str, ...] = DEFAULT_ORDER,
    registry: Registry = DEFAULT_REGISTRY,
    idle_timeout_ms: int | None = None,
    observe: Observer | None = None,
) -> DataFrame:
    """Evaluations of a stream of samples, in the order of `order` within each micro-batch of a series.

    The watermark closes nothing: late samples are scored too, where they arrive. State is the last `window` values of a
    series, so its size follows the number of series. It never expires unless `idle_timeout_ms` is set. A micro-batch
    holds what its trigger lets in (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`), which bounds a series' share of it.
    The number of shuffle partitions is fixed by the first run of a checkpoint.
    """
    scored = (
        _scored(samples, order, registry)
        .withColumn("event_time", epoch_to_timestamp(F.col("timestamp")))
        .withWatermark("event_time", watermark)
    )

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)
        kept = np.array(state.get[0], dtype=float) if state.exists else np.empty(0)
        values = np.concatenate([kept, rows["value"].to_numpy(dtype=float)])
        own = np.arange(len(values)) >= len(kept)
        origin = np.zeros(len(values), dtype=int)
        for block, algorithm, bands in score_values(
            values, origin, own, [key[1]], np.zeros(len(values), dtype=int), registry, window, observe
        ):
            chosen = rows.iloc[block - len(kept)]
            yield pd.DataFrame(
                {
                    "metric_id": chosen["metric_id"].to_numpy(),
                    "machine_id": key[0],
                    "metric_name": key[1],
                    "timestamp": chosen["timestamp"].to_numpy(),
                    "algorithm": algorithm,
                    "baseline": _numbers(bands.baseline),
                    "lower": _numbers(np.zeros(len(block)), True) if bands.lower is None else _numbers(bands.lower),
                    "upper": _numbers(bands.upper),
                    "is_anomaly": bands.is_anomaly,
                }
            )
        state.update((values[-window:].tolist(),))
        if idle_timeout_ms is not None:
            state.setTimeoutDuration(idle_timeout_ms)

    timeout = GroupStateTimeout.NoTimeout if idle_timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return scored.groupBy(*SERIES).applyInPandasWithState(
        advance, evaluation_schema(samples), "recent array<double>", "append", timeout
    )


_AGE = "_age"


def _scored(samples: DataFrame, order: tuple[str, ...], registry: Registry) -> DataFrame:
    """Of the samples that a detector scores, what scoring asks for."""
    columns = list(dict.fromkeys(["metric_id", *SERIES, "timestamp", "value", *order]))
    return samples.where(registry.is_scored(F.col("name"))).select(*columns)


def _newest_values(rows: DataFrame, order: tuple[str, ...], count: int) -> DataFrame:
    """Per series the last `count` values, the newest with age 1. Spark cuts a series down to `count` rows in every map
    task before it brings them together."""
    newest_first = [F.col(_AGE).asc_nulls_first(), *[F.col(c).desc() for c in order]]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*SERIES).orderBy(*newest_first)))
    return ranked.where(F.col("_rank") <= count).select(*SERIES, F.col("_rank").alias(_AGE), "value")


def score_after(
    state: DataFrame | None,
    batch: DataFrame,
    *,
    window: int = WINDOW_POINTS,
    order: tuple[str, ...] = DEFAULT_ORDER,
    registry: Registry = DEFAULT_REGISTRY,
    timed: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Evaluations of a batch of samples that follow the values of `state`, and the state after them."""
    rows = _scored(batch, order, registry).withColumn(_AGE, F.lit(None).cast("int"))
    if state is not None:
        rows = rows.unionByName(state, allowMissingColumns=True)
    # Earlier values first, the oldest at the head, then the batch in its own order.
    rows = rows.withColumn("_before", F.coalesce(-F.col(_AGE), F.lit(0)))
    scored = score(rows, window=window, order=("_before", *order), registry=registry, timed=timed)
    return scored.where(F.col("metric_id").isNotNull()), _newest_values(rows, order, window - 1)


def start_bulk_scoring(
    samples: DataFrame,
    publish: Callable[[DataFrame, int], None],
    state_path: str,
    checkpoint: str,
    *,
    trigger: str | None = None,
    window: int = WINDOW_POINTS,
    order: tuple[str, ...] = DEFAULT_ORDER,
    registry: Registry = DEFAULT_REGISTRY,
    counters_root: str | None = None,
) -> StreamingQuery:
    """Score a stream batch by batch and hand each batch's evaluations to `publish(evaluations, batch_id)`.

    With `counters_root` the evaluations, and per algorithm its scores and their microseconds, are counted in the job in which
    `publish` writes them (it must write them), and reported there.

    The state after a batch is written under the batch's number, before the batch counts as done: a batch that is run
    again starts from the state before it and writes the same once more.
    """

    def version(batch_id: int) -> str:
        return f"{state_path}/batch-{batch_id}"

    counters = JobCounters()
    algorithms = sorted({detector.name for rule in registry.rules for detector in rule.detectors})

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = spark.read.parquet(version(batch_id - 1)) if batch_id else None
        rows = materialise(_scored(batch, order, registry), "scored-batch")
        counted = counters_root is not None
        scored, after = score_after(state, rows, window=window, order=order, registry=registry, timed=counted)
        if counted:
            seen, mine = Observation(), lambda name: F.col("algorithm") == name
            scored = scored.observe(
                seen,
                *[F.count_if(mine(name)).alias(f"scores-{name}") for name in algorithms],
                *[F.sum(F.when(mine(name), F.col("_micros"))).alias(f"micros-{name}") for name in algorithms],
            )
            scored = scored.drop("_micros")
        publish(scored, batch_id)
        after.write.mode("overwrite").parquet(version(batch_id))
        release(rows)
        if counted:
            found = seen.get
            for name in algorithms:
                scores = found.get(f"scores-{name}") or 0
                counters.add("evaluations_emitted_total", scores)
                counters.add("scores_total", scores, algorithm=name)
                counters.add("score_micros_total", found.get(f"micros-{name}") or 0.0, algorithm=name)
            counters.save(spark, counters_root)
        if batch_id > 1:
            delete_path(spark, version(batch_id - 2))

    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return (
        samples.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )
