"""Quantiles from stored states that merge.

Per settled day a state is stored for each series (its values) and for each minute of insertion (the delays): counts,
extremes and a KLL sketch of bounded size. A question over all days merges the states of its groups, and reads rows only of
days that have changed since, or have none: those days' states are made on the way, by the same aggregates.

A state names the compaction whose files it was made from. When a day is written to again, or compacted again, its mark
changes and the state is no longer used, so answers are always those of the rows there are now.

A quantile taken from a state has a rank that is off by no more than `RANK_ERROR` of the group's size, in 99 of 100
groups; groups of fewer than some `SKETCH_SIZE` values are exact. Sketches draw lots when they merge, so within that error a quantile may differ from run to run.
`operators.quantiles` gives exact ones, by a sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.scalars import bucket, seconds_between
from gaugeline.plans.panels import KEYS, LIVE_SECONDS
from gaugeline.session import file_system
from gaugeline.sources.tables import Tables, in_days, open_tables

SKETCH_SIZE = 800
RANK_ERROR = 0.0055
SECONDS = 60


def series_values(rows: DataFrame) -> DataFrame:
    """The values of series."""
    return rows.select("date", *KEYS, "timestamp", "metric_id", "value")


def delays(rows: DataFrame) -> DataFrame:
    """The delays of live samples by the minute of their insertion."""
    delay = seconds_between(F.col("inserted_at"), F.col("timestamp"))
    rows = rows.select("date", bucket(F.col("inserted_at"), SECONDS).alias("time"), "timestamp", "metric_id", delay.alias("value"))
    return rows.where(F.col("value") < LIVE_SECONDS)


#: What states are kept of: how rows become values, and by what they are grouped.
KINDS = {"values": (series_values, KEYS), "delays": (delays, ("time",))}


def _states(values: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """A state per day and group, combined map-side: a group of any size reaches a reducer as one row per task."""
    return values.groupBy("date", *groups).agg(
        F.count("value").alias("samples"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("value").alias("total"),
        F.min("timestamp").alias("oldest"),
        F.max(F.struct("timestamp", "metric_id", "value")).alias("latest"),
        F.kll_sketch_agg_double("value", F.lit(SKETCH_SIZE)).alias("state"),
    )


def _path(root: str, kind: str) -> str:
    return f"{root}/states/{kind}"


def _kept(spark: SparkSession, root: str, kind: str, settled: Mapping[str, str]) -> tuple[DataFrame | None, list[str]]:
    """The stored states that still hold, and the folders of the days they cover."""
    fs, path = file_system(spark, _path(root, kind))
    if not fs.exists(path) or not settled:
        return None, []
    stored = spark.read.parquet(_path(root, kind))
    marks = stored.where(in_days(settled)).select(F.col("date").cast("string").alias("day"), "mark").distinct().collect()  # one per day
    valid = [f"date={r['day']}" for r in marks if settled.get(f"date={r['day']}") == r["mark"]]
    return (stored.where(in_days(valid)), valid) if valid else (None, [])


def store_states(spark: SparkSession, root: str) -> None:
    """Bring the stored states up to date: those of settled days that have none, or have been compacted again."""
    t = open_tables(spark, root)
    settled = {day: mark for day, mark in t.settled["metrics"].items() if day[5:6].isdigit()}
    for kind, (values, groups) in KINDS.items():
        _, valid = _kept(spark, root, kind, settled)
        due = {day: mark for day, mark in settled.items() if day not in valid}
        if not due:
            continue
        states = _states(values(t.metrics.where(in_days(due))), groups)
        marks = F.create_map(*[F.lit(x) for day, mark in due.items() for x in (day.removeprefix("date="), mark)])
        marked = states.withColumn("mark", F.try_element_at(marks, F.col("date").cast("string")))
        writer = marked.hint("rebalance", F.col("date")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(_path(root, kind))


def _merged(spark: SparkSession, root: str, kind: str) -> DataFrame:
    t = open_tables(spark, root)
    values, groups = KINDS[kind]
    kept, valid = _kept(spark, root, kind, t.settled["metrics"])
    states = _states(values(_unsketched(t, kind, valid)), groups)
    if kept is not None:
        states = states.unionByName(kept.select(states.columns))
    return states.groupBy(*groups).agg(
        F.sum("samples").alias("samples"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("total").alias("total"),
        F.min("oldest").alias("oldest"),
        F.max("latest").alias("latest"),
        F.kll_merge_agg_double("state").alias("state"),
    )


def _unsketched(t: Tables, kind: str, valid: list[str]) -> DataFrame:
    """Rows of the days without a state: samples count once, while every insertion has its delay."""
    rows = t.metrics.where(~in_days(valid)) if valid else t.metrics
    if kind == "delays":
        return rows
    return Tables(rows, t.evaluations, t.machines, t.settled).dated("metrics")


def _quantile(p: float) -> Column:
    return F.when(F.col("samples") > 0, F.kll_sketch_get_quantile_double("state", F.lit(p)))


def series_summary(spark: SparkSession, root: str) -> DataFrame:
    """`panels.series_summary` for all series and all time from states; `p95` within `RANK_ERROR`."""
    merged = _merged(spark, root, "values")
    span = seconds_between(F.col("latest.timestamp"), F.col("oldest"))
    return merged.select(
        *KEYS,
        F.col("latest.value").alias("latest"),
        F.col("low").alias("min"),
        (F.col("total") / F.col("samples")).alias("mean"),
        F.col("high").alias("max"),
        "samples",
        (span / F.nullif(F.col("samples") - 1, F.lit(0))).alias("avg_interval"),
        _quantile(0.95).alias("p95"),
    )


def ingest_delay(spark: SparkSession, root: str) -> DataFrame:
    """`panels.ingest_delay` for all time from states; quantiles within `RANK_ERROR`."""
    return _merged(spark, root, "delays").select("time", "samples", _quantile(0.5).alias("p50"), _quantile(0.95).alias("p95"))
