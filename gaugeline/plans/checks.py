"""Checks of a running pipeline's data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.sources.tables import Tables

TIME_COLUMNS = {"metrics": "timestamp", "machines": "last_seen_at", "evaluations": "timestamp"}


def fresh_rows(t: Tables, as_of: datetime | None = None, minutes: int = 10) -> DataFrame:
    """Per table the rows newer than `minutes` before `as_of` (default: now)."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    since = moment - F.make_dt_interval(mins=F.lit(minutes))
    counted = None
    for table, column in TIME_COLUMNS.items():
        rows = getattr(t, table)
        recent = rows.where(F.col(column) > since)
        if "date" in rows.columns:
            recent = recent.where(F.col("date") >= F.to_date(since))
        row = recent.agg(F.count("*").alias("fresh")).select(F.lit(table).alias("table"), "fresh")
        counted = row if counted is None else counted.unionByName(row)
    return counted


def orphans(t: Tables) -> DataFrame:
    """Evaluations whose sample is not stored."""
    samples = t.raw("metrics").select("metric_id").distinct()  # copies combine map-side
    return t.raw("evaluations").join(samples, "metric_id", "left_anti")


def orphan_count(t: Tables) -> DataFrame:
    return orphans(t).agg(F.count("*").alias("orphans"))


def stream_counts(streams: dict[str, DataFrame]) -> DataFrame:
    """Records per stream; each should have some."""
    counted = None
    for name, frame in streams.items():
        row = frame.agg(F.count("*").alias("records")).select(F.lit(name).alias("stream"), "records")
        counted = row if counted is None else counted.unionByName(row)
    return counted
