"""The three tables and the counters as DataFrames: raw, or with replays hidden."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.dedup import by_sample, final
from gaugeline.schemas import DAILY, INSERT_SEQ, COUNTERS_TABLE, TABLES, stored_schema

Range = tuple[datetime, datetime]

#: What the names of files begin with that a compaction has written; its own mark follows.
COMPACTED = "compacted_"


def settled_days(files: Iterable[str]) -> dict[str, str]:
    """Folders (`date=...`, or the table's own) all of whose files one compaction has written, and its mark.

    They hold no replays, and as files never change, whatever was made from them holds as long as the mark stays.
    """
    marks = defaultdict(set)
    for file in files:
        _, folder, name = file.rsplit("/", 2)
        marks[folder].add(name.split("-", 1)[0] if name.startswith(COMPACTED) else None)
    return {folder: found.pop() for folder, found in marks.items() if len(found) == 1 and None not in found}


def in_days(folders: Iterable[str]) -> Column:
    """Whether a row lies in one of the folders `date=...`. Rows without a time have no day and lie in none."""
    days = sorted(f.removeprefix("date=") for f in folders if f.startswith("date=") and f[5:6].isdigit())
    return F.coalesce(F.col("date").isin(days), F.lit(False)) if days else F.lit(False)


def time_range(df: DataFrame, within: Range | None, column: str = "timestamp") -> DataFrame:
    """Rows of the range, both ends included. On a daily table the days are bounded too, so that others are not read."""
    if within is None:
        return df
    start, end = (F.lit(t).cast("timestamp") for t in within)
    chosen = df.where(F.col(column).between(start, end))
    if column == "timestamp" and "date" in df.columns:
        chosen = chosen.where(F.col("date").between(F.to_date(start), F.to_date(end)))
    return chosen


def without_replays(rows: DataFrame, name: str, settled: Mapping[str, str]) -> DataFrame:
    """Rows of a table with replays hidden; those of settled days are read as they are, without a shuffle."""
    if name not in DAILY:
        return rows if name in settled else final(rows, name)
    if not settled or "date" not in rows.columns:
        return final(rows, name)
    clean = in_days(settled)  # a condition on the partition column alone: either side reads only its own days
    return rows.where(clean).unionByName(final(rows.where(~clean), name))


@dataclass(frozen=True)
class Tables:
    """Raw reads of the tables, `date` and `insert_seq` included where they are stored.

    `settled` has, per table, the folders that hold no replays, as `settled_days` gives them.
    """

    metrics: DataFrame
    evaluations: DataFrame
    machines: DataFrame
    settled: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def raw(self, name: str, within: Range | None = None, column: str = "timestamp") -> DataFrame:
        return time_range(getattr(self, name), within, column).drop(INSERT_SEQ, "date")

    def final(self, name: str, within: Range | None = None) -> DataFrame:
        """The range is part of the key, so it is cut out before replays are collapsed."""
        return self.dated(name, within).drop("date")

    def dated(self, name: str, within: Range | None = None) -> DataFrame:
        """As `final`, with the day that a row is stored under."""
        return without_replays(time_range(getattr(self, name), within), name, self.settled.get(name, {})).drop(INSERT_SEQ)

    def found(self, within: Range | None = None) -> DataFrame:
        """Evaluations with replays hidden, as an array per sample."""
        return by_sample(time_range(self.evaluations, within))


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(stored_schema(name)).parquet(f"{root}/{name}")


def open_tables(spark: SparkSession, root: str) -> Tables:
    stored = {name: open_table(spark, root, name) for name in ("metrics", "evaluations", "machines")}
    settled = {name: settled_days(rows.inputFiles()) for name, rows in stored.items()}  # a path per file, as planning lists them
    return Tables(**stored, settled=settled)


def read_table(
    spark: SparkSession, root: str, name: str, *, dedup: bool = True, within: Range | None = None
) -> DataFrame:
    """One table of `root`, with replays hidden unless `dedup` is off."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    stored = open_table(spark, root, name)
    rows = time_range(stored, within)
    return (without_replays(rows, name, settled_days(stored.inputFiles())) if dedup else rows).drop(INSERT_SEQ, "date")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNTERS_TABLE).parquet(path)
