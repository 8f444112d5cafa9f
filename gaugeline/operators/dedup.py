"""Reads that hide replays: of the rows with one key, the last version.

Written as aggregates on the key: Spark combines copies inside each map task before the shuffle, so a key with very many
copies does not burden one reducer, and filters on key columns reach the scan. Filters on other columns belong after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.schemas import INSERT_SEQ

METRICS_KEY = ("machine_id", "name", "timestamp", "metric_id")
EVALUATIONS_KEY = ("machine_id", "metric_name", "algorithm", "timestamp", "metric_id")
MACHINES_KEY = ("machine_id",)

FOUND = ("algorithm", "baseline", "lower", "upper", "is_anomaly")

KEYS = {"metrics": METRICS_KEY, "evaluations": EVALUATIONS_KEY, "machines": MACHINES_KEY}
VERSIONS = {"metrics": "inserted_at", "evaluations": None, "machines": "last_seen_at"}


def latest(df: DataFrame, key: tuple[str, ...], version: str | None, whole: bool = False) -> DataFrame:
    """Per `key` the row with the greatest `version`; of equal versions the one inserted last, where known.

    The day of a stored row follows from its key, so it is no part of the grouping: what is joined on the key afterwards
    lies where the collapse has put it. Columns are picked one by one, so that those nobody reads are left out; where all are
    wanted, a `whole` row is picked, and its version goes along once instead of next to every column.
    """
    keys = [c for c in key if c in df.columns]
    order = [F.col(c) for c in (version, INSERT_SEQ) if c and c in df.columns]
    others = [c for c in df.columns if c not in keys]
    if not order:
        picked = [F.any_value(c).alias(c) for c in others]
    else:
        by = order[0] if len(order) == 1 else F.struct(*order)
        if whole:
            rows = df.groupBy(*keys).agg(F.max_by(F.struct(*others), by).alias("_picked"))
            return rows.select(*keys, "_picked.*").select(df.columns)
        picked = [F.max_by(c, by).alias(c) for c in others]
    return df.groupBy(*keys).agg(*picked).select(df.columns)


def by_sample(evaluations: DataFrame) -> DataFrame:
    """Per sample (`machine_id, name, timestamp, metric_id`) what each algorithm found, replays hidden, as `found`.

    One shuffle, on the key of samples. Copies combine before it; replays score a sample alike, so a set holds one each.
    """
    rows = evaluations.withColumnRenamed("metric_name", "name")
    sets = rows.groupBy(*METRICS_KEY).agg(F.collect_set(F.struct(*FOUND)).alias("all"))
    algorithms = F.array_distinct(F.transform("all", lambda x: x["algorithm"]))
    one = F.transform(algorithms, lambda a: F.element_at(F.filter("all", lambda x: x["algorithm"] == a), 1))
    return sets.select(*METRICS_KEY, one.alias("found"))


def final(df: DataFrame, table: str, whole: bool = False) -> DataFrame:
    return latest(df, KEYS[table], VERSIONS[table], whole)


def metrics_final(df: DataFrame) -> DataFrame:
    return final(df, "metrics")


def evaluations_final(df: DataFrame) -> DataFrame:
    return final(df, "evaluations")


def machines_final(df: DataFrame) -> DataFrame:
    return final(df, "machines")


def drop_replays(stream: DataFrame, delay: str, key: tuple[str, ...] = ("metric_id", "algorithm")) -> DataFrame:
    """Within a stream, let a key pass once per `delay` of event time. `event_time` must be a column."""
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(key))
