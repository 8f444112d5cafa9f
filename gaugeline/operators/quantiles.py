"""Exact quantiles and histograms of groups of any size.

`percentile` keeps every distinct value of a group in one task's memory. Here equal values are counted first (combined
map-side), the distinct values are put in order over all partitions, and a quantile is the value at a known rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.operators.ordering import balanced_rows, order_rows, with_chunks


def ranked_values(df: DataFrame, groups: list[str], value: str, copies: str | None = None) -> DataFrame:
    """Per group and distinct value: `_first` and `_last`, the ranks its copies take, and `_total`, the group's size.

    Where `copies` names a column, `df` has each value of a group once already, and how many there are of it.
    """
    values = df.where(F.col(value).isNotNull())
    if copies is None:
        counted = values.groupBy(*groups, value).agg(F.count("*").alias("_copies"))
    else:
        counted = values.select(*groups, value, F.col(copies).alias("_copies"))
    ordered = order_rows(counted, [*groups, value])
    chunks = with_chunks(ordered, 0, balanced_rows(df.sparkSession, ordered.total))
    # One row per chunk and group. A group has at most about the square root of its values many chunks.
    sums = chunks.groupBy("_chunk", *groups).agg(F.sum("_copies").alias("_here"))
    group_keys = groups or [F.lit(0)]
    chain = Window.partitionBy(*group_keys).orderBy("_chunk")
    sums = sums.select(
        "_chunk",
        *groups,
        F.coalesce(F.sum("_here").over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_here").over(Window.partitionBy(*group_keys)).alias("_total"),
    )
    running = Window.partitionBy("_chunk", *groups).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunks.withColumn("_running", F.sum("_copies").over(running))
        .join(sums, ["_chunk", *groups])
        .select(
            *groups,
            value,
            "_total",
            (F.col("_before") + F.col("_running") - F.col("_copies")).alias("_first"),
            (F.col("_before") + F.col("_running") - 1).alias("_last"),
        )
    )


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, probabilities: dict[str, float], copies: str | None = None
) -> DataFrame:
    """One row per group with a column per named probability, interpolated between neighbouring values."""
    ranked = ranked_values(df, groups, value, copies)
    parts, result = [], []
    for i, (name, p) in enumerate(probabilities.items()):
        rank = (F.col("_total") - 1) * F.lit(float(p))
        for side, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            hit = (F.col("_first") <= at) & (F.col("_last") >= at)
            parts.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}{i}"))
        parts.append(F.max(rank - F.floor(rank)).alias(f"_share{i}"))
        low, high, share = F.col(f"_low{i}"), F.col(f"_high{i}"), F.col(f"_share{i}")
        result.append((low + (high - low) * share).alias(name))
    return ranked.groupBy(*groups).agg(*parts).select(*groups, *result)
