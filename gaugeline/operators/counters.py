"""Questions to cumulative counters, gauges and histograms stored as `(ts, name, labels, value)`.

An increase is the sum of the steps between neighbouring samples of one labelled series inside the range; after a reset
(a smaller value) the new value is the step. There is no extrapolation to the edges of the range.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.scalars import bucket

Range = tuple[datetime, datetime]

# How long a sample stays current for a gauge or `up`, in seconds.
LOOKBACK_SECONDS = 300


def label(key: str) -> Column:
    return F.coalesce(F.element_at("labels", F.lit(key)), F.lit(""))


def label_equals(key: str, value: str) -> Column:
    return label(key) == F.lit(value)


def label_matches(key: str, pattern: str) -> Column:
    """The whole label matches `pattern`; negate for a mismatch."""
    return label(key).rlike(f"^(?:{pattern})$")



def counter_steps(
    counters: DataFrame, names: str | list[str], within: Range, labels: Column | None = None
) -> DataFrame:
    """Each sample of the counters in the range with `step`, its rise since the sample before it (0 for the first).

    Steps are taken day by day, so that no task orders a whole series; the last value of the day before, one row per series and
    day, is joined to a day's first sample. The samples are shuffled once.
    """
    start, end = within
    listed = [names] if isinstance(names, str) else names
    chosen = counters.where(F.col("name").isin(listed) & F.col("ts").between(F.lit(start), F.lit(end)))
    if labels is not None:
        chosen = chosen.where(labels)
    # One text per set of labels, whatever the order of the map's entries.
    series = F.coalesce(F.to_json(F.array_sort(F.map_entries("labels"))), F.lit(""))
    keyed = chosen.select("name", series.alias("series"), "ts", "value", "labels", F.to_date("ts").alias("day"))
    of_day = ["name", "series", "day"]
    within_day = Window.partitionBy(*of_day).orderBy("ts")
    rows = keyed.withColumn("_before", F.lag("value").over(within_day)).withColumn("_place", F.row_number().over(within_day))
    lasts = keyed.groupBy(*of_day).agg(F.max_by("value", "ts").alias("_last"))
    over_days = Window.partitionBy("name", "series").orderBy("day")
    earlier = lasts.select(*of_day, F.lag("_last").over(over_days).alias("_earlier"))
    rows = rows.join(earlier, of_day)
    before = F.when(F.col("_place") == 1, F.col("_earlier")).otherwise(F.col("_before"))
    step = (
        F.when(before.isNull(), F.lit(0.0))
        .when(F.col("value") < before, F.col("value"))
        .otherwise(F.col("value") - before)
    )
    return rows.select("name", "series", "ts", "labels", "value", step.alias("step"))


def _by(labels: list[str]) -> list[Column]:
    return [label(key).alias(key) for key in labels]


def counter_increase(
    counters: DataFrame, name: str, within: Range, labels: Column | None = None, by: list[str] | None = None
) -> DataFrame:
    """Total increase in the range, per value of the `by` labels; 0 where no sample matches and no label is asked."""
    steps = counter_steps(counters, name, within, labels).select(*_by(by or []), "step")
    return steps.groupBy(*(by or [])).agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("increase"))


def counter_rate(
    counters: DataFrame,
    name: str,
    within: Range,
    seconds: int,
    by: list[str] | None = None,
    labels: Column | None = None,
) -> DataFrame:
    """Increase per second in each bucket of `seconds`, per value of the `by` labels."""
    by = by or []
    steps = counter_steps(counters, name, within, labels)
    return (
        steps.select(bucket(F.col("ts"), seconds).alias("time"), *_by(by), "step")
        .groupBy("time", *by)
        .agg((F.sum("step") / F.lit(seconds)).alias("rate"))
    )


def _timed(seconds: int | None) -> list[Column]:
    """The bucket of time to group by as well, if buckets are asked for."""
    return [] if seconds is None else [bucket(F.col("ts"), seconds).alias("time")]


def histogram_quantiles(
    counters: DataFrame,
    name: str,
    probabilities: dict[str, float],
    within: Range,
    by: list[str],
    seconds: int | None = None,
) -> DataFrame:
    """Quantiles of a cumulative bucket counter, by linear interpolation inside their buckets, a column for each; over
    the whole range, or in each bucket of `seconds` (`time`).

    Buckets are the values of the label `le`, the last one `+Inf`; a quantile in that one is the bound before it.
    """
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").try_cast("double"))
    steps = counter_steps(counters, name, within).select(*_timed(seconds), *_by([*by, "le"]), "step")
    by = [*(["time"] if seconds else []), *by]
    rates = (
        steps.groupBy(*by, "le")
        .agg(F.sum("step").alias("increase"))
        .withColumn("bound", bound)
        .where(F.col("bound").isNotNull())
    )
    # A row per bucket of the histogram: a handful per group.
    ladder = Window.partitionBy(*by).orderBy("bound")
    so_far = ladder.rowsBetween(Window.unboundedPreceding, 0)
    whole = ladder.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = (
        rates.withColumn("count", F.max("increase").over(so_far))  # later buckets include earlier ones
        .withColumn("total", F.last("count").over(whole))
        .withColumn("lower", F.coalesce(F.lag("bound").over(ladder), F.lit(0.0)))
        .withColumn("below", F.coalesce(F.lag("count").over(ladder), F.lit(0.0)))
        .where(F.col("total") > 0)
    )

    def quantile(q: float) -> Column:
        rank = F.col("total") * F.lit(float(q))
        share = F.try_divide(rank - F.col("below"), F.col("count") - F.col("below"))
        inside = F.col("lower") + (F.col("bound") - F.col("lower")) * share
        value = F.when(F.col("bound") == float("inf"), F.col("lower")).otherwise(inside)
        return F.min_by(value, F.when(F.col("count") >= rank, F.col("bound")))

    return steps.groupBy(*by).agg(*[quantile(q).alias(column) for column, q in probabilities.items()])


def histogram_quantile(counters: DataFrame, name: str, q: float, within: Range, by: list[str]) -> DataFrame:
    return histogram_quantiles(counters, name, {"quantile": q}, within, by)


def mean_cost(
    counters: DataFrame, total: str, count: str, within: Range, by: list[str], seconds: int | None = None
) -> DataFrame:
    """Mean per call: the increase of a running total over the increase of its count; in each bucket of `seconds`, if
    given."""
    steps = counter_steps(counters, [total, count], within).select("name", *_timed(seconds), *_by(by), "step")
    by = [*(["time"] if seconds else []), *by]
    spent = F.sum(F.when(F.col("name") == total, F.col("step")))
    calls = F.sum(F.when(F.col("name") == count, F.col("step")))
    return steps.groupBy(*by).agg(F.try_divide(spent, calls).alias("mean_cost"))


def _current(counters: DataFrame, name: str, as_of: datetime, lookback: int) -> DataFrame:
    """The newest value of each series not older than the lookback."""
    recent = (F.col("ts") <= F.lit(as_of)) & (
        F.col("ts") > F.lit(as_of) - F.make_dt_interval(secs=F.lit(lookback))
    )
    return (
        counters.where((F.col("name") == name) & recent)
        .withColumn("series", F.to_json(F.array_sort(F.map_entries("labels"))))
        .groupBy("series")
        .agg(F.max_by("value", "ts").alias("value"), F.any_value("labels").alias("labels"))
    )


def gauge_max(counters: DataFrame, name: str, as_of: datetime, lookback: int = LOOKBACK_SECONDS) -> DataFrame:
    return _current(counters, name, as_of, lookback).agg(F.max("value").alias("value"))


def gauge_max_over_time(counters: DataFrame, name: str, within: Range, seconds: int) -> DataFrame:
    """Per bucket of `seconds` the greatest of the series' newest values in it."""
    start, end = within
    chosen = counters.where((F.col("name") == name) & F.col("ts").between(F.lit(start), F.lit(end)))
    series = F.to_json(F.array_sort(F.map_entries("labels"))).alias("series")
    newest = chosen.select(*_timed(seconds), series, "ts", "value").groupBy("time", "series")
    return newest.agg(F.max_by("value", "ts").alias("value")).groupBy("time").agg(F.max("value").alias("value"))


def up_or_zero(counters: DataFrame, job: str, as_of: datetime, lookback: int = LOOKBACK_SECONDS) -> DataFrame:
    """1 if every target of `job` is up, 0 if one is down or none is known."""
    current = _current(counters, "up", as_of, lookback).where(label_equals("job", job))
    return current.agg(F.coalesce(F.min("value"), F.lit(0.0)).alias("value"))
