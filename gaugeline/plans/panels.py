"""The questions a dashboard asks.

`t` are the tables, `within` is an inclusive range of time. `series` is `(machine_id, name)`; without one, a question is
answered for every series at once, and its rows carry `machine_id` and `name`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.scalars import bucket, joined_names, label, readable_size, seconds_between
from gaugeline.operators.quantiles import exact_quantiles
from gaugeline.schemas import INSERT_SEQ
from gaugeline.session import materialise
from gaugeline.sources.tables import Range, Tables, without_replays

Series = tuple[str, str]

# The steps of a histogram, and the delay up to which a sample counts as live.
HISTOGRAM_BUCKETS = 30
LIVE_SECONDS = 3_600

HISTOGRAM_SLICES = 64


KEYS = ("machine_id", "name")
SAMPLE_KEY = ("machine_id", "name", "timestamp", "metric_id")


def _of(df: DataFrame, series: Series | None) -> DataFrame:
    if series is None:
        return df
    return df.where((F.col("machine_id") == F.lit(series[0])) & (F.col("name") == F.lit(series[1])))


def _shown(series: Series | None) -> list[str]:
    return list(KEYS) if series is None else []


def _samples(t: Tables, series: Series | None, within: Range | None) -> DataFrame:
    return _of(t.final("metrics", within), series)


def _evaluations(t: Tables, series: Series | None, within: Range | None) -> DataFrame:
    return _of(t.final("evaluations", within).withColumnRenamed("metric_name", "name"), series)


def _latest(value: str) -> Column:
    return F.max_by(value, F.struct("timestamp", "metric_id"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Frames of one row each, side by side as one row."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


# Lines, bands and points


def series_line(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    shown = _shown(series)
    lines = _samples(t, series, within).select(*shown, F.col("timestamp").alias("time"), "value")
    return lines.orderBy(*shown, "time")


def bands(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    shown = _shown(series)
    return (
        _evaluations(t, series, within)
        .select(*shown, F.col("timestamp").alias("time"), "algorithm", "baseline", "lower", "upper")
        .orderBy(*shown, "time", "algorithm")
    )


def _points(t: Tables, series: Series | None, within: Range | None) -> DataFrame:
    """Samples with the algorithms that flag them. Both sides are collapsed on the key of samples and joined where they lie."""
    flagged = _of(t.found(within), series).where(F.exists("found", lambda x: x["is_anomaly"]))
    joined = flagged.join(_samples(t, series, within).select(*SAMPLE_KEY, "value"), list(SAMPLE_KEY))
    return joined.select(*SAMPLE_KEY, "value", F.explode(F.filter("found", lambda x: x["is_anomaly"])).alias("x")).select(
        *SAMPLE_KEY, "value", "x.algorithm"
    )


def anomaly_points(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    shown = _shown(series)
    points = _points(t, series, within)
    points = points.select(*shown, F.col("timestamp").alias("time"), "algorithm", F.col("value").alias("anomaly"))
    return points.orderBy(*shown, "time", "algorithm")


def series_overlay(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    """Line, anomalies and bands as one frame, told apart by `layer`, from one read of each table."""
    columns = {"value": "double", "anomaly": "double", "algorithm": "string"} | dict.fromkeys(("baseline", "lower", "upper"), "double")

    def row(layer: str, **given: Column) -> Column:
        values = [given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in columns.items()]
        return F.struct(F.lit(layer).alias("layer"), *values)

    samples = _samples(t, series, within).select(*SAMPLE_KEY, "value", F.lit(True).alias("_sampled"))
    both = samples.join(_of(t.found(within), series), list(SAMPLE_KEY), "full")
    found = F.coalesce("found", F.array())
    line = F.when(F.col("_sampled"), F.array(row("value", value=F.col("value")))).otherwise(F.array())
    bands_ = F.transform(found, lambda x: row("band", **{c: x[c] for c in ("algorithm", "baseline", "lower", "upper")}))
    points = F.transform(
        F.filter(found, lambda x: x["is_anomaly"] & F.col("_sampled")),
        lambda x: row("anomaly", algorithm=x["algorithm"], anomaly=F.col("value")),
    )
    layers = both.select(*_shown(series), F.col("timestamp").alias("time"), F.explode(F.concat(line, points, bands_)).alias("x"))
    return layers.select(*_shown(series), "time", "x.*")  # in no order: a sort belongs with whoever draws it


def value_sample(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    """The values for a distribution, all of them; `value_histogram` counts them where they are too many to draw."""
    return _samples(t, series, within).select(*_shown(series), "value")


def value_histogram(
    t: Tables, series: Series | None = None, within: Range | None = None, buckets: int = HISTOGRAM_BUCKETS
) -> DataFrame:
    """Counts in `buckets` equal steps from a series' smallest to its largest value; flat data fills the first only."""
    values = _samples(t, series, within).groupBy(*KEYS, "value").agg(F.count("*").alias("copies"))
    values = values.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(HISTOGRAM_SLICES)))
    bounds = values.groupBy(*KEYS).agg(
        F.min("value").alias("low"), ((F.max("value") - F.min("value")) / F.lit(buckets)).alias("width")
    )
    # One series may be most of the values: they meet its bounds in slices, not in one task.
    bounds = bounds.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HISTOGRAM_SLICES - 1).cast("long"))))
    place = F.least(F.lit(buckets), F.floor((F.col("value") - F.col("low")) / F.col("width")).cast("int") + 1)
    shown = _shown(series)
    return (
        values.join(bounds, [*KEYS, "slice"])
        .withColumn("bucket", F.when(F.col("width") > 0, place).otherwise(F.lit(1)))
        .groupBy(*KEYS, "bucket", "low", "width")
        .agg(F.sum("copies").alias("samples"))
        .orderBy(*shown, "bucket")
        .select(*shown, "bucket", (F.col("low") + (F.col("bucket") - 1) * F.col("width")).alias("starts_at"), "samples")
    )


def series_summary(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    """The rows are read and collapsed once, into the distinct values of a series with their numbers and newest samples; these,
    in scratch, give the quantile and all the rest."""
    shown = _shown(series)
    counted = _samples(t, series, within).groupBy(*shown, "value").agg(
        F.count("*").alias("copies"), F.max(F.struct("timestamp", "metric_id")).alias("newest"), F.min("timestamp").alias("oldest")
    )
    counted = materialise(counted, "values")
    value, copies, samples = F.col("value"), F.col("copies"), F.coalesce(F.sum("copies"), F.lit(0))
    span = seconds_between(F.max("newest.timestamp"), F.min("oldest"))
    plain = counted.groupBy(*shown).agg(
        F.max_by("value", "newest").alias("latest"),
        F.min("value").alias("min"),
        (F.sum(value * copies) / F.nullif(F.sum(F.when(value.isNotNull(), copies)), F.lit(0))).alias("mean"),
        F.max("value").alias("max"),
        samples.alias("samples"),
        (span / F.nullif(samples - 1, F.lit(0))).alias("avg_interval"),
    )
    quantile = exact_quantiles(counted, shown, "value", {"p95": 0.95}, copies="copies")
    return plain.join(quantile, shown) if shown else one_row(plain, quantile)


def latest_value(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    return _samples(t, series, within).groupBy(*_shown(series)).agg(_latest("value").alias("latest"))


def samples_by_id(t: Tables, ids: list[str]) -> DataFrame:
    """The samples with these ids. Bloom filters skip the row groups that hold none of them."""
    found = t.metrics.where(F.col("metric_id").isin(list(ids)))
    return without_replays(found, "metrics", t.settled.get("metrics", {})).drop(INSERT_SEQ, "date")


# Anomalies


def anomalies_by_algorithm(t: Tables, series: Series | None = None, within: Range | None = None) -> DataFrame:
    by = [*_shown(series), "algorithm"]
    return (
        _evaluations(t, series, within).groupBy(*by).agg(F.count_if("is_anomaly").alias("anomalies")).orderBy(*by)
    )


def anomalies_over_time(
    t: Tables, series: Series | None = None, within: Range | None = None, seconds: int = 60
) -> DataFrame:
    by = [*_shown(series), "time", "algorithm"]
    return (
        _evaluations(t, series, within)
        .withColumn("time", bucket(F.col("timestamp"), seconds))
        .groupBy(*by)
        .agg(F.count_if("is_anomaly").alias("anomalies"))
        .orderBy(*by)
    )


def anomalous_only(t: Tables, within: Range | None = None) -> DataFrame:
    return t.final("evaluations", within).where("is_anomaly")


def flags_per_day(t: Tables) -> DataFrame:
    return (
        t.final("evaluations")
        .groupBy("metric_name", "algorithm", F.to_date("timestamp").alias("day"))
        .agg(F.count_if("is_anomaly").alias("flags"))
    )


def recent_anomalies(
    t: Tables, n: int, machine_id: str | None = None, within: Range | None = None
) -> DataFrame:
    """The `n` newest flags of a machine, or of all, newest first."""
    mine = F.lit(True) if machine_id is None else F.col("machine_id") == F.lit(machine_id)
    return (
        _points(t, None, within)
        .where(mine)
        .orderBy(F.desc("timestamp"), "metric_id", "algorithm")
        .limit(n)
        .select(
            F.col("timestamp").alias("time"),
            *(["machine_id"] if machine_id is None else []),
            F.col("name").alias("metric"),
            "algorithm",
            "value",
        )
    )


def sample_with_bands(
    t: Tables, algorithm: str, series: Series | None = None, within: Range | None = None
) -> DataFrame:
    """Every sample with the band of one algorithm, null where it was not scored."""
    shown = _shown(series)
    found = _of(t.found(within), series).select(*SAMPLE_KEY, F.get(F.filter("found", lambda x: x["algorithm"] == algorithm), F.lit(0)).alias("x"))
    return (
        _samples(t, series, within)
        .select(*SAMPLE_KEY, "value")
        .join(found, list(SAMPLE_KEY), "left")
        .select(*SAMPLE_KEY, "value", "x.*")
        .select(*shown, "timestamp", "value", "baseline", "lower", "upper", "is_anomaly")
        .orderBy(*shown, "timestamp")
    )


# All series


def series_rollup(t: Tables, within: Range | None = None) -> DataFrame:
    return (
        t.final("metrics", within)
        .groupBy("machine_id", "name")
        .agg(
            F.min("unit").alias("unit"),
            F.count("*").alias("samples"),
            F.max("timestamp").alias("last_sample"),
            _latest("value").alias("latest"),
            F.avg("value").alias("mean"),
            F.max("value").alias("max"),
        )
    )


def flagged_by(t: Tables, within: Range | None = None) -> DataFrame:
    return (
        t.final("evaluations", within)
        .groupBy("machine_id", F.col("metric_name").alias("name"))
        .agg(
            F.count_if("is_anomaly").alias("anomalies"),
            joined_names(F.collect_set(F.when(F.col("is_anomaly"), F.col("algorithm")))).alias("flagged_by"),
        )
    )


def top_series(t: Tables, n: int, within: Range | None = None) -> DataFrame:
    """The `n` series with most flags."""
    return series_overview(t, within).limit(n)


def series_overview(t: Tables, within: Range | None = None) -> DataFrame:
    """All series, those with most flags first; a series that is not scored shows 0 and no algorithm."""
    return (
        series_rollup(t, within)
        .join(flagged_by(t, within), ["machine_id", "name"], "left")
        .withColumn("anomalies", F.coalesce("anomalies", F.lit(0)))
        .withColumn("flagged_by", F.coalesce("flagged_by", F.lit("")))
        .orderBy(F.desc("anomalies"), "machine_id", "name")
    )


def rows_per_series(t: Tables) -> DataFrame:
    return t.final("metrics").groupBy("machine_id", "name").agg(F.count("*").alias("samples"))


# Machines and variables


def machine_labels(t: Tables) -> DataFrame:
    """Every machine that ever sent a sample, by name, or by id without one. Spark broadcasts the names if they fit."""
    return (
        t.raw("metrics")
        .select("machine_id")
        .distinct()
        .join(t.final("machines").select("machine_id", "hostname"), "machine_id", "left")
        .select("machine_id", label(F.col("hostname"), F.col("machine_id")).alias("label"))
    )


def host_names(t: Tables) -> DataFrame:
    return machine_labels(t).select("label").distinct().orderBy("label")


def label_to_machine(t: Tables, name: str) -> DataFrame:
    """The machine behind a label; of several with one name the first by id."""
    return machine_labels(t).where(F.col("label") == name).select("machine_id").orderBy("machine_id").limit(1)


def metric_names(t: Tables, machine_id: str | None = None) -> DataFrame:
    if machine_id is None:
        return t.raw("metrics").select(*KEYS).distinct().orderBy(*KEYS)
    return t.raw("metrics").where(F.col("machine_id") == machine_id).select("name").distinct().orderBy("name")


def any_unit(t: Tables, series: Series | None = None) -> DataFrame:
    return _of(t.raw("metrics"), series).groupBy(*_shown(series)).agg(F.min("unit").alias("unit"))


def series_with_host(t: Tables, name: str | None = None, within: Range | None = None) -> DataFrame:
    """The samples of a metric on all machines with each machine's name. One large machine is left to the adaptive
    skew join if the names are too many to broadcast."""
    hosts = t.final("machines").select("machine_id", "hostname")
    samples = t.final("metrics", within)
    if name is not None:
        samples = samples.where(F.col("name") == name)
    return samples.select("machine_id", "name", "timestamp", "value").join(hosts, "machine_id", "left")


def machine_card(t: Tables, machine_id: str | None = None) -> DataFrame:
    machines = t.final("machines")
    if machine_id is not None:
        machines = machines.where(F.col("machine_id") == machine_id)
    return machines.select(
            *(["machine_id"] if machine_id is None else []),
            F.col("hostname").alias("host"),
            "os",
            "os_version",
            "architecture",
            "cores",
            readable_size(F.col("total_memory")).alias("memory"),
            readable_size(F.col("total_disk")).alias("disk"),
            "last_boot",
            F.col("last_seen_at").alias("last_seen"),
        )


# Ingestion, on raw reads: a replay is a row that was ingested


def series_count(t: Tables) -> DataFrame:
    return t.raw("metrics").agg(F.count_distinct("machine_id", "name").alias("series"))


def stored(t: Tables) -> DataFrame:
    """Rows, series and data files as they lie on disk."""
    path = F.input_file_name()
    return one_row(
        t.metrics.select(*KEYS, path.alias("file")).agg(
            F.count("*").alias("metric_rows"),
            F.count_distinct(*KEYS).alias("series"),
            F.count_distinct("file").alias("metric_files"),
        ),
        t.evaluations.select(path.alias("file")).agg(
            F.count("*").alias("evaluation_rows"), F.count_distinct("file").alias("evaluation_files")
        ),
    )


def stored_files(t: Tables) -> DataFrame:
    """Data files per table and day."""
    counted = None
    for name in ("metrics", "evaluations"):
        files = (
            getattr(t, name)
            .select(F.lit(name).alias("table"), "date", F.col("_metadata.file_path").alias("file"))
            .groupBy("table", "date")
            .agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"))
        )
        counted = files if counted is None else counted.unionByName(files)
    return counted


def ingest_rate(t: Tables, within: Range | None = None, seconds: int = 60) -> DataFrame:
    return (
        t.raw("metrics", within, "inserted_at")
        .groupBy(bucket(F.col("inserted_at"), seconds).alias("time"))
        .agg((F.count("*") / F.lit(seconds)).alias("rows_per_second"))
        .orderBy("time")
    )


def ingest_delay(
    t: Tables, within: Range | None = None, seconds: int = 60, live_limit: int = LIVE_SECONDS
) -> DataFrame:
    """Median and 95th percentile of the delay of live samples, per bucket of their insertion."""
    delays = (
        t.raw("metrics", within, "inserted_at")
        .select(
            bucket(F.col("inserted_at"), seconds).alias("time"),
            seconds_between(F.col("inserted_at"), F.col("timestamp")).alias("delay"),
        )
        .where(F.col("delay") < live_limit)
    )
    return exact_quantiles(delays, ["time"], "delay", {"p50": 0.5, "p95": 0.95}).orderBy("time")
