"""Streams into tables: decode, split, append, and only then let Spark record the progress.

Delivery is at least once: a batch that failed after its write is written again, and reads collapse it.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gaugeline.functions.scalars import cut_to_millis, epoch_to_timestamp
from gaugeline.functions.validity import aware_timestamp
from gaugeline.operators.decode import (
    examine,
    examine_bodies,
    malformed_records,
    rejected_bodies,
    snapshot_samples,
    valid_records,
)
from gaugeline.plans.lifecycle import append
from gaugeline.schemas import COUNTERS_TABLE, TABLES, assert_agreement, assert_schema
from gaugeline.session import delete_path, materialise, release
from gaugeline.sources.streams import dead_letters, to_kafka
from gaugeline.sources.tables import read_counters

logger = logging.getLogger(__name__)

# When a batch is written, and how a failing write is repeated.
TRIGGER = "5 seconds"
WRITE_ATTEMPTS = 5
FIRST_WAIT_SECONDS = 1.0
WRITE_SECONDS_BOUNDS = ("0.1", "0.25", "0.5", "1", "2.5", "5", "10", "+Inf")


def metrics_row(records: DataFrame) -> DataFrame:
    """Samples as table rows: UTC milliseconds, no attributes as an empty map, the time of insertion added."""
    return records.select(
        "metric_id",
        "machine_id",
        "name",
        epoch_to_timestamp(F.col("timestamp")).alias("timestamp"),
        "type",
        "unit",
        "value",
        F.coalesce("attributes", F.create_map().cast("map<string,string>")).alias("attributes"),
        cut_to_millis(F.current_timestamp()).alias("inserted_at"),
    )


def evaluations_row(records: DataFrame) -> DataFrame:
    return records.select(
        "metric_id",
        "machine_id",
        "metric_name",
        epoch_to_timestamp(F.col("timestamp")).alias("timestamp"),
        "algorithm",
        "baseline",
        "lower",
        "upper",
        "is_anomaly",
    )


def machines_row(records: DataFrame) -> DataFrame:
    return records.select(
        "machine_id",
        "hostname",
        "os",
        "os_version",
        "architecture",
        "cores",
        "total_memory",
        "total_disk",
        cut_to_millis(aware_timestamp(F.col("last_boot"))).alias("last_boot"),
        epoch_to_timestamp(F.col("last_seen_at")).alias("last_seen_at"),
        cut_to_millis(F.current_timestamp()).alias("inserted_at"),
    )


@dataclass(frozen=True)
class SinkSpec:
    """What a topic's records are, and how one becomes a row of which table."""

    table: str
    to_row: Callable[[DataFrame], DataFrame]


SINKS = {
    "metrics": SinkSpec("metrics", metrics_row),
    "evaluations": SinkSpec("evaluations", evaluations_row),
    "machines": SinkSpec("machines", machines_row),
}


def write_with_retries(
    write: Callable[[], None],
    attempts: int = WRITE_ATTEMPTS,
    wait: float = FIRST_WAIT_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Repeat a failing write, waiting twice as long each time; the last failure is raised and fails the query."""
    for pause in [*(wait * 2**k for k in range(attempts - 1)), None]:
        try:
            return write()
        except Exception:
            if pause is None:
                raise
            logger.exception("a write failed, again in %.1f s", pause)
            sleep(pause)


class JobCounters:
    """Running totals of one job, from 0 at the start of its process; each batch appends them to `<root>/counters`."""

    def __init__(self, **labels: str):
        self.labels = labels
        self.totals: dict[tuple[str, tuple], float] = {}

    def add(self, name: str, amount: float, **labels: str) -> None:
        key = name, tuple(sorted((self.labels | labels).items()))
        self.totals[key] = self.totals.get(key, 0.0) + amount

    def add_write(self, seconds: float) -> None:
        self.add("write_seconds_sum", seconds)
        self.add("write_seconds_count", 1)
        for bound in WRITE_SECONDS_BOUNDS:
            self.add("write_seconds_bucket", float(seconds <= float(bound)), le=bound)

    def save(self, spark: SparkSession, root: str) -> None:
        rows = [(name, dict(labels), value) for (name, labels), value in self.totals.items()]
        spark.createDataFrame(rows, "name string, labels map<string,string>, value double").select(
            F.current_timestamp().alias("ts"), "name", "labels", "value"
        ).coalesce(1).write.mode("append").parquet(f"{root}/counters")


class SinkCounters(JobCounters):
    """The counters of the sink of one table."""

    def __init__(self, table: str):
        super().__init__(table=table)


def job_counters(spark: SparkSession, root: str) -> DataFrame:
    """The counters of all jobs that report to `root`."""
    return read_counters(spark, f"{root}/counters")


def compact_counters(spark: SparkSession, root: str) -> None:
    """Bring the counters' files, one of each batch, together; jobs may go on reporting.

    Only files that were read are removed. Stopped before that, a reading stands twice, which adds nothing to an increase.
    """
    files = job_counters(spark, root).inputFiles()
    read = materialise(spark.read.schema(COUNTERS_TABLE).parquet(*files), "counters")
    read.repartitionByRange("name", "ts").sortWithinPartitions("name", "ts").write.mode("append").parquet(f"{root}/counters")
    for file in files:
        delete_path(spark, file)
    release(read)


def _counted(rows: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The rows of a micro-batch, written to shared scratch, and what was counted on the way, in the same job."""
    seen = Observation()
    written = materialise(rows.observe(seen, *[F.coalesce(c, F.lit(0)).alias(name) for name, c in counts.items()]), label)
    return written, dict.fromkeys(counts, 0) | seen.get


def _letters_of(batch: DataFrame, root: str, table: str, batch_id: int | None) -> str:
    """The folder of a batch's malformed records: the same for a batch that is run again."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    name = f"batch-{batch_id}" if batch_id is not None else f"at-{time.time_ns()}"
    return f"{root}/malformed/table={table}/query={query}/run={name}"


def load_batch(
    batch: DataFrame,
    spec: SinkSpec,
    root: str,
    *,
    batch_id: int | None = None,
    counters: SinkCounters | None = None,
    attempts: int = WRITE_ATTEMPTS,
    wait: float = FIRST_WAIT_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
    write: Callable[..., None] = append,
) -> tuple[int, int]:
    """Load one micro-batch of `value` texts: valid rows into the table, the others into `<root>/malformed`.

    A batch that is run again, after a failure between the two writes or after them, replaces its malformed records, so each is
    kept once; the rows it adds again are hidden by reads. Returns how many records were read and how many of them were
    malformed. An empty batch writes nothing.
    """
    good = F.col("reason").isNull()
    parts = {"record": F.when(good, F.col("record")), "value": F.when(~good, F.col("value"))}  # stored is what goes on from here
    rows = examine(batch, spec.table).withColumns(parts)
    examined, seen = _counted(rows, "batch", consumed=F.count(F.lit(1)), malformed=F.count("reason"))
    consumed, malformed = seen["consumed"], seen["malformed"]
    started = time.perf_counter()
    if consumed > malformed:
        rows = spec.to_row(valid_records(examined))
        assert_schema(rows, TABLES[spec.table])
        sequence = round(time.time() * 1000)
        write_with_retries(lambda: write(rows, root, spec.table, sequence, sort=False), attempts, wait, sleep)
    seconds = time.perf_counter() - started
    if malformed:
        letters, place = malformed_records(examined), _letters_of(batch, root, spec.table, batch_id)
        write_with_retries(lambda: letters.write.mode("overwrite").json(place), attempts, wait, sleep)
    release(examined)
    if counters is not None and consumed:
        counters.add("messages_consumed_total", consumed)
        counters.add("malformed_records_total", malformed)
        if consumed > malformed:
            counters.add("rows_written_total", consumed - malformed)
            counters.add_write(seconds)
        counters.save(batch.sparkSession, root)
    return consumed, malformed


def start_sink(
    stream: DataFrame,
    spec: SinkSpec,
    root: str,
    checkpoint: str,
    *,
    trigger: str | None = TRIGGER,
    attempts: int = WRITE_ATTEMPTS,
    wait: float = FIRST_WAIT_SECONDS,
) -> StreamingQuery:
    """Load a topic into its table with a checkpoint of its own. Without a trigger, load what is there and stop.

    Spark commits a batch only after this writer returned, so progress never runs ahead of the table.
    """
    assert_agreement(spec.table)
    counters = SinkCounters(spec.table)

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, spec, root, batch_id=batch_id, counters=counters, attempts=attempts, wait=wait)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).queryName(spec.table)
    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.trigger(**timing).start()


def run_sinks(spark: SparkSession, streams: dict[str, DataFrame], root: str, checkpoints: str) -> None:
    """One query per topic; when one ends or fails, the others are stopped and the failure is raised."""
    spark.streams.resetTerminated()  # a query that ended earlier is none of these
    queries = [start_sink(stream, SINKS[name], root, f"{checkpoints}/{name}") for name, stream in streams.items()]
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def start_record_sink(
    records: DataFrame,
    format: str,
    target: str,
    checkpoint: str,
    *,
    key: str | None = None,
    trigger: str | None = TRIGGER,
    **options: str,
) -> StreamingQuery:
    """Publish records as JSON: samples keyed by machine, evaluations without a key. `target` is a topic or a folder."""
    place = {"topic": target} if format == "kafka" else {"path": target}
    writer = (
        to_kafka(records, key)
        .writeStream.format(format)
        .options(**place, **options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.trigger(**timing).start()


def start_collector(
    bodies: DataFrame,
    publish: Callable[[DataFrame, str], None],
    topic: str,
    checkpoint: str,
    *,
    machines_topic: str = "machines",
    trigger: str | None = TRIGGER,
    counters_root: str | None = None,
) -> StreamingQuery:
    """Bodies to samples on `topic`, or to records on `machines_topic` where their `kind` is `machine`; bodies that will
    not do to the dead letters of their kind, `<topic>_dlq`. A batch of both kinds is examined in one job and stored in shared scratch.

    `publish(records, topic)` writes key and value columns, e.g. to Kafka. With `counters_root` the scrapes by outcome (a null body
    is a failed fetch), the invalid responses and the published messages are counted, while the batch is stored, and reported there.
    """
    counters = JobCounters()

    def collect(batch: DataFrame, batch_id: int) -> None:
        topics = {"metrics": topic} | ({"machine": machines_topic} if "kind" in batch.columns else {})
        rows = examine_bodies(batch)
        flawless, published = F.col("error").isNull(), {"metrics": F.size("_metrics"), "machine": F.lit(1)}
        wanted = {}
        for kind in topics:
            mine = F.col("asked") == kind
            wanted[f"scrapes-{kind}"] = F.count_if(mine)
            wanted[f"fetched-{kind}"] = F.count_if(mine & (flawless | F.col("body").isNotNull()))
            wanted[f"invalid-{kind}"] = F.count_if(mine & ~flawless)
            wanted[f"published-{kind}"] = F.sum(F.when(mine & flawless, published[kind]))
        examined, seen = _counted(rows, "bodies", **wanted)
        asked = {kind: examined.where(F.col("asked") == kind) for kind in topics}
        outgoing = [
            (to_kafka(snapshot_samples(asked["metrics"]), key="machine_id"), topic),
            (dead_letters(rejected_bodies(asked["metrics"])), f"{topic}_dlq"),
        ]
        if "machine" in topics:
            outgoing += [
                (to_kafka(asked["machine"].where(flawless).select("record.*"), key="machine_id"), machines_topic),
                (dead_letters(rejected_bodies(asked["machine"])), f"{machines_topic}_dlq"),
            ]
        scrapes, fetches = (sum(seen[f"{what}-{kind}"] for kind in topics) for what in ("scrapes", "fetched"))
        try:
            for records, place in outgoing:
                publish(records, place)
        except Exception:
            counters.add("scrapes_total", fetches, outcome="publish_error")
            if counters_root:
                counters.save(batch.sparkSession, counters_root)
            raise
        release(examined)
        counters.add("scrapes_total", fetches, outcome="ok")
        counters.add("scrapes_total", scrapes - fetches, outcome="fetch_error")
        for kind, place in topics.items():
            counters.add("invalid_responses_total", seen[f"invalid-{kind}"], kind=kind)
            counters.add("messages_published_total", seen[f"published-{kind}"], topic=place)
        if counters_root and scrapes:
            counters.save(batch.sparkSession, counters_root)

    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return (
        bodies.writeStream.foreachBatch(collect)
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )
