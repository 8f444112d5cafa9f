"""Record streams, and raw bodies, as DataFrames with a `value` column. Decoding is the same for all of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceSpec:
    """A topic to load: `kafka` with servers in `options`, or `text` / `parquet` files under a folder.

    `start` holds for the first run only; afterwards a query goes on from its own checkpoint.
    """

    format: str
    path_or_topic: str
    start: str = "earliest"
    options: dict[str, str] = field(default_factory=dict)
    topic: str | None = None


def read_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """`value` as text, with `topic`, `partition` and `offset` where the source knows them."""
    reader = spark.readStream.format(spec.format).options(**spec.options)
    if spec.format == "kafka":
        loaded = reader.option("subscribe", spec.path_or_topic).option("startingOffsets", spec.start).load()
        return loaded.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
    if spec.format == "parquet":
        reader = reader.schema("value string, partition int, offset long")
    loaded = reader.load(spec.path_or_topic)
    for name, kind in (("partition", "int"), ("offset", "long")):
        if name not in loaded.columns:
            loaded = loaded.withColumn(name, F.lit(None).cast(kind))
    return loaded.select("value", F.lit(spec.topic or spec.path_or_topic).alias("topic"), "partition", "offset")


def read_snapshots(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Collected bodies as `(url, body)`; of plain text files, a body per file and its path as the url."""
    if format == "text":
        files = spark.read.text(path, wholetext=True)
        return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("body"))
    return spark.read.format(format).schema("url string, body string").load(path)


def to_kafka(records: DataFrame, key: str | None = None) -> DataFrame:
    """Records as JSON, nulls written out, keyed by `key` so that one key keeps its order."""
    body = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value")
    if key is None:
        return records.select(body)
    return records.select(F.col(key).cast("string").alias("key"), body)


def dead_letters(rejected: DataFrame) -> DataFrame:
    """Rejected bodies as they came, with the error, keyed by the url they came from."""
    return to_kafka(rejected.select("url", "error", "body"), key="url")
