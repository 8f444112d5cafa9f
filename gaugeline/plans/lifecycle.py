"""Creating, filling, compacting, expiring and rebuilding the stored tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.dedup import KEYS, VERSIONS, final
from gaugeline.schemas import INSERT_SEQ, DAILY, TABLES, stored_schema
from gaugeline.session import delete_path, file_system, materialise, release
from gaugeline.sources.tables import COMPACTED, settled_days

RETENTION_HOURS = 24

#: Bloom filters on the sample's id: files are in order of series and time, so statistics cannot find an id.
BLOOM = {
    "parquet.bloom.filter.enabled#metric_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def create_tables(spark: SparkSession, root: str, register: bool = True) -> None:
    """Make the table folders and, unless told not to, name them in the session's catalog."""
    for name in TABLES:
        fs, path = file_system(spark, f"{root}/{name}")
        fs.mkdirs(path)
        if register:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored_schema(name))
            days = "PARTITIONED BY (`date`)" if name in DAILY else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet {days} LOCATION '{root}/{name}'")


def drop_tables(spark: SparkSession) -> None:
    """Forget the tables; their files stay, as they do for any external table."""
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def to_stored(rows: DataFrame, table: str, insert_seq: int = 0) -> DataFrame:
    """Table rows as they go to disk: with the insert order, and for daily tables the day."""
    stored = rows if INSERT_SEQ in rows.columns else rows.withColumn(INSERT_SEQ, F.lit(insert_seq).cast("bigint"))
    if table in DAILY:
        stored = stored.withColumn("date", F.to_date("timestamp"))
    return stored.select(stored_schema(table).fieldNames())


def _sorted_by_key(stored: DataFrame, table: str) -> DataFrame:
    """Rows in key order within files, so that Parquet statistics skip other series.

    Range partitioning on day and key gives every task one stretch of one or two days: no small files, and a day or a
    series of any size is spread over as many files as it needs. Copies of one row have equal keys; the number of the
    partition they come from keeps them apart.
    """
    keys = [*(["date"] if table in DAILY else []), *KEYS[table], *([VERSIONS[table]] if VERSIONS[table] else [])]
    return (
        stored.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(*keys, "_from")
        .sortWithinPartitions(*keys)
        .drop("_from")
    )


def append(rows: DataFrame, root: str, table: str, insert_seq: int = 0, sort: bool = True, once: bool = False) -> None:
    """Add rows to a table.

    Sorting takes a sample of the rows first. Rows of daily tables that are dear to compute go in `once`: days are brought
    together in files as large as their size allows, each sorted by key. Small batches go unsorted, in as few files per day
    as their size allows; `compact` puts them in order later.
    """
    stored = to_stored(rows, table, insert_seq)
    if table in DAILY and (once or not sort):
        stored = stored.hint("rebalance", F.col("date"))
        if sort:
            stored = stored.sortWithinPartitions("date", *KEYS[table])
    elif sort:
        stored = _sorted_by_key(stored, table)
    writer = stored.write.mode("append")
    if table in DAILY:
        writer = writer.options(**BLOOM).partitionBy("date")
    writer.parquet(f"{root}/{table}")


@dataclass(frozen=True)
class Compaction:
    """The files that a compaction has read, and their rows without replays, in scratch."""

    root: str
    table: str
    files: list[str]
    rows: DataFrame

    def swap(self) -> None:
        """Add the rows as new files, then remove the files they came from, and no others.

        Rows that a sink has added meanwhile lie in files that were not read, so they stay. Stopped in between, the
        table holds rows twice, which deduplicated reads hide and the next compaction collapses; nothing is ever lost.

        The new files carry the compaction in their names: a day that holds files of one compaction alone has no
        replays (`settled_days`). The files read go only after all new ones are there, so such a day is complete.
        """
        spark = self.rows.sparkSession
        writer = _sorted_by_key(self.rows, self.table).write.mode("append")
        writer = writer.option("mapreduce.output.basename", f"{COMPACTED}{uuid.uuid4().hex}")
        if self.table in DAILY:
            writer = writer.options(**BLOOM).partitionBy("date")
        writer.parquet(f"{self.root}/{self.table}")
        for file in self.files:
            delete_path(spark, file)
        release(self.rows)


def prepare_compaction(spark: SparkSession, root: str, table: str, days: list[date] | None = None) -> Compaction | None:
    """Collapse the replays of the given days into scratch, reading only the files there are now.

    Days that only hold files of one earlier compaction are left alone; None if that leaves nothing.
    """
    source = f"{root}/{table}"
    stored = spark.read.schema(stored_schema(table)).parquet(source)
    if days is not None and table in DAILY:
        stored = stored.where(F.col("date").isin([str(d) for d in days]))
    files = sorted(stored.inputFiles())  # a path per data file, as Spark's own planning lists them
    if table in DAILY and days is not None:
        wanted = {f"date={d}" for d in days}
        files = [f for f in files if f.rsplit("/", 2)[1] in wanted]
    settled = settled_days(files)
    files = [f for f in files if f.rsplit("/", 2)[1] not in settled]
    if not files:
        return None
    read = spark.read.schema(stored_schema(table)).option("basePath", source).parquet(*files)
    return Compaction(root, table, files, materialise(final(read, table, whole=True), f"compact-{table}"))


def compact(spark: SparkSession, root: str, table: str, days: list[date] | None = None) -> None:
    """Collapse replays of the given days on disk and put their rows in key order; sinks may go on writing."""
    prepared = prepare_compaction(spark, root, table, days)
    if prepared is not None:
        prepared.swap()


def expired_days(stored: DataFrame, as_of: datetime, hours: int = RETENTION_HOURS) -> DataFrame:
    """Days whose newest row is older than the retention: a day goes as a whole or not at all."""
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return (
        stored.groupBy("date")
        .agg(F.max("timestamp").alias("newest"), F.count("*").alias("rows"))
        .where(F.col("newest") < limit)
    )


def expire(spark: SparkSession, root: str, table: str, as_of: datetime, hours: int = RETENTION_HOURS) -> list[date]:
    """Drop the expired days of a daily table and return them. `machines` keeps its rows for ever."""
    if table not in DAILY:
        return []
    stored = spark.read.schema(stored_schema(table)).parquet(f"{root}/{table}")
    days = [row["date"] for row in expired_days(stored, as_of, hours).select("date").collect()]  # one value per day
    for day in days:
        delete_path(spark, f"{root}/{table}/date={day}")
    return sorted(days)


def rebuild(spark: SparkSession, root: str, table: str, renames: dict[str, str]) -> None:
    """Copy a table under new column names and put the copy in its place. Stop writers first.

    To go back, rename the other way round. If the copy fails the table is untouched.
    """
    source = f"{root}/{table}"
    fresh, old = f"{source}_new", f"{source}_old"
    writer = spark.read.parquet(source).withColumnsRenamed(renames).write.mode("overwrite")
    if table in DAILY:
        writer = writer.partitionBy("date")
    writer.parquet(fresh)
    fs, path = file_system(spark, source)
    old_path, new_path = file_system(spark, old)[1], file_system(spark, fresh)[1]
    if not fs.rename(path, old_path) or not fs.rename(new_path, path):
        raise OSError(f"could not swap {source}; the copy is at {fresh} and the original at {old}")
    fs.delete(old_path, True)
