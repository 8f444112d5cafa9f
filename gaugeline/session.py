"""Session defaults, the shared scratch folder and shipping of this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Bytes of a batch on its way to Python: rows may be long texts, and both sides hold some copies of a batch.
BATCH_BYTES = str(2 << 20)

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "gaugeline", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; everything else is the cluster's own configuration."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Make an existing session fit: UTC dates, JSON as usually read, batches of bounded size, this package in Python workers."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # of a name given twice the last value counts
    bound = str(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)).removesuffix("b")  # None: Spark's own, far more
    if not bound.isdigit() or not 0 < int(bound) <= int(BATCH_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gaugeline-")) / "gaugeline.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the cluster names, or a fresh local one in local mode."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/gaugeline/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options: object) -> DataFrame:
    """Write `df` once to shared scratch and go on from the written table.

    What follows no longer depends on how `df` was computed, so a lost executor costs a re-read, and values that a
    recomputation could change (partition ids, sampled range bounds) are fixed by the committed files.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    return written


def release(*written: DataFrame) -> None:
    """Remove what `materialise` wrote for these; call it when nothing reads them any more."""
    for df in written:
        if path := getattr(df, "_scratch_path", None):
            delete_path(df.sparkSession, path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of `path` and the path on it: works on any storage Spark can reach."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = file_system(spark, path)
    fs.delete(jpath, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it once nothing made from them will be read again."""
    delete_path(spark, scratch_root(spark))
