"""One schema per entity, on the stream and in the tables, and the check that a DataFrame agrees with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _fields(*specs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in specs])


STRING, DOUBLE, LONG, INT, BOOL, TIME = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
    T.TimestampType(),
)
TEXT_MAP = T.MapType(STRING, STRING)

# Records as they travel on a stream: times are epoch seconds.
SAMPLE_STREAM = _fields(
    ("timestamp", DOUBLE),
    ("name", STRING),
    ("type", STRING),
    ("unit", STRING),
    ("value", DOUBLE),
    ("machine_id", STRING),
    ("metric_id", STRING),
    ("attributes", TEXT_MAP),
)
EVALUATION_STREAM = _fields(
    ("metric_id", STRING),
    ("machine_id", STRING),
    ("metric_name", STRING),
    ("timestamp", DOUBLE),
    ("algorithm", STRING),
    ("baseline", DOUBLE),
    ("lower", DOUBLE),
    ("upper", DOUBLE),
    ("is_anomaly", BOOL),
)
MACHINE_STREAM = _fields(
    ("machine_id", STRING),
    ("hostname", STRING),
    ("os", STRING),
    ("os_version", STRING),
    ("architecture", STRING),
    ("cores", INT),
    ("total_memory", LONG),
    ("total_disk", LONG),
    ("last_boot", STRING),
    ("last_seen_at", DOUBLE),
)

# Rows as they are stored: times are UTC timestamps cut to milliseconds.
METRICS_TABLE = _fields(
    ("metric_id", STRING),
    ("machine_id", STRING),
    ("name", STRING),
    ("timestamp", TIME),
    ("type", STRING),
    ("unit", STRING),
    ("value", DOUBLE),
    ("attributes", TEXT_MAP),
    ("inserted_at", TIME),
)
EVALUATIONS_TABLE = _fields(
    ("metric_id", STRING),
    ("machine_id", STRING),
    ("metric_name", STRING),
    ("timestamp", TIME),
    ("algorithm", STRING),
    ("baseline", DOUBLE),
    ("lower", DOUBLE),
    ("upper", DOUBLE),
    ("is_anomaly", BOOL),
)
MACHINES_TABLE = _fields(
    ("machine_id", STRING),
    ("hostname", STRING),
    ("os", STRING),
    ("os_version", STRING),
    ("architecture", STRING),
    ("cores", INT),
    ("total_memory", LONG),
    ("total_disk", LONG),
    ("last_boot", TIME),
    ("last_seen_at", TIME),
    ("inserted_at", TIME),
)
COUNTERS_TABLE = _fields(("ts", TIME), ("name", STRING), ("labels", TEXT_MAP), ("value", DOUBLE))

STREAMS = {"metrics": SAMPLE_STREAM, "evaluations": EVALUATION_STREAM, "machines": MACHINE_STREAM}
TABLES = {"metrics": METRICS_TABLE, "evaluations": EVALUATIONS_TABLE, "machines": MACHINES_TABLE}

# Tables with a folder per day; `date` follows from `timestamp` and `insert_seq` orders inserts of equal version.
DAILY = ("metrics", "evaluations")
INSERT_SEQ = "insert_seq"


def stored_schema(table: str) -> T.StructType:
    """The columns on disk: the table's own, the insert order, and the day for daily tables."""
    fields = [*TABLES[table].fields, T.StructField(INSERT_SEQ, LONG, True)]
    if table in DAILY:
        fields.append(T.StructField("date", T.DateType(), True))
    return T.StructType(fields)


def assert_schema(df: DataFrame, expected: T.StructType) -> None:
    """Fail unless `df` has exactly the expected columns, in order and by type."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in expected]
    if got != want:
        raise ValueError(f"schema mismatch: got {got}, expected {want}")


def assert_agreement(entity: str) -> None:
    """The stream record and the table of an entity name the same columns, apart from the insert time."""
    stream = set(STREAMS[entity].fieldNames())
    table = set(TABLES[entity].fieldNames()) - {"inserted_at"}
    if stream != table:
        raise ValueError(f"{entity}: stream and table differ in {sorted(stream ^ table)}")
