"""The engine's inputs as views over the driver's tables, each once for Spark and once as text for DuckDB.

`events` become samples of 20 series with replays, `customer` becomes machine records, and from the same events come
snapshot bodies and pipeline counters. Every view reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators import scoring
from gaugeline.operators.dedup import VERSIONS, metrics_final
from gaugeline.plans.lifecycle import append, create_tables
from gaugeline.schemas import TABLES
from gaugeline.session import prepare, scratch_path
from gaugeline.sources.tables import Tables, open_table, settled_days

_NAME = """CASE event_type WHEN 'click' THEN 'system.cpu.utilization' WHEN 'view' THEN 'system.memory.usage'
    WHEN 'purchase' THEN 'nab.purchase' WHEN 'error' THEN 'system.uptime' ELSE 'system.memory.limit' END"""
_UNIT = "CASE event_type WHEN 'click' THEN '%' WHEN 'purchase' THEN '%' WHEN 'error' THEN 's' ELSE 'By' END"
_REPLAYED = "event_id % 10 = 0"
# Every tenth or so evaluation is stored twice.
_TWICE = "substr(metric_id, 1, 1) IN ('0', '8')"

# Makes amounts with two decimals uneven, so that no sum of them lies midway between two sixth decimals, where engines
# round either way.
UNEVEN = 1.00000037


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _dashed(digest: str) -> str:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {start}, {length})" for start, length in parts)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreplayed samples, with the event's id for views built on top."""
    return events(spark, sf_dir).select(
        "event_id",
        F.expr(_dashed("md5(cast(event_id AS string))")).alias("metric_id"),
        F.expr("'m' || (user_id % 4)").alias("machine_id"),
        F.expr(_NAME).alias("name"),
        F.date_trunc("MILLISECOND", "ts").alias("timestamp"),
        F.lit("gauge").alias("type"),
        F.expr(_UNIT).alias("unit"),
        (F.col("value") * F.lit(UNEVEN)).alias("value"),
        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("attributes"),
        F.expr(
            "date_trunc('MILLISECOND', ts) + make_dt_interval(0, 0, 0, event_id % 7)"
            " + make_dt_interval(0, if(event_id % 50 = 0, 2, 0), 0, 0)"
        ).alias("inserted_at"),
    )


def metrics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows: every tenth sample came twice, the second time a minute later and with another value."""
    copies = F.expr(f"explode(if({_REPLAYED}, array(0, 1), array(0)))").alias("copy")
    return (
        samples(spark, sf_dir)
        .select("*", copies)
        .select(
            "metric_id",
            "machine_id",
            "name",
            "timestamp",
            "type",
            "unit",
            (F.col("value") + F.col("copy")).alias("value"),
            "attributes",
            (F.col("inserted_at") + F.make_dt_interval(mins=F.col("copy"))).alias("inserted_at"),
        )
    )


def machines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many records per machine; `m3` has none, `m4` to `m6` send no samples."""
    prepare(spark)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    seen = F.timestamp_seconds(F.lit(1704067200) + F.col("c_custkey"))
    return customers.select(
        F.expr("'m' || if(c_custkey % 6 = 3, 6, c_custkey % 6)").alias("machine_id"),
        F.col("c_name").alias("hostname"),
        F.lower("c_mktsegment").alias("os"),
        F.expr("'6.' || c_nationkey").alias("os_version"),
        F.expr("CASE WHEN c_nationkey % 2 = 0 THEN 'x86_64' ELSE 'arm64' END").alias("architecture"),
        F.expr("cast(4 + c_custkey % 29 AS int)").alias("cores"),
        F.expr("(8 + c_custkey % 57) * 1073741824").alias("total_memory"),
        F.expr("(100 + c_custkey % 1900) * 1000204886").alias("total_disk"),
        (seen - F.make_dt_interval(hours=F.lit(9))).alias("last_boot"),
        seen.alias("last_seen_at"),
        (seen + F.make_dt_interval(secs=F.lit(1))).alias("inserted_at"),
    )


def score(stored: DataFrame) -> DataFrame:
    """Evaluations of samples as they are stored, replays included."""
    return scoring.score(stored, version=VERSIONS["metrics"])


def evaluations_raw(evaluations: DataFrame) -> DataFrame:
    copies = F.expr(f"explode(if({_TWICE}, array(0, 1), array(0)))").alias("copy")
    return evaluations.select("*", copies).drop("copy")


_stored: dict[tuple[str, str], str] = {}
_filled: set[tuple[str, str]] = set()


def store_root(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """The folder of the tables, in which those named, or else all, are filled as the pipeline's sinks would fill them.

    Each is written on first use in a session: a question about samples does not wait for their scoring.
    """
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = scratch_path(spark, "store")
        create_tables(spark, _stored[key], register=False)
    root = _stored[key]
    for name in names or TABLES:
        if (root, name) not in _filled:
            _FILL[name](spark, sf_dir, root)
            _filled.add((root, name))
    return root


def _fill_metrics(spark: SparkSession, sf_dir: str, root: str) -> None:
    append(metrics_raw(spark, sf_dir), root, "metrics", once=True)


def _fill_machines(spark: SparkSession, sf_dir: str, root: str) -> None:
    append(machines_raw(spark, sf_dir), root, "machines")


def _fill_evaluations(spark: SparkSession, sf_dir: str, root: str) -> None:
    store_root(spark, sf_dir, "metrics")
    append(evaluations_raw(score(open_table(spark, root, "metrics"))), root, "evaluations", once=True)


_FILL = {"metrics": _fill_metrics, "evaluations": _fill_evaluations, "machines": _fill_machines}


class FilledOnUse(Tables):
    """The stored tables, each filled when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.__dict__.update(spark=spark, sf_dir=sf_dir, opened={}, settled={})

    def _open(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = open_table(self.spark, store_root(self.spark, self.sf_dir, name), name)
            self.settled[name] = settled_days(self.opened[name].inputFiles())
        return self.opened[name]

    metrics = property(lambda self: self._open("metrics"))
    evaluations = property(lambda self: self._open("evaluations"))
    machines = property(lambda self: self._open("machines"))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return FilledOnUse(spark, sf_dir)


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot body per event with two observations; every 20th is broken in one of four ways in turn.

    `kind` says what was asked for; one in three broken bodies answered a request for the machine record.
    """
    text = f"""
      CASE WHEN event_id % 20 <> 0 OR (event_id div 20) % 4 < 2 THEN
        '{{"machine_id":"' || if(event_id % 20 = 0 AND (event_id div 20) % 4 = 1, '', machine_id)
        || '","timestamp":"' || date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        || if(event_id % 20 = 0 AND (event_id div 20) % 4 = 0, '', if(event_id % 2 = 0, 'Z', '+00:00'))
        || '","metrics":[{{"name":"' || name || '","type":"gauge","unit":"' || unit || '","value":'
        || if(event_id % 20 = 1, '"' || cast(value AS string) || '"', cast(value AS string))
        || ',"attributes":{{"k":"' || attributes['k'] || '"}}}},'
        || '{{"name":"event.number","type":"gauge","unit":"1","value":' || cast(event_id AS string)
        || ',"added_later":true}}]}}'
      WHEN (event_id div 20) % 4 = 2 THEN '{{"machine_id":"' || machine_id || '","metrics":[{{"name":"x"}}]}}'
      ELSE '<html>busy ' || event_id || '</html>' END
    """
    return samples(spark, sf_dir).select(
        F.expr("'http://' || machine_id || '/v1/' || if(event_id % 60 = 0, 'machine', 'metrics')").alias("url"),
        F.expr(text).alias("body"),
        F.expr("if(event_id % 60 = 0, 'machine', 'metrics')").alias("kind"),
    )


def sample_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples as they travel: JSON with epoch seconds; ids in several spellings, some records malformed, and where
    each stood in its stream."""
    rows = samples(spark, sf_dir)
    record = rows.select(
        (F.unix_millis("timestamp") / 1000).alias("timestamp"),
        "name",
        "type",
        "unit",
        "value",
        "machine_id",
        F.expr(
            "CASE WHEN event_id % 40 = 4 THEN 'not-a-uuid' WHEN event_id % 4 = 1 THEN upper(metric_id)"
            " WHEN event_id % 4 = 2 THEN 'urn:uuid:' || metric_id WHEN event_id % 4 = 3 THEN '{' || metric_id || '}'"
            " ELSE metric_id END"
        ).alias("metric_id"),
        F.when(F.col("event_id") % 3 != 0, F.col("attributes")).alias("attributes"),
        F.lit(True).alias("added_later"),
        "event_id",
    )
    text = F.to_json(F.struct(*[c for c in record.columns if c != "event_id"]), {"ignoreNullFields": "false"})
    broken = F.expr("CASE WHEN event_id % 40 = 8 THEN 'not json' WHEN event_id % 40 = 12 THEN '[]' END")
    return record.select(
        F.coalesce(broken, text).alias("value"),
        F.lit("raw_metrics").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
    )


# Counters: how much each event adds to which counter, and under which label.
_COUNTED = [
    ("messages_published_total", "topic",
     "CASE event_type WHEN 'click' THEN 'raw_metrics' WHEN 'view' THEN 'evaluations' WHEN 'purchase' THEN 'machines'"
     " WHEN 'error' THEN 'raw_metrics_dlq' ELSE 'machines_dlq' END", "1"),
    ("scrapes_total", "outcome",
     "CASE WHEN user_id % 10 = 0 THEN 'fetch_error' WHEN user_id % 10 = 1 THEN 'publish_error' ELSE 'ok' END", "1"),
    ("scores_total", "algorithm", "CASE WHEN user_id % 2 = 0 THEN 'mad' ELSE 'ewma' END", "1"),
    ("score_micros_total", "algorithm", "CASE WHEN user_id % 2 = 0 THEN 'mad' ELSE 'ewma' END",
     "cast(1 + event_id % 97 AS double)"),
]
_BOUNDS = [("0.05", 0.05), ("0.1", 0.1), ("0.25", 0.25), ("0.5", 0.5), ("1", 1.0), ("+Inf", 1e300)]


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per minute, reset every midnight; a histogram of the values as seconds; two gauges."""
    source = events(spark, sf_dir)
    entry = "struct('{name}' AS name, '{label}' AS label, {value} AS tag, '' AS le, cast({amount} AS double) AS amount)"
    entries = [entry.format(name=n, label=k, value=v, amount=a) for n, k, v, a in _COUNTED]
    entries += [
        "struct('write_seconds_bucket' AS name, 'table' AS label, CASE WHEN event_type = 'view' THEN 'evaluations'"
        f" ELSE 'metrics' END AS tag, '{text}' AS le, CASE WHEN value / 100 <= {bound}D THEN 1.0D ELSE 0.0D END AS amount)"
        for text, bound in _BOUNDS
    ]
    steps = source.select(
        F.date_trunc("MINUTE", "ts").alias("ts"), F.expr(f"explode(array({', '.join(entries)}))").alias("e")
    ).select("ts", "e.*")
    per_minute = steps.groupBy("name", "label", "tag", "le", "ts").agg(F.sum("amount").alias("amount"))
    # At most the 1,440 minutes of a day per window.
    totals = per_minute.selectExpr(
        "*",
        "sum(amount) OVER (PARTITION BY name, label, tag, le, to_date(ts) ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value",
    )
    cumulative = totals.select(
        "ts",
        "name",
        F.expr("if(le = '', map(label, tag), map(label, tag, 'le', le))").alias("labels"),
        "value",
    )
    per_user = source.groupBy(F.date_trunc("MINUTE", "ts").alias("ts"), (F.col("user_id") % 4).alias("task")).agg(
        F.max("value").alias("highest"), F.max("event_id").alias("newest")
    )
    gauges = per_user.select(
        "ts",
        F.expr(
            "inline(array(struct('pending_records' AS name, map('task', cast(task AS string)) AS labels, highest AS value),"
            " struct('up' AS name, map('job', CASE WHEN task < 2 THEN 'collector' ELSE 'writer' END, 'instance',"
            " cast(task AS string)) AS labels, CASE WHEN newest % 11 = 0 THEN 0.0D ELSE 1.0D END AS value)))"
        ),
    )
    return cumulative.unionByName(gauges)


# The same views for DuckDB. `metrics` and `evaluations` are the deduplicated reads.

_SAMPLES_SQL = f"""
samples AS (
  SELECT event_id, {_dashed("md5(cast(event_id AS varchar))")} AS metric_id, 'm' || (user_id % 4) AS machine_id,
    {_NAME} AS name, date_trunc('millisecond', ts) AS timestamp, 'gauge' AS type, {_UNIT} AS unit, value * {UNEVEN}::double AS value,
    json_extract_string(props, '$.k') AS k,
    date_trunc('millisecond', ts) + to_seconds(event_id % 7)
      + to_hours(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END) AS inserted_at
  FROM events)"""

_METRICS_RAW_SQL = f"""
metrics_raw AS (
  SELECT metric_id, machine_id, name, timestamp, type, unit, value, k, inserted_at FROM samples
  UNION ALL
  SELECT metric_id, machine_id, name, timestamp, type, unit, value + 1, k, inserted_at + INTERVAL 1 MINUTE
  FROM samples WHERE {_REPLAYED})"""

_METRICS_SQL = """
metrics AS (
  SELECT * EXCLUDE (version) FROM (
    SELECT *, row_number() OVER (PARTITION BY machine_id, name, timestamp, metric_id ORDER BY inserted_at DESC) AS version
    FROM metrics_raw) WHERE version = 1)"""

_MACHINES_SQL = """
machines_raw AS (
  SELECT 'm' || CASE WHEN c_custkey % 6 = 3 THEN 6 ELSE c_custkey % 6 END AS machine_id, c_name AS hostname, lower(c_mktsegment) AS os,
    '6.' || c_nationkey AS os_version, CASE WHEN c_nationkey % 2 = 0 THEN 'x86_64' ELSE 'arm64' END AS architecture,
    cast(4 + c_custkey % 29 AS integer) AS cores, (8 + c_custkey % 57) * 1073741824 AS total_memory,
    (100 + c_custkey % 1900) * 1000204886 AS total_disk,
    TIMESTAMP '2023-12-31 15:00:00' + to_seconds(c_custkey) AS last_boot,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS last_seen_at,
    TIMESTAMP '2024-01-01 00:00:01' + to_seconds(c_custkey) AS inserted_at
  FROM customer),
machines AS (
  SELECT * EXCLUDE (version) FROM (
    SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY last_seen_at DESC) AS version FROM machines_raw)
  WHERE version = 1)"""

_WINDOWS_SQL = """
scored AS (
  SELECT *,
    CASE name WHEN 'system.cpu.utilization' THEN 10.0::double ELSE 0.0::double END AS min_deviation,
    CASE name WHEN 'system.memory.usage' THEN 0.02::double ELSE 0.0::double END AS min_relative
  FROM metrics
  WHERE name LIKE 'nab.%' OR name IN ('system.cpu.utilization', 'system.memory.usage')),
windows AS (
  SELECT metric_id, machine_id, name, timestamp, value, min_deviation, min_relative,
    list(value) OVER arrived AS w, median(value) OVER arrived AS med, count(*) OVER arrived AS points
  FROM scored
  WINDOW arrived AS (PARTITION BY machine_id, name ORDER BY timestamp, metric_id
                     ROWS BETWEEN 359 PRECEDING AND CURRENT ROW))"""

_DEVIATION = "(x.v - a.average)"
_SCALE = (
    "greatest(3.0::double * sqrt(a.variance), greatest(min_deviation, min_relative * abs(a.average)))"
)
_FLAG = f"(CASE WHEN {_SCALE} > 0 THEN {_DEVIATION} / {_SCALE} > 1.0::double ELSE {_DEVIATION} > 0 END)"
_ALPHA = f"(CASE WHEN a.i >= 10 AND {_FLAG} THEN 0.1::double * 0.1::double ELSE 0.1::double END)"

_EVALUATIONS_SQL = f"""
spreads AS (
  SELECT *, list_median(list_transform(w, lambda v: abs(v - med))) AS mad,
    list_avg(list_transform(w, lambda v: abs(v - med))) AS mean_deviation
  FROM windows),
mads AS (
  SELECT *, greatest(CASE WHEN mad = 0 THEN 1.253314::double * mean_deviation ELSE 1.4826::double * mad END,
      greatest(min_deviation, min_relative * abs(med)) / 3.5::double) AS scale
  FROM spreads WHERE points >= 20),
folds AS (
  SELECT *, list_reduce(
      list_transform(w[2:points - 1], lambda v: {{'i': 0::bigint, 'v': v, 'average': 0.0::double, 'variance': 0.0::double}}),
      lambda a, x: {{'i': a.i + 1, 'v': x.v, 'average': a.average + {_ALPHA} * {_DEVIATION},
        'variance': (1 - {_ALPHA}) * (a.variance + {_ALPHA} * ({_DEVIATION} * {_DEVIATION}))}},
      {{'i': 1::bigint, 'v': 0.0::double, 'average': w[1], 'variance': 0.0::double}}) AS a
  FROM windows WHERE points >= 11),
ewmas AS (
  SELECT *, {_SCALE} AS scale FROM folds),
evaluations AS (
  SELECT metric_id, machine_id, name AS metric_name, timestamp, 'mad' AS algorithm, med AS baseline,
    med - 3.5::double * scale AS lower, med + 3.5::double * scale AS upper,
    CASE WHEN scale > 0 THEN abs(value - med) / scale >= 3.5::double ELSE false END AS is_anomaly
  FROM mads
  UNION ALL
  SELECT metric_id, machine_id, name, timestamp, 'ewma', a.average, NULL, a.average + 1.0::double * scale,
    CASE WHEN scale > 0 THEN (value - a.average) / scale > 1.0::double ELSE value > a.average END
  FROM ewmas),
evaluations_raw AS (
  SELECT * FROM evaluations UNION ALL SELECT * FROM evaluations WHERE {_TWICE})"""


def _counters_sql() -> str:
    parts = [
        f"SELECT date_trunc('minute', ts) AS ts, '{n}' AS name, '{k}' AS label, {v} AS tag, '' AS le,"
        f" cast({a} AS double) AS amount FROM events"
        for n, k, v, a in _COUNTED
    ]
    parts += [
        "SELECT date_trunc('minute', ts), 'write_seconds_bucket', 'table', CASE WHEN event_type = 'view' THEN"
        f" 'evaluations' ELSE 'metrics' END, '{text}', CASE WHEN value / 100 <= {bound}::double THEN 1.0 ELSE 0.0 END"
        " FROM events"
        for text, bound in _BOUNDS
    ]
    return f"""
increments AS ({' UNION ALL '.join(parts)}),
per_minute AS (
  SELECT name, label, tag, le, ts, sum(amount) AS amount FROM increments GROUP BY ALL),
counters AS (
  SELECT ts, name, label, tag, le, sum(amount) OVER (
    PARTITION BY name, label, tag, le, ts::date ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value
  FROM per_minute),
steps AS (
  SELECT *, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value ELSE value - before END AS step FROM (
    SELECT *, lag(value) OVER (PARTITION BY name, label, tag, le ORDER BY ts) AS before FROM counters)),
per_user AS (
  SELECT date_trunc('minute', ts) AS ts, user_id % 4 AS task, max(value) AS highest, max(event_id) AS newest
  FROM events GROUP BY ALL),
gauges AS (
  SELECT ts, 'pending_records' AS name, '' AS job, task, highest AS value FROM per_user
  UNION ALL
  SELECT ts, 'up', CASE WHEN task < 2 THEN 'collector' ELSE 'writer' END, task,
    CASE WHEN newest % 11 = 0 THEN 0.0 ELSE 1.0 END FROM per_user)"""


_VIEWS = [
    ("samples", _SAMPLES_SQL, []),
    ("metrics_raw", _METRICS_RAW_SQL, ["samples"]),
    ("metrics", _METRICS_SQL, ["metrics_raw"]),
    ("machines", _MACHINES_SQL, []),
    ("windows", _WINDOWS_SQL, ["metrics"]),
    ("evaluations", _EVALUATIONS_SQL, ["windows"]),
    ("counters", _counters_sql(), []),
]


def with_views(needed: list[str], query: str, more: str = "") -> str:
    """`query` with the views it needs in front, and their own needs before them. `more` adds views of its own."""
    wanted = set(needed)
    for name, _, needs in reversed(_VIEWS):
        if name in wanted:
            wanted |= set(needs)
    texts = [text for name, text, _ in _VIEWS if name in wanted] + ([more] if more else [])
    return f"WITH {','.join(texts)}\n{query}"
