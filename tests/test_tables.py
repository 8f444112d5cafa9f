from __future__ import annotations

import os
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.dedup import evaluations_final, latest, machines_final, metrics_final
from gaugeline.plans import checks, lifecycle, panels
from gaugeline.schemas import METRICS_TABLE, TABLES, assert_agreement, assert_schema, stored_schema
from gaugeline.sources.tables import Tables, open_tables, read_table

DAY = datetime(2024, 3, 1, tzinfo=UTC)


def metrics(spark, rows):
    """Rows of (machine, name, seconds, id, value, inserted seconds)."""
    full = [
        (i, m, n, DAY + timedelta(seconds=s), "gauge", "%", float(v), {}, DAY + timedelta(seconds=s + late))
        for m, n, s, i, v, late in rows
    ]
    return spark.createDataFrame(full, METRICS_TABLE)


def evaluations(spark, rows):
    full = [(i, m, n, DAY + timedelta(seconds=s), a, 1.0, None, 2.0, f) for m, n, s, i, a, f in rows]
    return spark.createDataFrame(full, TABLES["evaluations"])


def machines(spark, rows):
    full = [(m, h, "linux", "6", "x86_64", 4, 2**33, 2**40, DAY, DAY + timedelta(seconds=s), DAY) for m, h, s in rows]
    return spark.createDataFrame(full, TABLES["machines"])


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


SAMPLES = [
    ("m1", "cpu", 0, "a", 1, 1),
    ("m1", "cpu", 0, "a", 2, 60),
    ("m1", "cpu", 10, "b", 3, 1),
    ("m2", "cpu", 90_000, "c", 4, 1),
    ("m2", "mem", 90_010, "d", 5, 1),
]


def test_a_whole_row_is_picked_like_its_columns(spark):
    rows = metrics(spark, SAMPLES).withColumn("insert_seq", F.lit(0).cast("long"))
    tied = rows.withColumns({"insert_seq": F.lit(1).cast("long"), "value": F.col("value") + 100, "unit": F.lit(None).cast("string")})
    both, say = rows.unionByName(tied), lambda df: sorted(map(str, df.collect()))
    picked = latest(both, ("machine_id", "name", "timestamp", "metric_id"), "inserted_at", whole=True)
    assert picked.columns == both.columns and say(picked) == say(metrics_final(both))
    assert sorted(r["value"] for r in picked.collect()) == [102, 103, 104, 105]


def test_the_summary_reads_the_table_once(spark, root):
    """What it is made from are the distinct values, in scratch; a series may have values that are null."""
    lifecycle.create_tables(spark, root, register=False)
    rows = metrics(spark, [*SAMPLES, ("m2", "cpu", 90_001, "e", 4, 1), ("m2", "cpu", 90_002, "f", 0, 1)])
    lifecycle.append(rows.withColumn("value", F.when(F.col("metric_id") != "f", F.col("value"))), root, "metrics")
    found = panels.series_summary(open_tables(spark, root))
    assert not [file for file in found.inputFiles() if f"{root}/metrics" in file]
    got = {(r["machine_id"], r["name"]): r for r in found.collect()}
    assert [got["m2", "cpu"][c] for c in ("latest", "min", "mean", "max", "samples", "avg_interval", "p95")] == [None, 4, 4, 4, 3, 1, 4]
    assert [got["m1", "cpu"][c] for c in ("latest", "min", "mean", "max", "samples", "avg_interval")] == [3, 2, 2.5, 3, 2, 10]


def test_last_version_wins(spark):
    kept = {r["metric_id"]: r["value"] for r in metrics_final(metrics(spark, SAMPLES)).collect()}
    assert kept == {"a": 2.0, "b": 3.0, "c": 4.0, "d": 5.0}
    seen = machines_final(machines(spark, [("m1", "old", 1), ("m1", "new", 9), ("m1", "mid", 5)])).collect()
    assert [r["hostname"] for r in seen] == ["new"]
    twice = evaluations(spark, [("m1", "cpu", 0, "a", "mad", True)] * 2 + [("m1", "cpu", 0, "a", "ewma", True)])
    assert evaluations_final(twice).count() == 2


def test_equal_versions_fall_back_to_the_insert_order(spark):
    rows = metrics(spark, [("m1", "cpu", 0, "a", v, 1) for v in (7, 9, 8)])
    rows = rows.withColumn("insert_seq", F.when(F.col("value") == 9, 5).otherwise(F.lit(1)).cast("long"))
    assert metrics_final(rows).first()["value"] == 9.0


def test_key_filters_pass_below_the_collapse(spark, root, capsys):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    within = (DAY, DAY + timedelta(hours=1))
    t = Tables(spark.read.schema(stored_schema("metrics")).parquet(f"{root}/metrics"), None, None)
    panels.series_line(t, ("m1", "cpu"), within).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(machine_id,m1)" in plan and "EqualTo(name,cpu)" in plan
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "attributes" not in next(line for line in plan.splitlines() if line.startswith("ReadSchema"))


def test_days_and_replays_on_disk(spark, root):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    lifecycle.append(metrics(spark, SAMPLES[2:3]), root, "metrics", insert_seq=1)
    assert {d for d in os.listdir(f"{root}/metrics") if d.startswith("date=")} == {"date=2024-03-01", "date=2024-03-02"}
    before = sorted(map(str, read_table(spark, root, "metrics").collect()))
    assert read_table(spark, root, "metrics", dedup=False).count() == 6
    lifecycle.compact(spark, root, "metrics", [date(2024, 3, 1)])
    assert read_table(spark, root, "metrics", dedup=False).count() == 4
    assert sorted(map(str, read_table(spark, root, "metrics").collect())) == before
    with pytest.raises(ValueError, match="unknown table"):
        read_table(spark, root, "other")


def test_compaction_keeps_what_arrives_meanwhile(spark, root):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    lifecycle.append(metrics(spark, SAMPLES[2:3]), root, "metrics", insert_seq=1)
    prepared = lifecycle.prepare_compaction(spark, root, "metrics")
    late = [("m1", "cpu", i, f"late{i}", i, 1) for i in range(50)]
    lifecycle.append(metrics(spark, late), root, "metrics")
    prepared.swap()
    ids = sorted(r["metric_id"] for r in read_table(spark, root, "metrics", dedup=False).collect())
    assert [i for i in ids if i.startswith("late")] == sorted(f"late{i}" for i in range(50))
    assert [i for i in ids if not i.startswith("late")] == sorted({s[3] for s in SAMPLES})


def test_compaction_stopped_before_it_removes_files(spark, root, monkeypatch):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    before = sorted(map(str, read_table(spark, root, "metrics").collect()))

    def stop(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(lifecycle, "delete_path", stop)
        with pytest.raises(OSError, match="gone"):
            lifecycle.compact(spark, root, "metrics")
    assert sorted(map(str, read_table(spark, root, "metrics").collect())) == before
    lifecycle.compact(spark, root, "metrics")
    assert sorted(map(str, read_table(spark, root, "metrics", dedup=False).collect())) == before
    assert lifecycle.prepare_compaction(spark, root, "metrics", [date(1999, 1, 1)]) is None


def test_copies_of_one_row_are_spread_over_files(spark, root):
    one = metrics(spark, SAMPLES[:1]).first()
    values = [F.lit(one[c]).cast(METRICS_TABLE[c].dataType).alias(c) for c in one.asDict() if c != "attributes"]
    copies = spark.range(0, 4_000, 1, 4).select(*values, F.expr("map('k', '1')").alias("attributes"))
    lifecycle.append(copies, root, "metrics")
    sizes = spark.read.parquet(f"{root}/metrics").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2_500
    assert read_table(spark, root, "metrics").count() == 1


def test_a_day_expires_as_a_whole(spark, root):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    newest_of_first_day = DAY + timedelta(seconds=10)
    assert lifecycle.expire(spark, root, "metrics", newest_of_first_day + timedelta(hours=24)) == []
    gone = lifecycle.expire(spark, root, "metrics", newest_of_first_day + timedelta(hours=24, seconds=1))
    assert gone == [date(2024, 3, 1)]
    assert {r["metric_id"] for r in read_table(spark, root, "metrics").collect()} == {"c", "d"}
    lifecycle.append(machines(spark, [("m1", "old", 1)]), root, "machines")
    assert lifecycle.expire(spark, root, "machines", DAY + timedelta(days=900)) == []
    assert read_table(spark, root, "machines").count() == 1


def test_rebuild_renames_there_and_back(spark, root):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    before = sorted(map(str, read_table(spark, root, "metrics", dedup=False).collect()))
    lifecycle.rebuild(spark, root, "metrics", {"inserted_at": "ingested_at"})
    assert "ingested_at" in spark.read.parquet(f"{root}/metrics").columns
    lifecycle.rebuild(spark, root, "metrics", {"ingested_at": "inserted_at"})
    assert sorted(map(str, read_table(spark, root, "metrics", dedup=False).collect())) == before
    assert os.listdir(root) == ["metrics"]


def test_create_and_drop(spark, root):
    lifecycle.create_tables(spark, root)
    lifecycle.create_tables(spark, root)
    assert all(spark.table(name).columns == stored_schema(name).fieldNames() for name in TABLES)
    assert open_tables(spark, root).final("evaluations").count() == 0
    lifecycle.drop_tables(spark)
    assert not any(spark.catalog.tableExists(name) for name in TABLES)


def test_schemas_agree(spark):
    for entity in TABLES:
        assert_agreement(entity)
    with pytest.raises(ValueError, match="schema mismatch"):
        assert_schema(spark.range(1), METRICS_TABLE)


@pytest.fixture
def tables(spark):
    return Tables(
        metrics(spark, [*SAMPLES, ("m3", "cpu", 5, "e", 100, 7200)]),
        evaluations(
            spark,
            [
                ("m1", "cpu", 0, "a", "mad", True),
                ("m1", "cpu", 0, "a", "mad", True),
                ("m1", "cpu", 0, "a", "ewma", True),
                ("m1", "cpu", 10, "b", "mad", False),
                ("m2", "cpu", 90_000, "zz", "mad", True),
            ],
        ),
        machines(spark, [("m1", "box", 1), ("m3", "", 1), ("m9", "box", 1)]),
    )


def test_overview_has_defaults_for_unscored_series(tables):
    rows = [tuple(r)[:2] + (r["anomalies"], r["flagged_by"], r["samples"]) for r in panels.series_overview(tables).collect()]
    assert rows == [
        ("m1", "cpu", 2, "ewma, mad", 2),
        ("m2", "cpu", 1, "mad", 1),
        ("m2", "mem", 0, "", 1),
        ("m3", "cpu", 0, "", 1),
    ]


def test_labels_fall_back_to_ids(tables):
    assert {tuple(r) for r in panels.machine_labels(tables).collect()} == {("m1", "box"), ("m2", "m2"), ("m3", "m3")}
    assert panels.label_to_machine(tables, "box").first()["machine_id"] == "m1"
    assert panels.label_to_machine(tables, "nobody").collect() == []


def test_joins_on_the_sample(tables):
    points = panels.anomaly_points(tables, ("m1", "cpu")).collect()
    assert [(r["algorithm"], r["anomaly"]) for r in points] == [("ewma", 2.0), ("mad", 2.0)]
    bands = panels.sample_with_bands(tables, "mad", ("m2", "mem")).first()
    assert (bands["value"], bands["baseline"], bands["is_anomaly"]) == (5.0, None, None)
    assert [r["metric_id"] for r in checks.orphans(tables).collect()] == ["zz"]
    assert panels.recent_anomalies(tables, 1, "m1").count() == 1


def test_summary_of_one_sample_and_of_none(tables):
    one = panels.series_summary(tables, ("m2", "mem")).first()
    assert (one["latest"], one["p95"], one["samples"], one["avg_interval"]) == (5.0, 5.0, 1, None)
    none = panels.series_summary(tables, ("m2", "none")).first()
    assert (none["latest"], none["p95"], none["samples"]) == (None, None, 0)
    two = panels.series_summary(tables, ("m1", "cpu")).first()
    assert (two["avg_interval"], two["p95"], two["mean"]) == (10.0, 2.95, 2.5)


def test_histogram_of_flat_data_and_its_last_bucket(spark):
    flat = Tables(metrics(spark, [("m", "x", i, f"f{i}", 5, 1) for i in range(4)]), None, None)
    assert [tuple(r) for r in panels.value_histogram(flat, ("m", "x")).collect()] == [(1, 5.0, 4)]
    wide = Tables(metrics(spark, [("m", "x", i, f"f{i}", i, 1) for i in range(31)]), None, None)
    counts = {r["bucket"]: r["samples"] for r in panels.value_histogram(wide, ("m", "x")).collect()}
    assert len(counts) == 30 and counts[30] == 2 and sum(counts.values()) == 31


def test_raw_reads_keep_replays(tables):
    row = panels.stored(tables).first()
    assert (row["metric_rows"], row["evaluation_rows"], row["series"]) == (6, 5, 4)
    delays = panels.ingest_delay(tables, seconds=86_400).collect()
    assert [r["p50"] for r in delays] == [1.0, 1.0] and [r["p95"] for r in delays] == [pytest.approx(54.1), 1.0]
    assert sum(r["rows_per_second"] for r in panels.ingest_rate(tables, seconds=86_400).collect()) == pytest.approx(6 / 86_400)


def test_fresh_rows(tables):
    rows = checks.fresh_rows(tables, DAY + timedelta(minutes=10)).collect()
    assert {r["table"]: r["fresh"] for r in rows} == {"metrics": 4, "machines": 3, "evaluations": 2}


def _exchanges(df):
    """Shuffles and scans of a plan with broadcasts off, told from its text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(f"Exchange {kind}partitioning(" in line for line in plan.splitlines() for kind in ("hash", "range")), plan.count("FileScan")


@pytest.mark.parametrize(
    ("panel", "shuffles"), [("series_overlay", 2), ("sample_with_bands", 3), ("anomaly_points", 3), ("recent_anomalies", 2)]
)
def test_panels_join_where_the_collapse_has_put_the_rows(spark, tmp_path, panel, shuffles):
    root = str(tmp_path)
    lifecycle.create_tables(spark, root, register=False)
    t = open_tables(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        more = {"sample_with_bands": ("mad",), "recent_anomalies": (200,)}.get(panel, ())
        frame = getattr(panels, panel)(t, *more)
        frame.write.format("noop").mode("overwrite").save()
        assert _exchanges(frame) == (shuffles, 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_settled_days_are_read_without_a_shuffle(spark, root):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    lifecycle.append(machines(spark, [("m1", "old", 1), ("m1", "new", 9)]), root, "machines")
    lifecycle.create_tables(spark, root, register=False)
    before = sorted(map(str, read_table(spark, root, "metrics").collect()))
    lifecycle.compact(spark, root, "metrics", [date(2024, 3, 1)])
    lifecycle.compact(spark, root, "machines")
    t = open_tables(spark, root)
    assert set(t.settled["metrics"]) == {"date=2024-03-01"} and set(t.settled["machines"]) == {"machines"}
    first_day = t.final("metrics", (DAY, DAY + timedelta(hours=1)))
    assert "Exchange" not in _plan(read_table(spark, root, "machines"))
    assert sorted(map(str, t.final("metrics").collect())) == before
    assert first_day.count() == 2
    lifecycle.compact(spark, root, "metrics")
    assert sorted(map(str, read_table(spark, root, "metrics").collect())) == before
    assert set(open_tables(spark, root).settled["metrics"]) == {"date=2024-03-01", "date=2024-03-02"}
    lifecycle.append(metrics(spark, SAMPLES[2:3]), root, "metrics", insert_seq=1)  # a replay unsettles its day
    assert set(open_tables(spark, root).settled["metrics"]) == {"date=2024-03-02"}
    assert sorted(map(str, read_table(spark, root, "metrics").collect())) == before


def test_compaction_leaves_settled_days_alone(spark, root):
    lifecycle.append(metrics(spark, SAMPLES), root, "metrics")
    lifecycle.compact(spark, root, "metrics")
    files = {f for _, _, names in os.walk(root) for f in names}
    assert lifecycle.prepare_compaction(spark, root, "metrics") is None
    lifecycle.append(metrics(spark, SAMPLES[2:3]), root, "metrics", insert_seq=1)
    prepared = lifecycle.prepare_compaction(spark, root, "metrics")
    assert {f.rsplit("/", 2)[1] for f in prepared.files} == {"date=2024-03-01"}
    prepared.swap()
    assert {f for _, _, names in os.walk(f"{root}/metrics/date=2024-03-02") for f in names} <= files
    assert read_table(spark, root, "metrics", dedup=False).count() == 4


def test_rows_without_a_time_are_kept_beside_settled_days(spark, root):
    timeless = metrics(spark, SAMPLES[:1]).withColumn("timestamp", F.lit(None).cast("timestamp"))
    lifecycle.append(metrics(spark, SAMPLES).unionByName(timeless), root, "metrics")
    before = sorted(map(str, read_table(spark, root, "metrics").collect()))
    assert len(before) == 5
    lifecycle.compact(spark, root, "metrics")
    assert sorted(map(str, read_table(spark, root, "metrics").collect())) == before


def test_ids_are_found_in_few_row_groups(spark, root):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("metric_id"),
        F.concat(F.lit("m"), F.col("id") % 40).alias("machine_id"),
        F.lit("cpu").alias("name"),
        (F.lit(DAY).cast("timestamp") + F.make_dt_interval(secs=F.col("id") / 10)).alias("timestamp"),
        F.lit("gauge").alias("type"), F.lit("%").alias("unit"), F.col("id").cast("double").alias("value"),
        F.expr("map('k', '1')").alias("attributes"), F.lit(DAY).cast("timestamp").alias("inserted_at"),
    )
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 5_000)
    try:
        lifecycle.append(rows, root, "metrics")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    lifecycle.create_tables(spark, root, register=False)
    wanted = [r["metric_id"] for r in rows.where("id % 66667 = 3").select("metric_id").collect()]
    t = open_tables(spark, root)
    spark.sparkContext.setJobGroup("lookup", "lookup")
    try:
        found = panels.samples_by_id(t, wanted).collect()
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert sorted(r["metric_id"] for r in found) == sorted(wanted) and len(wanted) == 3
    status, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for job in status.getJobIdsForGroup("lookup") for s in status.getJobInfo(job).stageIds}
    read = sum(store.lastStageAttempt(s).inputRecords() for s in stages)
    assert 3 <= read <= 40_000  # three files of 5,000 rows, and what the filters let through by mistake


def test_rows_are_computed_once_to_be_appended_in_order(spark, root):
    """No pass for a sample of the rows comes before the one that stores them; files are in key order all the same."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = metrics(spark, [("m1", "cpu", 40_000 * (i % 5) + i, f"{i:03}", i, 1) for i in range(60)])
    lifecycle.append(rows.mapInArrow(count, rows.schema), root, "metrics", once=True)
    assert seen.value == 60
    stored = spark.read.parquet(f"{root}/metrics").select(F.input_file_name().alias("file"), "timestamp", "metric_id").collect()
    by_file = {}
    for row in stored:
        by_file.setdefault(row["file"], []).append((row["timestamp"], row["metric_id"]))
    assert len(stored) == 60 and all(keys == sorted(keys) for keys in by_file.values())
