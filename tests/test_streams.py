from __future__ import annotations

import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

import brute
from gaugeline.operators import counters as ct
from gaugeline.operators.dedup import drop_replays
from gaugeline.operators.scoring import score
from gaugeline.sources.streams import SourceSpec, read_snapshots, read_stream, to_kafka
from gaugeline.sources.tables import read_table
from gaugeline.streaming import sinks
from gaugeline.streaming.scoring import score_stream, start_bulk_scoring
from test_decode import BAD, EVALUATION, MACHINE, SAMPLE, SNAPSHOT
from test_scoring import frame

SCHEMA = "metric_id string, machine_id string, name string, timestamp double, value double"


def epoch(samples):
    return samples.withColumn("timestamp", F.unix_micros("timestamp") / 1e6).select(*[c.split()[0] for c in SCHEMA.split(", ")])


def run(spark, source, out, checkpoint, per_trigger=None):
    reader = spark.readStream.schema(SCHEMA)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    query = (
        score_stream(reader.parquet(source))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def comparable(rows):
    return sorted(
        (r["metric_id"], r["algorithm"], round(r["baseline"], 6), r["lower"] and round(r["lower"], 6), round(r["upper"], 6), r["is_anomaly"])
        for r in rows.collect()
    )


@pytest.fixture
def series():
    return {
        ("m1", brute.CPU): [50.0 + (i * 7) % 5 + (80 if i % 97 == 96 else 0) for i in range(420)],
        ("m2", "nab.x"): [float(i % 9) for i in range(60)],
        ("m2", "system.uptime"): [1.0] * 60,
    }


def parts(samples, path, bounds):
    """A file per stretch of time, named in order."""
    samples = samples.withColumn("second", F.expr("timestamp - 1704067200"))
    for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        part = samples.where((F.col("second") >= low) & (F.col("second") < high)).drop("second")
        part.coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            if name.startswith("part-") and not name.startswith("part-9"):
                os.utime(f"{path}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
                os.rename(f"{path}/{name}", f"{path}/part-9{k:04d}-{name}")


def test_stream_equals_batch_over_many_batches_and_a_restart(spark, series, tmp_path):
    samples = epoch(frame(spark, series)).persist()
    expected = comparable(score(samples))
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    parts(samples, source, [0, 1, 15, 30])
    run(spark, source, out, checkpoint, per_trigger=1)
    first = spark.read.parquet(out).count()
    parts(samples, source, [30, 200, 420])
    run(spark, source, out, checkpoint, per_trigger=1)
    assert 0 < first < len(expected)
    assert comparable(spark.read.parquet(out)) == expected


def test_bulk_scoring_equals_batch(spark, series, small_chunks, tmp_path):
    samples = epoch(frame(spark, series)).persist()
    source, out, state, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state", "cp"))
    for low, high in ((0, 5), (5, 15), (15, 400), (400, 420)):
        second = F.expr("timestamp - 1704067200")
        samples.where((second >= low) & (second < high)).write.mode("append").parquet(source)
        start_bulk_scoring(
            spark.readStream.schema(SCHEMA).parquet(source),
            lambda scored, _: scored.write.mode("append").parquet(out),
            state,
            checkpoint,
        ).awaitTermination()
    assert comparable(spark.read.parquet(out)) == comparable(score(samples))
    assert sorted(os.listdir(state)) == ["batch-2", "batch-3"]
    kept = spark.read.parquet(f"{state}/batch-3").groupBy("name").agg(F.count("*").alias("n")).collect()
    assert {r["name"]: r["n"] for r in kept} == {brute.CPU: 359, "nab.x": 60}


def test_a_series_is_cut_down_before_the_shuffle(spark, capsys):
    from gaugeline.streaming.scoring import score_after

    score_after(None, epoch(frame(spark, {("m", "nab.x"): [1.0] * 40})))[1].explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) and "Partial" in plan


def test_not_a_number_is_not_null(spark, tmp_path):
    values = [1.0, 2.0] * 15 + [float("nan")] + [1.0] * 5
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    epoch(frame(spark, {("m", "nab.x"): values})).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    writer = score_stream(stream).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(out).where("algorithm = 'mad'").collect()
    broken = [r for r in rows if r["baseline"] != r["baseline"]]
    assert len(broken) == 6 and all(r["lower"] != r["lower"] and not r["is_anomaly"] for r in broken)
    assert all(r["baseline"] is not None for r in rows)


def test_late_samples_are_scored(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    early = epoch(frame(spark, {("m", "nab.x"): [1.0] * 30}))
    late = early.withColumn("metric_id", F.concat(F.lit("late-"), "metric_id"))
    early.withColumn("timestamp", F.col("timestamp") + 10_000).coalesce(1).write.parquet(source)
    run(spark, source, out, checkpoint)
    late.coalesce(1).write.mode("append").parquet(source)
    run(spark, source, out, checkpoint)
    assert spark.read.parquet(out).where("metric_id LIKE 'late-%'").count() == 60


def test_replay_without_checkpoint_collapses(spark, series, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "root")
    samples = epoch(frame(spark, series))
    parts(samples, source, [0, 100, 420])
    texts = str(tmp_path / "texts")
    for attempt in ("one", "two"):
        out = str(tmp_path / f"out-{attempt}")
        run(spark, source, out, str(tmp_path / f"cp-{attempt}"))
        scored = spark.read.parquet(out).withColumn("metric_id", F.expr("regexp_replace(md5(metric_id), '(.{8})(.{4})(.{4})(.{4})', '$1-$2-$3-$4-')"))
        to_kafka(scored).write.mode("append").parquet(texts)
    stream = read_stream(spark, SourceSpec("parquet", texts, topic="evaluations"))
    sinks.start_sink(stream, sinks.SINKS["evaluations"], root, str(tmp_path / "cp"), trigger=None).awaitTermination()
    raw = read_table(spark, root, "evaluations", dedup=False).count()
    assert raw == 2 * read_table(spark, root, "evaluations").count() == 2 * scored.count()


@pytest.mark.parametrize(("entity", "record"), [("metrics", SAMPLE), ("evaluations", EVALUATION), ("machines", MACHINE)])
def test_sink_loads_good_records_and_keeps_bad_ones(spark, tmp_path, entity, record):
    source, root = tmp_path / "in", str(tmp_path / "root")
    source.mkdir()
    bad = [t if isinstance(t, str) else json.dumps(t) for t in BAD[entity] if t != ""]
    (source / "a.txt").write_text("\n".join([json.dumps(record), *bad, json.dumps({**record, "added_later": 1})]))
    stream = read_stream(spark, SourceSpec("text", str(source), topic=entity))
    sinks.start_sink(stream, sinks.SINKS[entity], root, str(tmp_path / "cp"), trigger=None).awaitTermination()
    assert read_table(spark, root, entity, dedup=False).count() == 2
    assert read_table(spark, root, entity).count() == 1
    kept = spark.read.json(f"{root}/malformed")
    assert kept.count() == len(bad) and {r["topic"] for r in kept.select("topic").collect()} == {entity}
    totals = {(r["name"], r["labels"].get("le")): r["value"] for r in sinks.job_counters(spark, root).collect()}
    assert totals["messages_consumed_total", None] == len(bad) + 2
    assert totals["malformed_records_total", None] == len(bad)
    assert totals["rows_written_total", None] == 2
    assert totals["write_seconds_bucket", "+Inf"] == 1
    before = len(os.listdir(f"{root}/counters"))
    sinks.start_sink(stream, sinks.SINKS[entity], root, str(tmp_path / "cp"), trigger=None).awaitTermination()
    assert read_table(spark, root, entity, dedup=False).count() == 2 and len(os.listdir(f"{root}/counters")) == before


def texts(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def test_nothing_is_written_for_an_empty_or_all_malformed_batch(spark, tmp_path):
    calls = []
    write = lambda *a, **k: calls.append(a)
    spec = sinks.SINKS["metrics"]
    assert sinks.load_batch(texts(spark, SAMPLE).where("false"), spec, str(tmp_path), write=write) == (0, 0)
    assert sinks.load_batch(texts(spark, "[]"), spec, str(tmp_path), write=write) == (1, 1)
    assert not calls and os.listdir(tmp_path) == ["malformed"]
    assert sinks.load_batch(texts(spark, "[]", SAMPLE), spec, str(tmp_path), write=write) == (2, 1)
    assert len(calls) == 1


def test_a_failing_write_is_repeated_then_raised():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise OSError("down")

    sinks.write_with_retries(flaky, sleep=waits.append)
    assert (len(calls), waits) == (2, [1.0])
    waits.clear()

    def broken():
        raise OSError("down")

    with pytest.raises(OSError, match="down"):
        sinks.write_with_retries(broken, attempts=3, wait=0.5, sleep=waits.append)
    assert waits == [0.5, 1.0]
    waits.clear()
    with pytest.raises(OSError, match="down"):
        sinks.write_with_retries(broken, sleep=waits.append)
    assert waits == [1.0, 2.0, 4.0, 8.0]


def test_progress_is_not_recorded_before_the_write(spark, tmp_path, monkeypatch):
    """A sink whose write fails fails its query; the next run reads the same records again."""
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "root"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.txt").write_text(json.dumps(SAMPLE))
    stream = read_stream(spark, SourceSpec("text", str(source), topic="raw_metrics"))
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "load_batch", lambda *a, **k: (_ for _ in ()).throw(OSError("down")))
        query = sinks.start_sink(stream, sinks.SINKS["metrics"], root, checkpoint, trigger=None)
        with pytest.raises(Exception, match="down"):
            query.awaitTermination()
    sinks.start_sink(stream, sinks.SINKS["metrics"], root, checkpoint, trigger=None).awaitTermination()
    assert read_table(spark, root, "metrics").count() == 1


def test_one_failing_sink_stops_the_others(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text(json.dumps(SAMPLE))
    good = read_stream(spark, SourceSpec("text", str(source), topic="raw_metrics"))
    bad = good.withColumn("value", F.expr("raise_error('broken source')").cast("string"))
    with pytest.raises(Exception, match="broken source"):
        sinks.run_sinks(spark, {"metrics": good, "machines": bad}, str(tmp_path / "root"), str(tmp_path / "cp"))
    assert spark.streams.active == []


def test_collector_publishes_samples_and_dead_letters(spark, tmp_path):
    source, published = str(tmp_path / "in"), {}
    bodies = [("http://a/v1/metrics", json.dumps(SNAPSHOT)), ("http://b/v1/metrics", "<html>busy</html>")]
    spark.createDataFrame(bodies, "url string, body string").write.parquet(source)
    assert read_snapshots(spark, source).count() == 2

    def publish(records, topic):
        published.setdefault(topic, []).extend((r["key"], json.loads(r["value"])) for r in records.collect())

    stream = spark.readStream.schema("url string, body string").parquet(source)
    sinks.start_collector(stream, publish, "raw_metrics", str(tmp_path / "cp"), trigger=None).awaitTermination()
    assert [(k, v["value"]) for k, v in published["raw_metrics"]] == [("rack7", 1200.25)]
    (key, letter), = published["raw_metrics_dlq"]
    assert key == letter["url"] == "http://b/v1/metrics" and letter["body"] == "<html>busy</html>"


def test_collector_tells_machines_from_metrics(spark, tmp_path):
    source, published = str(tmp_path / "in"), {}
    bodies = [
        ("u1", json.dumps(SNAPSHOT), "metrics"),
        ("u2", json.dumps(MACHINE), "machine"),
        ("u3", json.dumps(SNAPSHOT), "machine"),
        ("u4", json.dumps(MACHINE), "metrics"),
        ("u5", "<html>busy</html>", "machine"),
    ]
    spark.createDataFrame(bodies, "url string, body string, kind string").write.parquet(source)

    def publish(records, topic):
        published.setdefault(topic, []).extend((r["key"], json.loads(r["value"])) for r in records.collect())

    stream = spark.readStream.schema("url string, body string, kind string").parquet(source)
    sinks.start_collector(stream, publish, "raw_metrics", str(tmp_path / "cp"), trigger=None).awaitTermination()
    assert [v["machine_id"] for _, v in published["raw_metrics"]] == ["rack7"]
    assert published["machines"] == [(MACHINE["machine_id"], MACHINE)]
    assert [k for k, _ in published["raw_metrics_dlq"]] == ["u4"]
    assert sorted(k for k, _ in published["machines_dlq"]) == ["u3", "u5"]


def stored(monkeypatch, module, *columns):
    """The rows that each copy in scratch holds, as they are written."""
    copies, write = [], module.materialise

    def noted(df, label, **options):
        copies.append((written := write(df, label, **options)).select(*columns).collect())
        return written

    monkeypatch.setattr(module, "materialise", noted)
    return copies


def test_the_collector_stores_bodies_of_both_kinds_at_once_and_text_of_rejected_ones_alone(spark, tmp_path, monkeypatch):
    source, copies = str(tmp_path / "in"), stored(monkeypatch, sinks, "url", "body")
    bodies = [("u1", json.dumps(SNAPSHOT), "metrics"), ("u2", json.dumps(MACHINE), "machine"), ("u3", "<html>", "machine"), ("u4", "{}", "metrics")]
    spark.createDataFrame(bodies, "url string, body string, kind string").write.parquet(source)
    stream = spark.readStream.schema("url string, body string, kind string").parquet(source)
    sinks.start_collector(stream, lambda *_: None, "raw_metrics", str(tmp_path / "cp"), trigger=None).awaitTermination()
    (copy,) = copies
    assert sorted((r["url"], r["body"]) for r in copy if r["body"]) == [("u3", "<html>"), ("u4", "{}")] and len(copy) == 4


def test_a_sink_stores_the_text_of_malformed_records_alone(spark, tmp_path, monkeypatch):
    copies = stored(monkeypatch, sinks, "value", "record", "reason")
    assert sinks.load_batch(texts(spark, SAMPLE, "[]"), sinks.SINKS["metrics"], str(tmp_path)) == (2, 1)
    ((good, bad),) = [sorted(copy, key=lambda r: r["reason"] is not None) for copy in copies]
    assert good["value"] is None and good["record"]["metric_id"] and (bad["value"], bad["record"]) == ("[]", None)


def test_bulk_scoring_stores_what_is_scored_alone(spark, tmp_path, monkeypatch):
    from gaugeline.streaming import scoring

    source, copies = str(tmp_path / "in"), stored(monkeypatch, scoring, "*")
    samples = epoch(frame(spark, {("m", "nab.x"): [1.0] * 30, ("m", "unscored"): [1.0] * 30}))
    samples.withColumn("unit", F.lit("By")).write.parquet(source)
    stream = spark.readStream.schema(f"{SCHEMA}, unit string").parquet(source)
    out, state, progress = (str(tmp_path / n) for n in ("out", "state", "cp"))
    start_bulk_scoring(stream, lambda df, _: df.write.parquet(out), state, progress).awaitTermination()
    (copy,) = copies
    assert len(copy) == 30 and {r["name"] for r in copy} == {"nab.x"} and "unit" not in copy[0].asDict()


def test_record_sink_and_replay_suppression(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    row = (EVALUATION["metric_id"], "mad", 1.0)
    spark.createDataFrame([row, row, (*row[:1], "ewma", 1.0)], "metric_id string, algorithm string, timestamp double").write.parquet(source)
    stream = spark.readStream.schema("metric_id string, algorithm string, timestamp double").parquet(source)
    once = drop_replays(stream.withColumn("event_time", F.timestamp_seconds("timestamp")), "1 hour").drop("event_time")
    sinks.start_record_sink(once, "text", out, str(tmp_path / "cp"), trigger=None).awaitTermination()
    assert sorted(json.loads(r["value"])["algorithm"] for r in spark.read.text(out).collect()) == ["ewma", "mad"]


def test_counters_of_the_sinks_can_be_asked(spark, tmp_path):
    counted = sinks.SinkCounters("metrics")
    for amount in (5, 7):
        counted.add("rows_written_total", amount)
        counted.add_write(0.2)
        counted.save(spark, str(tmp_path))
    everything = (datetime(2020, 1, 1, tzinfo=UTC), datetime(2100, 1, 1, tzinfo=UTC))
    rows = ct.counter_increase(sinks.job_counters(spark, str(tmp_path)), "rows_written_total", everything, by=["table"])
    assert [tuple(r) for r in rows.collect()] == [("metrics", 7.0)]


def test_a_batch_that_is_run_again_keeps_each_letter_once(spark, tmp_path):
    """A failure between the two writes, and one after both: the batch comes again under its number."""
    spec, root, failures = sinks.SINKS["metrics"], str(tmp_path), [1]

    def write(*args, **kwargs):
        sinks.append(*args, **kwargs)
        if failures.pop():
            raise OSError("down")

    batch = texts(spark, SAMPLE, "[]", "not json")
    with pytest.raises(OSError):
        sinks.load_batch(batch, spec, root, batch_id=7, attempts=1, write=write)
    for _ in range(2):
        failures[:] = [0]
        assert sinks.load_batch(batch, spec, root, batch_id=7, write=write) == (3, 2)
    sinks.load_batch(texts(spark, "{}"), spec, root, batch_id=8, write=write)
    letters = spark.read.json(f"{root}/malformed")
    assert sorted(r["value"] for r in letters.collect()) == ["[]", "not json", "{}"]
    assert {r["table"] for r in letters.select("table").collect()} == {"metrics"}
    assert read_table(spark, root, "metrics", dedup=False).count() == 3 and read_table(spark, root, "metrics").count() == 1


def test_compacted_counters_say_the_same_in_fewer_files(spark, tmp_path):
    root, counted = str(tmp_path), sinks.JobCounters(job="x")
    for amount in range(1, 6):
        counted.add("things_total", amount, kind="a")
        counted.add_write(0.2)
        counted.save(spark, root)
    say = lambda: sorted((r["ts"], r["name"], sorted(r["labels"].items()), r["value"]) for r in sinks.job_counters(spark, root).collect())
    files = lambda: [f for f in os.listdir(f"{root}/counters") if f.endswith(".parquet")]
    before = say()
    assert len(files()) == 5
    sinks.compact_counters(spark, root)
    assert say() == before and len(files()) < 5


def test_the_collector_counts_outcomes(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "root")
    good = json.dumps(SNAPSHOT)
    rows = [("http://a/v1/metrics", good), ("http://a/v1/metrics", "<html>"), ("http://b/v1/metrics", None)]
    spark.createDataFrame(rows, "url string, body string").write.parquet(source)
    stream = spark.readStream.schema("url string, body string").parquet(source)
    down = [True]

    def publish(records, topic):
        if down[0]:
            raise OSError("no broker")
        records.write.mode("append").parquet(str(tmp_path / topic))

    run = lambda: sinks.start_collector(stream, publish, "raw", str(tmp_path / "cp"), trigger=None, counters_root=root)
    with pytest.raises(Exception, match="no broker"):
        run().awaitTermination()
    down[0] = False
    run().awaitTermination()
    totals = {(r["name"], *sorted(r["labels"].values())): r["value"] for r in sinks.job_counters(spark, root).collect()}
    assert totals == {
        ("scrapes_total", "publish_error"): 2,
        ("scrapes_total", "ok"): 2,
        ("scrapes_total", "fetch_error"): 1,
        ("invalid_responses_total", "metrics"): 2,
        ("messages_published_total", "raw"): len(SNAPSHOT["metrics"]),
    }
