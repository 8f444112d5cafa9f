from __future__ import annotations

import json
import uuid
from datetime import datetime

import pytest

from gaugeline.operators import decode as dc
from gaugeline.sources.streams import dead_letters, to_kafka
from gaugeline.streaming.sinks import evaluations_row, machines_row, metrics_row

ID = str(uuid.UUID(int=0x5EED << 100 | 7 << 76 | 1 << 63 | 1234567))
SAMPLE = {
    "timestamp": 1930000000.25,
    "name": "fan.speed",
    "type": "counter",
    "unit": "rpm",
    "value": 812.5,
    "machine_id": "rack7-node2",
    "metric_id": ID,
    "attributes": {"slot": "left", "row": "b"},
}
EVALUATION = {
    "metric_id": ID,
    "machine_id": "rack7-node2",
    "metric_name": "fan.speed",
    "timestamp": 1930000000.25,
    "algorithm": "mad",
    "baseline": 790.125,
    "lower": None,
    "upper": 801.0625,
    "is_anomaly": True,
}
MACHINE = {
    "machine_id": "rack7-node2",
    "hostname": "press",
    "os": "bsd",
    "os_version": "14.2",
    "architecture": "riscv64",
    "cores": 12,
    "total_memory": 48 * 2**30,
    "total_disk": 3 * 10**12,
    "last_boot": "2031-03-04T05:06:07+02:00",
    "last_seen_at": 1930000001.75,
}
RECORDS = {"metrics": SAMPLE, "evaluations": EVALUATION, "machines": MACHINE}
OBSERVATION = {"name": "fan.speed", "type": "gauge", "unit": "rpm", "value": "1200.25"}
SNAPSHOT = {"machine_id": "rack7", "timestamp": "2031-03-04T05:06:07+02:00", "metrics": [OBSERVATION]}
SNAPSHOT_TIME = datetime.fromisoformat(SNAPSHOT["timestamp"]).timestamp()


def split(spark, entity, texts):
    texts = [t if isinstance(t, str) else json.dumps(t) for t in texts]
    return dc.decode(spark.createDataFrame([(t,) for t in texts], "value string"), entity)


def without(record, field):
    return {k: v for k, v in record.items() if k != field}


def spoiled(record, texts=(), numbers=(), other=()):
    """The record with one field at a time that breaks a rule, and values that are no record at all."""
    cases = [{**record, f: v} for f in texts for v in ("", None, 8, ["a"])] + [without(record, f) for f in texts]
    cases += [{**record, f: v} for f in numbers for v in ("twelve", "0b1", "", {"a": 1})] + [without(record, f) for f in numbers]
    cases += [{**record, f: v} for f, values in other for v in values]
    return [*cases, "", "{", "null", "17", json.dumps("text"), json.dumps([record, record]), "{}"]


NO_IDS = ("", None, 31, "5eed", ID + "0", ID[:-1] + "g", [ID])
BAD = {
    "metrics": spoiled(
        SAMPLE,
        ("machine_id", "name", "type", "unit"),
        ("value", "timestamp"),
        [("metric_id", NO_IDS), ("attributes", ({"slot": 4}, {"slot": None}, "slot", [1]))],
    ),
    "evaluations": spoiled(
        EVALUATION,
        ("machine_id", "metric_name", "algorithm"),
        ("timestamp", "baseline", "upper"),
        [("metric_id", NO_IDS), ("lower", ("low", [])), ("is_anomaly", ("maybe", {}))],
    ),
    "machines": spoiled(
        MACHINE,
        ("machine_id", "hostname", "os", "os_version", "architecture"),
        ("last_seen_at", "total_disk"),
        [("cores", (-3, 2.75, None)), ("total_memory", (-1,)), ("last_boot", ("2031-03-04T05:06:07", "soon", None))],
    ),
}
GOOD = {
    "metrics": [
        SAMPLE,
        {**SAMPLE, "note": {"any": "thing"}},
        {**SAMPLE, "value": "-7.5"},
        {**SAMPLE, "value": 44},
        {**SAMPLE, "value": "2e2"},
        without(SAMPLE, "attributes"),
        *[{**SAMPLE, "attributes": v} for v in (None, {})],
        *[{**SAMPLE, "metric_id": v} for v in (ID.upper(), ID.replace("-", ""), f"urn:uuid:{ID}", f"{{{ID}}}")],
        json.dumps({**SAMPLE, "value": float("nan")}),
    ],
    "evaluations": [EVALUATION, {**EVALUATION, "lower": -4.0}, {**EVALUATION, "note": 1}],
    "machines": [MACHINE, {**MACHINE, "cores": "12"}, {**MACHINE, "last_boot": "2031-03-04T05:06+02:00"}],
}


@pytest.mark.parametrize("entity", ["metrics", "evaluations", "machines"])
def test_malformed_records_are_set_aside(spark, entity):
    valid, malformed = split(spark, entity, BAD[entity])
    assert valid.collect() == []
    rows = malformed.collect()
    assert len(rows) == len(BAD[entity]) and all(r["reason"] for r in rows)


@pytest.mark.parametrize("entity", ["metrics", "evaluations", "machines"])
def test_valid_records_pass(spark, entity):
    valid, malformed = split(spark, entity, GOOD[entity])
    assert malformed.collect() == []
    rows = valid.collect()
    assert len(rows) == len(GOOD[entity])
    assert rows[0].asDict() == RECORDS[entity]
    if entity == "metrics":
        assert {r["metric_id"] for r in rows} == {ID}
        assert [r["value"] for r in rows[:5]] == [812.5, 812.5, -7.5, 44.0, 200.0]


def test_positions_of_malformed_records_are_kept(spark):
    values = spark.createDataFrame([("17", "raw_metrics", 5, 906)], "value string, topic string, partition int, offset long")
    row = dc.decode(values, "metrics")[1].first()
    assert (row["topic"], row["partition"], row["offset"], row["value"]) == ("raw_metrics", 5, 906, "17")


def test_rows_for_the_tables(spark):
    exact = {**EVALUATION, "baseline": 0.1 + 0.2}
    row = evaluations_row(split(spark, "evaluations", [exact])[0]).first()
    assert (row["baseline"], row["lower"]) == (0.30000000000000004, None)
    row = metrics_row(split(spark, "metrics", [{**SAMPLE, "attributes": None}])[0]).first()
    assert row["attributes"] == {} and row["inserted_at"] is not None
    timed = {**MACHINE, "last_seen_at": 2.25, "last_boot": "2031-03-04T05:06+02:00"}
    row = machines_row(split(spark, "machines", [timed])[0]).selectExpr("cast(last_boot AS string)", "unix_millis(last_seen_at)").first()
    assert tuple(row) == ("2031-03-04 03:06:00", 2250)


def snapshots(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return dc.explode_snapshots(
        spark.createDataFrame([(f"http://agent{i}/samples", t) for i, t in enumerate(texts)], "url string, body string")
    )


def test_a_snapshot_becomes_samples(spark):
    two = {**SNAPSHOT, "metrics": [OBSERVATION, {**OBSERVATION, "attributes": {"slot": "b"}}, OBSERVATION]}
    samples, rejected = snapshots(spark, two, {**SNAPSHOT, "metrics": []})
    rows = samples.collect()
    assert rejected.collect() == []
    assert {(r["timestamp"], r["value"], r["machine_id"]) for r in rows} == {(SNAPSHOT_TIME, 1200.25, "rack7")}
    assert [r["attributes"] for r in rows] == [None, {"slot": "b"}, None]
    ids = [r["metric_id"] for r in rows]
    assert len(set(ids)) == 3 and all(i[14] == "7" and i[19] in "89ab" and len(i) == 36 for i in ids)
    assert ids == [r["metric_id"] for r in snapshots(spark, two)[0].collect()]


def test_one_bad_part_rejects_the_whole_snapshot(spark):
    part = lambda **fields: {**SNAPSHOT, "metrics": [OBSERVATION, {**OBSERVATION, **fields}]}
    bad = spoiled(SNAPSHOT, ("machine_id",), (), [("timestamp", ("2031-03-04T05:06:07", "soon", None)), ("metrics", (None, {}, "x", [OBSERVATION, None], [7]))])
    bad += [part(unit=""), part(name=3), part(type=None), part(value="much"), {**SNAPSHOT, "metrics": [without(OBSERVATION, "unit")]}]
    samples, rejected = snapshots(spark, *bad)
    assert samples.collect() == []
    letters = {r["key"]: json.loads(r["value"]) for r in dead_letters(rejected).collect()}
    assert len(letters) == len(bad)
    for i, body in enumerate(bad):
        letter = letters[f"http://agent{i}/samples"]
        assert letter["body"] == (body if isinstance(body, str) else json.dumps(body)) and letter["error"]


def test_machine_bodies(spark):
    bodies = spark.createDataFrame([("u1", json.dumps(MACHINE)), ("u2", "oops")], "url string, body string")
    records, rejected = dc.machine_records(bodies)
    assert records.first()["hostname"] == "press"
    assert [(r["url"], r["body"]) for r in rejected.collect()] == [("u2", "oops")]


def test_published_records_name_every_field(spark):
    valid = split(spark, "evaluations", [EVALUATION])[0]
    assert to_kafka(valid).columns == ["value"]
    assert list(json.loads(to_kafka(valid).first()["value"]).items()) == list(EVALUATION.items())
    keyed = to_kafka(split(spark, "metrics", [SAMPLE])[0], key="machine_id").first()
    assert keyed["key"] == "rack7-node2" and json.loads(keyed["value"]) == SAMPLE
