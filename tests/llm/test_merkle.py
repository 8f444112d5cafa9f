from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import merkle

RECORDS = "archive long, offset long, content binary, node string, digest int"


def records(seed=1, archives=4, each=60):
    rng, out = random.Random(seed), []
    for archive in range(archives):
        at = 0
        for _ in range(rng.randint(1, each)):
            content = rng.randbytes(rng.randint(0, 400))
            out.append((archive, at, content))
            at += len(content) + 10
    return out


def run(spark, primary, replica, **more):
    frame = lambda rows: spark.createDataFrame([(*r, "clash", 1) for r in rows], RECORDS).repartition(3)
    rows = merkle.audit(frame(primary), frame(replica), **more).collect()
    return sorted(((r["archive"], r["offset"], r["status"]) for r in rows), key=str)


@pytest.mark.parametrize(("leaf", "fanout"), [(64, 2), (500, 4), (1 << 20, 16)])
def test_locates_exactly_the_damage(spark, leaf, fanout):
    primary = records()
    replica = list(primary)
    a, o, c = replica[7]
    replica[7] = (a, o, c + b"!")
    missing = replica.pop(20)
    replica.append((2, 10**6, b"new"))
    replica.append((9, 0, b"other file"))
    want = [(a, o, "changed"), (*missing[:2], "missing"), (2, 10**6, "extra"), (9, 0, "extra")]
    assert run(spark, primary, replica, leaf_bytes=leaf, fanout=fanout) == sorted(want, key=str)


def test_equal_replicas_odd_and_repeated_rows(spark):
    primary = [*records(2), (None, 5, b"x"), (1, None, b"y"), (1, None, None), (3, 7777, b"twice"), (3, 7777, b"twice")]
    assert run(spark, primary, primary[::-1], leaf_bytes=100, fanout=3) == []
    fewer = primary[:-1]
    assert run(spark, primary, fewer, leaf_bytes=100, fanout=3) == [(3, 7777, "changed")]


def test_empty_replicas(spark):
    primary = records(3, archives=2, each=5)
    assert run(spark, primary, []) == sorted(((a, o, "missing") for a, o, _ in primary), key=str)
    assert run(spark, [], []) == []


def test_archived_pages(spark):
    rows = [(i, f"http://h/{i}", "é" * (i % 5)) for i in range(1200)] + [(None, None, None), (7, "http://h/7", "again")]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, archive int, offset string")
    found = merkle.archived(pages).withColumn("end", F.col("offset") + F.length("content")).collect()
    assert len(found) == len(rows)
    by_archive = {}
    for r in sorted(found, key=lambda r: r["offset"]):
        assert r["offset"] == by_archive.get(r["archive"], 0)
        by_archive[r["archive"]] = r["end"]
    assert bytes(found[0]["content"]).startswith(b"WARC/1.0\r\n")


@pytest.mark.parametrize("place", [(3, 7777), (1, None), (None, None)])
def test_change_among_many_records_at_one_place(spark, place):
    many = [(*place, b"record %d" % i) for i in range(40)]
    primary = [*records(2), *many]
    assert run(spark, primary, primary[::-1], leaf_bytes=100, fanout=3) == []
    for i in (0, 7, 39):
        replica = [*records(2), *many[:i], (*place, b"changed"), *many[i + 1 :]]
        assert run(spark, primary, replica, leaf_bytes=100, fanout=3) == [(*place, "changed")]
    swapped = [*records(2), *many[:-2], many[0], many[1]]  # as many records, two of them twice
    assert run(spark, primary, swapped, leaf_bytes=100, fanout=3) == [(*place, "changed")]


def test_long_content_and_fingerprints_in_its_place(spark):
    long = b"0123456789" * 2_000_000
    primary = [(0, 0, long), (0, len(long), b"after"), (1, 0, None)]
    replica = [(0, 0, long[:-1] + b"x"), (0, len(long), b"after"), (1, 0, b"")]
    assert run(spark, primary, replica) == [(0, 0, "changed")]
    frames = [spark.createDataFrame([(*r, "clash", 1) for r in rows], RECORDS) for rows in (primary, replica)]
    length, sha = merkle.fingerprint(F.col("content"))
    short = [f.select("archive", "offset", length.alias("length"), sha.alias("sha"), "node") for f in frames]
    assert [tuple(r) for r in merkle.audit(*short).collect()] == [(0, 0, "changed")]


def test_damaged_copy_is_found_and_nothing_else(spark):
    rows = [(i, f"http://h/{i}", "word " * (i % 9)) for i in range(900)] + [(None, None, None), (None, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r["page_id"]: r["status"] for r in merkle.audit(*merkle.with_damaged_copy(pages), keep=("page_id",)).collect()}
    lost = {i: "missing" for i in range(900) if i % 211 == 7}
    changed = {i: "changed" for i in range(900) if i % 97 == 5 or i % 389 == 11}
    assert found == changed | lost
