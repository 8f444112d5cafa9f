from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import driver_views as views
from check_oracle import rows_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 852


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = rows_of(entry.queries()[name](spark, SF_DIR).toPandas())
    assert got.equals(rows_of(db.execute(entry.oracle_sql()[name]).df()))


def test_sizes_beyond_tebibytes_equal_sql(spark, db, tmp_path):
    """Keys as of a customer table of 1 GB: sizes of more than 1024 TiB, one of them a hair below the middle of two hundredths."""
    name = "scalar_text"
    nation = "CASE WHEN c_custkey = 122 THEN 8 ELSE c_nationkey END::integer AS c_nationkey"
    shifted = f"SELECT * REPLACE (c_custkey + 854450 AS c_custkey, {nation}) FROM customer"
    db.execute(f"COPY ({shifted}) TO '{tmp_path}/customer.parquet'")
    got = rows_of(entry.queries()[name](spark, str(tmp_path)).toPandas())
    want = db.execute(f"WITH customer AS ({shifted.replace('FROM customer', 'FROM main.customer')}) {entry.oracle_sql()[name]}").df()
    assert got.equals(rows_of(want)) and got.str.contains("5977.80 TiB").any()


def test_samples_are_stored_without_scoring(spark, monkeypatch):
    """A question about samples fills their table alone; evaluations are scored from what is stored."""
    monkeypatch.setattr(views, "_stored", {})
    scored = []
    monkeypatch.setattr(views, "score", lambda rows, score=views.score: scored.append(rows.inputFiles()) or score(rows))
    lines = entry.queries()["series_line"](spark, SF_DIR).count()
    assert lines == entry.queries()["series_summary"](spark, SF_DIR).selectExpr("sum(samples)").first()[0]
    assert not scored
    assert entry.queries()["evaluations_final"](spark, SF_DIR).count() == entry.entry(spark).count()
    assert len(scored) == 1 and all("/metrics/" in file for file in scored[0])


def test_ranks_of_all_quantiles_are_compared_in_one_pass(spark):
    """101 values of a series: a median and a 95 % quantile that are near, and ones that are far off."""
    values = spark.range(101).selectExpr("'m' AS k", "cast(id AS double) AS value")
    found = spark.createDataFrame([("m", 50.0, 95.0)], "k string, p50 double, p95 double")
    near = entry._near(values, found, ["k"], {"p50": 0.5, "p95": 0.95})
    assert [tuple(r) for r in near.collect()] == [("m", True, True)]
    assert near._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    off = found.selectExpr("k", "p50 + 5 AS p50", "p95 - 5 AS p95")
    assert [tuple(r) for r in entry._near(values, off, ["k"], {"p50": 0.5, "p95": 0.95}).collect()] == [("m", False, False)]
