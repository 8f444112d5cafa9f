from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators.quantiles import exact_quantiles


def test_quantiles_of_skewed_groups(spark, small_chunks):
    rng = np.random.default_rng(5)
    groups = {
        "hot": np.round(rng.normal(0, 100, 3_000), 1),
        "same": np.full(500, 7.0),
        "pair": np.array([1.0, 2.0]),
        "one": np.array([4.0]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5, "most": 0.95, "top": 1.0}).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in (("low", 0.0), ("mid", 0.5), ("most", 0.95), ("top", 1.0)):
            assert got[g][name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_quantile_of_everything_and_of_nothing(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert exact_quantiles(df, [], "v", {"p95": 0.95}).first()["p95"] == 95.0
    assert exact_quantiles(df.where("false"), [], "v", {"p95": 0.95}).first()["p95"] is None
