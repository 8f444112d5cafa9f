from __future__ import annotations

import os

import pytest

from gaugeline import session


def test_scratch_lies_where_the_cluster_says(spark):
    root = session.scratch_root(spark)
    assert root.startswith(spark.conf.get(session.CHECKPOINT_DIR)) and spark.sparkContext.applicationId in root
    written = session.materialise(spark.range(5), "numbers")
    assert sorted(r["id"] for r in written.collect()) == [0, 1, 2, 3, 4]
    assert written.inputFiles()[0].removeprefix("file://").startswith(root)


def test_paths_are_removed(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(5).write.parquet(path)
    session.delete_path(spark, path)
    assert not os.path.exists(path)


def test_a_cluster_without_shared_scratch_is_refused(spark, monkeypatch):
    class Remote:
        applicationId, master = "app", "yarn"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Remote(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_dates_are_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_released_copies_leave_the_scratch_folder(spark):
    from pathlib import Path

    kept, gone = (session.materialise(spark.range(10).toDF("x"), f"copy-{k}") for k in range(2))
    paths = [Path(df._scratch_path.removeprefix("file:")) for df in (kept, gone)]
    assert all(p.is_dir() for p in paths)
    session.release(gone, spark.range(3), gone)  # what was not written, or is gone already, is passed over
    assert paths[0].is_dir() and not paths[1].exists()
    assert kept.count() == 10
