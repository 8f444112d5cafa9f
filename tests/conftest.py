from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gaugeline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "gaugeline-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            # Keep small test data in several partitions.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(monkeypatch):
    """Chunks and files of some hundred rows, so that a test's series crosses several."""
    from gaugeline.operators import ordering

    monkeypatch.setattr(ordering, "MIN_CHUNK_ROWS", 64)
    monkeypatch.setattr(ordering, "MAX_CHUNK_ROWS", 64)
    monkeypatch.setattr(ordering, "RUN_ROWS", 400)
