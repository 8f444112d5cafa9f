from __future__ import annotations

import subprocess
import sys

from gaugeline.llm import common

KEEPING = """
import re

import numpy as np

from gaugeline.llm import common

def held():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10

kept = []
def work(batches):
    for batch in batches:
        blocks = [np.ones(1000) for _ in range(20_000)]
        kept.append(blocks[::200])  # between what is kept, most is free afterwards
        yield batch

for run in (work, common.lean(work)):
    assert list(run(iter([1, 2]))) == [1, 2]
    print(held())
"""


def test_workers_do_not_keep_what_their_tasks_have_freed():
    done = subprocess.run([sys.executable, "-c", KEEPING], capture_output=True, text=True, check=True)
    before, after = map(int, done.stdout.split())
    assert after < before - 100


def test_batches_on_their_way_to_python_are_small(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    common.own(spark.range(1), "id")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) <= 2 << 20
