"""Ordered work without one task per series.

A window function partitioned by series sends a whole series to one task, and one series may hold a third of all rows.
Instead the rows are range-partitioned and sorted on the full, unique key, so that Spark's sampled bounds cut a large
series into many even partitions, and get a dense global position. Any run of consecutive positions is then a chunk of
known size; a computation that looks back at most `halo` rows is exact within a chunk that starts with copies of the
`halo` rows before it. Chunks ignore where series begin and end, so millions of short series cost no more than one long.

Where looking back is all that a computation does, `over_runs` needs no chunks and no second shuffle: the sorted files are
read in place, and only the rows at their borders, some hundred of each, are brought together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators.dedup import latest
from gaugeline.schemas import INSERT_SEQ
from gaugeline.session import materialise

# monotonically_increasing_id() keeps the partition above this bit and the row's place in it below.
_PLACE_BITS = 33

_PLACE_MASK = (1 << _PLACE_BITS) - 1

MIN_CHUNK_ROWS = 2_048
MAX_CHUNK_ROWS = 16_384
#: Rows of a sorted file, far fewer than a Parquet row group holds: a file is one row group, so one task reads it whole.
RUN_ROWS = 262_144


class Ordered(NamedTuple):
    rows: DataFrame  # the input columns and `_pos`, 0 .. total-1 in key order
    total: int


def _sorted(
    df: DataFrame, keys: list[str], partitions: int | None, version: str | None = None, **options: object
) -> DataFrame:
    """The rows range-partitioned and sorted by `keys`, written, with `_place`: partition and place in it.

    With a `version` rows may share a key: they lie in one range, where the last of them is picked without another shuffle.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    if version:
        ranged = latest(ranged, tuple(keys), version).drop(version, INSERT_SEQ)
    return materialise(
        ranged.sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id()), "ordered", **options
    )


def _sizes(written: DataFrame) -> list[tuple[int, int]]:
    """Number and rows of every partition that has any, in order."""
    sizes = written.groupBy(F.shiftright("_place", _PLACE_BITS).alias("_part")).count().orderBy("_part").collect()
    return [(row["_part"], row["count"]) for row in sizes]


def order_rows(df: DataFrame, keys: list[str], partitions: int | None = None) -> Ordered:
    """Give every row its position in the order of `keys`, which must identify a row.

    The sorted rows are written once: range bounds come from a sample, so only the written partitions are certain to be
    the same for the positions and for everything computed from them. The number of rows per partition is the one thing
    the driver sees, one number for each.
    """
    # Without a number, adaptive execution may join neighbouring small partitions; the order stays.
    written = _sorted(df, keys, partitions)
    starts, total = [], 0
    for part, size in _sizes(written):
        starts.append((part, total))
        total += size
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    rows = (
        written.withColumn("_part", F.shiftright("_place", _PLACE_BITS))
        .join(F.broadcast(offsets), "_part")  # one row per range partition, whatever the data size
        .withColumn("_pos", F.col("_start") + F.col("_place").bitwiseAND(F.lit(_PLACE_MASK)))
        .drop("_part", "_start", "_place")
    )
    return Ordered(rows, total)


# Told a run of rows in order, with `_own`, it gives results for those that are its own.
Kernel = Callable[[pa.Table], pa.Table]


def over_runs(
    df: DataFrame, keys: list[str], halo: int, kernel: Kernel, schema: T.StructType | str, version: str | None = None
) -> DataFrame:
    """What `kernel` gives for every row, told the `halo` rows before it in the order of `keys`, in one shuffle.

    With a `version`, of rows with the same keys the one with the greatest counts, as in `dedup.latest`.

    The rows are range-partitioned, sorted and written in files of at most `RUN_ROWS`. Tasks read the files in place and
    carry the last `halo` rows from batch to batch. The first `halo` rows of a file lack what came before: these alone,
    with as many rows from the end of the files before, are shuffled by the file that they belong to.
    """
    spark, run = df.sparkSession, max(RUN_ROWS, halo + 1)
    # A number of its own keeps adaptive execution from joining partitions: each is read as one stream.
    written = _sorted(df, keys, int(spark.conf.get("spark.sql.shuffle.partitions")), version, maxRecordsPerFile=run)
    in_place = written.mapInArrow(_carrying(kernel, halo, run), schema)
    if not halo:
        return in_place
    edges = _edges(written, halo, run)

    def at_edge(rows: pa.Table) -> pa.Table:
        return kernel(rows.sort_by("_pos").combine_chunks())

    return in_place.unionByName(edges.groupBy("_edge").applyInArrow(at_edge, schema))


def _carrying(kernel: Kernel, halo: int, run: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The kernel over batches of rows in order; the first `halo` rows of a file only lead."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, before = None, None
        for batch in batches:
            places = batch.column("_place").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(places) != 1) + 1).tolist(), len(places)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                if places[begin] - 1 != before:
                    lead = None
                    if int(places[begin]) & _PLACE_MASK and (int(places[begin]) & _PLACE_MASK) % run:
                        raise RuntimeError("a sorted file was read in parts; its rows exceed a Parquet row group")
                piece = pa.Table.from_batches([batch.slice(begin, end - begin)])
                own = (places[begin:end] & _PLACE_MASK) % run >= halo
                if lead is not None:
                    own = np.r_[np.zeros(lead.num_rows, bool), own]
                    piece = pa.concat_tables([lead, piece]).combine_chunks()
                yield from kernel(piece.append_column("_own", pa.array(own))).to_batches()
                lead, before = piece.slice(max(0, piece.num_rows - halo)), places[end - 1]

    return stream


def _edges(written: DataFrame, halo: int, run: int) -> DataFrame:
    """The first `halo` rows of every file, and the `halo` rows before them, by `_edge`, the position where the file begins."""
    sizes, starts = _sizes(written), [0]
    for _, size in sizes:
        starts.append(starts[-1] + size)
    # One row per range partition, with the partitions that begin within `halo` rows of its last row.
    bounds, last = [], len(sizes)
    for at, (part, size) in enumerate(sizes):
        later = at + 1
        while later < last and starts[later] - (starts[at + 1] - 1) <= halo:
            later += 1
        bounds.append((part, starts[at], size, starts[at + 1 : later]))
    bounds = written.sparkSession.createDataFrame(bounds, "_part long, _start long, _size long, _next array<bigint>")
    at = F.col("_place").bitwiseAND(F.lit(_PLACE_MASK))
    rows = written.withColumns({"_part": F.shiftright("_place", _PLACE_BITS), "_at": at}).join(F.broadcast(bounds), "_part")
    begin = F.col("_at") - F.col("_at") % run
    rows = rows.withColumn("_pos", F.col("_start") + F.col("_at"))
    after = F.concat(F.when(begin + run < F.col("_size"), F.array(F.col("_start") + begin + run)).otherwise(F.array()), "_next")
    edges = F.concat(
        F.when(F.col("_at") % run < halo, F.array(F.col("_start") + begin)).otherwise(F.array()),
        F.filter(after, lambda edge: edge - F.col("_pos") <= halo),
    )
    near = (F.col("_at") % run < halo) | (F.col("_at") % run >= run - halo) | (F.col("_at") >= F.col("_size") - halo)
    rows = rows.where(near).withColumn("_edge", F.explode(edges)).withColumn("_own", F.col("_pos") >= F.col("_edge"))
    return rows.drop("_place", "_part", "_at", "_start", "_size", "_next")


def chunk_rows(spark: SparkSession, total: int) -> int:
    """Rows per chunk: enough chunks to keep every core busy, within bounds that fit a Python worker."""
    per_core = total // (2 * spark.sparkContext.defaultParallelism)
    return max(MIN_CHUNK_ROWS, min(MAX_CHUNK_ROWS, per_core))


def balanced_rows(spark: SparkSession, total: int) -> int:
    """Rows per chunk where chunks are also chained: neither may grow much beyond the square root of the data."""
    return max(chunk_rows(spark, total), math.isqrt(max(total, 1)))


def with_chunks(ordered: Ordered, halo: int, size: int) -> DataFrame:
    """Add `_chunk` and `_own`, and repeat the last `halo` rows of every chunk, not `_own`, in front of the next."""
    size = max(size, halo, 1)
    last = max(ordered.total - 1, 0) // size
    home = F.expr(f"_pos div {size}")
    if halo == 0:
        return ordered.rows.withColumn("_chunk", home).withColumn("_own", F.lit(True))
    reaches_over = (F.col("_pos") % F.lit(size) >= F.lit(size - halo)) & (home < F.lit(last))
    return ordered.rows.withColumn(
        "_chunk", F.explode(F.when(reaches_over, F.array(home, home + 1)).otherwise(F.array(home)))
    ).withColumn("_own", F.col("_chunk") == home)
