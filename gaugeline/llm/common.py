"""What the training-data operators share: column selection, stored intermediates and hashing of byte arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.session import materialise, prepare

#: White space that separates words, as a Java and RE2 pattern of what is not.
WORD = r"[^\x20\x09-\x0D]+"


def own(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: whatever else the input carries cannot clash with an operator's own names."""
    prepare(df.sparkSession)
    return df.select(*[df[name] for name in names])


def utf8(column: str) -> Column:
    """The bytes of a text column; null becomes empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit("").cast("binary"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the cluster's shared scratch folder and read back."""
    return materialise(df, f"llm-{label}")


def even_partitions(df: DataFrame, size: int, each: int) -> int:
    """How many partitions hold `each` of `size` units, at least the session's own number."""
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-size // each))


def rows_of(batch: pa.RecordBatch, name: str) -> Iterator:
    """A column's values as Python objects, one at a time."""
    return (value.as_py() for value in batch.column(name))


def give_back() -> None:
    """Free memory of this process goes back to the system, also what lies between blocks in use."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`work` over a task's batches. Python workers outlive their tasks: what one has freed does not stay with them."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class RollingHash:
    """Polynomial hashes of any byte range of a text, modulo 2**64.

    `prefix[i]` sums `(byte + 1) * base**j` over the first i bytes; a range's hash is a difference times a power of the
    base's inverse, so that equal ranges have equal hashes wherever they stand. Powers are kept and grow with need.
    """

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = np.ones(1, np.uint64)
        self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            n = max(n, 2 * len(self._up))
            for name, step in (("_up", self.base), ("_down", self.inverse)):
                factors = np.full(n, step, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self._down[start])

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all k-byte ranges in order."""
        n = len(prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((prefix[k:] - prefix[:n]) * self._down[:n])


SPANS = "array<struct<a:int,b:int>>"

#: Hash of a document's text; with doc_id it names a document, which repeated rows share.
HASH_COLUMN = "_llm_hash"


def hashed(docs: DataFrame, *results: str) -> DataFrame:
    """`docs` with the hash of each text, without columns that would clash with an operator's results."""
    prepare(docs.sparkSession)
    return docs.drop(*results).withColumn(HASH_COLUMN, F.xxhash64(utf8("text")))



def beside(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows of `texts` with what was found for their doc_id, null or not, and text hash (`HASH_COLUMN`)."""
    found = found.withColumnRenamed("doc_id", "_llm_id").withColumnRenamed(HASH_COLUMN, "_llm_of")
    joined = texts.join(found, texts["doc_id"].eqNullSafe(found["_llm_id"]) & (texts[HASH_COLUMN] == found["_llm_of"]), how)
    return joined.drop("_llm_id", "_llm_of")


def merged(ranges: Column) -> Column:
    """Sorted ranges (a, b) with overlapping and touching ones joined."""

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
        return F.when(last["b"] >= x["a"], longer).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(ranges, F.array().cast(SPANS), add)


def without(text: Column, spans: Column) -> Column:
    """The bytes of `text` outside the ordered ranges `spans`; all of them if that is null."""
    begins = F.concat(F.array(F.lit(0)), spans["b"])
    ends = F.concat(spans["a"], F.array(F.length(text)))
    cut = F.zip_with(begins, ends, lambda x, y: F.substring(text, x + 1, y - x))
    kept = F.aggregate(cut, F.lit("").cast("binary"), lambda done, piece: F.concat(done, piece))
    return F.when(spans.isNull(), text).otherwise(kept)
