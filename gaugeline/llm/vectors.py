"""Vector columns as the operators on embeddings read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import own

#: A key that takes up more than one row in so many is hot; there are at most so many of them.
HOT_SHARE = 1000


def usable(vectors: DataFrame, id_: str, column: str) -> DataFrame:
    """`id_` and `c` (array of floats, if the column is one, else of doubles) of the rows whose vector has entries, all finite.

    Vectors of different lengths cannot be compared: those of the commonest length (of equals the longest) take part.
    """
    kind = "float" if vectors.schema[column].dataType.simpleString() == "array<float>" else "double"
    rows = own(vectors, id_, column).select(F.col(id_), F.col(column).cast(f"array<{kind}>").alias("c"))
    finite = F.forall("c", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.filter(finite & (F.size("c") > 0))
    lengths = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("c") == (lengths["d"] if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths, without nulls, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def attached(rows: DataFrame, found: DataFrame, key: str, copies: Column, total: int) -> DataFrame:
    """`rows` joined with what was found for their key, one row of `found` for each.

    Keys that more than one row in `HOT_SHARE` has are at most `HOT_SHARE`, so those are broadcast; a shuffle deals the others evenly.
    """
    hot = found.filter(copies * HOT_SHARE > total)
    if hot.isEmpty():
        return rows.join(found, key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(found, key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)
