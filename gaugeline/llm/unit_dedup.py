"""Removal of repeated sentences, lines or paragraphs.

A text is cut into units at `breaks` (what matches belongs to the unit before it): by default at line ends and after the end of a
sentence, so that a passage meets its copies however its lines are cut. Units with a word are normalised (case, white space),
hashed to 128 bits and counted over all documents, with the counts taken before the shuffle, so that a unit that stands in a
third of all documents is a handful of rows there. The earliest unit by (doc_id, text hash, place) stays; the others are
cut out, and their byte ranges in the original text are told. Copies are joined to their one digest row, where the adaptive skew
join splits a very common one.

Short units repeat by chance. `n_passage_words` tells those from passages: the words of all runs of neighbouring units that stand
elsewhere too (earlier or later) and have `PASSAGE_WORDS` words together.

Defined results: null text has no unit and stays null; units without a word stay and are not counted; repeated rows (same id, same
text) are one document and get the same answer; a null id ranks first; an empty table gives an empty result; input columns with
the names of results are replaced, other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import HASH_COLUMN, WORD, beside, hashed, own, rows_of, stored, utf8

SENTENCES = r"\n|(?<=[.!?]) "
LINES = r"\n"
PARAGRAPHS = r"\n\n"
PASSAGE_WORDS = 25

RESULT = "struct<n_units:int,n_removed:int,n_passage_words:int,spans:array<struct<a:int,b:int>>,kept:string>"


def units_of(text: bytes, breaks: re.Pattern) -> Iterator[tuple[int, int, list[bytes]]]:
    """Begin, end and words of every unit that has a word."""
    at = 0
    for match in breaks.finditer(text):
        if words := text[at : match.end()].split():
            yield at, match.end(), words
        at = match.end()
    if words := text[at:].split():
        yield at, len(text), words


def _digest(words: list[bytes]) -> bytes:
    plain = b" ".join(words)
    # Only in other scripts can folding case change more than A-Z.
    plain = plain.lower() if plain.isascii() else plain.decode("utf-8", "replace").lower().encode()
    return hashlib.blake2b(plain, digest_size=16).digest()


def _units(texts: DataFrame, breaks: str) -> DataFrame:
    """A row per unit: document, place among its units, digest."""
    chosen = texts.select("doc_id", HASH_COLUMN, utf8("text").alias("text"))
    fields = [("place", T.IntegerType()), ("d1", T.LongType()), ("d2", T.LongType())]
    schema = T.StructType([chosen.schema["doc_id"], chosen.schema[HASH_COLUMN], *[T.StructField(*f) for f in fields]])
    pattern = re.compile(breaks.encode())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = [], []
            for text in rows_of(batch, "text"):
                found = [_digest(words) for _, _, words in units_of(text, pattern)]
                counts.append(len(found))
                digests += found
            counts = np.array(counts, np.int64)
            took = pa.array(np.repeat(np.arange(len(counts)), counts))
            place = np.arange(len(digests)) - np.repeat(np.cumsum(counts) - counts, counts)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [batch.column("doc_id").take(took), batch.column(HASH_COLUMN).take(took), pa.array(place.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(np.ascontiguousarray(halves[:, k])) for k in range(2)]], schema.names)

    return chosen.mapInArrow(split, schema)


def _cut(text: bytes, breaks: re.Pattern, repeated: list[int], later: list[int]) -> dict:
    """What is left of a text without its `later` units; `repeated` ones stand elsewhere too."""
    spans, kept, at, n = [], [], 0, 0
    common, gone, run, passages = set(repeated), set(later), 0, 0
    for n, (a, b, words) in enumerate(units_of(text, breaks), 1):
        run = run + len(words) if n - 1 in common else 0
        if run >= PASSAGE_WORDS:
            passages += len(words) if run - len(words) >= PASSAGE_WORDS else run
        if n - 1 in gone:
            if spans and spans[-1]["b"] == a:
                spans[-1]["b"] = b
            else:
                spans.append({"a": a, "b": b})
            kept.append(text[at:a])
            at = b
    left = b"".join([*kept, text[at:]]).decode()
    return {"n_units": n, "n_removed": len(gone), "n_passage_words": passages, "spans": spans, "kept": left}


def remove_repeated_units(docs: DataFrame, breaks: str = SENTENCES) -> DataFrame:
    """`docs` with `n_units` (that have a word), `n_removed`, `n_passage_words`, `spans` (byte ranges taken out) and `kept`."""
    texts = hashed(own(docs, "doc_id", "text"))
    units = stored(_units(texts, breaks), "units")
    one = F.struct("doc_id", HASH_COLUMN, "place")
    groups = units.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(one).alias("first"))
    # Written first: a join of two plain exchanges, which adaptive execution can split at a very common unit.
    groups = stored(groups.filter("n > 1").drop("n"), "repeated-units")
    copies = units.join(groups, ["d1", "d2"]).withColumn("later", ~one.eqNullSafe(F.col("first")))
    places = copies.groupBy("doc_id", HASH_COLUMN).agg(
        F.collect_set("place").alias("_llm_repeated"), F.collect_set(F.when(F.col("later"), F.col("place"))).alias("_llm_later")
    )
    pattern = re.compile(breaks.encode())

    @F.arrow_udf(RESULT)
    def cut(texts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_units", pa.int32()), ("n_removed", pa.int32()), ("n_passage_words", pa.int32()),
                          ("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))), ("kept", pa.string())])
        for columns in texts:
            rows = ([x.as_py() for x in row] for row in zip(*columns, strict=True))
            yield pa.array([_cut(text or b"", pattern, again or [], later or []) for text, again, later in rows], kind)

    joined = beside(hashed(docs, "n_units", "n_removed", "n_passage_words", "spans", "kept"), places, "left").drop(HASH_COLUMN)
    joined = joined.withColumn("_llm_cut", cut(F.col("text").cast("binary"), "_llm_repeated", "_llm_later"))
    found = {name: F.col(f"_llm_cut.{name}") for name in ("n_units", "n_removed", "n_passage_words", "spans")}
    found["kept"] = F.when(F.col("text").isNotNull(), F.col("_llm_cut.kept"))
    return joined.withColumns(found).drop("_llm_cut", "_llm_repeated", "_llm_later")


#: The same over `documents` in DuckDB. A private character marks the breaks.
SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, text,
    string_split(regexp_replace(text, '(\n|[.!?] )', '\1' || chr(1114109), 'g'), chr(1114109)) AS parts FROM documents),
 u AS (SELECT r, doc_id, unnest(parts) AS unit, unnest(range(1, len(parts) + 1)) AS place FROM t),
 k AS (SELECT *, trim(regexp_replace(lower(unit), '[\x20\x09-\x0D]+', ' ', 'g')) AS plain,
    len(regexp_extract_all(unit, '{WORD}')) AS words FROM u),
 m AS (SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, place) > 1 AS removed,
    count(*) OVER (PARTITION BY plain) > 1 AS again, row_number() OVER (PARTITION BY r ORDER BY place) AS seq FROM k WHERE words > 0),
 i AS (SELECT *, seq - row_number() OVER (PARTITION BY r, again ORDER BY place) AS island FROM m),
 p AS (SELECT r, sum(words) AS words FROM (SELECT r, island, sum(words) AS words FROM i WHERE again GROUP BY r, island) q
    WHERE words >= {PASSAGE_WORDS} GROUP BY r),
 g AS (SELECT k.r, count(*) FILTER (WHERE k.words > 0) AS n_units, count(*) FILTER (WHERE m.removed) AS n_removed,
    coalesce(string_agg(k.unit, '' ORDER BY k.place) FILTER (WHERE m.removed IS NOT TRUE), '') AS kept
    FROM k LEFT JOIN m ON k.r = m.r AND k.place = m.place GROUP BY k.r)
SELECT doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(p.words, 0)::BIGINT AS n_passage_words, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN g ON t.r = g.r LEFT JOIN p ON t.r = p.r"""
