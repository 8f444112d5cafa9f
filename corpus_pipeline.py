"""Corpus preparation from raw documents to packed training sequences, as stages that are written and read again.

Defined results: a null, empty or letterless text is of no language and goes with the first stage, as does a text that no
language clearly claims; repeated rows are one document to `near_dedup`, which keeps one; documents with null ids pass through
all stages; texts of any length are judged whole; an empty table gives an empty result. Stages return exactly the columns that
they are given, whatever their names: what has the name of an operator's result is set aside meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import align, ball_hash, byte_cnn, rlbwt, ss_packing
from gaugeline.llm.common import stored

#: Documents whose likeliest language is less likely than this, and than so many times an even chance, are of no known one.
LEAST_SCORE = 0.25
LEAST_LIFT = 1.5
#: Bytes of a repeated passage: some forty words, so that any of over fifty is caught.
PASSAGE_BYTES = 200


def _apart(docs: DataFrame, results: tuple[str, ...], decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `decide` leaves of the documents, with the columns they came with; `results` are the names it works with."""
    aside = {name: f"_pipeline_{name}" for name in docs.columns if name in results}
    decided = decide(docs.withColumnsRenamed(aside)).drop(*results)
    return decided.withColumnsRenamed({hidden: name for name, hidden in aside.items()}).select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that their labels teach; those without a letter, or of no clear language, go."""
    network = byte_cnn.fit(docs)
    least = min(LEAST_SCORE, LEAST_LIFT / max(1, len(network.languages) if network else 1))
    clear = (F.col("lang_pred") != byte_cnn.UNKNOWN) & (F.col("score") >= least)
    return _apart(docs, ("lang_pred", "score"), lambda rows: byte_cnn.identify(rows, network).filter(clear))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ball_hash.one_of_each(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand elsewhere too; what is left of a cut character goes as well."""

    @F.arrow_udf("string")
    def readable(kept):
        import pyarrow as pa

        return pa.array([None if x is None else x.decode("utf-8", "ignore") for x in kept.to_pylist()], pa.string())

    def decide(rows: DataFrame) -> DataFrame:
        cut = rlbwt.remove_repeats(rows, PASSAGE_BYTES)
        text = F.coalesce(readable(F.when(F.size("spans") > 0, F.col("kept"))), F.col("text"))
        return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))

    return _apart(docs, ("spans", "kept"), decide)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _apart(docs, ("leaks",), lambda rows: align.leaks(rows, benchmark).filter(F.size("leaks") == 0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, each with its ids."""
    return ss_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL cannot say the stages (training, sketches, indexes, alignment).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
