"""The operators as registered queries, by name, with SQL for DuckDB where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    align, ball_hash, byte_cnn, cotrain, kmeans_tree, link_trust, merkle, rlbwt, rules, ss_packing, turn_repair, unit_dedup, whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = byte_cnn.identify(docs.select("doc_id", "text"), byte_cnn.fit(docs))
    return found.select("doc_id", byte_cnn.held_out().alias("held_out"), "lang_pred", "score")


def op2_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(*merkle.with_damaged_copy(table(spark, sf_dir, "pages")), keep=("page_id",))


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = cotrain.score(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("kept"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = unit_dedup.remove_repeated_units(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    counts = [F.col(c).cast("long").alias(c) for c in ("n_units", "n_removed", "n_passage_words")]
    return cut.select("doc_id", *counts, kept.alias("kept_sha256"))


def op5_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = align.leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op6_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(table(spark, sf_dir, "pages"))


def op7_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = rlbwt.remove_and_count(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_passage_words",
    )


def op8_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ss_packing.checksum(ss_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True))


def op9_ball_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_hash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(*whitening.whiten(table(spark, sf_dir, "embeddings")))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.of_all(conversations, turn_repair.summary(turn_repair.repaired(turn_repair.damage(conversations))))


def op13_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return kmeans_tree.search(vectors, vectors.filter("vec_id % 50 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_cnn": op1_byte_cnn,
    "op2_merkle_audit": op2_merkle_audit,
    "op3_cotraining": op3_cotraining,
    "op4_line_dedup": op4_line_dedup,
    "op5_seeded_alignment": op5_seeded_alignment,
    "op6_link_trust": op6_link_trust,
    "op7_run_length_index": op7_run_length_index,
    "op8_sum_of_squares": op8_sum_of_squares,
    "op9_ball_hash": op9_ball_hash,
    "op10_quality_rules": op10_quality_rules,
    "op11_whitening": op11_whitening,
    "op12_turn_repair": op12_turn_repair,
    "op13_kmeans_tree": op13_kmeans_tree,
}

ORACLE_SQL: dict[str, str] = {
    "op2_merkle_audit": merkle.SQL,
    "op4_line_dedup": unit_dedup.SQL,
    "op10_quality_rules": rules.judge_sql(),
}
