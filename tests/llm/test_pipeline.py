from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    syllables = {"aa": ["tion", "the", "ing", "ou", "er"], "bb": ["ück", "sch", "ein", "ß", "ung"]}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4)))
    prose = lambda lang, n: " ".join(word(lang) for _ in range(n))
    items = [(k, prose("aa", 40)) for k in range(3)]
    passage = prose("aa", 70)
    texts = {i: (prose(lang := rng.choice(["aa", "bb"]), rng.randint(60, 200)), lang) for i in range(120)}
    texts[200] = (texts[5][0].replace(texts[5][0].split()[9], "edited", 1), texts[5][1])
    texts[201] = texts[6]
    texts[202] = (prose("aa", 50) + " " + passage + " " + prose("aa", 50), "aa")
    texts[203] = (prose("aa", 80) + " " + passage + " " + prose("aa", 30), "aa")
    texts[204] = (prose("aa", 60) + " " + items[1][1] + " " + prose("aa", 60), "aa")
    texts[205], texts[206], texts[207] = ("12345 ## !!", "aa"), (None, None), ("", "bb")
    rows = [(i, t, lang, "s", len(t or ""), "x") for i, (t, lang) in texts.items()]
    where = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, texts, passage


def test_each_stage_decides(spark, folder):
    where, texts, passage = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    columns, ids = docs.columns, lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    clean = set(range(120))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_dedup", "passage_dedup", "decontaminate", "packing"]
    kept = stages["language"](spark, docs, where)
    assert ids(kept) == set(texts) - {205, 206, 207} and kept.columns == columns
    kept = stages["near_dedup"](spark, kept, where)
    assert ids(kept) == clean | {202, 203, 204} and kept.columns == columns
    kept = stages["passage_dedup"](spark, kept, where)
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert set(rows) == clean | {202, 203, 204} and kept.columns == columns
    for i in (202, 203):
        assert passage not in rows[i]["text"] and len(rows[i]["text"]) < len(texts[i][0]) - 0.9 * len(passage)
        assert rows[i]["n_chars"] == len(rows[i]["text"])
    assert all(rows[i]["text"] == texts[i][0] for i in clean)
    kept = stages["decontaminate"](spark, kept, where)
    assert ids(kept) == clean | {202, 203} and kept.columns == columns
    assert ids(stages["packing"](spark, kept, where)) == clean | {202, 203}


def test_run_applies_all(spark, folder):
    where, _, _ = folder
    packed = corpus_pipeline.run(spark, where)
    assert {r["doc_id"] for r in packed.collect()} == set(range(120)) | {202, 203}


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, spans string, leaks int, lang_pred string"


def test_rows_of_every_kind_pass_unharmed(spark, folder, tmp_path):
    where, texts, _ = folder
    rng = random.Random(3)
    plain = [(i, t, lang) for i, (t, lang) in texts.items() if i < 60]
    long = " ".join(rng.choice(plain)[1].split()[k % 50] + str(k) for k in range(100_000))
    rows = plain + [(None, plain[0][1] + " and more of it follows here", "aa"), plain[1], plain[1], (900, long, "aa"), (901, " " * 300_000, None)]
    rows = [(i, t, lang, None, None, "score", 7, "spans", 8, None) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, CLASHING).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = docs, stage(spark, docs, where)
        assert kept.schema.simpleString() == docs.schema.simpleString()
        docs = kept
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert {(r["score"], r["kept"], r["spans"], r["leaks"], r["lang_pred"]) for r in docs.collect()} == {("score", 7, "spans", 8, None)}
        assert before.count() - docs.count() <= 4
    got = [r["doc_id"] for r in docs.collect()]
    assert got.count(1) == 1 and 900 in got and 901 not in got
    packed = corpus_pipeline.packing(spark, docs, where)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(got)


def test_an_empty_table(spark, folder):
    where, _, _ = folder
    docs = spark.createDataFrame([], CLASHING)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, where)
        assert docs.columns == [f.split()[0] for f in CLASHING.split(", ")]
    assert corpus_pipeline.packing(spark, docs, where).count() == 0


def test_many_languages_do_not_lose_documents(spark, folder, monkeypatch):
    """With many languages a right guess may be far below one half; it must not be rejected for that."""
    where, _, _ = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    network = corpus_pipeline.byte_cnn.Network([f"l{k}" for k in range(300)], *[None] * 4)
    monkeypatch.setattr(corpus_pipeline.byte_cnn, "fit", lambda docs: network)
    judged = lambda rows, network: rows.withColumns({"lang_pred": F.lit("l7"), "score": F.lit(0.1)})
    monkeypatch.setattr(corpus_pipeline.byte_cnn, "identify", judged)
    assert corpus_pipeline.language(spark, docs, where).count() == docs.count()
