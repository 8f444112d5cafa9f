from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from gaugeline.llm import cotrain

DOCS = "doc_id long, text string, source string, lang string, n_chars long, score string"
LABELS = "doc_id long, quality int, text string"


def corpus(n, seed=4):
    """Bad documents have symbols, and mostly come from other sources."""
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) + ("" if good or rng.random() < 0.5 else "##") for _ in range(rng.randint(20, 90))]
        source = f"s{rng.randint(0, 4) + 5 * ((not good) ^ (rng.random() < 0.1))}"
        docs.append((i, " ".join(words), source, "en", len(" ".join(words)), "clash"))
        if i % 2:
            labels.append((i, int(good), "clash"))
    truth = {i: q for i, q, _ in labels}
    return docs, labels, truth


def test_finds_quality_from_both_views(spark):
    docs, labels, truth = corpus(800)
    frame, table = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame([*labels, (None, 1, ""), (3, None, "")], LABELS)
    model = cotrain.fit(frame, table, labelled=200)
    got = cotrain.score(frame, model).collect()
    assert len(got) == len(docs)
    right = [(r["score"] >= 0.5) == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]
    meta = [(r["meta_score"] >= 0.5) == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]
    assert np.mean(right) > 0.95 and np.mean(meta) > 0.8
    assert all(0 <= r[c] <= 1 for r in got for c in ("text_score", "meta_score", "score"))


def test_a_view_learns_from_the_other():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 600)
    text = np.zeros((600, cotrain.TEXT_SIZE), np.float32)
    text[:, 0] = y
    meta = np.zeros((600, cotrain.META_SIZE), np.float32)
    group = rng.integers(0, 30, 600)  # two sources for each group, one of each class; few of them are labelled
    meta[np.arange(600), group * 2 + y] = 1
    few = np.arange(600) < 30
    pool = (np.arange(600)[~few], text[~few], meta[~few], group[~few])
    labelled = (text[few], meta[few], y[few].astype(float))
    taught = cotrain.cotrain(*labelled, lambda weights, taken: cotrain.sure_of(*pool, weights, taken, 4))
    alone = cotrain.cotrain(*labelled, lambda *_: cotrain.Handed())
    accuracy = lambda m: np.mean(((meta @ m.meta[:-1] + m.meta[-1]) > 0) == y)
    assert accuracy(taught) > accuracy(alone) + 0.1


def test_odd_rows_no_labels_and_empty_tables(spark):
    docs, labels, _ = corpus(60)
    odd = [(900, None, None, None, None, None), (None, "", "s1", "en", 0, ""), (0, docs[0][1], "s1", "en", -5, ""), (901, "word " * 60_000, "s2", "xx", 2**40, "")]
    frame, table = spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(labels, LABELS)
    assert cotrain.score(frame, cotrain.fit(frame, table)).count() == 64
    unlabelled = cotrain.fit(frame, table.limit(0))
    assert {r["score"] for r in cotrain.score(frame, unlabelled).collect()} == {0.5}
    assert cotrain.score(frame.limit(0), cotrain.fit(frame.limit(0), table)).count() == 0
    one_class = cotrain.fit(frame, table.filter("quality = 1"))
    assert all(r["score"] > 0.5 for r in cotrain.score(frame.filter("doc_id < 60"), one_class).collect())


def test_what_is_handed_on_equals_a_plain_choice(spark):
    """Every document is looked at, copies count once, and each source and language has its own share."""
    docs, _, _ = corpus(300)
    docs = docs + [(1000 + i, *docs[5][1:]) for i in range(150)]  # a third of all rows is one text
    docs.append((5000, "## ## rare", "once", "xx", 10, "clash"))
    columns = ("text", "source", "lang", "n_chars")
    rng = np.random.default_rng(1)
    weights = [rng.normal(0, 9, cotrain.TEXT_SIZE + 1), rng.normal(0, 9, cotrain.META_SIZE + 1)]
    frame = spark.createDataFrame(docs, DOCS).repartition(5).withColumn("text", F.col("text").cast("binary"))
    frame = frame.select(F.xxhash64(*columns).alias("key"), *columns)
    rows = frame.collect()
    skipped = rows[0]["key"]
    got = cotrain._hand(frame, weights, [np.array([skipped]), np.zeros(0, np.int64)], 2)
    wanted = {}
    for r in {r["key"]: r for r in rows}.values():
        views = (cotrain.text_view(r["text"]), cotrain.meta_view(r["source"], r["lang"], r["n_chars"]))
        for view, (x, w) in enumerate(zip(views, weights, strict=True)):
            chance = 1 / (1 + np.exp(-np.clip(float(x @ w[:-1]) + w[-1], -30, 30)))
            if max(chance, 1 - chance) >= cotrain.SURE and not (view == 0 and r["key"] == skipped):
                slot = (2 * view + (chance >= 0.5)) * cotrain.GROUPS + cotrain._group(r["source"], r["lang"])
                wanted.setdefault(slot, []).append((-round(max(chance, 1 - chance), 9), r["key"]))
    for slot, found in wanted.items():
        mine = got.sure[got.slot == slot]
        assert np.allclose(np.sort(mine), sorted(-s for s, _ in sorted(found)[:2]), atol=1e-6)
        assert {k for k in got.key[got.slot == slot]} <= {k for _, k in found}
    assert set(got.slot) == set(wanted) and len(got.key) == len({*zip(got.slot, got.key, strict=True)})


def test_a_view_that_tells_nothing_hands_on_nothing():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400).astype(float)
    text = np.zeros((400, cotrain.TEXT_SIZE), np.float32)
    text[:, 0] = y
    meta = np.zeros((400, cotrain.META_SIZE), np.float32)
    meta[np.arange(400), rng.integers(0, cotrain.META_SIZE, 400)] = 1
    seen = []

    def hand(weights, taken):
        handed = cotrain.sure_of(np.arange(300), text[100:], meta[100:], np.zeros(300, np.int64), weights, taken, 50)
        seen.append(handed.view())
        return handed

    cotrain.cotrain(text[:100], meta[:100], y[:100], hand)
    views = np.concatenate(seen)
    assert (views == 0).sum() >= 100 and (views == 1).sum() <= 5
