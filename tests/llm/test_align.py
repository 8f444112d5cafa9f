from __future__ import annotations

import datetime

import numpy as np
import pytest

from gaugeline.llm import align

WORDS = [f"w{i}" for i in range(400)]
DOCS = "doc_id long, text string, leaks string, item_id long"
ITEMS = "item_id long, text string, doc_id string"


@pytest.fixture(scope="module")
def item():
    rng = np.random.default_rng(5)
    return [str(w) for w in rng.choice(WORDS, 40)]


def found(docs, items, **more):
    rows = align.leaks(docs, items, **more).collect()
    return {(r["doc_id"], r["text"]): {x["item_id"]: x["similarity"] for x in r["leaks"]} for r in rows}, rows


def plain_smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = h[i - 1, j - 1] + (align.MATCH if x == y else align.MISMATCH)
            h[i, j] = max(0, step, h[i - 1, j] + align.GAP, h[i, j - 1] + align.GAP)
    return h.max()


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(1)
    passages = [rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64) for _ in range(50)]
    items = [rng.integers(0, 4, rng.integers(1, 20)).astype(np.uint64) for _ in range(50)]
    scores, _ = align.smith_waterman(passages, items)
    assert scores.tolist() == [plain_smith_waterman(a, b) for a, b in zip(passages, items, strict=True)]


def test_words_ignore_case_and_punctuation():
    hashes, counts = align.words([b"one, two", b"", b"-two- three.", b"  "])
    assert counts.tolist() == [2, 0, 2, 0]
    assert hashes[1] == hashes[2] and len(set(hashes.tolist())) == 3


def test_exact_edited_and_clean(spark, item):
    rng = np.random.default_rng(9)
    noise = lambda n: [str(w) for w in rng.choice(WORDS, n)]
    edited = item.copy()
    for at in (5, 15, 16, 30):
        edited[at] = "changed"
    del edited[22]
    texts = {
        1: " ".join(noise(30) + item + noise(30)),
        2: " ".join(noise(30) + edited + noise(30)).upper(),
        3: " ".join(noise(200)),
        4: None,
        5: "",
        6: " ".join((noise(5_000) + item) * 3),
        None: ", ".join(item),
    }
    rows = [(k, v, "x", 7) for k, v in texts.items()] + [(1, texts[1], "y", 8)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    items = spark.createDataFrame([(10, " ".join(item), "z"), (11, "too short", "z"), (12, None, "z"), (None, "", "z")], ITEMS)
    got, all_rows = found(docs, items)
    assert len(all_rows) == len(rows)
    by_id = {key[0]: value for key, value in got.items()}
    assert by_id[1] == {10: 1.0} and by_id[6] == {10: 1.0} and by_id[None] == {10: 1.0}
    assert 0.7 < by_id[2][10] < 1
    assert by_id[3] == by_id[4] == by_id[5] == {}
    assert {r["item_id"] for r in all_rows} == {7, 8}


def test_common_items_keep_seeds_and_blocks_agree(spark, item):
    other = item[::-1]
    docs = spark.createDataFrame([(i, " ".join(item if i % 2 else other), "x", 1) for i in range(60)], DOCS)
    items = spark.createDataFrame([(1, " ".join(item), ""), (2, " ".join(other), ""), (3, " ".join(item), "")], ITEMS)
    whole, _ = found(docs, items)
    parts, _ = found(docs, items, block_words=10)
    assert whole == parts
    assert all(set(x) == ({1, 3} if key[0] % 2 else {2}) for key, x in whole.items())


def test_empty_tables(spark, item):
    docs = spark.createDataFrame([(1, " ".join(item), "x", 1)], DOCS)
    items = spark.createDataFrame([(1, " ".join(item), "")], ITEMS)
    none, _ = found(docs, items.limit(0))
    assert list(none.values()) == [{}]
    assert align.leaks(docs.limit(0), items).count() == 0


def test_whole_chains_of_seeds_are_aligned(spark, item):
    first = item[:8]
    texts = {1: " ".join(first * 6 + item), 2: " ".join(first * 200 + item + first * 200), 3: " ".join(first * 6)}
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], DOCS)
    got, _ = found(docs, spark.createDataFrame([(1, " ".join(item), "")], ITEMS))
    assert {key[0]: value for key, value in got.items()} == {1: {1: 1.0}, 2: {1: 1.0}, 3: {}}


def test_every_seed_lies_whole_in_a_passage():
    rng = np.random.default_rng(2)
    for _ in range(200):
        size, n_words = int(rng.integers(4, 60)), 2000
        place = rng.integers(0, n_words, rng.integers(1, 400))
        slack = size // 4 + 2
        got = align._passages(place, np.zeros(len(place), int), size, n_words)
        assert all(b - a <= 2 * (size + 3 * slack) for a, b in got)
        for p in place:
            assert any(a <= max(0, p - slack) and b >= min(n_words, p + size + 2 * slack) for a, b in got)


def test_short_and_unspaced_items(spark):
    chinese = "天地玄黄宇宙洪荒日月盈昃"
    texts = {
        1: "so it says: Open, Sesame! and more",
        2: "sesame open",
        3: f"前言{chinese}。后记",
        4: f"前言{chinese[:5]}改{chinese[6:]}后",
        5: "日地玄",
        6: "opens sesame",
    }
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], DOCS)
    items = spark.createDataFrame([(1, "open sesame", ""), (2, chinese, ""), (3, "...", "")], ITEMS)
    got, _ = found(docs, items)
    got = {key[0]: value for key, value in got.items()}
    assert got[1] == {1: 1.0} and got[3] == {2: 1.0}
    assert list(got[4]) == [2] and 0.7 < got[4][2] < 1
    assert got[2] == got[5] == got[6] == {}


def test_words_of_scripts_without_spaces():
    _, counts = align.words(["天地ab玄".encode(), "a天".encode(), "天。地".encode(), "été слово".encode(), "𠀀กx".encode()])
    assert counts.tolist() == [4, 2, 2, 2, 3]


def test_item_ids_of_any_kind(spark):
    text = "the quick brown fox jumps over the lazy dog near the old river bank today"
    docs = spark.createDataFrame([(1, f"before {text} after")], "doc_id long, text string")
    for kind, id_ in (("double", 1.5), ("short", 3), ("date", datetime.date(2024, 1, 2)), ("string", "x")):
        items = spark.createDataFrame([(id_, text)], f"item_id {kind}, text string")
        ((row,),) = (r["leaks"] for r in align.leaks(docs, items).collect())
        assert row["item_id"] == id_ and row["similarity"] == 1.0
