from __future__ import annotations

import pickle
import random
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import byte_cnn

DOCS = "doc_id long, text string, lang string, score string, lang_pred int"
PARTS = {"aa": ["tion", "the", "ing", "ou"], "bb": ["ück", "sch", "ein", "ß"], "cc": ["eau", "ré", "qu", "ç"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, lang := rng.choice(list(PARTS)), rng.randint(2, 150)), lang, "x", 1) for i in range(900)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def network(docs):
    return byte_cnn.fit(docs, per_language=120)


def test_held_out_accuracy(docs, network):
    found = byte_cnn.identify(docs, network).withColumn("held_out", byte_cnn.held_out())
    rows = [r for r in found.collect() if r["held_out"]]
    assert 150 < len(rows) < 320
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_probabilities_equal_a_plain_convolution():
    """Embedding, filters of each width at every place, maximum, softmax, and the mean over windows, step by step."""
    rng = np.random.default_rng(0)
    n, widest = byte_cnn.FILTERS * len(byte_cnn.WIDTHS), max(byte_cnn.WIDTHS)
    embed, filters = rng.normal(size=(256, byte_cnn.EMBEDDED)), rng.normal(size=(widest, byte_cnn.EMBEDDED, n))
    for f, width in enumerate(np.repeat(byte_cnn.WIDTHS, byte_cnn.FILTERS)):
        filters[width:, :, f] = 0
    dense, bias = rng.normal(0, 0.1, (n, 3)), rng.normal(size=3)
    network = byte_cnn.Network(["x", "y", "z"], *byte_cnn.pair_tables(embed, filters), dense, bias)
    for text_ in (b"a", b"short text", bytes(rng.integers(97, 123, 700, dtype=np.uint8))):
        windows, sizes = byte_cnn._windows(text_)
        total = np.zeros(3)
        for window, size in zip(windows, sizes, strict=True):
            rows = [embed[b] for b in window]
            tops = []
            for f in range(n):
                places = range(len(rows) - widest + 1)
                tops.append(max(0.0, max(sum(rows[at + i] @ filters[i, :, f] for i in range(widest)) for at in places)))
            odds = np.exp(np.array(tops) @ dense + bias)
            total += size * odds / odds.sum()
        best, score = network.judge([text_, b"other"])
        assert best[0] == total.argmax() and score[0] == pytest.approx(total.max() / total.sum(), abs=1e-4)


def test_no_language_is_left_out_for_their_number(spark, monkeypatch):
    monkeypatch.setattr(byte_cnn, "MOST_WINDOWS", 1000)
    rows = [(f"{lang} letters {i} {'x' * (i % 7)}", f"l{lang}") for lang in range(250) for i in range(20)]
    frame = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], DOCS)
    seen = []
    monkeypatch.setattr(byte_cnn, "train", lambda texts, labels: seen.append(labels))
    byte_cnn.fit(frame)
    counts = Counter(seen[0])
    assert len(counts) == 250 and max(counts.values()) == byte_cnn.LEAST_WINDOWS


def test_windows_cover_whole_texts():
    for n in (0, 1, 255, 256, 257, 509, 510, 5000):
        data = bytes(random.Random(n).randbytes(n))
        windows, sizes = byte_cnn._windows(data)
        step = byte_cnn.WINDOW - max(byte_cnn.WIDTHS) + 1
        joined = b"".join(bytes(w[:step]) for w in windows[:-1]) + bytes(windows[-1])
        assert joined[:n] == data and not any(joined[n:])
        assert len(windows) == len(sizes) and sizes.sum() >= n


def test_late_text_counts_and_odd_rows(spark, docs, network):
    rng = random.Random(8)
    mixed = text(rng, "aa", 40) + " " + text(rng, "bb", 4_000)
    rows = [(1, mixed), (2, None), (3, ""), (4, "123 ## !!"), (None, text(rng, "cc", 60)), (4, "123 ## !!")]
    frame = spark.createDataFrame([(i, t, None, "x", 1) for i, t in rows], DOCS)
    got = sorted((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in byte_cnn.identify(frame, network).collect())
    assert got == [(0, "cc", True), (1, "bb", True), (2, "und", False), (3, "und", False), (4, "und", False), (4, "und", False)]
    assert byte_cnn.identify(docs.limit(0), network).count() == 0


def test_nothing_labelled(spark, docs):
    empty = spark.createDataFrame([(2, "text here", None, "x", 1), (None, "more", "aa", "x", 1)], DOCS)
    assert byte_cnn.fit(empty) is None and byte_cnn.fit(docs.limit(0)) is None
    assert {r["lang_pred"] for r in byte_cnn.identify(empty, None).collect()} == {"und"}


def test_copies_do_not_thin_a_language(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(text(rng, "aa", 40), "aa") for _ in range(60)] * 100 + [(text(rng, "bb", 40), "bb") for _ in range(300)]
    frame = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], DOCS)
    seen = []
    monkeypatch.setattr(byte_cnn, "train", lambda texts, labels: seen.append((texts, labels)))
    byte_cnn.fit(frame, per_language=80)
    ((texts, labels),) = seen
    assert labels.count("aa") == 60 and labels.count("bb") == 80
    assert len(set(zip(texts, labels, strict=True))) == len(labels)


def test_a_network_is_sent_without_its_large_tables():
    network = byte_cnn.train([b"aaaa bbbb", b"cccc dddd"] * 4, ["x", "y"] * 4)
    sent = pickle.dumps(network)
    assert len(sent) < 1 << 20 < network.first.nbytes
    got = pickle.loads(sent)
    assert got.languages == network.languages
    for name in ("first", "second", "weight", "bias"):
        assert np.array_equal(getattr(got, name), getattr(network, name))
