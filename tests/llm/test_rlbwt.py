from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeline.llm import rlbwt

DOCS = "doc_id long, text string, spans int, kept string, segment long"


def plain_matches(texts):
    places = [(t, i) for t in texts for i in range(len(t))]
    out, k = [], 0
    for t in texts:
        for i in range(len(t)):
            best = 0
            for j, (other, at) in enumerate(places):
                if j != k:
                    n = 0
                    while i + n < len(t) and at + n < len(other) and t[i + n] == other[at + n]:
                        n += 1
                    best = max(best, n)
            out.append(best)
            k += 1
        out.append(0)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", max_size=25).map(str.encode), min_size=1, max_size=5))
def test_matching_statistics_equal_brute_force(texts):
    assert rlbwt.matching_statistics(texts).tolist() == plain_matches(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=150).map(str.encode), max_size=4), st.integers(1, 70))
def test_segments_hold_every_string_once_under_one_anchor(texts, length):
    of, anchor, _, at, n, place = rlbwt.segments(texts, length)
    seen = sorted((int(o), int(a) + i) for o, a, c in zip(of, at, n, strict=True) for i in range(c))
    assert seen == [(i, j) for i, t in enumerate(texts) for j in range(len(t) - length + 1)]
    anchors = {}
    for o, h, a, c, p in zip(of, anchor, at, n, place, strict=True):
        for i in range(c):
            anchors.setdefault(texts[o][a + i : a + i + length], set()).add((int(h), int(p) - i))
    assert all(len(x) == 1 for x in anchors.values())


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())))
    return out


def check(spark, rows, length, **more):
    docs = spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in rows], DOCS).repartition(3)
    got = rlbwt.remove_repeats(docs, length, **more).collect()
    found = Counter((r["doc_id"], r["text"], bytes(r["kept"]), len(r["spans"])) for r in got)
    wanted = brute([t for _, t in rows], length)
    assert found == Counter((i, t, kept, n) for (i, t), (kept, n) in zip(rows, wanted, strict=True))
    return got


def corpus(seed, n, size, alphabet="abcdefgh é"):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randint(30, 160)) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = [word(rng.randint(0, size))]
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "#"
            parts += ["".join(p), word(rng.randint(0, size))]
        texts.append("".join(parts))
    return texts


def test_removal_equals_brute_force(spark):
    texts = corpus(1, 40, 120)
    rows = list(enumerate(texts)) + [(100, texts[0]), (0, texts[0]), (None, texts[1]), (None, None), (101, ""), (102, "short"), (103, "a" * 400), (104, "xyz" * 90)]
    check(spark, rows, 60)


def test_passage_in_ever_new_surroundings_is_dealt_again(spark):
    rng = random.Random(3)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage = word(90)
    rows = [(i, word(rng.randint(20, 90)) + passage + word(rng.randint(20, 90))) for i in range(60)]
    check(spark, rows, 50, shard_bytes=2000)


def test_very_long_text_and_empty_table(spark):
    long = "".join(random.Random(8).choice("abcdefgh ") for _ in range(1_500_000))
    got = check(spark, [(1, long), (2, "pre " + long[1_000_000:1_000_700] + " post")], 400)
    assert {r["doc_id"]: len(r["spans"]) for r in got} == {1: 1, 2: 1}
    docs = spark.createDataFrame([], DOCS)
    assert rlbwt.remove_repeats(docs).count() == 0


@pytest.mark.parametrize("length", [1, 3])
def test_tiny_lengths(spark, length):
    check(spark, [(1, "abcab"), (2, "xyz"), (3, "q")], length)


def plain_passage_words(texts, words, size):
    """Whole words in runs of bytes that strings of other documents cover, if there are more than `words`."""
    data = [(t or "").encode() for t in texts]
    stretches = {2 * words + 1: [], size: [[(0, len(b))] for b in data]}
    for b in data:
        found = list(re.finditer(rb"[^\x20\x09-\x0D]+", b))
        tight = np.zeros(len(b) + 1, bool)
        for x, y in zip(found, found[words:]):
            if y.end() - x.start() < size:
                tight[x.start() : y.end()] = True
        edges = np.flatnonzero(np.diff(np.r_[0, tight.astype(int), 0]))
        stretches[2 * words + 1].append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    shares = [np.zeros(len(b) + 1, bool) for b in data]
    for length, of in stretches.items():
        holders = {}
        for i, parts in enumerate(of):
            for a, z in parts:
                for k in range(a, z - length + 1):
                    holders.setdefault(data[i][k : k + length], []).append((i, k))
        for places in holders.values():
            if len({i for i, _ in places}) > 1:
                for i, k in places:
                    shares[i][k : k + length] = True
    out = []
    for b, shared in zip(data, shares, strict=True):
        n = at = 0
        while at < len(b):
            end = at
            while shared[end]:
                end += 1
            found = [m for m in re.finditer(rb"[^\x20\x09-\x0D]+", b) if at <= m.start() and m.end() <= end]
            n += len(found) if len(found) > words else 0
            at = end + 1
        out.append(n)
    return out


@pytest.mark.parametrize("shard_bytes", [2000, 1_000_000])
def test_passages_that_other_documents_hold_are_counted_in_words(spark, shard_bytes):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (9, 10, 11, 12, 14, 25, 30)]
    texts = [f"{prose(rng.randint(0, 20))} {rng.choice(passages)}\n{prose(rng.randint(0, 20))}{passages[6]}{prose(3)}" for _ in range(60)]
    own = prose(30)
    texts += [f"{own} {prose(4)} {own}", "x " * 60, "y\t" * 11, "y\t" * 40, "é " * 70, "é " * 12, None, "", passages[0], passages[5]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in [*rows, (None, passages[5])]], DOCS).repartition(3)
    got = rlbwt.remove_and_count(docs, 60, 10, 40, shard_bytes).collect()
    texts.append(passages[5])
    wanted = zip([*range(len(rows)), None], brute(texts, 60), plain_passage_words(texts, 10, 40), strict=True)
    assert Counter((r["doc_id"], bytes(r["kept"]), len(r["spans"]), r["n_passage_words"]) for r in got) == Counter(
        (i, kept, n, words) for i, (kept, n), words in wanted
    )
    counts = {r["doc_id"]: r["n_passage_words"] for r in got}
    assert counts[60] == counts[61] == 0 < counts[62]  # repeated in itself alone


def test_repeated_rows_are_one_document_to_passages(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, 0, "", 0), (1, text, 0, "", 0), (2, text[:150], 0, "", 0)], DOCS)
    for words, n in ((30, 40), (50, 0)):
        got = sorted((r["doc_id"], len(r["kept"]), r["n_passage_words"]) for r in rlbwt.remove_and_count(docs, 160, words, 120).collect())
        assert got == [(1, 0, n), (1, 0, n), (2, 150, n)]


def test_the_query_tells_passages_shorter_than_its_strings(spark, tmp_path):
    from gaugeline.llm.queries import op7_run_length_index

    passage = " ".join(["a few words of four and five to six"] * 7)  # 63 words, 251 bytes
    texts = [f"one {passage} begin", f"two {passage} other end", "clean", None]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op7_run_length_index(spark, str(tmp_path)).collect()}
    assert [got[i]["n_passage_words"] for i in range(4)] == [63, 63, 0, 0]
    assert [got[i]["n_removed"] for i in range(4)] == [0, 0, 0, 0]
