from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from gaugeline.llm import ball_hash
from gaugeline.llm.components import components

DOCS = "doc_id long, text string, fp string, node int"


def plain_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points, radius):
    """Least index reachable over steps of at most `radius` bits, by trying all pairs."""
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= radius:
                a_, b_ = find(i), find(j)
                parent[max(a_, b_)] = min(a_, b_)
    return [find(i) for i in range(len(points))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clouds(seed, centres, each, flips):
    rng, points = random.Random(seed), set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            points.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))))
    return sorted(points)


def check_links(spark, points, **more):
    # The same points under another name must not meet these.
    fps = spark.createDataFrame([(of, signed(p)) for p in points for of in (3, 4)], "of int, fp long")
    links = ball_hash.links(fps, **more)
    rows = [r for r in links.collect() if r["of"] == 3]
    index = {signed(p): i for i, p in enumerate(points)}
    got = list(range(len(points)))

    def find(x):
        while got[x] != x:
            x = got[x]
        return x

    for r in rows:
        a, b = find(index[r["u"]]), find(index[r["v"]])
        got[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(points))] == classes(points, more.get("radius", 4))


def test_links_equal_brute_force(spark):
    check_links(spark, clouds(1, 30, 12, 5))


def test_overfull_buckets_are_dealt_again(spark):
    check_links(spark, clouds(2, 2, 60, 4), variants=3000)
    check_links(spark, clouds(3, 3, 30, 3), radius=2, variants=64)


def test_fingerprints(spark):
    texts = {1: "One two THREE four five ÉTÉ", 2: None, 3: "", 4: "two words", 5: "\t \n", 6: "a b c d", 7: "x y z " * 30_000}
    docs = spark.createDataFrame([(k, v, "clash", 1) for k, v in texts.items()], DOCS)
    got = {r["doc_id"]: r["fp"] for r in ball_hash.fingerprints(docs).collect()}
    assert got == {k: signed(plain_fingerprint(v, 4)) for k, v in texts.items()}


def test_near_duplicates(spark):
    texts = [(5, "same text here now"), (3, "Same text here now"), (3, "same text here now"), (9, None), (8, ""), (7, "other words entirely different"), (None, "same text here now"), (None, "alone it stands here")]
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in texts], DOCS).repartition(4)
    rows = ball_hash.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows)
    assert got == [(-1, -1), (-1, 3), (3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (9, 8)]
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (8, 9)} == {"0" * 16}
    assert ball_hash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 299)]
    rng.shuffle(edges)
    rows = components(spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "u long, v long")).collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(got)
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 299, 299: 299}


def test_one_of_each(spark):
    rng = random.Random(6)
    words = [f"word{i}" for i in range(5000)]
    base = [" ".join(rng.sample(words, 400)) for _ in range(6)]
    near = base[0].split()
    near[17] = "edited"
    rows = [(i, t) for i, t in enumerate(base)] + [(10, " ".join(near)), (11, base[1]), (2, base[2]), (None, base[3]), (None, None), (20, "")]
    docs = spark.createDataFrame([(i, t, "clash", k) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)
    kept = ball_hash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 20]
    assert ball_hash.one_of_each(docs.limit(0)).count() == 0


def similar_classes(texts):
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    least = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and least[i] != least[j]:
                old, new = max(least[i], least[j]), min(least[i], least[j])
                least = [new if x == old else x for x in least]
    return set(least)


def test_one_of_each_keeps_texts_that_only_share_their_words(spark):
    rng = random.Random(12)
    words = [f"word{i}" for i in range(5000)]
    texts = []
    for _ in range(3):
        base = rng.sample(words, 300)
        texts.append(" ".join(base))
        texts.append(" ".join(base[::-1]))  # the same set of words, no shingle in common
        for edits in (1, 4, 5, 6, 7, 8, 12, 20, 30):
            for _ in range(3):
                copy = list(base)
                for at in rng.sample(range(300), edits):
                    copy[at], copy[at - 1] = copy[at - 1], copy[at]
                texts.append(" ".join(copy))
    docs = spark.createDataFrame([(i, t, "clash", i) for i, t in enumerate(texts)], DOCS).repartition(3)
    want = similar_classes(texts)
    assert 6 <= len(want) < len(texts)
    assert {r["doc_id"] for r in ball_hash.one_of_each(docs).collect()} == want


@pytest.mark.parametrize("bound", [ball_hash.TASK_SHINGLES, 100])
def test_verified_classes_equal_all_pairs(spark, bound, monkeypatch):
    """Sets with few and many shingles in common, in components that fit into a task and in some that do not."""
    monkeypatch.setattr(ball_hash, "TASK_SHINGLES", bound)
    monkeypatch.setattr(ball_hash, "PAIRS", 16)
    rng = random.Random(21)
    root, sets = [], []
    for component in range(8):
        pool = rng.sample(range(10**6), 60)
        for _ in range(rng.randrange(1, 25)):
            base = set(rng.sample(pool, rng.randrange(40, 60))) if rng.random() < 0.8 or not sets else set(sets[-1])
            for _ in range(rng.randrange(6)):
                base.add(rng.randrange(10**6))
            sets.append(sorted(base))
            root.append(component)
    sets += [[], [1], [1], [1, 2, 3, 4, 5], [1, 2, 3, 4]]
    root += [50, 51, 51, 52, 52]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            a, b = set(sets[i]), set(sets[j])
            if root[i] == root[j] and 5 * len(a & b) >= 4 * len(a | b) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    arrays = [np.array(x, np.int64) for x in sets]
    if bound > 1000:
        assert ball_hash.near_classes(np.array(root), arrays).tolist() == label
    rows = [(i, r, x.tobytes()) for i, (r, x) in enumerate(zip(root, arrays, strict=True))]
    got = {r["node"]: r["root"] for r in ball_hash._near_components(spark.createDataFrame(rows, "id long, root long, shingles binary")).collect()}
    assert [got.get(i, i) for i in range(len(sets))] == label
    assert len(set(label)) < len(sets) - 20


def test_frequent_shingles_name_no_pairs():
    """Texts of the same sentences in ever new orders share most shingles; only the few that share a rare one are compared."""
    rng = random.Random(3)
    sentences = [[f"s{k}w{i}" for i in range(12)] for k in range(120)]
    counts = []
    for n in (50, 200):
        texts = [" ".join(w for s in rng.sample(sentences, 120) for w in s).encode() for _ in range(n)]
        sets = [ball_hash.shingles(t) for t in texts]
        counts.append(sum(len(u) for u, _ in ball_hash._candidates(np.zeros(n, np.int64), sets)))
    assert counts[1] < 0.4 * 200 * 199 / 2  # two random orders have some sentence after the same one in most cases
