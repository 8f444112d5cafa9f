"""SimHash near-duplicates by meeting in the middle.

Two fingerprints that differ in at most 2h bits share a number that lies within h bits of both. So every fingerprint
stands for all variants within h flipped bits, and equal variants of two fingerprints prove a link. The shuffle goes by
the leading bits of the variants: a fingerprint is sent once to each bucket that any of its variants falls into (a few
dozen, not all of its 2,081 variants), and the bucket's task writes out the variants that begin so, some leading bits further
at a time, so that it holds a bounded number of them. A bucket with more variants than a task should go through is dealt out
again by more leading bits, down to single variants if need be; at most 2,081 different fingerprints share a variant, so no group
is unbounded, and none is cut.

Within a bucket only a spanning forest of the links leaves the task, never all pairs of a group. Components are then
found over different fingerprints, not documents: a thousand copies are one node.

`one_of_each` takes what chains together by such links as candidates only: within a component texts are near if their
sets of five-word shingles have a Jaccard similarity of at least 0.8, and that is computed exactly for every pair that
can reach it and is not connected yet. Pairs come from shared shingles, rarest first: of two near sets, the larger one has a
common shingle among its first fifth and the smaller one among its first ninth, so frequent shingles name no pairs. Components
are packed into tasks by their size; one that is too large for a task is verified by joins instead.

Defined results: null and empty texts (no words) have fingerprint zero, which links like any other; repeated rows each
get their row; a null doc_id is returned but never names a component unless it is all there is; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import even_partitions, give_back, lean, own, rows_of, stored, utf8
from gaugeline.llm.components import components
from gaugeline.session import release

#: Variants that one task holds at a time, and how many times as many it goes through.
VARIANTS = 2_000_000
SLICES = 16
#: Leading bits by which fingerprints are dealt at least.
LEAST_BITS = 8
#: Independent fingerprints by which `one_of_each` looks for near texts.
TABLES = 4
#: Leading bits by which an overfull bucket is dealt out again.
MORE_BITS = 6
#: Words of a shingle, and the least similarity of near texts, as a fraction of whole numbers.
SHINGLE = 5
NEAR = (4, 5)
#: Shingles that a task verifies at a time; a component with more is verified by joins.
TASK_SHINGLES = 500_000
#: Rounds in which texts that share a shingle are first compared with one leader each, and pairs compared at a time.
LEADERS = 2
PAIRS = 4_096


def _majority(hashes: list[int]) -> int:
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = np.array(hashes[at : at + 4096], dtype=">u8")
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, width: int) -> int:
    """64 majority votes over the hashes of the text's word windows (all of its words if it has fewer)."""
    words = text.lower().split()  # of bytes: only A-Z, and only ASCII white space
    if not words:
        return 0
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(word) + 1 for word in words])
        starts = [0, *ends[:-width].tolist()]
        stops = (ends[width - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)]
    return _majority(hashes)


def word_set_fingerprints(text: bytes, tables: int) -> list[int]:
    """Fingerprints by different seeds, in which each different word votes once."""
    words = set(text.lower().split())
    digest = xxhash.xxh64_intdigest
    return [_majority([digest(word, seed) for word in words]) if words else 0 for seed in range(tables)]


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Different hashes of the text's word windows (all of its words if it has fewer), in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64).view(np.int64)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts, stops = [0, *ends[:-width].tolist()], (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    found = {digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)}
    return np.sort(np.fromiter(found, np.uint64, len(found)).view(np.int64))


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """`doc_id, fp`: the fingerprint as a signed 64-bit number."""
    chosen = own(docs, "doc_id", "text").select("doc_id", utf8("text").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text, width) for text in rows_of(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return chosen.mapInArrow(lean(vote), T.StructType([chosen.schema["doc_id"], T.StructField("fp", T.LongType())]))


def ball(bits: int, flips: int) -> int:
    """How many numbers lie within so many flips of one, over so many bits."""
    return sum(math.comb(bits, k) for k in range(flips + 1))


@lru_cache(maxsize=None)
def _flips(bits: int, most: int) -> np.ndarray:
    """Masks of up to `most` set bits among the lowest `bits`."""
    masks = [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in combinations(range(bits), k)]
    return np.array(masks, np.uint64)


def _deal(rows: DataFrame, depth: int, deeper: int, half: int) -> DataFrame:
    """Every row (`of`, `fp`, `bucket` of `depth` leading bits) once for each bucket of `deeper` bits that its variants reach."""
    masks = [F.lit(int(m)) for m in _flips(deeper - depth, half)]
    own_bits = F.shiftrightunsigned(F.col("fp"), 64 - deeper).bitwiseAND((1 << (deeper - depth)) - 1)
    spread = rows.select("of", "fp", "bucket", F.explode(F.array(*masks)).alias("mask"))
    bucket = F.shiftleft("bucket", deeper - depth).bitwiseOR(own_bits.bitwiseXOR(F.col("mask")))
    spread = spread.select("of", "fp", bucket.alias("bucket"))
    return spread.filter(_used(deeper) <= half) if depth else spread


def _used(depth: int) -> Column:
    """How many of the leading bits the bucket has flipped."""
    return F.bit_count(F.shiftrightunsigned(F.col("fp"), 64 - depth).bitwiseXOR(F.col("bucket")))


def _weight(depth: int, half: int) -> Column:
    """Variants that a row stands for, by the flips that it has left."""
    weight = F.lit(1)
    for used in range(half):
        weight = F.when(_used(depth) == used, F.lit(ball(64 - depth, half - used))).otherwise(weight)
    return weight


def _buckets(fps: DataFrame, half: int, variants: int) -> DataFrame:
    """`fps` dealt into buckets (of `depth` bits) of at most about `variants * SLICES`, whatever lies close together."""
    # An even bucket is an eighth full at most: only where fingerprints lie close together is one dealt out again.
    largest = fps.groupBy("of").count().agg(F.max("count")).first()[0] or 0
    variants *= SLICES
    spread = largest * ball(64, half) / (variants / 8)
    deeper = min(24, max(LEAST_BITS, math.ceil(math.log2(max(2, spread)))))
    rows, depth = fps.select("of", "fp", F.lit(0).cast("long").alias("bucket")), 0
    ready = None
    while True:
        dealt = _deal(rows, depth, deeper, half)
        full = dealt.groupBy("of", "bucket").agg(F.sum(_weight(deeper, half)).alias("n")).filter(F.col("n") > variants)
        full = stored(full.select("of", "bucket"), "full-buckets")
        done = deeper == 64 or full.isEmpty()
        fitting = dealt if done else dealt.join(full, ["of", "bucket"], "left_anti").select("of", "fp", "bucket")
        fitting = fitting.withColumn("depth", F.lit(deeper))
        ready = fitting if ready is None else ready.unionByName(fitting)
        if done:
            return ready
        rows = stored(dealt.join(full, ["of", "bucket"], "left_semi").select("of", "fp", "bucket"), "overfull")
        depth, deeper = deeper, min(64, deeper + MORE_BITS)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least reachable index of each of n nodes under the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _meetings(fp: np.ndarray, rows: np.ndarray, depth: int, bucket: int, half: int, variants: int) -> Iterator[np.ndarray]:
    """Pairs of neighbours (one index << 32 | the other) among the rows with equal variants that begin with the bucket's bits."""
    bits = 64 - depth
    mine = fp[rows]
    v = mine & np.uint64((1 << bits) - 1) | np.uint64((bucket << bits) % (1 << 64))
    used = np.bitwise_count(mine ^ v)
    if bits and sum(int((used == k).sum()) * ball(bits, half - k) for k in range(half + 1)) > variants:
        further = min(4, bits)
        lead = (mine >> np.uint64(bits - further)) & np.uint64((1 << further) - 1)
        for begin in range(1 << further):  # the variants whose next bits are these
            reach = np.bitwise_count(lead ^ np.uint64(begin)) + used <= half
            if reach.any():
                yield from _meetings(fp, rows[reach], depth + further, bucket << further | begin, half, variants)
        return
    made, owner = [], []
    for flipped in range(half + 1):
        own_ = np.flatnonzero(used == flipped)
        masks = _flips(bits, half - flipped)
        made.append((v[own_][:, None] ^ masks[None, :]).ravel())
        owner.append(np.repeat(rows[own_], len(masks)))
    made, owner = np.concatenate(made), np.concatenate(owner)
    order = np.argsort(made)
    made, owner = made[order], owner[order]
    same = np.flatnonzero(made[1:] == made[:-1])
    yield np.unique(owner[same].astype(np.int64) << 32 | owner[same + 1])


def links(fps: DataFrame, radius: int = 4, variants: int = VARIANTS) -> DataFrame:
    """`of, u, v`: links that connect exactly the fingerprints (`of, fp`, all different) of each `of` within `radius` bits.

    A link may stand for a chain of near pairs that one bucket has seen; all nearness is kept up to that.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    half = radius // 2

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        fp = rows.column("fp").to_numpy().view(np.uint64)
        of, depth, bucket = (k.as_py() for k in key)
        pairs = [np.zeros(0, np.int64), *_meetings(fp, np.arange(len(fp), dtype=np.int32), depth, bucket % (1 << 64), half, variants)]
        pairs = np.unique(np.concatenate(pairs))
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        label = _forest(len(fp), a[near], b[near])
        moved = np.flatnonzero(label != np.arange(len(fp)))
        u, w = fp[moved].view(np.int64), fp[label[moved]].view(np.int64)
        return pa.table({"of": pa.array([of] * len(u), pa.int32()), "u": u, "v": w})

    return _buckets(fps, half, variants).groupBy("of", "depth", "bucket").applyInArrow(meet, "of int, u long, v long")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """`doc_id, fingerprint, component_id` for every document."""
    found = stored(fingerprints(docs, width), "fingerprints")
    different = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "different-fingerprints")
    roots = components(links(different.select(F.lit(0).alias("of"), "fp"), radius))
    rooted = different.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.join(by_fp, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def _near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles have a Jaccard similarity of at least `NEAR`."""
    part, whole = NEAR
    common = len(np.intersect1d(a, b, assume_unique=True))
    return whole * common >= part * (len(a) + len(b) - common)


def _candidates(root: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets of one root that can be near: by a shingle rare enough, where it stands in both, and their sizes."""
    part, whole = NEAR
    size = np.array([len(x) for x in sets], np.int64)
    of = np.repeat(np.arange(len(sets)), size)
    token = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    order = np.lexsort((token, root[of]))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (token[order][1:] != token[order][:-1]) | (root[of[order]][1:] != root[of[order]][:-1])
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(fresh) - 1
    many = np.bincount(name)
    order = np.lexsort((name, many[name], of))  # a set's shingles, rarest first
    of, name = of[order], name[order]
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    left = size[of] - at
    shared = many[name] > 1
    probe = np.flatnonzero(shared & (whole * left >= part * size[of]))
    index = np.flatnonzero(shared & ((part + whole) * left >= 2 * part * size[of]))
    # Of each shingle the sets by size: a probing set meets those of at least 4/5 of its size and at most its own.
    wide = np.int64(size.max() + 1 if len(size) else 1)
    key = name[index] * wide + size[of[index]]
    index = index[np.argsort(key, kind="stable")]
    key.sort()
    low = np.searchsorted(key, name[probe] * wide + -(-part * size[of[probe]] // whole))
    high = np.searchsorted(key, name[probe] * wide + size[of[probe]], side="right")
    met = np.maximum(high - low, 0)
    begin = 0
    while begin < len(probe):  # blocks of bounded size
        end = max(begin + 1, int(np.searchsorted(np.cumsum(met[begin:]), 64 * PAIRS, side="right")) + begin)
        n = met[begin:end]
        u = np.repeat(probe[begin:end], n)
        v = index[np.repeat(low[begin:end], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        common = np.minimum(left[u], left[v])
        su, sv = size[of[u]], size[of[v]]
        may = ((part + whole) * common >= part * (su + sv)) & (of[u] != of[v])
        pairs = np.unique(np.minimum(of[u], of[v])[may] * np.int64(len(sets)) + np.maximum(of[u], of[v])[may])
        if len(pairs):
            yield pairs // len(sets), pairs % len(sets)
        begin = end


def near_classes(root: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """For each set the least index of a set that a chain of near sets of its root connects it with."""
    label = np.arange(len(sets))
    for u, v in _candidates(root, sets):
        for at in range(0, len(u), PAIRS):
            a, b = u[at : at + PAIRS], v[at : at + PAIRS]
            open_ = label[a] != label[b]  # what is connected already need not be compared
            near = [(i, j) for i, j in zip(a[open_].tolist(), b[open_].tolist(), strict=True) if _near(sets[i], sets[j])]
            if near:
                i, j = np.array(near).T
                label = _forest(len(sets), label[i], label[j])[label]
    return label


def _in_tasks(texts: DataFrame, shingles_in_all: int) -> DataFrame:
    """`node, root`: what the sets (`id, root, shingles`) of components that fit into a task connect."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("root")
        sets = [np.frombuffer(x.as_py(), np.int64) for x in rows.column("shingles")]
        ids, root = rows.column("id").to_numpy(), rows.column("root").to_numpy()
        size = np.cumsum([len(x) for x in sets])
        ends = np.r_[np.flatnonzero(root[1:] != root[:-1]) + 1, len(root)]
        node, found, at = [], [], 0
        while at < len(root):  # whole components, until the bound is passed
            end = int(ends[np.searchsorted(size[ends - 1], (size[at - 1] if at else 0) + TASK_SHINGLES).clip(max=len(ends) - 1)])
            label = near_classes(root[at:end], sets[at:end])
            moved = np.flatnonzero(label != np.arange(end - at))
            node.append(ids[at + moved])
            found.append(ids[at + label[moved]])
            at = end
        del sets
        give_back()
        return pa.table({"u": np.concatenate(node), "v": np.concatenate(found)})

    tasks = even_partitions(texts, shingles_in_all, TASK_SHINGLES)
    dealt = texts.withColumn("task", F.pmod(F.xxhash64("root"), F.lit(tasks)))
    return components(stored(dealt.groupBy("task").applyInArrow(work, "u long, v long"), "near-in-tasks"))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs `u, v` of sets (`id, shingles`) that are near."""
    left, right = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"{c}_has")) for c in "uv")
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "u_has", "v_has")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(rows_of(batch, "u_has"), rows_of(batch, "v_has"), strict=True)
            near = [_near(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)) for a, b in rows]
            yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(lean(compare), "u long, v long")


def _by_joins(sets: DataFrame) -> DataFrame:
    """`node, root`: what the sets (`id, root, shingles`) of large components connect, as `near_classes` has it, by joins.

    Sets with a shingle in common are first compared with one of them; only what is not connected by then is compared in pairs.
    """
    part, whole = NEAR

    @F.arrow_udf("array<bigint>")
    def listed(shingles: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x, np.int64) for x in shingles.to_pylist()], pa.list_(pa.int64()))

    size = (F.length("shingles") / 8).cast("int")
    every = sets.select("id", "root", size.alias("size"), F.explode(listed("shingles")).alias("token"))
    shared = every.groupBy("root", "token").agg(F.count("*").alias("n")).filter("n > 1")
    every = every.join(stored(shared, "shared-shingles"), ["root", "token"])
    ranked = every.groupBy("id", "root", "size").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("all"))
    spread = ranked.select("id", "root", "size", (F.col("size") - F.size("all")).alias("alone"), F.posexplode("all").alias("at", "x"))
    at = (F.col("alone") + F.col("at")).alias("at")
    tokens = spread.select("id", "root", "size", at, F.col("x.token").alias("token"))
    tokens = stored(tokens.filter(whole * (F.col("size") - F.col("at")) >= part * F.col("size")), "rare-shingles")

    def may(a: str, b: str) -> Column:
        """Whether a and b can be near, by their sizes and the places of the shingle that they share."""
        common = F.least(F.col(f"{a}.size") - F.col(f"{a}.at"), F.col(f"{b}.size") - F.col(f"{b}.at"))
        return (part + whole) * common >= part * (F.col(f"{a}.size") + F.col(f"{b}.size"))

    found, labels = None, None
    for round_ in range(LEADERS + 1):
        now = tokens.withColumn("label", F.col("id"))
        if labels is not None:
            named = labels.select(F.col("node").alias("id"), F.col("root").alias("named"))
            now = tokens.join(named, "id", "left").withColumn("label", F.coalesce("named", "id")).drop("named")
        me = F.struct("id", "label", "size", "at")
        groups = now.groupBy("root", "token").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(me, F.xxhash64("id", F.lit(round_))).alias("leader")
        )
        groups = stored(groups.filter("low <> high").select("root", "token", "leader"), "open-shingles")
        if labels is not None and groups.isEmpty():
            return labels
        now = stored(now.join(groups, ["root", "token"]).select("root", "token", me.alias("me"), "leader"), "open")
        if round_ < LEADERS:
            pairs = now.select("me", F.col("leader").alias("other"))
        else:
            # The smaller set has the shingle among its first ninth.
            small = now.filter((part + whole) * (F.col("me.size") - F.col("me.at")) >= 2 * part * F.col("me.size"))
            small = small.select("root", "token", F.col("me").alias("other"))
            larger = F.struct("me.size", "me.id") > F.struct("other.size", "other.id")
            pairs = now.select("root", "token", "me").join(small, ["root", "token"]).filter(larger)
        pairs = pairs.filter("me.label <> other.label").filter(may("me", "other"))
        pairs = pairs.select(F.least("me.id", "other.id").alias("u"), F.greatest("me.id", "other.id").alias("v")).distinct()
        near = stored(_similar(stored(pairs, "pairs"), sets), "near")
        found = near if found is None else found.unionByName(near)
        labels = stored(components(found), "labels")
    return labels


def _near_components(texts: DataFrame) -> DataFrame:
    """`node, root` for the sets (`id, root, shingles`) that chains of near sets of one root connect."""
    sizes = texts.groupBy("root").agg(F.sum(F.length("shingles") / 8).alias("n"))
    sizes = stored(sizes, "component-sizes")
    large = sizes.filter(F.col("n") > TASK_SHINGLES).select("root")
    fitting = _in_tasks(texts.join(large, "root", "left_anti"), int(sizes.agg(F.sum("n")).first()[0] or 0))
    if large.isEmpty():
        return fitting
    return fitting.unionByName(_by_joins(stored(texts.join(large, "root", "left_semi"), "large-components")))


def one_of_each(docs: DataFrame, tables: int = TABLES, radius: int = 4) -> DataFrame:
    """`docs` with one row (the least doc_id that is not null, then text hash) of each group of near-duplicates.

    Near are texts whose sets of five-word shingles have similarity 0.8 at least, and what chains of near texts connect.
    Looked for are they among texts that are connected by word sets with fingerprints within `radius` bits under any of
    `tables` seeds. Repeated rows count as one document.
    """
    hashed = docs.withColumn("_llm_key", F.struct("doc_id", F.xxhash64(utf8("text")).alias("hash")))
    chosen = hashed.select("_llm_key", utf8("text").alias("_text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for text in rows_of(batch, "_text"):
                found.append(word_set_fingerprints(text, tables))
                ids.append(xxhash.xxh64_intdigest(shingles(text).tobytes(), 42))
            fps = np.array(found, np.uint64).reshape(-1, tables).view(np.int64)
            columns = [pa.array(np.ascontiguousarray(fps[:, k])) for k in range(tables)]
            columns.append(pa.array(np.array(ids, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_llm_key"), *columns], ["_llm_key", *names, "id"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = pa.array([shingles(text).tobytes() for text in rows_of(batch, "_text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("root"), has], ["id", "root", "shingles"])

    names = [f"fp{k}" for k in range(tables)]
    kinds = [T.StructField(name, T.LongType()) for name in names]
    found = chosen.mapInArrow(lean(vote), T.StructType([chosen.schema["_llm_key"], *kinds, T.StructField("id", T.LongType())]))
    found = stored(found.withColumn("node", F.xxhash64(*names)), "word-set-fingerprints")
    nodes = found.select("node", *names).distinct()
    # All tables in one run; what has equal fingerprints in a table hangs on the least node that has them.
    spread = nodes.select("node", F.posexplode(F.array(*names)).alias("of", "fp"))
    named = stored(spread.groupBy("of", "fp").agg(F.min("node").alias("first"), F.count("*").alias("n")), "tables")
    same = spread.join(named.filter("n > 1").drop("n"), ["of", "fp"]).select(F.col("node").alias("u"), F.col("first").alias("v"))
    u, v = (named.select("of", F.col("fp").alias(c), F.col("first").alias(f"{c}_first")) for c in "uv")
    close = links(named.select("of", "fp"), radius).join(u, ["of", "u"]).join(v, ["of", "v"])
    close = close.select(F.col("u_first").alias("u"), F.col("v_first").alias("v"))
    near = stored(same.filter("u <> v").unionByName(close), "table-links")
    order = F.struct(F.col("_llm_key.doc_id").isNull().alias("last"), F.col("_llm_key").alias("key"))
    sets = found.groupBy("id", "node").agg(F.min(order).alias("least"))
    sets = sets.join(components(near), "node", "left").groupBy("id").agg(
        F.min(F.coalesce("root", "node")).alias("root"), F.min("least").alias("least")
    )
    sets = stored(sets, "shingle-sets")
    release(found, named, near)
    several = sets.groupBy("root").agg(F.count("*").alias("n")).filter("n > 1").select("root")
    # The text of one document stands for all that have its shingles.
    to_verify = sets.join(stored(several, "components"), "root", "left_semi").select("id", "root", F.col("least.key").alias("_llm_key"))
    texts = chosen.join(stored(to_verify, "to-verify"), "_llm_key").select("id", "root", "_text").mapInArrow(
        lean(collect), "id long, root long, shingles binary"
    )
    texts = stored(texts.dropDuplicates(["id"]), "shingles")
    near = _near_components(texts)
    release(texts)
    rooted = sets.select("id", "least").join(near.select(F.col("node").alias("id"), F.col("root").alias("near")), "id", "left")
    kept = rooted.groupBy(F.coalesce("near", "id").alias("root")).agg(F.min("least").alias("kept"))
    kept = kept.select(F.col("kept.key").alias("_llm_key"))
    joined = hashed.join(kept, "_llm_key", "left_semi")
    return joined.dropDuplicates(["_llm_key"]).select(docs.columns)
