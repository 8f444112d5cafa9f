"""Exact repeated-substring removal with run-length Burrows-Wheeler indexes over shards of candidate text.

A byte goes if a string of `length` bytes that covers it also starts anywhere else. One suffix structure over the whole
corpus would be one task, so the corpus is first cut into pieces that can be judged apart without losing a match:

1. Every string of `length` bytes belongs to the least (by hash, leftmost of equals) of the short grams inside it: its
   anchor. Equal strings have equal anchors at equal places. A segment is the text of all strings that share an anchor;
   each string starts in exactly one segment.
2. Anchors are counted over all documents. An anchor that occurs once has nothing to match. Segments that are equal as a
   whole are kept once, with their number.
3. Different segments of one anchor meet in a shard. There the segments' suffixes are sorted, the transform is
   compressed to runs, and the longest common prefixes with the neighbours are measured at run ends only: in between,
   each step along the text loses one byte of the match (`matching_statistics`). Strings whose match reaches `length`
   are repeated.
4. The found ranges go back to every copy of a segment, are merged per document, and the rest is put together.

An anchor whose different segments exceed a shard (a passage in ever new surroundings) is dealt out again by the bytes
that narrower and narrower blocks of its strings have in common, at last by the whole strings, so no group is unbounded
and none is cut. Copies of a document are one document with a number wherever counts suffice.

Defined results: null text counts as empty; texts shorter than `length` keep everything; overlapping matches in one text
count; repeated rows are matches of each other, and each gets its row; null ids are returned; an empty table gives an
empty result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import (
    HASH_COLUMN, SPANS, WORD, RollingHash, beside, even_partitions, give_back, hashed, lean, merged, own, stored, utf8, without
)
from gaugeline.session import release

#: Bytes of text that one task indexes at a time; sorting ranks of three neighbours in 63 bits needs fewer than 2**21.
SHARD_BYTES = 1_000_000
#: Bytes of text hashed at a time.
BLOCK_BYTES = 1 << 20
#: Widths of the blocks of strings into which an overfull anchor is dealt.
WIDTHS = (64, 8, 1)

HASH = RollingHash(0x9E3779B97F4A7C15)
BASE = 3


def gram_of(length: int) -> int:
    """Bytes in an anchor: long enough to be rare, short enough that few are needed."""
    return max(1, length // 6)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` numbers."""
    reach, out = 1, x
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Of texts: number of the text, anchor hash, hash of the segment, its start, its strings, the anchor's place in it."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    gram = gram_of(length)
    prefix = HASH.prefix(data)
    grams = HASH.grams(prefix, gram)
    low = np.uint64(0xFFFFFFFF)
    owner = _window_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    counts = np.maximum(lengths - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    own_ = (owner[starts] & low).astype(np.int64)
    if not len(starts):
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    first = np.flatnonzero(np.r_[True, (own_[1:] != own_[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:] - 1, len(starts) - 1]
    at, stop, anchor, of = starts[first], starts[last] + length, own_[first], text[first]
    whole = HASH.ranges(prefix, at, stop)
    return of, grams[anchor], whole, at - begins[of], last - first + 1, anchor - at


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    chosen = docs.select("doc_id", HASH_COLUMN, utf8("text").alias("text"))
    fields = [("anchor", T.LongType()), ("segment", T.LongType()), ("at", T.IntegerType()), ("n", T.IntegerType()), ("place", T.IntegerType())]
    schema = T.StructType([chosen.schema["doc_id"], chosen.schema[HASH_COLUMN], *[T.StructField(*f) for f in fields]])

    def emit(batch: pa.RecordBatch, rows: list[int], texts: list[bytes]) -> pa.RecordBatch:
        of, anchor, whole, at, n, place = segments(texts, length)
        of = pa.array(np.array(rows, np.int64)[of])
        columns = [batch.column("doc_id").take(of), batch.column(HASH_COLUMN).take(of)]
        columns += [pa.array(x.view(np.int64)) for x in (anchor, whole)]
        columns += [pa.array(x.astype(np.int32)) for x in (at, n, place)]
        return pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, held = [], [], 0
            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                if len(text) < length:
                    continue
                rows.append(i)
                texts.append(text)
                held += len(text)
                if held >= BLOCK_BYTES:
                    yield emit(batch, rows, texts)
                    rows, texts, held = [], [], 0
            if rows:
                yield emit(batch, rows, texts)

    return chosen.mapInArrow(lean(cut), schema)


def _ranks(symbols: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of the suffixes by their first 1, 3, 9, ... symbols, and the suffix array.

    Every text ends in a symbol of its own, so ranks become all different at last. Prefixes triple in each round.
    """
    n = len(symbols)
    rank, reach, levels = symbols.astype(np.int64), 1, []
    while True:
        levels.append((reach, rank.astype(np.int32)))
        second, third = np.zeros(n, np.int64), np.zeros(n, np.int64)
        second[: max(0, n - reach)] = rank[reach:] + 1
        third[: max(0, n - 2 * reach)] = rank[2 * reach :] + 1
        key = rank << 42 | second << 21 | third
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int64)
        dense = np.cumsum(np.r_[False, key[1:] != key[:-1]])
        rank[order] = dense
        reach *= BASE
        if n == 0 or dense[-1] == n - 1:
            return levels, order


def _common(levels: list[tuple[int, np.ndarray]], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at p and at q, from the ranks of ever shorter prefixes."""
    p, q, start, n = p.copy(), q.copy(), p, len(levels[0][1])
    for reach, rank in reversed(levels):
        for _ in range(BASE - 1 if reach > 1 or len(levels) > 1 else n):
            inside = (p < n) & (q < n)
            same = np.zeros(len(p), bool)
            same[inside] = rank[p[inside]] == rank[q[inside]]
            p, q = p + reach * same, q + reach * same
    return p - start


def matching_statistics(texts: list[bytes]) -> np.ndarray:
    """For every byte of the texts, each with one end symbol: the longest string from there that starts elsewhere too.

    Builds the transform, compresses it to runs and samples the run ends: at the first suffix of a run the match with
    the suffix before, at the last one the match with the suffix after is measured. Inside a run both the suffix and its
    neighbour go on from neighbours one byte earlier, so the match there is the sampled one less the bytes walked.
    """
    t, lengths = len(texts), np.array([len(x) + 1 for x in texts], np.int64)
    symbols = np.zeros(lengths.sum(), np.int64)
    closing = np.cumsum(lengths) - 1
    inner = np.ones(len(symbols), bool)
    inner[closing] = False
    symbols[inner] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + t
    symbols[closing] = np.arange(t)
    levels, order = _ranks(symbols)
    transform = symbols[order - 1]
    edge = np.flatnonzero(transform[1:] != transform[:-1])  # between a run's last suffix and the next run's first
    common = _common(levels, order[edge], order[edge + 1])
    places = np.arange(len(symbols))
    best = np.zeros(len(symbols), np.int64)
    for sampled, match in ((order[np.r_[0, edge + 1]], np.r_[0, common]), (order[np.r_[edge, len(order) - 1]], np.r_[common, 0])):
        value = np.zeros(len(symbols), np.int64)
        value[sampled] = match
        known = np.zeros(len(symbols), np.int64)
        known[sampled] = sampled
        known = np.maximum.accumulate(known)
        best = np.maximum(best, value[known] - (places - known))
    return best


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return edges[::2], edges[1::2] - 1


_MARK = "anchor long, segment long, first int, last int, across boolean"


def _in_several(texts: list[bytes], flags: list[np.ndarray], low: np.ndarray, high: np.ndarray, length: int) -> list[np.ndarray]:
    """Of the flagged strings of each segment: whether their copies lie in more than one document, least and greatest being known."""
    counts = [int(x.sum()) for x in flags]
    grams = [HASH.grams(HASH.prefix(np.frombuffer(x, np.uint8)), length)[f] for x, f in zip(texts, flags, strict=True)]
    _, group = np.unique(np.concatenate(grams), return_inverse=True)
    least, most = np.full(len(group), np.iinfo(np.int64).max), np.full(len(group), np.iinfo(np.int64).min)
    np.minimum.at(least, group, np.repeat(low, counts))
    np.maximum.at(most, group, np.repeat(high, counts))
    several = np.split((least != most)[group], np.cumsum(counts)[:-1])
    out = [np.zeros(len(f), bool) for f in flags]
    for found, flag, x in zip(out, flags, several, strict=True):
        found[flag] = x
    return out


def _index(length: int, shard_bytes: int):
    def repeated(texts: list[bytes], counts: list[int], bounds: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
        best, begin, flags = matching_statistics(texts), 0, []
        for text, n in zip(texts, counts, strict=True):
            flags.append(best[begin : begin + n] >= length)
            begin += len(text) + 1
        several = _in_several(texts, flags, *bounds, length) if bounds else [np.zeros(len(f), bool) for f in flags]
        for i, (flag, found) in enumerate(zip(flags, several, strict=True)):
            yield i, *_runs(flag & ~found), False
            yield i, *_runs(found), True

    def work(rows: pa.Table) -> pa.Table:
        """Of a shard of candidates: the runs of strings that are repeated, counted from the segment's first."""
        rows = rows.sort_by("key")
        keys, size = rows.column("key").to_numpy(), np.cumsum(rows.column("size").to_numpy())
        n, offset = rows.column("n").to_numpy(), rows.column("offset").to_numpy()
        of, first, last, across, at = [], [], [], [], 0
        bounds = [rows.column(c).to_numpy() for c in ("low", "high") if c in rows.column_names]
        ends = np.r_[np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        while at < len(keys):  # whole keys, until the shard's bound is passed
            end = ends[np.searchsorted(size[ends - 1], (size[at - 1] if at else 0) + shard_bytes).clip(max=len(ends) - 1)]
            texts = [x.as_py() for x in rows.column("text").slice(at, end - at)]
            for i, a, b, several in repeated(texts, n[at:end].tolist(), [x[at:end] for x in bounds]):
                of += [at + i] * len(a)
                across += [several] * len(a)
                first += (a + offset[at + i]).tolist()
                last += (b + offset[at + i]).tolist()
            at = end
        give_back()
        took = pa.array(of, pa.int64())
        columns = [rows.column("anchor").take(took), rows.column("segment").take(took)]
        columns += [pa.chunked_array([pa.array(x, pa.int32())]) for x in (first, last)]
        columns.append(pa.chunked_array([pa.array(across, pa.bool_())]))
        return pa.Table.from_arrays(columns, ["anchor", "segment", "first", "last", "across"])

    return work


def _narrower(candidates: DataFrame, width: int, length: int) -> DataFrame:
    """Candidates cut into blocks of at most `width` strings; the new key hashes what a block's strings have in common."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text, place, n = row["text"], row["place"], row["n"]
                prefix = HASH.prefix(np.frombuffer(text, np.uint8))
                for block in range((place - n + 1) // width, place // width + 1):
                    first = max(0, place - (block + 1) * width + 1)
                    last = min(n - 1, place - block * width)
                    span = np.array([[place - block * width], [place - (block + 1) * width + 1 + length]])
                    core = int(HASH.ranges(prefix, *span)[0]) ^ (row["key"] + block) % (1 << 64)
                    part = {"key": core - (core >> 63 << 64), "n": last - first + 1, "place": place - first}
                    part |= {"offset": row["offset"] + first, "text": text[first : last + length]}
                    out.append(row | part)
            yield pa.RecordBatch.from_pylist(out, batch.schema)

    narrow = candidates.mapInArrow(lean(cut), candidates.schema)
    return narrow.withColumn("whole", F.xxhash64("text", "place")).withColumn("size", F.length("text") + 1)


def _grouped(candidates: DataFrame) -> DataFrame:
    """With the bytes under each key, whether all there is the same, and in several documents; keys that occur once are dropped."""
    several = F.min("low") != F.max("high") if "low" in candidates.columns else F.lit(False)
    groups = candidates.groupBy("key").agg(
        F.sum("copies").alias("all_copies"),
        F.sum("size").alias("bytes"),
        (F.min("whole") == F.max("whole")).alias("same"),
        several.alias("across"),
    )
    return candidates.join(stored(groups.filter("all_copies > 1").drop("all_copies"), "groups"), "key")


def _repeated(candidates: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """`anchor, segment, first, last, across`: the runs of repeated strings of grouped candidates with their text.

    With `low` and `high`, the least and greatest document of each candidate, `across` tells strings that stand in several.
    """
    found, widths = None, [width for width in WIDTHS if width <= length]  # wider blocks have nothing in common
    several = F.col("low") != F.col("high") if "low" in candidates.columns else F.lit(False)
    while True:
        certain = candidates.filter("same or copies > 1").select(
            "anchor", "segment", F.col("offset").alias("first"), (F.col("offset") + F.col("n") - 1).alias("last"),
            F.when(F.col("same"), F.col("across")).otherwise(several).alias("across"),
        )
        over = candidates.filter(~F.col("same") & (F.col("bytes") > shard_bytes)) if widths else candidates.limit(0)
        fitting = candidates.filter(~F.col("same") & ((F.col("bytes") <= shard_bytes) | F.lit(not widths)))
        shards = even_partitions(candidates, fitting.agg(F.sum("size")).first()[0] or 0, shard_bytes // 2)
        fitting = fitting.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        indexed = fitting.groupBy("shard").applyInArrow(_index(length, shard_bytes), _MARK)
        part = certain.unionByName(indexed)
        found = part if found is None else found.unionByName(part)
        if over.isEmpty():
            return found
        narrow = stored(_narrower(over.drop("bytes", "same", "across"), widths.pop(0), length), "narrower")
        candidates = stored(_grouped(narrow), "narrower-grouped")


def repeats(docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES, across: Column | None = None) -> DataFrame:
    """`doc_id`, text hash, `spans`: the maximal byte ranges to remove from each text that has any.

    With `across`, a number of the document that a row belongs to, also `shared`: the ranges of strings that another one holds too.
    """
    tracked = across is not None
    several = F.min(across) != F.max(across) if tracked else F.lit(False)
    bounds = [F.min(across).alias("low"), F.max(across).alias("high")] if tracked else []
    texts = hashed(own(docs, "doc_id", "text"))
    anchors = stored(_anchors(texts, length), "anchors")
    counted = anchors.groupBy("anchor").agg(
        F.count("*").alias("copies"), (F.min("segment") == F.max("segment")).alias("same"), several.alias("across")
    )
    # Written first: a join of two plain exchanges, which adaptive execution can split at a hot anchor.
    counted = stored(counted.filter("copies > 1").drop("copies"), "counted-anchors")
    seen = stored(anchors.join(counted, "anchor"), "repeated-anchors")
    release(anchors, counted)
    where = F.struct("doc_id", HASH_COLUMN, "at", "n", "place")
    different = seen.filter("not same").groupBy("anchor", "segment")
    different = different.agg(F.count("*").alias("copies"), F.min(where).alias("one"), *bounds)
    different = different.select(
        "anchor", "segment", "copies", "one.*", *[c for c in ("low", "high") if tracked], F.col("anchor").alias("key"), F.lit(0).alias("offset"),
        F.col("segment").alias("whole"), (F.col("one.n") + F.lit(length)).alias("size"),
    )
    grouped = _grouped(different)
    parts = [c for c in grouped.columns if c not in ("doc_id", HASH_COLUMN)]
    wanted = grouped.groupBy("doc_id", HASH_COLUMN).agg(F.collect_list(F.struct(*parts)).alias("parts"))
    text = F.col("text").cast("binary")
    taken = beside(texts, wanted, "inner").select(
        F.explode(
            F.transform("parts", lambda x: x.withField("text", F.substring(text, x["at"] + 1, x["n"] + F.lit(length - 1))))
        ).alias("part")
    )
    candidates = stored(taken.select("part.*"), "candidates")
    marks = stored(_repeated(candidates, length, shard_bytes).distinct(), "marks")
    release(candidates)
    spread = seen.filter("not same").drop("across").join(marks, ["anchor", "segment"])
    whole = seen.filter("same").withColumns({"first": F.lit(0), "last": F.col("n") - 1})
    spans = spread.select(whole.columns).unionByName(whole).select(
        "doc_id", HASH_COLUMN, F.struct((F.col("at") + F.col("first")).alias("a"), (F.col("at") + F.col("last") + length).alias("b")).alias("range"),
        "across",
    )
    kinds = {"spans": F.col("range")} | ({"shared": F.when(F.col("across"), F.col("range"))} if tracked else {})
    ranges = spans.groupBy("doc_id", HASH_COLUMN).agg(*[F.sort_array(F.collect_set(x)).alias(name) for name, x in kinds.items()])
    return ranges.select("doc_id", HASH_COLUMN, *[merged(F.col(name)).alias(name) for name in kinds])


def _inside(docs: DataFrame, found: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """`spans` of the repeats of `length` bytes, given those of shorter strings: a longer one lies whole inside a range of theirs.

    The ranges are judged as texts of their own, so there are rows for each of them.
    """
    texts = hashed(own(docs, "doc_id", "text")).withColumn("text", utf8("text"))
    long = found.select("doc_id", HASH_COLUMN, F.filter("spans", lambda x: x["b"] - x["a"] >= length).alias("spans"))
    pieces = beside(texts, long.filter(F.size("spans") > 0), "inner").select("doc_id", HASH_COLUMN, "text", F.explode("spans").alias("range"))
    pieces = pieces.select(
        F.struct("doc_id", HASH_COLUMN, F.col("range.a").alias("begin")).alias("doc_id"),
        F.substring("text", F.col("range.a") + 1, F.col("range.b") - F.col("range.a")).alias("text"),
    )
    return _placed(repeats(stored(pieces, "pieces"), length, shard_bytes), "spans")


def _placed(judged: DataFrame, name: str) -> DataFrame:
    """Ranges of pieces as ranges of the documents that they begin in."""
    place = lambda x: F.struct((x["a"] + F.col("begin")).alias("a"), (x["b"] + F.col("begin")).alias("b"))
    return judged.select("doc_id.*", name).select("doc_id", HASH_COLUMN, F.transform(name, place).alias(name))


def dense(text: bytes, words: int, size: int) -> list[tuple[int, int]]:
    """The stretches of a text in which more than `words` words follow each other in fewer than `size` bytes."""
    data = np.frombuffer(text, np.uint8)
    starts, last = _runs((data != 32) & ((data < 9) | (data > 13)))
    ends = last + 1
    if len(starts) <= words:
        return []
    first, final = _runs(ends[words:] - starts[: len(starts) - words] < size)
    return list(zip(starts[first].tolist(), ends[final + words].tolist(), strict=True))


def _dense(docs: DataFrame, words: int, size: int) -> DataFrame:
    """The dense stretches of all documents, as documents of their own."""
    chosen = hashed(own(docs, "doc_id", "text")).select("doc_id", HASH_COLUMN, utf8("text").alias("text"))
    schema = T.StructType([*chosen.schema, T.StructField("begin", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, begins, pieces = [], [], []
            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                for a, b in dense(text, words, size):
                    of.append(i)
                    begins.append(a)
                    pieces.append(text[a:b])
            if of:
                took = pa.array(of, pa.int64())
                columns = [batch.column("doc_id").take(took), batch.column(HASH_COLUMN).take(took)]
                columns += [pa.array(pieces, batch.column("text").type), pa.array(begins, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return chosen.mapInArrow(lean(cut), schema).select(F.struct("doc_id", HASH_COLUMN, "begin").alias("doc_id"), "text")


def _words(text: Column, spans: Column, over: int) -> Column:
    """Whole words in those of the byte ranges that hold more than `over` of them."""
    space = WORD[:-1].replace("^", "")
    blank = F.lit(" ").cast("binary")

    def count(x: Column) -> Column:
        before = F.when(x["a"] == 0, blank).otherwise(F.substring(text, x["a"], F.lit(1)))
        after = F.when(x["b"] == F.length(text), blank).otherwise(F.substring(text, x["b"] + 1, F.lit(1)))
        piece = F.concat(before, F.substring(text, x["a"] + 1, x["b"] - x["a"]), after).cast("string")
        return F.regexp_count(piece, F.lit(f"(?<={space}){WORD}(?={space})"))

    counts = F.filter(F.transform(spans, count), lambda n: n > over)
    return F.aggregate(counts, F.lit(0), lambda done, n: done + n)


def remove_repeats(docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All of `docs` with `spans` (array of removed byte ranges, empty if none) and `kept` (the remaining bytes)."""
    return _removed(hashed(docs, "spans", "kept"), repeats(docs, length, shard_bytes)).drop(HASH_COLUMN)


def _removed(texts: DataFrame, found: DataFrame) -> DataFrame:
    kept = without(utf8("text"), F.col("spans"))
    joined = beside(texts, found, "left").withColumn("kept", kept)
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def remove_and_count(
    docs: DataFrame, length: int = 400, words: int = 50, size: int = 200, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """As `remove_repeats`, with `n_passage_words`: the words in passages of over `words` words that another document holds too.

    Such a passage may have fewer bytes than `length`, and then stays. Strings of `size` bytes are searched for first; passages
    of fewer bytes lie in stretches of very short words, and there strings of one byte a word and one between each two are
    searched for as well, so that none is missed. Whole words in a range that the strings found in other documents cover are
    counted if there are more than `words`.
    """
    least = 2 * words + 1
    if not least <= size < length:
        raise ValueError(f"passages are searched for by {least} bytes at least, fewer than the {length} removed")
    texts = hashed(docs, "spans", "kept", "n_passage_words")
    short = stored(repeats(docs, size, shard_bytes, F.xxhash64("doc_id", HASH_COLUMN)), "short")
    tight = stored(_dense(docs, words, size), "dense")
    holder = F.xxhash64("doc_id.doc_id", f"doc_id.{HASH_COLUMN}")
    tiny = _placed(repeats(tight, least, shard_bytes, holder), "shared")
    parts = [_inside(docs, short, length, shard_bytes), short.drop("spans"), tiny]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    spans, shared = (F.sort_array(F.flatten(F.collect_list(c))) for c in ("spans", "shared"))
    found = both.groupBy("doc_id", HASH_COLUMN).agg(spans.alias("spans"), shared.alias("shared"))
    n = F.coalesce(_words(utf8("text"), merged(F.col("shared")), words), F.lit(0)).cast("long")
    return _removed(texts, found).withColumn("n_passage_words", n).drop("shared", HASH_COLUMN)
