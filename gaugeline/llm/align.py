"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark's word n-grams are counted over all documents. Each item keeps the rarer part of its own n-grams as seeds
(by its own ranking, so that an item copied into a third of the corpus still has seeds). A document that holds a seed is
aligned with the item, word by word, around the places that the seeds point to; the best local alignment, as a share of
the item's perfect score, finds edited and paraphrased copies as well as exact ones.

Test items are taken in blocks of a bounded number of words; a block travels to the tasks as a broadcast of proven
size, and every document meets every block, so nothing is shuffled but a count per n-gram. Documents are read twice (to
count, to align) and never grouped, so copies, hot sources and common passages cannot pile up anywhere.

An item of fewer words than a seed has no n-gram; its whole word sequence is its seed, so it is found where it stands
exactly. In scripts without spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) every character is a word.

Defined results: null and empty texts hold no item; items without a word, and null ones, are never found; repeated rows
and items are each answered; null ids are returned; empty tables give empty answers; other columns pass through. Case,
ASCII punctuation and CJK punctuation do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gaugeline.llm.common import RollingHash, lean, mix, own

SEED_WORDS = 4
#: Share of an item's n-grams, the rarest first, that serve as seeds.
SEED_SHARE = 0.75
#: Words of test items in a block.
BLOCK_WORDS = 500_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least share of the perfect score of an item that counts as a copy.
LEAST = 0.5

HASH = RollingHash(0xD6E8FEB86659FD93)
#: Letters, digits and bytes beyond ASCII stay; what else there is separates words.
_PLAIN = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, int]]]:
    """The bytes with CJK punctuation as spaces, and where characters of scripts without spaces begin, by size."""
    found = []
    if data.max() < 0xE0:
        return data, found
    second = np.r_[data[1:], np.uint8(32)]
    thai_lao = (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    burmese_khmer = (data == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    marks = np.flatnonzero((data == 0xE3) & (second == 0x80))
    three = np.flatnonzero(((data >= 0xE3) & (data <= 0xE9)) | thai_lao | burmese_khmer)
    four = np.flatnonzero((data == 0xF0) & (second >= 0xA0) & (second <= 0xB3))
    three = three[~np.isin(three, marks)]
    if len(marks):
        data = data.copy()
        for k in range(3):
            data[marks + k] = 32
    return data, [(three, 3), (four, 4)]


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of the texts in order, and how many words each text has."""
    data = np.frombuffer(b" ".join(texts).translate(_PLAIN) + b" ", np.uint8)
    data, alone = _unspaced(data)
    inside = np.r_[False, data != 32]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    for at, size in alone:  # a word of its own: one ends before it and may begin behind it
        begins[at] = True
        ends[at] |= inside[at]
        ends[at + size] = True
        begins[at + size] |= data[at + size] != 32
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    prefix = HASH.prefix(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return HASH.ranges(prefix, start, end), np.diff(np.searchsorted(start, ends), prepend=0)


def grams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row, and the place of the first word; none reaches into the next text."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(hashes) - n + 1
    found = np.zeros(size, np.uint64)
    for i in range(n):
        found = found * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + size]
    left = np.repeat(np.cumsum(counts), counts)[:size] - np.arange(size)
    at = np.flatnonzero(left >= n)
    return mix(found[at]), at


@dataclass
class Block:
    """Test items with their words; `seed` (sorted) with `item` and `place` says where each n-gram stands."""

    ids: list
    words: list[np.ndarray]
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray
    sizes: tuple[int, ...]  # words of its seeds

    def grams(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all that may be a seed, and the place of the first word."""
        found, at = zip(*[grams(hashes, counts, n) for n in self.sizes], strict=True)
        return np.concatenate(found), np.concatenate(at)

    def finder(self) -> np.ndarray:
        table = np.zeros(1 << 22, bool)
        table[self.seed >> np.uint64(42)] = True
        return table

    def hits(self, table: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the found n-grams are seeds, and the first seed equal to each."""
        likely = np.flatnonzero(table[found >> np.uint64(42)])
        first = np.searchsorted(self.seed, found[likely])
        real = self.seed[first.clip(max=len(self.seed) - 1)] == found[likely] if len(self.seed) else first < 0
        return likely[real], first[real]


def block_of(rows: list[tuple], n: int) -> Block:
    hashes, counts = words([text for _, text in rows])
    seed, at = grams(hashes, counts, n)
    begins = np.cumsum(counts) - counts
    sizes = [n]
    for short in sorted({int(c) for c in counts if 0 < c < n}):
        more, whole = grams(hashes, counts, short)
        whole_item = np.isin(whole, begins[counts == short])
        seed, at = np.r_[seed, more[whole_item]], np.r_[at, whole[whole_item]]
        sizes.append(short)
    item = np.searchsorted(begins, at, "right") - 1
    # An item without words begins where the next one does; the right one is the last that begins there.
    order = np.argsort(seed, kind="stable")
    parts = [hashes[b : b + c] for b, c in zip(begins, counts, strict=True)]
    return Block([i for i, _ in rows], parts, seed[order], item[order], (at - begins[item])[order], tuple(sizes))


def blocks(benchmark: DataFrame, n: int, most_words: int) -> Iterator[Block]:
    chosen = own(benchmark, "item_id", "text").filter("text is not null")
    rows, held = [], 0
    for item, text in chosen.select("item_id", F.lower("text")).orderBy("item_id", "text").toLocalIterator():
        rows.append((item, text.encode()))
        held += text.count(" ") + 1 + sum(c >= "\u0e00" for c in text)
        if held >= most_words:
            yield block_of(rows, n)
            rows, held = [], 0
    if rows:
        yield block_of(rows, n)


def _texts(array: pa.Array, size: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    rows, texts, held = [], [], 0
    for i in range(len(array)):
        text = array[i].as_py()
        if text:
            rows.append(i)
            texts.append(text)
            held += len(text)
            if held >= size:
                yield rows, texts
                rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def rarest(docs: DataFrame, block: Block, n: int, share: float) -> Block:
    """The block with only the n-grams as seeds that are rare over all documents, by each item's own ranking."""
    chosen = own(docs, "text").select(F.lower("text").cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table, total = known.finder(), np.zeros(len(known.seed), np.int64)
        for batch in batches:
            for _, texts in _texts(batch.column("text")):
                hashes, counts = words(texts)
                found, at = known.grams(hashes, counts)
                hit, first = known.hits(table, found)
                doc = np.searchsorted(np.cumsum(counts), at[hit], "right")
                once = np.unique(doc.astype(np.int64) << 32 | first)  # a document counts once for an n-gram
                total += np.bincount(once & 0xFFFFFFFF, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["seed", "docs"])

    counted = chosen.mapInArrow(lean(count), "seed long, docs long").groupBy("seed").agg(F.sum("docs").alias("docs"))
    frequency = np.zeros(len(block.seed), np.int64)
    for row in counted.collect():  # a row per n-gram of the block at most
        frequency[row["seed"]] = row["docs"]
    same = np.searchsorted(block.seed, block.seed)  # counts stand at the first of equal n-grams
    frequency = frequency[same]
    order = np.lexsort((block.place, frequency, block.item))
    item = block.item[order]
    begins = np.searchsorted(item, item)
    rank, size = np.arange(len(item)) - begins, np.searchsorted(item, item, "right") - begins
    # Seeds: the rarer share, and whatever is as rare as the rarest, so that an item never loses all.
    kept = (rank < np.ceil(share * size)) | (frequency[order] == frequency[order][begins])
    kept = np.sort(order[kept])
    return Block(block.ids, block.words, block.seed[kept], block.item[kept], block.place[kept], block.sizes)


def smith_waterman(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each passage with its item, and the passage's word after the alignment; all pairs at once."""
    p, longest = len(passages), max(len(x) for x in passages)
    width = max(len(x) for x in items)
    a, b = np.zeros((p, longest), np.uint64), np.zeros((p, width), np.uint64)
    a_used, b_used = np.zeros((p, longest), bool), np.zeros((p, width), bool)
    for i, (x, y) in enumerate(zip(passages, items, strict=True)):
        a[i, : len(x)], a_used[i, : len(x)] = x, True
        b[i, : len(y)], b_used[i, : len(y)] = y, True
    row = np.zeros((p, width + 1), np.int32)
    climb = -GAP * np.arange(width + 1, dtype=np.int32)
    best, where = np.zeros(p, np.int32), np.zeros(p, np.int64)
    for j in range(longest):
        equal = (a[:, j, None] == b) & b_used & a_used[:, j, None]
        new = np.maximum(row + GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + np.where(equal, MATCH, MISMATCH))
        # A gap along the item: the best start to the left, less a step for each word passed.
        row = (np.maximum.accumulate(new + climb, axis=1) - climb).astype(np.int32)
        top = row.max(axis=1)
        better = top > best
        best[better], where[better] = top[better], j + 1
    return best, where


def _passages(place: np.ndarray, item_place: np.ndarray, size: int, n_words: int) -> list[tuple[int, int]]:
    """Stretches of a document in which an item may lie, given places of seeds there and in the item.

    Seeds that follow each other closely share a stretch; a long one is cut into pieces that overlap so far that what
    belongs to any seed, `size + 3 * slack` words, lies whole in one of them.
    """
    slack = size // 4 + 2
    begins = np.sort((place - item_place).clip(min=0))
    edges = np.flatnonzero(np.diff(begins) > slack)
    firsts, lasts = begins[np.r_[0, edges + 1]], begins[np.r_[edges, len(begins) - 1]]
    reach, found = size + 3 * slack, []
    for first, last in zip(firsts.tolist(), lasts.tolist(), strict=True):
        at, end = first - slack, last + size + 2 * slack
        while end - at > 2 * reach:
            found.append((max(0, at), min(n_words, at + 2 * reach)))
            at += reach
        found.append((max(0, at), min(n_words, end)))
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, n: int = SEED_WORDS, share: float = SEED_SHARE,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with `leaks`: an array of (item_id, similarity, end_word) for each test item that a text holds a copy of."""
    kind = f"array<struct<item_id:{benchmark.schema['item_id'].dataType.simpleString()},similarity:double,end_word:bigint>>"
    found, names = docs, []
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    for number, block in enumerate(blocks(benchmark, n, block_words)):
        shared = docs.sparkSession.sparkContext.broadcast(rarest(docs, block, n, share))
        name = f"_llm_leaks{number}"
        # Not to be computed again for each use of the result, as the optimizer may do with a deterministic function.
        align = F.arrow_udf(lean(_aligner(shared, n, least, item_type)), kind).asNondeterministic()
        found = found.withColumn(name, align(F.lower("text").cast("binary")))
        names.append(name)
    together = F.concat(*names) if names else F.array().cast(kind)
    return found.withColumn("leaks", F.coalesce(together, F.array().cast(kind))).drop(*names)


def _aligner(shared, n: int, least: float, item_type: pa.DataType):
    def align(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = shared.value
        table = block.finder()
        for array in arrays:
            rows, items, scores, ends = [], [], [], []
            for own_rows, texts in _texts(array):
                hashes, counts = words(texts)
                begins = np.cumsum(counts) - counts
                found, at = block.grams(hashes, counts)
                hit, first = block.hits(table, found)
                last = np.searchsorted(block.seed, found[hit], "right")
                # Every seed equal to a found n-gram: one for each item and place that has it.
                times = last - first
                seeds = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                place = np.repeat(at[hit], times)
                doc = np.searchsorted(np.cumsum(counts), place, "right")
                order = np.lexsort((block.item[seeds], doc))
                doc, place, seeds = doc[order], place[order], seeds[order]
                if not len(doc):
                    continue
                edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (np.diff(block.item[seeds]) != 0)])
                todo = []
                best: dict[tuple[int, int], tuple[float, int]] = {}
                for a, b in zip(edges, [*edges[1:], len(doc)], strict=True):
                    d, item = int(doc[a]), int(block.item[seeds[a]])
                    inner = place[a:b] - begins[d]
                    if len(block.words[item]) < n:  # its seed is the whole of it
                        best[d, item] = 1.0, int(inner.max()) + len(block.words[item])
                        continue
                    for x, y in _passages(inner, block.place[seeds[a:b]], len(block.words[item]), int(counts[d])):
                        todo.append((d, item, x, hashes[begins[d] + x : begins[d] + y]))
                todo.sort(key=lambda t: len(block.words[t[1]]))  # pairs of like size together
                for c in range(0, len(todo), 64):
                    part = todo[c : c + 64]
                    score, end = smith_waterman([t[3] for t in part], [block.words[t[1]] for t in part])
                    for (d, item, x, _), s, e in zip(part, score.tolist(), end.tolist(), strict=True):
                        similarity = s / (MATCH * len(block.words[item]))
                        if similarity >= least:
                            best[d, item] = max(best.get((d, item), (0.0, 0)), (similarity, x + e))
                for (d, item), (similarity, e) in sorted(best.items()):
                    rows.append(own_rows[d])
                    items.append(block.ids[item])
                    scores.append(similarity)
                    ends.append(e)
            offsets = np.searchsorted(np.array(rows, np.int64), np.arange(len(array) + 1)).astype(np.int32)
            fields = [pa.array(items, item_type), pa.array(scores, pa.float64()), pa.array(ends, pa.int64())]
            inner = pa.StructArray.from_arrays(fields, ["item_id", "similarity", "end_word"])
            yield pa.ListArray.from_arrays(pa.array(offsets), inner)

    align.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return align
