"""Packing token sequences by the sum-of-squares rule.

Each task packs the documents of its partition as they come. A document's ids are cut into full windows and a rest; the
rest goes to the fill level (a new window counts as level 0) that leaves the least sum of squared numbers of partially
filled windows per level, which steers towards levels that rests fit exactly. The level array holds that number for
each level, so a choice costs one pass over it, however many windows are open.

When the partition ends, or more than `most_open` windows are open, the open ones are closed without waste: the
emptiest are cut to fill the fullest, and what is left of the last is cut into lengths that are powers of two, which
need no padding. So a task's memory is bounded by the open windows, and no row waits for another partition. Ids come
from the vocabulary of a byte-level BPE file of the `tokenizers` library, encoded by `tiktoken`, which gives the same ids
several times faster; the file is read once on the driver and travels with the task.

Defined results: null and empty texts are one end id; repeated rows are packed each; null ids are returned; an empty
table gives an empty result; other columns are ignored. Strings of the file's added tokens are ordinary text, or with
`added` get the added token's id, as the unchanged tokenizer has it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import lean, own, rows_of

WINDOW = 1024
END_ID = 0
MOST_OPEN = 4096
#: Pieces handed on at a time, of up to a window's ids each.
BATCH = 512

#: Fixed value: how byte-level BPE splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Fixed value: the characters that count as white space there.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: From so many on, a run of white space is too much for the splitting pattern, which goes back over it step by step.
LONG_RUN = 10_000
_RUNS = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def read_added(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file and their ids."""
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file).get("added_tokens", [])}


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE file; its letters stand for bytes, the unprintable ones moved up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}
    with open(path, encoding="utf-8") as file:
        known = json.load(file)
    special = {token["content"] for token in known.get("added_tokens", [])}
    vocabulary = known["model"]["vocab"]
    return {bytes(byte_of[c] for c in word): i for word, i in vocabulary.items() if word not in special}


@lru_cache(maxsize=2)
def _encoder(ranks: tuple, special: tuple) -> tiktoken.Encoding:
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=dict(ranks), special_tokens=dict(special))


def token_ids(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text. Long runs of white space are cut out first, as the pattern would cut them.

    A run is a piece of its own, but for its last character, which the pattern leaves to what follows; where the text or an added
    token ends the run, it is a piece as a whole.
    """
    parts, at = [], 0
    if len(text) >= LONG_RUN:
        special = tuple(encoder.special_tokens_set)
        for run in _RUNS.finditer(text):
            begin, end = run.span()
            if end < len(text) and not text.startswith(special, end):
                end -= 1
            parts.append(encoder.encode_to_numpy(text[at:begin], allowed_special="all"))
            parts.append(np.array(encoder._encode_single_piece(text[begin:end]), np.uint32))
            at = end
    parts.append(encoder.encode_to_numpy(text[at:] if at else text, allowed_special="all"))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


class Packer:
    """Windows filled online; `done` holds the pieces of closed windows: (doc, start, ids, doc tokens, window, offset)."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0
        self.next_window = 0
        self.done: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self._close([(doc, at, ids[at : at + self.window], len(ids))])
        if whole < len(ids):
            rest = ids[whole:].copy() if whole else ids  # an open window does not hold the whole document
            self._place((doc, whole, rest, len(ids)))

    def _place(self, piece: tuple) -> None:
        size = len(piece[2])
        fit = self.level[: self.window - size + 1]
        # Growth of the sum of squares if a window of level h takes the piece: it leaves h and enters h + size.
        growth = 2 * self.level[size : self.window + 1] + 1
        growth[-1] = 0  # a full window is in no level
        growth[1:] += 1 - 2 * fit[1:]
        growth[1:][fit[1:] == 0] = np.iinfo(np.int64).max
        chosen = len(growth) - 1 - int(np.argmin(growth[::-1]))  # of equals the fullest
        pieces = []
        if chosen:
            pieces = self.open[chosen].pop()
            self.level[chosen] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if chosen + size == self.window:
            self._close(pieces)
        else:
            self.open[chosen + size].append(pieces)
            self.level[chosen + size] += 1
            self.n_open += 1
            if self.n_open > self.most_open:
                self.close_all()

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, ids, total, self.next_window, offset))
            offset += len(ids)
        self.next_window += 1

    def close_all(self) -> None:
        """Close the open windows without padding: fill the fullest from the emptiest."""
        waiting = [pieces for level in reversed(range(self.window)) for pieces in self.open[level]]
        self.open = [[] for _ in range(self.window)]
        self.level[:] = 0
        self.n_open = 0
        front = 0
        while front < len(waiting):
            pieces = waiting[front]
            room = self.window - sum(len(p[2]) for p in pieces)
            while room and len(waiting) > front + 1:
                doc, start, ids, total = waiting[-1].pop()
                taken = ids[:room]
                pieces.append((doc, start, taken, total))
                if len(taken) < len(ids):
                    waiting[-1].append((doc, start + len(taken), ids[len(taken) :], total))
                elif not waiting[-1]:
                    waiting.pop()
                room -= len(taken)
            if room:
                break
            self._close(pieces)
            front += 1
        for pieces in waiting[front:]:
            self._close_powers(pieces)

    def _close_powers(self, pieces: list[tuple]) -> None:
        left = sum(len(p[2]) for p in pieces)
        pieces = pieces[::-1]
        while left:
            size = room = 1 << (left.bit_length() - 1)
            part = []
            while room:
                doc, start, ids, total = pieces.pop()
                part.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:], total))
                room -= len(part[-1][2])
            self._close(part)
            left -= size


_FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, most_open: int = MOST_OPEN, added: bool = False) -> DataFrame:
    """One row per piece of a document's ids: where it starts, its length and ids, and its sequence and offset there."""
    chosen = own(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranks, special = tuple(read_ranks(tokenizer).items()), tuple(read_added(tokenizer).items()) if added else ()
    names = [*_FIELDS[:2], "ids", *_FIELDS[3:]]
    kinds = {name: T.LongType() for name in names} | {"ids": T.BinaryType()}
    schema = T.StructType([chosen.schema["doc_id"], *[T.StructField(name, kinds[name]) for name in names]])

    def rows(done: list[tuple], base: int, kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array([p[0] for p in done], kind)]
        columns += [pa.array([p[1] for p in done], pa.int64()), pa.array([len(p[2]) for p in done], pa.int64())]
        columns += [pa.array([p[2].astype("<u4").tobytes() for p in done], pa.binary())]
        columns += [pa.array([p[3] for p in done], pa.int64())]
        columns += [pa.array([base + p[4] for p in done], pa.int64()), pa.array([p[5] for p in done], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    def handed_on(packer: Packer, base: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        done, packer.done = packer.done, []
        for at in range(0, len(done), BATCH):
            yield rows(done[at : at + BATCH], base, kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, kind = _encoder(ranks, special), Packer(window, most_open), None
        base = TaskContext.get().partitionId() << 33  # sequences of different partitions have different numbers
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc, text in zip(rows_of(batch, "doc_id"), rows_of(batch, "text"), strict=True):
                packer.add(doc, np.append(token_ids(encoder, text), np.uint32(END_ID)))
                if len(packer.done) >= BATCH:
                    yield from handed_on(packer, base, kind)
        packer.close_all()
        yield from handed_on(packer, base, kind)

    return chosen.mapInArrow(lean(work), schema)


def checksum(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), *_FIELDS[3:])
