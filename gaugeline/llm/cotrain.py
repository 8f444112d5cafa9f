"""Quality classification by co-training.

Two logistic classifiers see different views of a document: one its text (shares of bytes and byte pairs), one its
metadata (source, language, length). In each round both are fitted, and each hands unlabelled documents of which it is
sure to the other as labelled ones; what a view cannot tell it therefore learns from the other view. At last both are
calibrated on labelled documents kept aside, and their log-odds are added, less the prior that both hold.

Fitting takes at most `labelled` labelled documents, drawn by a hash of their id (features of 2 KB each, computed in the
tasks, go to the driver). Pseudo-labels come from all other documents: every round is a Spark pass without a shuffle of
texts, in which each task keeps, for each view, class and group of metadata (source and language, by hash), the few
documents that the view is surest of, each text once; a small shuffle then picks `quota` of each over all tasks. Their
number is bounded by the groups and not by the corpus, so that a rare source gets its pseudo-labels however large
the corpus is. Scoring covers every document with its whole text in one pass without a shuffle.

Defined results: null text and null metadata are values of their own; documents listed twice are scored each, and handed
on once; a document labelled twice counts with its best label; one with a label that was not drawn counts as unlabelled;
null ids are scored but not learned from; without labels all scores are one half; an empty table gives an empty result;
other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import own

LABELLED = 4000
ROUNDS = 4
#: A view hands on what it holds for at least so sure, in a round so many of each class and group of metadata.
SURE = 0.95
QUOTA = 4
GROUPS = 128

PAIRS = 384
TEXT_SIZE = 129 + PAIRS
META_SIZE = 64 + 32 + 16
_COLUMNS = ("text", "source", "lang", "n_chars")


def text_view(text: bytes | None) -> np.ndarray:
    """Roots of the shares of ASCII bytes, of all other bytes together, and of hashed byte pairs."""
    out = np.zeros(TEXT_SIZE, np.float32)
    data = np.frombuffer(text or b"", np.uint8)
    if len(data):
        out[:129] = np.bincount(np.minimum(data, 128), minlength=129)[:129] / len(data)
        pair = (data[:-1].astype(np.uint32) << 8 | data[1:]) * np.uint32(2654435761) >> np.uint32(8)
        out[129:] = np.bincount(pair % PAIRS, minlength=PAIRS) / len(data)
    return np.sqrt(out)


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed source and language, and the length by powers of two."""
    out = np.zeros(META_SIZE, np.float32)
    for at, size, value in ((0, 64, source), (64, 32, lang)):
        out[at + zlib.crc32(repr(value).encode()) % size] = 1
    out[96 + (0 if n_chars is None else min(15, 1 + max(0, int(n_chars)).bit_length() // 2))] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, seed: int = 3, steps: int = 1000, shrink: float = 1e-4) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression, by so many steps of Adam over small batches."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(x.shape[1] + 1)
    mean, square, step = np.zeros_like(weights), np.zeros_like(weights), 0
    while step < steps:
        order = rng.permutation(len(x))
        for at in range(0, len(order), 128):
            part = order[at : at + 128]
            error = _sigmoid(x[part] @ weights[:-1] + weights[-1]) - y[part]
            grad = np.r_[x[part].T @ error / len(part) + shrink * weights[:-1], error.mean()]
            step += 1
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights


@dataclass
class Model:
    """Each view's weights and its calibration (slope and offset of the log-odds), and the prior log-odds."""

    text: np.ndarray
    meta: np.ndarray
    calibration: tuple[np.ndarray, np.ndarray]
    prior: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Columns: calibrated text score, metadata score, and both together."""
        odds = [
            (x @ w[:-1] + w[-1]) * c[0] + c[1]
            for x, w, c in ((text, self.text, self.calibration[0]), (meta, self.meta, self.calibration[1]))
        ]
        return _sigmoid(np.stack([*odds, odds[0] + odds[1] - self.prior], axis=1))


@dataclass
class Handed:
    """Documents that the views are sure of: their keys, both views, and a slot for the view, class and group."""

    key: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    text: np.ndarray = field(default_factory=lambda: np.zeros((0, TEXT_SIZE), np.float32))
    meta: np.ndarray = field(default_factory=lambda: np.zeros((0, META_SIZE), np.float32))
    slot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sure: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def at(self, rows: np.ndarray) -> Handed:
        return Handed(self.key[rows], self.text[rows], self.meta[rows], self.slot[rows], self.sure[rows])

    def with_rows(self, other: Handed) -> Handed:
        pairs = zip(vars(self).values(), vars(other).values(), strict=True)
        return Handed(*[np.concatenate(pair) for pair in pairs])

    def view(self) -> np.ndarray:
        """The view that is sure: 0 the text, 1 the metadata."""
        return self.slot // (2 * GROUPS)

    def label(self) -> np.ndarray:
        return (self.slot // GROUPS % 2).astype(float)

    def surest(self, quota: int) -> Handed:
        """The `quota` surest documents of each slot, every key once in a slot; of equally sure ones those with lesser keys."""
        order = np.lexsort((self.key, -self.sure, self.slot))
        slot, key = self.slot[order], self.key[order]
        new = np.r_[True, (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])] if len(order) else np.zeros(0, bool)
        order, slot = order[new], slot[new]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        return self.at(order[rank < quota])


Weights = list[np.ndarray]


def _calibrated(x: np.ndarray, label: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Slope and offset that turn a view's log-odds into chances, never against the view."""
    odds = (x @ weights[:-1] + weights[-1])[:, None]
    scale = max(1e-6, float(np.abs(odds).max()))
    slope, offset = logistic(odds / scale, label, steps=2000)
    return np.array([max(0.0, slope) / scale, offset])


def sure_of(key: np.ndarray, text: np.ndarray, meta: np.ndarray, group: np.ndarray, weights: Weights, taken: list[np.ndarray],
            quota: int) -> Handed:
    """Of some documents those that a view is sure of and has not handed on yet, at most `quota` of a class and group."""
    found = Handed()
    for view, (x, w) in enumerate(zip((text, meta), weights, strict=True)):
        chance = _sigmoid(x @ w[:-1] + w[-1])
        sure = np.maximum(chance, 1 - chance)
        rows = np.flatnonzero((sure >= SURE) & ~np.isin(key, taken[view]))
        slot = (2 * view + (chance[rows] >= 0.5)) * GROUPS + group[rows]
        found = found.with_rows(Handed(key[rows], text[rows], meta[rows], slot.astype(np.int64), sure[rows]))
    return found.surest(quota)


def cotrain(text: np.ndarray, meta: np.ndarray, label: np.ndarray, hand: Callable[[Weights, list[np.ndarray]], Handed],
            rounds: int = ROUNDS) -> Model:
    """Fit both views on the labelled rows and what they hand each other; every fifth labelled row calibrates.

    `hand(weights, taken)` finds what the views with these weights are sure of, without the keys each has handed on. Its
    weights are calibrated: a view that tells nothing is sure of nothing, whatever it has learnt by heart.
    """
    if not len(label):
        zero = np.zeros(2)
        return Model(np.zeros(TEXT_SIZE + 1), np.zeros(META_SIZE + 1), (zero, zero), 0.0)
    aside = np.arange(len(label)) % 5 == 4
    fit = ~aside if aside.any() else np.ones(len(label), bool)
    check = aside if aside.any() else fit
    given = Handed()
    for last in [False] * rounds + [True]:
        weights = []
        for view, x in enumerate((text, meta)):
            more = given.at(np.flatnonzero(given.view() != view))  # what the other view is sure of
            known = np.concatenate([x[fit], more.meta if view else more.text])
            weights.append(logistic(known, np.concatenate([label[fit], more.label()])))
        calibration = [_calibrated(x[check], label[check], w) for x, w in zip((text, meta), weights, strict=True)]
        if last:
            break
        sure = [np.r_[w[:-1] * slope, w[-1] * slope + offset] for w, (slope, offset) in zip(weights, calibration, strict=True)]
        handed = hand(sure, [given.key[given.view() == view] for view in (0, 1)])
        if not len(handed.key):
            break  # nobody is sure of anything new: another round would fit the same
        given = given.with_rows(handed)
    prior = np.log((label.sum() + 1) / (len(label) - label.sum() + 1))
    return Model(weights[0], weights[1], tuple(calibration), float(prior))


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """At most `most` of the rows, by a hash of doc_id."""
    count = rows.count()
    share = min(1.0, 1.2 * most / max(1, count))
    drawn = rows.withColumn("_order", F.xxhash64("doc_id"))
    return drawn.filter(F.pmod("_order", F.lit(1_000_000)) < share * 1_000_000).orderBy("_order", "doc_id").limit(most)


def _group(source: str | None, lang: str | None) -> int:
    return zlib.crc32(repr((source, lang)).encode()) % GROUPS


def _views(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    text = [text_view(r["text"]) for r in rows]
    meta = [meta_view(r["source"], r["lang"], r["n_chars"]) for r in rows]
    return np.array(text, np.float32).reshape(-1, TEXT_SIZE), np.array(meta, np.float32).reshape(-1, META_SIZE)


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in x], pa.binary())


def _unpacked(rows: list, name: str, size: int) -> np.ndarray:
    return np.array([np.frombuffer(r[name], np.float32) for r in rows], np.float32).reshape(-1, size)


def _slices(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, size) for batch in batches for at in range(0, batch.num_rows, size))


def _features(docs: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both views and the label of a bounded number of documents, on the driver."""

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            text, meta = _views(batch.to_pylist())
            yield pa.RecordBatch.from_arrays([_packed(text), _packed(meta), batch.column(label)], ["t", "m", label])

    rows = docs.mapInArrow(views, f"t binary, m binary, {label} double").collect()
    return _unpacked(rows, "t", TEXT_SIZE), _unpacked(rows, "m", META_SIZE), np.array([r[label] for r in rows], float)


_HANDED = "slot long, sure double, key long, t binary, m binary"


def _hand(docs: DataFrame, weights: Weights, taken: list[np.ndarray], quota: int) -> Handed:
    """What the views are sure of among all of `docs` (`key` and the columns of the views), by one pass over them."""

    def surest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Handed()
        for batch in _slices(batches):
            rows = batch.to_pylist()
            key = np.array([r["key"] for r in rows], np.int64)
            group = np.array([_group(r["source"], r["lang"]) for r in rows], np.int64)
            best = best.with_rows(sure_of(key, *_views(rows), group, weights, taken, quota)).surest(quota)
        columns = [pa.array(best.slot), pa.array(best.sure), pa.array(best.key), _packed(best.text), _packed(best.meta)]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "sure", "key", "t", "m"])

    found = docs.mapInArrow(surest, _HANDED).dropDuplicates(["slot", "key"])
    first = Window.partitionBy("slot").orderBy(F.desc("sure"), "key")  # at most `quota` rows of a task and slot
    rows = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= quota).collect()
    key, slot = (np.array([r[c] for r in rows], np.int64) for c in ("key", "slot"))
    handed = Handed(key, _unpacked(rows, "t", TEXT_SIZE), _unpacked(rows, "m", META_SIZE), slot, np.array([r["sure"] for r in rows], float))
    return handed.surest(quota)  # in an order of its own


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, quota: int = QUOTA,
        rounds: int = ROUNDS) -> Model:
    """A model from labels (`doc_id` and a 0/1 column) of some of the documents, and from all the others without."""
    known = own(labels, "doc_id", label).filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    cut = own(docs, "doc_id", *_COLUMNS).withColumn("text", F.col("text").cast("binary"))
    taught = F.broadcast(_sampled(known, labelled).select("doc_id", "label"))  # at most `labelled` rows of two numbers
    chosen = cut.join(taught, "doc_id").select("doc_id", *_COLUMNS, "label").orderBy(F.xxhash64("doc_id"), "doc_id", *_COLUMNS)
    text, meta, y = _features(chosen.limit(labelled).select(*_COLUMNS, "label"), "label")
    others = cut.filter("doc_id is not null").join(taught, "doc_id", "left_anti")
    others = others.select(F.xxhash64(*_COLUMNS).alias("key"), *_COLUMNS)  # copies are one document to learn from
    return cotrain(text, meta, y, lambda weights, taken: _hand(others, weights, taken, quota), rounds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `text_score`, `meta_score` and `score`, the calibrated chance of good quality."""

    @F.arrow_udf("struct<text_score:double,meta_score:double,score:double>")
    def judged(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for text, *meta in batches:
            out = [np.zeros((0, 3))]
            for at in range(0, len(text), 512):
                rows = range(at, min(at + 512, len(text)))
                views = np.stack([text_view(text[i].as_py()) for i in rows])
                others = np.stack([meta_view(*[column[i].as_py() for column in meta]) for i in rows])
                out.append(model.scores(views, others))
            scores = np.concatenate(out)
            yield pa.StructArray.from_arrays([pa.array(scores[:, k]) for k in range(3)], ["text_score", "meta_score", "score"])

    found = docs.withColumn("_llm_scores", judged(F.col("text").cast("binary"), "source", "lang", "n_chars"))
    names = ("text_score", "meta_score", "score")
    return found.withColumns({name: F.col(f"_llm_scores.{name}") for name in names}).drop("_llm_scores")
