"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over fixed-length windows, each filter keeps its maximum over the
window, and a softmax over the maxima gives the languages' probabilities. A text's answer is the mean over all of its
windows, weighted by their bytes. The network is trained in numpy on the driver, on a bounded sample of labelled
windows (`per_language` windows of every language, fewer where there are so many languages that they would exceed `MOST_WINDOWS`;
a text that occurs often counts once), and is a few thousand numbers. To apply it, embedding and filters are multiplied out into two tables over byte pairs, so that a
filter's value at a place is the sum of two rows.

Defined results: a null text or one without a letter is `und` with score 0, as is every text if nothing is labelled; a
null doc_id is not held out and is not learned from; repeated rows are judged each; windows cover whole texts of any
length; an empty table gives an empty result; input columns `lang_pred` and `score` are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import lean, own, utf8

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDED = 8
PER_LANGUAGE = 1500
MOST_WINDOWS = 300_000
LEAST_WINDOWS = 8
EPOCHS = 6
#: Windows computed at a time.
BLOCK = 128


@dataclass
class Network:
    languages: list[str]
    first: np.ndarray  # what a pair of bytes adds to each filter as its first two bytes
    second: np.ndarray  # and as its last two
    weight: np.ndarray
    bias: np.ndarray
    by_byte: np.ndarray | None = None  # what a byte adds at each of the four places, from which the pairs are made

    def __reduce__(self):
        """A task is sent the small table, if that is known, and multiplies the large ones out itself."""
        if self.by_byte is None:
            return Network, (self.languages, self.first, self.second, self.weight, self.bias)
        return _made, (self.languages, self.by_byte, self.weight, self.bias)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        out = np.empty((len(windows), len(self.languages)))
        for at in range(0, len(windows), BLOCK):
            part = pairs[at : at + BLOCK]
            value = self.first[part[:, :-2]]
            value += self.second[part[:, 2:]]
            top = np.maximum(value.max(axis=1), 0)
            out[at : at + BLOCK] = _softmax(top @ self.weight + self.bias)
        return out

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The index of each text's likeliest language and its probability."""
        windows, sizes = zip(*[_windows(text) for text in texts], strict=True)
        counts = np.array([len(w) for w in windows])
        weighted = self.probabilities(np.concatenate(windows)) * np.concatenate(sizes)[:, None]
        total = np.add.reduceat(weighted, np.cumsum(counts) - counts)
        total /= total.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        return best, total[np.arange(len(best)), best].clip(0, 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's windows, filled up with zeros, and the bytes that are new in each; no filter's place is left out."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(text) - WINDOW + step) // step))
    data = np.zeros((n - 1) * step + WINDOW, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    size = np.full(n, float(step))
    size[-1] = max(1, len(text) - (n - 1) * step)
    return np.lib.stride_tricks.sliding_window_view(data, WINDOW)[::step], size


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Gradient descent (Adam) on cross-entropy; a third of the windows are cut short, so that short texts are known."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    data = np.zeros((len(texts), WINDOW), np.uint8)
    for row, text in zip(data, texts, strict=True):
        size = min(len(text), WINDOW)
        if rng.random() < 1 / 3:
            size = min(size, int(rng.integers(16, WINDOW)))
        row[:size] = np.frombuffer(text[:size], np.uint8)
    widest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    wide = np.repeat(WIDTHS, FILTERS)
    used = (np.arange(widest)[:, None] < wide[None, :])[:, None, :]  # a narrow filter is a wide one with zeros behind
    weights = {
        "embed": rng.normal(0, 0.5, (256, EMBEDDED)),
        "filter": rng.normal(0, 0.4, (widest, EMBEDDED, filters)) * used,
        "dense": rng.normal(0, 0.2, (filters, len(languages))),
        "bias": np.zeros(len(languages)),
    }
    moments = {name: (np.zeros_like(w), np.zeros_like(w)) for name, w in weights.items()}
    places, step = WINDOW - widest + 1, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            x = data[chosen]
            embedded = weights["embed"][x]
            value = sum(embedded[:, i : i + places] @ weights["filter"][i] for i in range(widest))
            where = value.argmax(axis=1)
            top = np.take_along_axis(value, where[:, None], axis=1)[:, 0]
            active = np.maximum(top, 0)
            delta = _softmax(active @ weights["dense"] + weights["bias"])
            delta[np.arange(len(chosen)), target[chosen]] -= 1
            delta /= len(chosen)
            back = (delta @ weights["dense"].T) * (top > 0)
            grad = {"dense": active.T @ delta, "bias": delta.sum(axis=0)}
            grad["embed"], grad["filter"] = np.zeros_like(weights["embed"]), np.zeros_like(weights["filter"])
            rows = np.arange(len(chosen))[:, None]
            for i in range(widest):  # only the places of the maxima pass a gradient on
                grad["filter"][i] = np.einsum("nfe,nf->ef", embedded[rows, where + i], back)
                np.add.at(grad["embed"], x[rows, where + i], back[:, :, None] * weights["filter"][i].T[None])
            grad["filter"] *= used
            step += 1
            for name, g in grad.items():
                mean, square = moments[name]
                mean += 0.1 * (g - mean)
                square += 0.001 * (g * g - square)
                size = 0.01 / (1 + step / 400)
                weights[name] -= size * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    by_byte = byte_table(weights["embed"], weights["filter"])
    return _made(languages, by_byte, weights["dense"].astype(np.float32), weights["bias"].astype(np.float32))


def _made(languages: list[str], by_byte: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> Network:
    return Network(languages, *_of_pairs(by_byte), weight, bias, by_byte)


def byte_table(embed: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """What a byte adds to each filter (four places, embedding, filter) at each place."""
    return np.einsum("be,kef->kbf", embed, filters)


def _of_pairs(by_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, second = (np.empty((256, *by_byte.shape[1:]), np.float32) for _ in range(2))
    for table, i in ((first, 0), (second, 2)):
        for row, byte in zip(table, by_byte[i], strict=True):
            row[:] = byte + by_byte[i + 1]
    return first.reshape(65536, -1), second.reshape(65536, -1)


def pair_tables(embed: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a pair of bytes adds to each filter as its first two and as its last two."""
    return _of_pairs(byte_table(embed, filters))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def readable(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network from a bounded sample of the labelled documents that are not held out; None if there are none."""
    known = own(docs, "doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(~held_out() & readable())
    low = utf8("_low")
    hashed = known.withColumn("_low", F.lower("text")).withColumn("_hash", F.xxhash64("_low"))
    texts_of = hashed.select("lang", "_hash").distinct().groupBy("lang").agg(F.count("*").alias("texts"))
    counts = texts_of.collect()  # a row per language
    if not counts:
        return None
    per_language = min(per_language, max(LEAST_WINDOWS, MOST_WINDOWS // len(counts)))
    # A text is drawn by its hash, with twice the chance needed among the different texts of its language, and gives a
    # window from a place drawn likewise.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2 * per_language / r["texts"]))])
    drawn = hashed.filter(F.pmod("_hash", F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    place = F.pmod(F.xxhash64("_hash"), F.greatest(F.length(low) - WINDOW + 1, F.lit(1))).cast("int")
    windows = drawn.select("lang", "_hash", F.substring(low, place + 1, F.lit(WINDOW)).alias("window"))
    windows = windows.dropDuplicates(["lang", "_hash"]).orderBy("_hash", "lang")
    rows = windows.limit(4 * per_language * len(counts)).collect()
    texts, labels, taken = [], [], dict.fromkeys((r["lang"] for r in counts), 0)
    for row in rows:
        if taken[row["lang"]] < per_language:
            taken[row["lang"]] += 1
            texts.append(bytes(row["window"]))
            labels.append(row["lang"])
    return train(texts, labels) if texts else None


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """`docs` with `lang_pred` and `score`."""
    if network is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    names = np.array(network.languages, object)

    @F.arrow_udf("struct<lang:string,score:double>")
    @lean
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lang, score = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            rows, texts, held = [], [], 0
            for i in range(len(batch)):
                text = batch[i].as_py()
                if text is not None:
                    rows.append(i)
                    texts.append(text)
                    held += len(text)
                if texts and (held >= 1 << 20 or i == len(batch) - 1):
                    best, sure = network.judge(texts)
                    lang[rows], score[rows] = names[best], sure
                    rows, texts, held = [], [], 0
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang", "score"])

    text = F.when(readable(), F.lower("text").cast("binary"))
    found = docs.withColumn("_llm_found", judged(text))
    return found.withColumns({"lang_pred": F.col("_llm_found.lang"), "score": F.col("_llm_found.score")}).drop("_llm_found")
