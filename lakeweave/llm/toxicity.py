"""Toxicity by compression distance: windows are compressed with a dictionary of toxic and one of ordinary text.

A window is one lower-cased word between spaces, in a fixed frame that both dictionaries compress alike (without it
short windows would be stored raw). Its gain is its compressed length under the ordinary dictionary less that under the toxic
one. Windows that share no five bytes with the toxic dictionary cannot use it and have gain 0. A text's features are the
numbers of windows whose gain reaches each of a few thresholds; a logistic fitted on documents that the dictionaries have not
seen turns them into a probability.

Toxic documents are mostly ordinary text, so the toxic dictionary is trained on those of their windows that occur in clearly more
places there than in ordinary documents. A place is a word with both its neighbours: copies of one document count once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import _logistic, _newton
from .sampling import bounded, held_out
from .text import LOWER, RangeHash, mix, slices, word_bounds

#: The bounded sample to fit on: documents per label, of at most so many bytes each.
FIT_TOXIC, FIT_ORDINARY, FIT_BYTES = 3_000, 7_000, 1 << 16
TOXIC_BYTES, ORDINARY_BYTES = 8_192, 16_384
FRAME = b"0" * 24
THRESHOLDS = (2, 3, 4, 5, 6)
SHARED = 5
LEVEL = 6
CACHE = 200_000


def _compressor(body: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(compression_level=LEVEL, write_content_size=False, write_dict_id=False,
                                                   write_checksum=False)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(body))


def _grams(data: np.ndarray) -> np.ndarray:
    """A 20-bit hash of the ``SHARED`` bytes that begin at each position."""
    if len(data) < SHARED:
        return np.zeros(0, np.int64)
    value = np.zeros(len(data) - SHARED + 1, np.uint64)
    for k in range(SHARED):
        value = (value << np.uint64(8)) | data[k:len(data) - SHARED + 1 + k]
    return (mix(value) & np.uint64((1 << 20) - 1)).astype(np.int64)


class Distance:
    """Window gains under a pair of trained dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.known = np.zeros(1 << 20, bool)
        self.known[_grams(np.frombuffer(toxic, np.uint8))] = True
        self.cache: dict[bytes, int] = {}

    def gain(self, window: bytes) -> int:
        found = self.cache.get(window)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            framed = window + FRAME
            found = self.cache[window] = len(self.ordinary.compress(framed)) - len(self.toxic.compress(framed))
        return found

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text: windows with at least each threshold's gain, their sum of gains, and all windows."""
        out = np.zeros((len(texts), len(THRESHOLDS) + 2))
        for part in slices(texts):
            data = LOWER[part.data]
            start, end, row = word_bounds(data, part.offsets)
            if not len(start):
                continue
            n = part.last - part.first
            out[part.first:part.last, -1] = np.bincount(row, minlength=n)
            # words between single spaces: shared strings may begin or end with the space beside the word
            framed = np.concatenate([[np.uint8(32)], data, [np.uint8(32)]])
            framed[np.concatenate([start, end + 1])] = 32
            hits = np.zeros(len(framed) + 1, np.int64)
            shared = self.known[_grams(framed)]
            hits[1:len(shared) + 1] = np.cumsum(shared)
            hits[len(shared) + 1:] = hits[len(shared)]
            stop = np.maximum(end + 2 - SHARED + 1, start)
            text = data.tobytes()
            for i in np.flatnonzero(hits[stop] > hits[start]).tolist():
                gain = self.gain(b" " + text[start[i]:end[i]] + b" ")
                if gain >= THRESHOLDS[0]:
                    values = out[part.first + row[i]]
                    for k, least in enumerate(THRESHOLDS):
                        values[k] += gain >= least
                    values[-2] += gain
        return out


def _design(x: np.ndarray) -> np.ndarray:
    """Logarithms of counts, and shares of all windows."""
    words = np.maximum(x[:, -1:], 1)
    return np.concatenate([np.log1p(x), np.minimum(x[:, 1:4], 1), 20 * np.minimum(x[:, 1:5] / words, 0.05), np.ones((len(x), 1))], axis=1)


@dataclass
class ToxicModel:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    base: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not self.toxic:
            return np.full(len(texts), self.base)
        distance = self.__dict__.get("_distance")
        if distance is None:
            distance = self.__dict__["_distance"] = Distance(self.toxic, self.ordinary)
        return _logistic(_design(distance.features(texts)) @ self.weights)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_distance"}


def _places(texts: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
    """(word hash, places) of every word, and one spelling of each."""
    words, spelled, seen = [], {}, []
    for part in slices(pa.array(texts, pa.large_string())):
        data = LOWER[part.data]
        start, end, row = word_bounds(data, part.offsets)
        if not len(start):
            continue
        key = RangeHash(data)(start, end)
        before, after = np.roll(key, 1), np.roll(key, -1)
        before[np.append(True, row[1:] != row[:-1])] = 0
        after[np.append(row[1:] != row[:-1], True)] = 0
        with np.errstate(over="ignore"):
            seen.append(np.stack([mix(key + np.uint64(3) * mix(before) + np.uint64(5) * mix(after + np.uint64(1))), key]))
        first, at = np.unique(key, return_index=True)
        text = data.tobytes()
        for h, i in zip(first.tolist(), at.tolist()):
            if h not in spelled:
                spelled[h] = text[start[i]:end[i]]
        words.append(first)
    if not seen:
        return np.zeros(0, np.uint64), np.zeros(0, int), {}
    places = np.concatenate(seen, axis=1)
    _, at = np.unique(places[0], return_index=True)
    return *np.unique(places[1][at], return_counts=True), spelled


def marked_windows(toxic: list[str], ordinary: list[str], least: int = 5, ratio: float = 8.0, z: float = 4.0) -> list[tuple[bytes, int]]:
    """Windows in clearly more places of toxic than of ordinary documents, with their number of places, most first."""
    word, count, spelled = _places(toxic)
    other, other_count, _ = _places(ordinary)
    if not len(word):
        return []
    at = np.searchsorted(other, word)
    at_ok = np.minimum(at, max(0, len(other) - 1))
    rest = np.where(other[at_ok] == word, other_count[at_ok], 0) if len(other) else np.zeros(len(word))
    share = count.sum() / max(1, count.sum() + other_count.sum())
    both = count + rest
    surplus = (count - both * share) / np.sqrt(np.maximum(both * share * (1 - share), 1e-9))
    odds = (count / count.sum()) / ((rest + 0.5) / max(1, other_count.sum()))
    chosen = np.flatnonzero((count >= least) & (surplus >= z) & (odds >= ratio))
    chosen = chosen[np.lexsort((word[chosen], -count[chosen]))]
    return [(b" " + spelled[int(word[i])] + b" ", int(count[i])) for i in chosen]


def _dictionary(samples: list[bytes], size: int, rng: np.random.Generator) -> bytes:
    """Train a dictionary on samples joined to passages of a dozen windows; a plain one if they are too few to train on."""
    mixed = [samples[i] for i in rng.permutation(len(samples))]
    passages = [b"".join(mixed[i:i + 12]).replace(b"  ", b" ") for i in range(0, len(mixed), 12)]
    try:
        return zstandard.train_dictionary(size, passages, k=24, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def fit(toxic: list[str], ordinary: list[str], prior: float, seed: int = 3) -> ToxicModel:
    """Train on texts of both labels: dictionaries on two thirds of them, the logistic on the rest.

    ``prior`` is the share of toxic documents among the labelled ones; the fit is weighted to it. Without windows that mark
    toxic text the score is the prior.
    """
    rng = np.random.default_rng(seed)
    seen_toxic, new_toxic = [t for i, t in enumerate(toxic) if i % 3], toxic[::3]
    seen_ordinary, new_ordinary = [t for i, t in enumerate(ordinary) if i % 3], ordinary[::3]
    marked = marked_windows(seen_toxic, seen_ordinary)
    if not marked or not new_toxic or not new_ordinary:
        return ToxicModel(b"", b"", np.zeros(0), prior)
    common = [b" " + w + b" " for t in seen_ordinary[:600] for w in t.encode().translate(LOWER.tobytes()).split()]
    common = [common[i] for i in rng.permutation(len(common))[:200_000]]
    model = ToxicModel(_dictionary([w for w, n in marked for _ in range(min(n, 40))], TOXIC_BYTES, rng),
                       _dictionary(common, ORDINARY_BYTES, rng), np.zeros(0), prior)
    distance = Distance(model.toxic, model.ordinary)
    x = _design(distance.features(pa.array(new_toxic + new_ordinary, pa.large_string())))
    y = np.r_[np.ones(len(new_toxic)), np.zeros(len(new_ordinary))]
    share = np.where(y == 1, prior / len(new_toxic), (1 - prior) / len(new_ordinary)) * len(y)
    model.weights = _newton(x, y, 1.0, weight=share)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text") -> ToxicModel:
    """Fit on a bounded hash sample of each label, of documents of at most ``FIT_BYTES`` bytes."""
    known = (labels.where(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    chosen = bounded(known.where("label = 1"), "id", FIT_TOXIC).union(bounded(known.where("label = 0"), "id", FIT_ORDINARY))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(
        F.octet_length("text").between(1, FIT_BYTES))
    got = texts.join(F.broadcast(chosen), "id").toPandas().sort_values(["id", "text"])
    return fit(got["text"][got["label"] == 1].tolist(), got["text"][got["label"] == 0].tolist(), prior)


def score_column(model: ToxicModel, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts))

    return score(text.cast("string"))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", mod: int = 4,
           rest: int = 2, cutoff: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row; null and empty texts are scored as texts without windows."""
    model = train(docs, labels, ~held_out(id_col, mod, rest), label, id_col, text_col)
    scored = docs.select(F.col(id_col), held_out(id_col, mod, rest).alias("held_out"),
                         score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
