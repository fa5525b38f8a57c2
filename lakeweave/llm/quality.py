"""Quality scores learned from preference pairs (Bradley-Terry), and filtering by a score quantile.

Each document becomes a row of shape features, counted over its whole text. From labelled documents, pairs (better,
worse) are formed and weights are fitted so that the logistic loss of weight x feature difference is least: the
probability that one document is preferred to another is the logistic of their score difference. A two-parameter logistic
maps the score to the probability of label 1; the threshold of the filter is a quantile of the scores.

Null and empty texts have all-zero features and get the score of such a row. Ties share their score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import held_out, labelled
from .text import LOWER, RangeHash, slices, word_bounds

FIT_ROWS = 20_000
CLASSES = ("upper", "lower", "digit", "bar", "bang", "symbol", "stop", "beyond")
_CLASS = np.zeros(256, np.uint8)
for _code, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b"|", b"!?", b"#$%&*+/<=>@[\\]^_`{}~", b".,;:",
                                range(128, 256)), start=1):
    _CLASS[list(_bytes)] = _code
NAMES = (*CLASSES, "newline", "word_bytes", "distinct_words", "same_as_before", "distinct_pairs", "marked_words", "log_words",
         "longest_word", "distinct_lines")


def _per_row(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=n)


def _distinct(row: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys of each row."""
    order = np.lexsort((key, row))
    r, k = row[order], key[order]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    return np.bincount(r[first], minlength=n)


def features(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """One row of ``NAMES`` per text: shares of byte classes, repetition of words, pairs and lines, lengths."""
    out = np.zeros((len(texts), len(NAMES)))
    for part in slices(texts):
        n, data, offsets = part.last - part.first, part.data, part.offsets
        if not len(data):
            continue
        got = out[part.first:part.last]
        kind = _CLASS[data]
        size = np.maximum(part.lengths, 1)
        filled = np.flatnonzero(part.lengths)
        for c in range(1, len(CLASSES) + 1):
            got[filled, c - 1] = np.add.reduceat((kind == c).view(np.uint8), offsets[:-1][filled], dtype=np.int64)
        got[:, :len(CLASSES)] /= size[:, None]
        hashed = RangeHash(LOWER[data])
        breaks = np.flatnonzero(data == 10)
        line_row = np.searchsorted(offsets, breaks, side="right") - 1
        got[:, 8] = np.bincount(line_row, minlength=n) / size
        begin = np.unique(np.concatenate([offsets[:-1][filled], breaks + 1]))
        begin = begin[begin < len(data)]
        stop = np.append(begin[1:], len(data))
        stop = np.where((stop > 0) & (data[stop - 1] == 10), stop - 1, stop)
        lines = np.searchsorted(offsets, begin, side="right") - 1
        got[:, 16] = _distinct(lines, hashed(begin, np.maximum(stop, begin)), n) / np.maximum(np.bincount(lines, minlength=n), 1)
        start, end, row = word_bounds(data, offsets)
        if not len(start):
            continue
        words = np.bincount(row, minlength=n)
        some = np.maximum(words, 1)
        got[:, 9] = _per_row(end - start, row, n) / some
        key = hashed(start, end)
        got[:, 10] = _distinct(row, key, n) / some
        same_row = row[1:] == row[:-1]
        got[:, 11] = _per_row((key[1:] == key[:-1])[same_row], row[1:][same_row], n) / some
        pairs = hashed(start[:-1], end[1:])[same_row]
        got[:, 12] = _distinct(row[1:][same_row], pairs, n) / np.maximum(words - 1, 1)
        last = kind[end - 1]
        got[:, 13] = _per_row((last == 5) | (last == 6), row, n) / some
        got[:, 14] = np.log1p(words)
        longest = np.zeros(n)
        np.maximum.at(longest, row, end - start)
        got[:, 15] = np.log1p(longest)
    return out


@dataclass(frozen=True)
class BradleyTerry:
    """Fitted scorer. ``knots`` are feature quantiles; each feature enters as itself and as hinges above its knots."""

    knots: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float
    threshold: float

    def design(self, x: np.ndarray) -> np.ndarray:
        return (_hinges(x, self.knots) - self.centre) / self.spread

    def strength(self, x: np.ndarray) -> np.ndarray:
        """Pairwise score: differences are log odds of preference."""
        return self.design(x) @ self.weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * self.strength(x) + self.shift)


def _hinges(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    return np.concatenate([x, *(np.maximum(x - k, 0) for k in knots)], axis=1)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _newton(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _logistic(x @ w)
        curve = x * (weight * p * (1 - p))[:, None]
        change = np.linalg.solve(curve.T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 60_000, ridge: float = 3.0, seed: int = 7) -> BradleyTerry:
    """Fit on feature rows and labels 0/1. Without both labels the score is the (smoothed) share of label 1."""
    rng = np.random.default_rng(seed)
    base = (y.sum() + 1) / (len(y) + 2)
    knots = np.quantile(x, (0.1, 0.5, 0.9), axis=0) if len(x) else np.zeros((3, len(NAMES)))
    design = _hinges(x, knots) if len(x) else np.zeros((0, 4 * len(NAMES)))
    centre = design.mean(axis=0) if len(x) else np.zeros(design.shape[1])
    spread = design.std(axis=0) if len(x) else np.ones(design.shape[1])
    spread = np.where(spread > 1e-9, spread, 1.0)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(better) or not len(worse):
        return BradleyTerry(knots, centre, spread, np.zeros(design.shape[1]), 0.0, float(np.log(base / (1 - base))), base)
    design = (design - centre) / spread
    # every labelled document takes part equally often on its side
    i = rng.permutation(np.resize(better, max(pairs, len(better))))
    j = rng.permutation(np.resize(worse, len(i)))
    weights = _newton(design[i] - design[j], np.ones(len(i)), ridge)
    raw = design @ weights
    spread_raw = raw.std() or 1.0
    fitted = _newton(np.stack([raw / spread_raw, np.ones(len(raw))], axis=1), y.astype(float), 1e-3)
    model = BradleyTerry(knots, centre, spread, weights, float(fitted[0] / spread_raw), float(fitted[1]), 0.0)
    cut_at = float(np.quantile(model.probability(x), 1 - base))
    return BradleyTerry(**{**model.__dict__, "threshold": cut_at})


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", bound: int = FIT_ROWS) -> BradleyTerry:
    """Fit on at most about ``bound`` labelled documents; only their features reach the driver."""
    rows = labelled(docs, labels, label, id_col, text_col, usable, bound)

    def run(batches):
        for batch in batches:
            values = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int64()),
                 pa.array(list(values), pa.list_(pa.float64()))], names=["id", "label", "x"])

    got = rows.withColumn("id", F.xxhash64("id")).select("id", "text", "label").mapInArrow(
        run, "id long, label long, x array<double>").toPandas().sort_values("id")
    x = np.stack(got["x"]) if len(got) else np.zeros((0, len(NAMES)))
    return fit(x, got["label"].to_numpy())


def score_column(model: BradleyTerry, text: Column) -> Column:
    """Probability of label 1 of a text column."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.probability(features(texts)))

    return score(text.cast("string"))


def keep_good(docs: DataFrame, model: BradleyTerry, text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """Rows whose score reaches ``threshold`` (by default the model's score quantile), with their columns as they were."""
    limit = model.threshold if threshold is None else threshold
    return docs.where(score_column(model, F.col(text_col)) >= limit)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
           mod: int = 5, rest: int = 0, cutoff: float = 0.3, bound: int = FIT_ROWS) -> DataFrame:
    """(id, held_out, score, predicted) of every row, learned from rows that are not held out."""
    model = train(docs, labels, ~held_out(id_col, mod, rest), label, id_col, text_col, bound)
    scored = docs.select(F.col(id_col), held_out(id_col, mod, rest).alias("held_out"),
                         score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
