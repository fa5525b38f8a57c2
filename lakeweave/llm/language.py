"""Language identification by averaged hashed subword embeddings with a linear softmax.

A text is the bag of its byte n-grams inside words (1 to 4 bytes, word edges marked) and whole words, hashed to buckets.
Each bucket has an embedding; the text's vector is their mean, and a linear softmax over it gives the languages.
Embeddings and softmax are trained together by stochastic gradient descent in numpy. For prediction they are folded into one
table of logits per bucket, so a whole text of any length costs one gather and one mean. A temperature fitted on
rows set aside calibrates the probabilities, and the rejection limit is the score that a set share of right answers reaches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import bounded, held_out
from .text import LOWER, RangeHash, Slice, slices, word_bounds

UNKNOWN = "und"
BUCKETS = 1 << 15
#: The bounded sample of labelled rows to fit on: so many rows, of texts of at most so many bytes.
FIT_ROWS, FIT_BYTES = 3_000, 1 << 14


def buckets(part: Slice, size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram of a slice."""
    data = LOWER[part.data]
    start, end, row = word_bounds(data, part.offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = RangeHash(data)
    keys, rows = [hashed(start, end) + np.uint64(1)], [row]
    length = end - start
    for n in (1, 2, 3, 4):
        count = np.maximum(length - n + 1, 0)
        word = np.repeat(np.arange(len(start)), count)
        at = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + start[word]
        edge = (at == start[word]).astype(np.uint64) + 2 * (at + n == end[word]).astype(np.uint64)
        with np.errstate(over="ignore"):
            keys.append(hashed(at, at + n) + edge * np.uint64(0x9E3779B97F4A7C15))
        rows.append(row[word])
    return (np.concatenate(keys) >> np.uint64(20)).astype(np.int64) % size, np.concatenate(rows)


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    limit: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), len(self.names)))
        for part in slices(texts, 1 << 19):
            code, row = buckets(part, len(self.table))
            n = part.last - part.first
            count = np.maximum(np.bincount(row, minlength=n), 1)
            for k in range(len(self.names)):
                out[part.first:part.last, k] = np.bincount(row, weights=self.table[code, k], minlength=n) / count
        return _softmax(out + self.bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], dim: int = 16, epochs: int = 6, rate: float = 4.0, accept: float = 0.995,
        size: int = BUCKETS, seed: int = 11) -> LanguageModel:
    """Train on texts and their languages; a tenth is set aside for the temperature and the rejection limit."""
    names = tuple(sorted(set(langs)))
    target = np.array([names.index(x) for x in langs], int)
    bags = []
    for text in texts:
        parts = list(slices(pa.array([text], pa.large_string())))
        code = buckets(parts[0], size)[0] if parts else np.zeros(0, np.int64)
        bags.append(np.unique(code, return_counts=True) if len(code) else (code, code))
    rng = np.random.default_rng(seed)
    order = np.array([i for i in rng.permutation(len(bags)) if len(bags[i][0])], int)
    aside, used = order[:len(order) // 10], order[len(order) // 10:]
    embed = rng.normal(0, 0.1, (size, dim))
    soft = np.zeros((dim, len(names)))
    bias = np.zeros(len(names))
    steps, step = max(1, epochs * len(used)), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            code, count = bags[i]
            share = count / count.sum()
            x = share @ embed[code]
            error = _softmax((x @ soft + bias)[None])[0]
            error[target[i]] -= 1
            now = rate * (1 - step / steps)
            step += 1
            back = soft @ error
            soft -= 0.1 * now * np.outer(x, error)
            bias -= 0.01 * now * error
            embed[code] -= now * share[:, None] * back
    table = embed @ soft
    if not len(aside):
        return LanguageModel(names, table, bias, 0.0)
    logits = np.stack([(bags[i][1] / bags[i][1].sum()) @ table[bags[i][0]] + bias for i in aside])
    truth = target[aside]
    heats = np.exp(np.linspace(-2, 2.5, 46))
    loss = [-np.log(_softmax(logits * h)[np.arange(len(truth)), truth] + 1e-12).mean() for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    sure = _softmax(logits * heat)
    right = sure.max(axis=1)[sure.argmax(axis=1) == truth]
    limit = float(np.quantile(right, 1 - accept)) if len(right) else 0.0
    return LanguageModel(names, table * heat, bias * heat, limit)


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = FIT_ROWS, max_bytes: int = FIT_BYTES) -> LanguageModel | None:
    """Fit on a hash sample of about ``rows`` labelled texts of 1 to ``max_bytes`` bytes; None if there are none."""
    pool = docs.where(usable & F.col(lang_col).isNotNull() & F.octet_length(F.col(text_col)).between(1, max_bytes)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    got = bounded(pool, "id", rows).toPandas().sort_values(["id", "text"])
    return fit(got["text"].tolist(), got["lang"].tolist()) if len(got) else None


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", reject: bool = False) -> DataFrame:
    """``docs`` with a struct column ``language`` (lang_pred, score, sure).

    Null texts, texts without a letter and every text if there is no model are ``und`` with score 0. ``sure`` tells
    whether the score reaches the calibrated limit; with ``reject`` such unsure texts are ``und`` too.
    """
    @F.pandas_udf("lang_pred string, score double, sure boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        known = texts.map(lambda t: t is not None and any(map(str.isalpha, t))).to_numpy(bool)
        if model is None:
            return pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "sure": False}, index=texts.index)
        chance = model.probabilities(pa.array(texts, pa.large_string(), from_pandas=True))
        score = chance.max(axis=1) if len(chance) else np.zeros(0)
        name = np.array(model.names, object)[chance.argmax(axis=1)]
        known_name = known & (score >= model.limit) if reject else known
        return pd.DataFrame({"lang_pred": np.where(known_name, name, UNKNOWN), "score": np.where(known, score, 0.0),
                             "sure": known & (score >= model.limit)})

    return docs.withColumn("language", run(F.col(text_col).cast("string")))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", mod: int = 5,
              rest: int = 0) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row, learned from the rows that are not held out."""
    model = train(docs, ~held_out(id_col, mod, rest), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), held_out(id_col, mod, rest).alias("held_out"), F.col(text_col).alias("__text"))
    return predict(rows, model, "__text").select(id_col, "held_out", "language.lang_pred", "language.score")
