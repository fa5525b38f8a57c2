"""Language-model scores of documents by stupid backoff over the corpus's own n-gram counts.

The score of a word after its history is count(history + word) / count(history); if the longer n-gram does not occur, ``alpha``
times the score after the history without its first word. A single word scores count / words of the corpus; one that does not occur counts
``alpha`` times. Counts are of all documents but the scored one, so that a text does not predict itself; copies
of it do. A document's score is the sum of the logarithms over its words, and their mean.

Relationally: documents are dealt into chunks of like size. Every chunk explodes its n-grams and sends each distinct one once, with its
count, to the count table, which is partitioned by n-gram hash; there the counts of all chunks are added and joined back to the
n-grams of each chunk, which sums the scores per document. A frequent n-gram is one row per chunk, so no partition is hot.
Rows travel packed, one per pair of chunk and partition.

Null and empty texts have no words and score 0. Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mixing import word_count
from .packed import bucket_count, pack, unpack
from .text import RangeHash, mix, slices, word_bounds

ORDER = 2
ALPHA = 0.4


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of a chunk."""
    keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in slices(texts):
        start, end, row = word_bounds(part.data, part.offsets)
        if len(start):
            keys.append(RangeHash(part.data)(start, end))
            rows.append(row + part.first)
    return np.concatenate(keys), np.concatenate(rows)


def _ngrams(key: np.ndarray, row: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``: the hash of the n-gram that ends at each word (0 where the text begins later)."""
    out = [key]
    for n in range(2, order + 1):
        longer = np.zeros(len(key), np.uint64)
        with np.errstate(over="ignore"):
            longer[n - 1:] = mix(out[-1][:-1][n - 2:] * np.uint64(0x9E3779B97F4A7C15) + key[n - 1:] + np.uint64(n))
        longer[n - 1:][row[n - 1:] != row[:len(row) - n + 1]] = 0
        longer[:n - 1] = 0
        out.append(longer)
    return out


def _explode(buckets: int, order: int):
    def run(key, table):
        word, row = _words(table.column("text"))
        out = []
        for n, grams in enumerate(_ngrams(word, row, order), start=1):
            distinct, count = np.unique(grams[grams != 0], return_counts=True)
            bucket = (distinct % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            for at in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
                if len(at):
                    out.append((n, int(bucket[at[0]]), key[0].as_py(), pack(np.diff(distinct[at], prepend=np.uint64(0)),
                                                                          count[at].astype(np.uint32))))
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                        names=["n", "bucket", "chunk", "payload"])
    return run


def _count(table):
    """Totals of one bucket of one order, for each chunk in the order of its own n-grams."""
    parts = [unpack(p) for p in table.column("payload").to_pylist()]
    grams = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    _, place = np.unique(grams, return_inverse=True)
    total = np.zeros(int(place.max()) + 1, np.int64)
    np.add.at(total, place, np.concatenate([p[1] for p in parts]))
    ends = np.cumsum([len(p[0]) for p in parts])
    answers = [pack(total[place[b - len(p[0]):b]]) for p, b in zip(parts, ends)]
    return pa.table([table.column("n"), table.column("bucket"), table.column("chunk"), pa.array(answers, pa.binary())],
                    names=["n", "bucket", "chunk", "payload"])


def _outside(grams: np.ndarray, row: np.ndarray, answers: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """Count of the n-gram at each word, without those of the word's own document; 0 where there is none."""
    some = np.flatnonzero(grams)
    distinct, place = np.unique(grams[some], return_inverse=True)
    bucket = (distinct % np.uint64(buckets)).astype(np.int64)
    total = np.zeros(len(distinct), np.int64)
    for b in np.unique(bucket):
        total[bucket == b] = answers[int(b)]
    mine = row[some] * np.int64(max(1, len(distinct))) + place
    _, at, count = np.unique(mine, return_inverse=True, return_counts=True)
    out = np.zeros(len(grams), np.int64)
    out[some] = total[place] - count[at]
    return out


def _score(buckets: int, order: int, alpha: float, words: int):
    def run(docs, answers):
        texts = docs.column("text")
        word, row = _words(texts)
        known: dict[int, dict[int, np.ndarray]] = {n: {} for n in range(1, order + 1)}
        for n, b, payload in zip(*(answers.column(c).to_pylist() for c in ("n", "bucket", "payload"))):
            known[n][b] = unpack(payload)[0]
        length = np.bincount(row, minlength=docs.num_rows)
        outside = np.maximum(words - length, 1)[row]
        counts = [_outside(g, row, known[n], buckets) for n, g in enumerate(_ngrams(word, row, order), start=1)]
        # from short to long histories: a longer n-gram that occurs replaces the backed-off score
        score = np.log(np.maximum(counts[0], alpha) / outside)
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
        for n in range(2, order + 1):
            history = np.roll(counts[n - 2], 1)
            seen = counts[n - 1] > 0
            longer = np.log(np.maximum(counts[n - 1], 1) / np.maximum(history, 1))
            score = np.where(place < n - 1, score, np.where(seen, longer, np.log(alpha) + score))
        total = np.bincount(row, weights=score, minlength=docs.num_rows).astype(float)
        mean = total / np.maximum(length, 1)
        return pa.table([docs.column("id"), pa.array(length, pa.int64()), pa.array(total), pa.array(mean)],
                        names=["id", "n_words", "log_score", "mean_log_score"])
    return run


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """(id, n_words, log_score, mean_log_score) of every row."""
    buckets = bucket_count(docs.sparkSession, 1)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(buckets)).cast("int"))
    words = rows.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    kind = rows.schema["id"].dataType.simpleString()
    schema = "n int, bucket int, chunk int, payload binary"
    sent = rows.groupBy("chunk").applyInArrow(_explode(buckets, order), schema)
    answers = sent.groupBy("n", "bucket").applyInArrow(_count, schema)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(buckets, order, alpha, words), f"id {kind}, n_words long, log_score double, mean_log_score double")
