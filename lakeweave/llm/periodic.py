"""Periodic runs of words within a document: where, how long, with which period, and the text without their repetitions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least ``exponent`` periods and
``least`` words that no neighbouring word extends. All runs of a text are found by a descending-LCP Kruskal:

1. Words become numbers, exactly, by a dictionary. Texts in which no window of ``reach`` words occurs twice hold no run and are
   done; ``reach`` is the least overlap of a run with itself one period on (16 words for 24 words and three periods).
2. The suffixes of the other texts are sorted by prefix doubling; the classes of every doubling give the longest common prefix
   (LCP) of neighbours.
3. Neighbours are united by decreasing LCP, with union-find over ordered sets of positions, the smaller set into the larger.
   Two positions i < j that become adjacent at LCP l with (exponent - 1) * (j - i) <= l seed a run: words i to j + l have
   period j - i. It is their smallest period, as a smaller one would put a position between the two, and nothing extends it
   to the right. Seeds that the word before would extend lie inside a run that has a seed of its own.

Everything happens where the text lies: no shuffle, and nothing of one document waits for another. Null texts are empty and
hold no runs; rows that repeat an id or a text are judged one by one; whole texts are judged, however long.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import Slice, mix, slices, word_bounds

LEAST, EXPONENT = 24, 3
SLICE = 1 << 20
SPACE = r"[\x20\x09-\x0D]+"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_DDL = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def reach_of(least: int, exponent: int) -> int:
    """The least LCP of the first two positions of a run: length less period, at the period where both bounds meet."""
    return min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))


def words_of(part: Slice) -> tuple[pa.Array, np.ndarray]:
    """Every word of a slice with one space behind it, and the number of its first word for each row (and the end)."""
    start, end, row = word_bounds(part.data, part.offsets)
    size = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size + 1, out=offsets[1:])
    body = np.full(int(offsets[-1]), 0x20, np.uint8)
    if len(start):
        edges = np.zeros(len(part.data) + 1, np.int8)
        edges[start] += 1
        edges[end] -= 1
        inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
        body[np.arange(int(size.sum())) + np.repeat(np.arange(len(start)), size)] = part.data[inside]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return words, np.searchsorted(row, np.arange(part.last - part.first + 1))


def suspects(word: np.ndarray, first: np.ndarray, reach: int) -> np.ndarray:
    """Rows in which some window of ``reach`` words may occur twice (by hash: never one too few)."""
    n, height = len(word), 1
    if n <= reach:
        return np.zeros(0, np.int64)
    hashed = mix(word.astype(np.uint64) + np.uint64(1))
    with np.errstate(over="ignore"):
        while 2 * height <= reach:
            hashed = mix(hashed[:-height] * np.uint64(0x9E3779B97F4A7C15) + hashed[height:])
            height *= 2
        if height < reach:
            hashed = mix(hashed[:height - reach] * np.uint64(0x9E3779B97F4A7C15) + hashed[reach - height:])
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[:len(hashed)]
    valid = np.arange(len(hashed)) + reach <= first[1:][row]
    row, hashed = row[valid], hashed[valid] ^ mix(row[valid].astype(np.uint64))
    ordered = np.sort(hashed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    return np.unique(row[np.isin(hashed, twice)])


def doubled(word: np.ndarray, row: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of several texts (each for itself, one after the other) and the prefix classes of 1, 2, 4, ... words.

    ``end`` is the end of the text of each position. A class is the rank of its first member; suffixes that have fewer words
    than a level have a class of their own there.
    """
    n = len(word)
    key = row.astype(np.int64) * (int(word.max()) + 1) + word
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, height = [rank], 1
    while True:
        begins = np.append(np.flatnonzero(new), n)
        at = np.flatnonzero(np.repeat(np.diff(begins) > 1, np.diff(begins)))
        if not len(at):
            return order, levels
        pos = order[at]
        ahead = pos + height
        inside = ahead < end[pos]
        key = rank[pos] * (n + 1) + np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        by = np.argsort(key, kind="stable")
        key, pos = key[by], pos[by]
        order[at] = pos
        split = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[pos] = at[np.maximum.accumulate(np.where(split, np.arange(len(at)), 0))]
        new[at] = split
        levels.append(rank)
        height *= 2


def common(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b``, by the classes from the longest down."""
    a, b, stop = a.copy(), b.copy(), end[a]
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < stop) & (b < stop)
        same = inside & (levels[k][np.where(inside, a, 0)] == levels[k][np.where(inside, b, 0)])
        step = same.astype(np.int64) << k
        a, b, total = a + step, b + step, total + step
    return total


def kruskal(position: list[int], left: list[int], lcp: list[int], least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the seeds. ``left`` and ``lcp``: neighbours ``left`` and ``left + 1`` in descending order of LCP."""
    root, members, found = list(range(len(position))), [[p] for p in position], []
    times = exponent - 1

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, common_words in zip(left, lcp):
        big, small = find(a), find(a + 1)
        if len(members[big]) < len(members[small]):
            big, small = small, big
        root[small] = big
        into, added, members[small] = members[big], members[small], None
        at = [bisect_left(into, p) for p in added]
        for k, (p, x) in enumerate(zip(added, at)):
            if x and (k == 0 or at[k - 1] < x):
                gap = p - into[x - 1]
                if times * gap <= common_words and gap + common_words >= least:
                    found.append((into[x - 1], gap + common_words, gap))
            if x < len(into) and (k + 1 == len(at) or at[k + 1] > x):
                gap = into[x] - p
                if times * gap <= common_words and gap + common_words >= least:
                    found.append((p, gap + common_words, gap))
        for p, x in zip(reversed(added), reversed(at)):
            into.insert(x, p)
    return found


def runs_of(word: np.ndarray, first: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Runs of several texts of numbered words; ``first`` has the first word of each text and the end of all.

    Rows (start, length, period) by start, then period; starts count from the first word of all texts.
    """
    reach = reach_of(least, exponent)
    chosen = suspects(word, first, reach)
    if not len(chosen):
        return np.zeros((0, 3), np.int64)
    size = np.diff(first)[chosen]
    stop = np.cumsum(size)
    origin = np.repeat(first[chosen] - (stop - size), size) + np.arange(int(stop[-1]))
    word, row, end = word[origin], np.repeat(np.arange(len(chosen)), size), np.repeat(stop, size)
    order, levels = doubled(word, row, end)
    near = np.flatnonzero(row[order[1:]] == row[order[:-1]])
    floor = min(len(levels) - 1, reach.bit_length() - 1)  # neighbours with less in common are not looked at
    near = near[levels[floor][order[near]] == levels[floor][order[near + 1]]]
    shared = common(order[near], order[near + 1], levels, end)
    near, shared = near[shared >= reach], shared[shared >= reach]
    if not len(near):
        return np.zeros((0, 3), np.int64)
    nodes = np.unique(np.concatenate([near, near + 1]))
    by = np.argsort(-shared, kind="stable")
    left = np.searchsorted(nodes, near[by])
    found = np.array(kruskal(order[nodes].tolist(), left.tolist(), shared[by].tolist(), least, exponent), np.int64).reshape(-1, 3)
    at, after = found[:, 0], found[:, 0] + found[:, 2]
    begins = (stop - size)[row[at]]
    found = found[(at == begins) | (word[at - 1] != word[after - 1])]
    found[:, 0] = origin[found[:, 0]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """True for each word that no run holds after its first period."""
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.subtract.at(gone, found[:, 0] + found[:, 1], 1)
    return np.cumsum(gone[:-1]) == 0


def _judge(part: Slice, ids: pa.Array, least: int, exponent: int) -> pa.RecordBatch:
    words, first = words_of(part)
    n = len(words)
    number = words.dictionary_encode().indices.to_numpy() if n else np.zeros(0, np.int64)
    found = runs_of(number, first, least, exponent)
    keep = kept_words(n, found)
    left = words.filter(pa.array(keep)) if len(found) else words
    ends = np.concatenate([[0], np.cumsum(keep)])[first]
    offsets = np.frombuffer(left.buffers()[1], np.int64)[:len(left) + 1] if len(left) else np.zeros(1, np.int64)
    body = np.frombuffer(left.buffers()[2], np.uint8) if len(left) else np.zeros(0, np.uint8)
    bounds = offsets[ends]
    some = np.diff(ends) > 0  # the last space of each text goes
    solid = np.ones(int(bounds[-1]), bool)
    solid[bounds[1:][some] - 1] = False
    at = np.concatenate([[0], np.cumsum(np.diff(bounds) - some)]).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(at), pa.py_buffer(body[:len(solid)][solid]))
    owner = np.searchsorted(first, found[:, 0], side="right") - 1
    columns = [found[:, 0] - first[owner], found[:, 1], found[:, 2]]
    listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(first))), pa.int32()),
                                      pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(first)), listed, texts], schema=_OUT)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  exponent: int = EXPONENT) -> DataFrame:
    """(id, n_words, runs, collapsed): one row per row of ``docs``.

    ``runs`` is an array of (start, length, period) in words, by start and period; ``collapsed`` is the text without the words
    that a run holds after its first period, the rest joined by one space. ``exponent`` is 2 at least.
    """
    if exponent < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")

    def judge(batches):
        for batch in batches:
            for part in slices(batch.column(1), SLICE):
                yield _judge(part, batch.column(0).slice(part.first, part.last - part.first), least, exponent)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(judge, _DDL)


def with_repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): about a tenth of the texts repeat a stretch of themselves to their end, chosen and cut by crc32 of the id.

    With h the crc32 of the id as text and g = floor(h / 10): if h % 10 is 0, word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, those without a word or an id stay as they are.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"))
    chosen = F.col("h") % 10 == 0
    rows = rows.withColumn("w", F.when(chosen, F.array_remove(F.split("text", SPACE), "")))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", (F.col("g") % F.when(F.col("n") > 0, F.col("n"))).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail: Column = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a"))), " ")
    return rows.select("id", F.when(chosen & (F.col("n") > 0), changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of ``periodic_runs``.

    The run shown has the greatest exact length / period, ties by smallest start and period; nulls without a run.
    """
    best = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"),
                       lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    rows = found.withColumn("best", best)
    shown = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return rows.select("id", F.size("runs").cast("long").alias("n_runs"), *shown,
                       F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                       F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
