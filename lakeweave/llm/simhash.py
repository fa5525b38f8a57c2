"""SimHash fingerprints of word shingles, and the groups of documents whose fingerprints lie close together.

Links are found by anchor-point covering. Two fingerprints at Hamming distance d <= 3 differ by at most one bit in one
of their 32-bit halves, so each half is a space of its own with threshold 1. The anchors of a half are the words of a
covering code: the [31, 26] Hamming code on its low 31 bits with the top bit free, of covering radius 1. A fingerprint
is at home at the one anchor within radius 1 of its half and is copied to every anchor within radius + threshold = 2
(at most 17 of them, whatever the data). Fingerprints at home at an anchor are compared with the copies there by the
full 64-bit distance. If x is at home at a and y differs from x by one bit in that half, then d(a, y) <= 2, so no link
is lost; no cap applies anywhere.

Equal fingerprints are folded before the search, so exact copies cost one row however many there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard
from .components import components
from .membership import told_apart
from .packed import bucket_count
from .state import cut, fresh, passing
from .text import LOWER, mix, slices, word_bounds

SEED = 42
#: Parity masks of the [31, 26] Hamming code: bit j of the syndrome is the parity of the positions whose number has bit j.
CHECKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> j & 1) for j in range(5)]


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """Reference form for one word sequence: a bit is set if it is set in over half of the shingle hashes."""
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, SEED) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _column(texts: pa.Array, shingle: int, count: int = 1) -> np.ndarray:
    """Fingerprints of each text, one column per hash function (the first is XXH64, the others are mixed from it)."""
    out = np.zeros((len(texts), count), np.uint64)
    digest = xxhash.xxh64_intdigest
    for part in slices(texts):
        data = LOWER[part.data]
        start, end, row = word_bounds(data, part.offsets)
        if not len(start):
            continue
        joined, place, length = jaccard.spaced(data, start, end)
        text = joined.tobytes()
        counts = np.bincount(row, minlength=part.last - part.first)
        first = np.cumsum(counts) - counts
        for i in np.flatnonzero(counts):
            n, at = int(counts[i]), int(first[i])
            grams = max(1, n - shingle + 1)
            begin = place[at:at + grams].tolist()
            stop = (place + length)[min(at + shingle, at + n) - 1:at + n].tolist()
            hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(begin, stop)), np.uint64, grams)
            for c in range(count):
                bits = hashes if c == 0 else mix(hashes + np.uint64(c))
                ones = np.zeros(64, np.int64)
                for k in range(0, grams, 1 << 14):
                    set_bits = np.unpackbits(bits[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    ones += set_bits.sum(axis=0, dtype=np.int64)
                out[part.first + i, c] = np.packbits(2 * ones > grams, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp long) for every row; a text without words, or null, has fingerprint 0."""

    def run(batches):
        for batch in batches:
            got = _column(batch.column(1), shingle)[:, 0].copy().view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], names=["id", "fp"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, fp long")


def anchors(fps: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(home, copies), both (fp, which, anchor, more): the one anchor within radius 1 of each half, and all within 2.

    With syndrome s of the low 31 bits, the words of the code near a half are reached by flipping nothing (s = 0) or bit
    s, two bits whose numbers xor to s, and the free top bit beside at most one of the former.
    """
    syndrome = " + ".join(f"shiftleft(bit_count(half & {mask}L) % 2, {j})" for j, mask in enumerate(CHECKS))
    near = (fps.select("fp", *more, F.expr("inline(array(struct(0 as which, fp & 4294967295L as half), "
                                    "struct(1 as which, shiftrightunsigned(fp, 32) as half)))"))
            .withColumn("s", F.expr(syndrome))
            .withColumn("fix", F.expr("if(s = 0, 0L, shiftleft(1L, s - 1))")))
    home = near.select("fp", "which", F.expr("half ^ fix as anchor"), *more)
    pairs = ("transform(filter(sequence(1, 31), i -> s != 0 and i < (i ^ s)), "
             "i -> shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1))")
    flips = F.expr(f"concat(array(fix, fix ^ shiftleft(1L, 31)), {pairs})")
    copies = near.select("fp", "which", "half", *more, F.explode(flips).alias("flip")).select(
        "fp", "which", F.expr("half ^ flip as anchor"), *more)
    return home, copies


def links(fps: DataFrame, threshold: int = 3) -> DataFrame:
    """(a, b): all pairs a < b of distinct fingerprints at Hamming distance ``threshold`` (up to 3) or less."""
    if not 0 <= threshold <= 3:
        raise ValueError("two halves guarantee distances up to 3")
    home, copies = anchors(fps)
    home = home.withColumnRenamed("fp", "a")
    copies = copies.withColumnRenamed("fp", "b")
    near = home.join(copies, ["which", "anchor"]).where((F.col("a") < F.col("b"))
                                                        & (F.bit_count(F.expr("a ^ b")) <= threshold))
    return near.select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    threshold: int = 3) -> DataFrame:
    """(id, fp, component): the least id reachable over links of close fingerprints, for every row.

    Nulls and texts without words have fingerprint 0 and are linked like any other. Rows that repeat an id stay rows;
    a null id counts as larger than all others and is a component's name only if the component has no other id.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    groups = components(links(classes.select("fp"), threshold))
    named = classes.join(groups, classes["fp"] == groups["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "least")
    first = named.groupBy("root").agg(F.min("least").alias("component"))
    names = named.join(first, "root").select("fp", "component")
    return rows.join(names, "fp").select("id", "fp", "component")


# --- documents of a given similarity ---------------------------------------
#
# Five-word shingles of texts with a similarity of 0.8 differ in so many bits that no code covers them cheaply. Single words
# hardly do: a few edits leave the word SimHash within three bits. So the anchors are taken on the fingerprint of single words,
# and the pairs they bring together are sifted by longer fingerprints of the five-word shingles. Appended, cut or replaced blocks
# move many bits of any fingerprint; a prefix-filter join over the shingles (``jaccard``) finds every pair, whatever the edit.
# Fingerprints only propose: every link has the exact similarity.

SKETCH = 3
SIMILARITY, SHINGLE_WORDS = 0.8, 5


def sketch_limit(similarity: float, bits: int = 64 * SKETCH, spread: float = 3.5) -> int:
    """Most bits in which sketches of this Jaccard similarity differ: the mean and ``spread`` standard deviations."""
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(bits * share + spread * np.sqrt(bits * share * (1 - share)))


def _describe(batches):
    """(id, node, fp, sketch...): a hash of the words, the fingerprint of single words, and those of five-word shingles."""
    for batch in batches:
        texts = batch.column(1)
        words = _column(texts, 1)[:, 0].copy()
        sketch = _column(texts, SHINGLE_WORDS, SKETCH)
        node = jaccard.nodes(texts)
        columns = [node, words, *(sketch[:, c].copy() for c in range(SKETCH))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c.view(np.int64)) for c in columns)],
                                         names=["id", "node", "fp", *_SKETCHES])


_SKETCHES = [f"s{c}" for c in range(SKETCH)]


def _spanning(limit: int, threshold: int):
    """Links of each anchor's documents, as many as connect what is linked: breadth first, never all pairs of a group."""
    def close(fp, sketch, a, b):
        near = np.bitwise_count(fp[a][:, None] ^ fp[b][None]) <= threshold
        return near & (np.bitwise_count(sketch[a][:, None] ^ sketch[b][None]).sum(axis=2) <= limit)

    def run(table):
        which, anchor, node, fp = (table.column(c).to_numpy() for c in ("which", "anchor", "node", "fp"))
        sketch = np.stack([table.column(c).to_numpy() for c in _SKETCHES], axis=1).view(np.uint64)
        fp = fp.view(np.uint64)
        order = np.lexsort((node, anchor, which))
        which, anchor, node, fp, sketch = which[order], anchor[order], node[order], fp[order], sketch[order]
        new = np.append(True, (which[1:] != which[:-1]) | (anchor[1:] != anchor[:-1]))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(node)))
        two = begin[size == 2]
        linked = ((np.bitwise_count(fp[two] ^ fp[two + 1]) <= threshold)
                  & (np.bitwise_count(sketch[two] ^ sketch[two + 1]).sum(axis=1) <= limit))
        found = [(two[linked], two[linked] + 1)]
        for at, n in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
            rest = np.arange(at, at + n)
            while len(rest) > 1:
                frontier, rest = rest[:1], rest[1:]
                while len(frontier) and len(rest):
                    some, frontier = frontier[:64], frontier[64:]
                    near = close(fp, sketch, some, rest)
                    hit = near.any(axis=0)
                    if hit.any():
                        found.append((some[near[:, hit].argmax(axis=0)], rest[hit]))
                        frontier, rest = np.concatenate([frontier, rest[hit]]), rest[~hit]
        a, b = (np.concatenate(c) for c in zip(*found))
        return pa.table([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])
    return run


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                      threshold: int = 3) -> DataFrame:
    """(id, component) of every row: groups linked by equal words or an exact five-word similarity of ``similarity`` or more.

    Lower-cased words count; texts without words are one group. Groups are connected components, named by their least id.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sketches = ", ".join(f"{c} long" for c in _SKETCHES)
    rows = cut(chosen.mapInArrow(_describe, f"id {chosen.schema['id'].dataType.simpleString()}, node long, fp long, {sketches}"), "sketches")
    classes = rows.groupBy("node").agg(F.min("id").alias("least"), *[F.min(c).alias(c) for c in ("fp", *_SKETCHES)])
    _, copies = anchors(classes.drop("least"), "node", *_SKETCHES)
    buckets = bucket_count(docs.sparkSession, 4)
    dealt = copies.withColumn("bucket", F.pmod(F.xxhash64("which", "anchor"), F.lit(buckets)).cast("int"))
    seeds = dealt.groupBy("bucket").applyInArrow(_spanning(sketch_limit(similarity), threshold), "a long, b long")
    texts = jaccard.candidates(chosen, "text", similarity, SHINGLE_WORDS)
    groups = components(jaccard.links(texts, similarity, seeds))
    named = classes.select("node", "least").join(groups, "node", "left").withColumn("root", F.coalesce("component", "node"))
    first = named.groupBy("root").agg(F.min("least").alias("component"))
    return rows.select("id", "node").join(named.select("node", "root").join(first, "root"), "node").select("id", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of each group's least id, as they were; rows that repeat that id all stay.

    The ids that go are few beside those that stay: only rows that may have one of them are shuffled.
    """
    name = fresh(docs, "__gone")
    with passing() as stays:
        found = similar_documents(docs, id_col, text_col, **options)
        stay = found.groupBy("id").agg(F.max(F.col("id").eqNullSafe(F.col("component"))).alias("stay"))
        gone = stays(cut(stay.where(~F.col("stay")).select(F.col("id").alias(name)), "gone"))
    may, cannot = told_apart(docs, [F.col(id_col)], gone)
    return cannot.union(may.join(gone, may[id_col].eqNullSafe(gone[name]), "left_anti"))
