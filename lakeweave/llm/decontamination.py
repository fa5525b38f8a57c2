"""Finding benchmark items inside documents, with DataFrame functions only.

An item of L words matches a document if one of its windows of L words (the whole document if it is shorter) has a SimHash
within ``radius`` bits of the item's and a weighted Jaccard similarity of five-word shingles (a shingle weighs as often as it
occurs) of ``threshold`` or more. Items of fewer than five words are one shingle.

1. *Windows.* Similarity t leaves at most (1 - t) m of an item's m shingles out of the window, so one of any floor((1 - t) m) + 1
   of them is inside. The longest ones, which are the rarest, are looked up in one pass over the documents; every
   item-sized window around a hit goes on. No window that can match is lost.
2. *Fingerprints.* Each window gets a 64-bit SimHash of its shingles. Multi-index Hamming: the 64 bits are cut into
   radius + 1 blocks, so fingerprints within the radius agree in one block at least; windows and items of one size are
   joined on (size, block, value), and the full distance decides.
3. *Verification.* The exact weighted similarity of each pair.

Nulls, empty texts and items without words match nothing. The looked-up shingles of the benchmark are broadcast in blocks
of at most ``block_rows`` rows, so a large benchmark takes more passes, not more memory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .state import cut, fresh

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 19
BLOCK_ROWS = 500_000
LANES = 16


def words_of(text: Column) -> Column:
    """Lower-cased words; empty for null."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.array_remove(parts, "")


def shingles(words: str, size: int = SHINGLE) -> str:
    """SQL for the shingles of a words column, repeats included; shorter sequences are one shingle, empty ones none."""
    return (f"if(size({words}) = 0, cast(array() as array<string>), transform(sequence(0, greatest(0, size({words}) - {size})), "
            f"i -> concat_ws(' ', slice({words}, i + 1, {size}))))")


def fingerprint(grams: str) -> Column:
    """64-bit SimHash of a shingle array: a bit is set if it is set in over half of the shingle hashes; 0 if there are none.

    Sixteen sums count four bits each, in lanes of 16 bits, which hold up to 65 535 shingles.
    """
    mask = sum(1 << (LANES * k) for k in range(64 // LANES))
    bits = []
    for j in range(LANES):
        total = f"aggregate(hs, 0L, (a, h) -> a + (shiftrightunsigned(h, {j}) & {mask}L))"
        lanes = " | ".join(f"if(2 * (shiftrightunsigned(t, {LANES * k}) & 65535L) > size(hs), shiftleft(1L, {j + LANES * k}), 0L)"
                           for k in range(64 // LANES))
        bits.append(f"(transform(array({total}), t -> {lanes})[0])")
    return F.expr(f"transform(array(transform({grams}, g -> xxhash64(g))), hs -> {' | '.join(bits)})[0]")


def blocks(radius: int) -> list[int]:
    """Masks of radius + 1 nearly equal blocks of the 64 bits, as signed numbers."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def blocked(fp: str, masks: list[int]) -> Column:
    """One row (block, value) per block of a fingerprint."""
    return F.posexplode(F.array(*[F.expr(f"{fp} & {m}L") for m in masks])).alias("block", "value")


def weighted_similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two shingle arrays: sum of the smaller over sum of the larger counts."""
    shared = ("aggregate(array_intersect(p.a, p.b), 0, (n, s) -> n + least(size(filter(p.a, x -> x = s)), "
              "size(filter(p.b, x -> x = s))))")
    ratio = f"transform(array({shared}), c -> cast(c as double) / (size(p.a) + size(p.b) - c))[0]"
    return F.expr(f"transform(array(struct({a} as a, {b} as b)), p -> {ratio})[0]")  # each array is made once


def items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words, n, grams, fp) of every item that has words."""
    rows = benchmark.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    rows = rows.where(F.size("words") > 0).withColumn("n", F.size("words")).withColumn("grams", F.expr(shingles("words")))
    return rows.withColumn("fp", fingerprint("grams"))


def _probes(known: DataFrame, threshold: float) -> DataFrame:
    """(hash, k, n): for each item its floor((1 - t) m) + 1 longest shingles, with the item's size."""
    rows = known.withColumn("m", F.size("grams")).withColumn(
        "longest", F.expr("slice(array_sort(transform(grams, g -> struct(-length(g) as l, g as g))), 1, "
                          f"cast(floor((1 - {threshold}) * m + 1e-9) as int) + 1)"))
    rows = rows.select("n", F.explode("longest").alias("x")).select("n", F.expr("split(x.g, ' ')").alias("w"))
    return rows.select(_chain("w").alias("hash"), F.size("w").alias("k"), "n").distinct()


def _chain(words: str) -> Column:
    """Hash of a short word array by its words' hashes."""
    return F.expr(f"aggregate({words}, 42L, (a, w) -> xxhash64(a, xxhash64(w)))")


def _hits(docs: DataFrame, probes: DataFrame, size: int) -> DataFrame:
    """(id, words, n, at): windows sizes n asked for around word ``at``, for probes of ``size`` words."""
    chain = "42L"
    for j in range(size):
        chain = f"xxhash64({chain}, hw[i + {j}])"
    rows = docs.withColumn("hw", F.expr("transform(words, w -> xxhash64(w))"))
    # a step of its own: the exploding join then runs in generated code, which does not copy the words to every row;
    # an outer explode, since Spark would else put a filter on the array's size below the steps that make it
    rows = rows.select("id", "words", F.expr(f"if(size(hw) < {size}, null, transform(sequence(0, size(hw) - {size}), "
                                             f"i -> {chain}))").alias("hashes"))
    rows = rows.select("id", "words", F.posexplode_outer("hashes").alias("at", "hash"))
    return rows.join(F.broadcast(probes.where(F.col("k") == size).select("hash", "n")), "hash").select("id", "words", "n", "at")


def windows(docs: DataFrame, probes: DataFrame, size: int) -> DataFrame:
    """(id, n, start, words): every window of n words (or the whole shorter document) that holds a probe."""
    hits = _hits(docs, probes, size)
    starts = F.expr(f"sequence(greatest(0, least(at - n + {size}, size(words) - n)), greatest(0, least(at, size(words) - n)))")
    rows = hits.select("id", "n", "words", F.explode_outer(starts).alias("start"))
    return rows.select("id", "n", "start", F.expr("slice(words, start + 1, n)").alias("words"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", threshold: float = THRESHOLD, radius: int = RADIUS,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, item, start, n_words, hamming, similarity): the best window of each pair of document and item that match.

    Ties go to the first window. Rows that repeat an id count as one document; repeated item ids as one item.
    """
    known = cut(items(benchmark, item_col, item_text), "items")
    probes = cut(_probes(known, threshold), "probes")
    counts = {r["k"]: r["n"] for r in probes.groupBy("k").agg(F.count("*").alias("n")).collect()}
    words = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    found = None
    for size, count in sorted(counts.items()):
        passes = math.ceil(count / block_rows)
        for block in range(passes):
            part = probes.where(F.pmod("hash", F.lit(passes)) == block) if passes > 1 else probes
            got = windows(words, part, size)
            found = got if found is None else found.union(got)
    masks = blocks(radius)
    right = known.select("item", "n", F.col("grams").alias("item_grams"), F.col("fp").alias("item_fp"), blocked("fp", masks))
    if found is None:
        found = words.where(F.lit(False)).select("id", F.lit(0).alias("n"), F.lit(0).alias("start"), "words")
    # written, so that the fingerprint is computed once per window and not in every expression that uses it
    left = cut(found.distinct().withColumn("fp", fingerprint(shingles("words"))), "windows")
    left = left.select("id", "n", "start", "words", "fp", blocked("fp", masks))
    first = "array_position(transform(array({}), m -> ((fp ^ item_fp) & m) = 0), true) - 1".format(", ".join(f"{m}L" for m in masks))
    pairs = left.join(right, ["n", "block", "value"]).where(
        (F.bit_count(F.expr("fp ^ item_fp")) <= radius) & (F.col("block") == F.expr(first)))
    pairs = pairs.select("id", "item", "start", F.size("words").alias("n_words"), F.bit_count(F.expr("fp ^ item_fp")).alias("hamming"),
                         weighted_similarity(shingles("words"), "item_grams").alias("similarity"))
    pairs = pairs.where(F.col("similarity") >= threshold)
    best = pairs.groupBy("id", "item").agg(F.min(F.struct(
        (-F.col("similarity")).alias("s"), "start", "n_words", "hamming")).alias("best"))
    return best.select("id", "item", "best.start", "best.n_words", "best.hamming", (-F.col("best.s")).alias("similarity"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, as they were, in which no item was found."""
    name = fresh(docs, "__found")
    found = cut(contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("id").alias(name)).distinct(), "leaks")
    return docs.join(found, docs[id_col].eqNullSafe(found[name]), "left_anti")
