"""Links between distinct texts whose sets of word shingles have a Jaccard similarity of t or more: a prefix-filter join.

0. *Texts that may have a partner.* In the order of the hashes, texts of similarity t share the first l of their common
   shingles within the first m - ceil(t m) + l of each (of its m). With l = m / 10 every text sends three tenths of its
   shingles, packed, to a bucket of the hash; a text stays if l of those it sent were sent by others as well. Passages shared by
   unlike texts fill too little of it to keep them.
1. *Shared shingles.* Each text that stays sends all its distinct shingle hashes, packed, to a bucket of the hash; there the
   equal texts are folded and the shingles that only one text has are dropped. What is left goes packed to a bucket of the text.
2. *Prefixes.* Two texts of similarity t share one of the m - ceil(t m) + 1 rarest shingles of each (of its m). Those of
   one text only lead nowhere, so a text with more than that many of them is in no pair at all; few texts remain.
3. *Candidates.* Texts that share a prefix shingle. Shingles of the same texts are folded to one first. Each shingle's
   texts are first compared with a few leads, the texts with the fewest shingles of their own, and only pairs that are
   not connected afterwards are compared one by one. Both go by classes first: texts of one size that hold the shingle at
   one place of their order. A pair first meets at the earliest shingle that both have, so that no more can be common
   than this and what follows it in the shorter rest; classes for which that is too little are never opened.
4. *Verification.* The exact similarity of each candidate pair: a shingle that one text has alone is in no intersection, so
   the shared ones and the sizes suffice.

Every pair of similarity t or more is a link or connected by links, and every link has that similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .packed import bucket_count, pack, unpack
from .state import cut
from .text import IS_SPACE, LOWER, RangeHash, slices, word_bounds

FEW_ROWS = 500  # texts held as Python objects at a time
FLUSH = 1 << 22  # shingles that a task holds before it sends them
BITS, PART = 1 << 26, 1 << 15  # bits of the map of texts, and of each part that Spark builds (4 KB)
LEADS = 8
COMMON = 10  # a text must share one in so many of its shingles within what it sends first
SLACK = 1e-9


def spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, place, length): the words one space apart, and where each begins there. A shingle is one cut of it."""
    length = end - start
    place = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int(place[-1] + length[-1]), 0x20, np.uint8)
    joined[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = data[~IS_SPACE[data]]
    return joined, place, length


def shingle_sets(texts: pa.Array, shingle: int):
    """(node, m, hash, row) of each slice of texts: a hash of each text's words and its m distinct shingles; texts without words are left out."""
    for part in slices(texts):
        data = LOWER[part.data]
        start, end, row = word_bounds(data, part.offsets)
        if not len(start):
            continue
        joined, place, length = spaced(data, start, end)
        counts = np.bincount(row)
        counts = counts[counts > 0]
        first = np.cumsum(counts) - counts
        text, stop = joined.tobytes(), place + length
        node = np.fromiter((xxhash.xxh3_64_intdigest(text[a:b]) for a, b in
                            zip(place[first].tolist(), stop[first + counts - 1].tolist())), np.uint64, len(first))
        grams = np.maximum(1, counts - shingle + 1)
        owner = np.repeat(np.arange(len(first)), grams)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams) + first[owner]
        hashes = RangeHash(joined)(place[at], stop[at + np.minimum(shingle, counts)[owner] - 1])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
        hashes, owner = hashes[new], owner[new]
        yield node, np.bincount(owner, minlength=len(node)).astype(np.uint32), hashes, owner


def _differences(column: np.ndarray) -> np.ndarray:
    return np.diff(column, prepend=column.dtype.type(0))


def least_common(m: np.ndarray, similarity: float) -> np.ndarray:
    """The fewest shingles that a text of m and any partner of it have in common."""
    return np.ceil(similarity * m.astype(np.int64) - SLACK).astype(np.int64)


def early(m: np.ndarray, owner: np.ndarray, similarity: float) -> np.ndarray:
    """Which shingles, in order of owner and hash, each text sends first: so many that l = m / ``COMMON`` common ones must be among them."""
    m = m.astype(np.int64)
    place = np.arange(len(owner)) - (np.cumsum(m) - m)[owner]
    return place < (m - least_common(m, similarity) + np.maximum(1, m // COMMON))[owner]


def _send(shingle: int, buckets: int, similarity: float | None = None):
    """Packed shingles by bucket: of every text in a batch all, or with a ``similarity`` the ``early`` ones."""
    def flush(held):
        base = np.cumsum([0, *(len(h[0]) for h in held)])
        node, m, hashes = (np.concatenate([h[c] for h in held]) for c in range(3))
        owner = np.concatenate([h[3] + b for h, b in zip(held, base)])
        held.clear()
        bucket = hashes % np.uint64(buckets)
        order = np.lexsort((hashes, bucket))
        hashes, owner, bucket = hashes[order], owner[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = slice(edges[k], edges[k + 1])
            used, at = np.unique(owner[own], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(_differences(hashes[own]), at.astype(np.uint32),
                                                                                       node[used], m[used])], pa.binary())],
                                             names=["bucket", "payload"])

    def run(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            for node, m, hashes, owner in shingle_sets(batch.column(0), shingle):
                fresh = np.zeros(len(node), bool)
                for i, n in enumerate(node.tolist()):
                    if n not in seen:
                        seen.add(n)
                        fresh[i] = True
                keep = fresh[owner] if similarity is None else fresh[owner] & early(m, owner, similarity)
                held.append((node[fresh], m[fresh], hashes[keep], (np.cumsum(fresh) - 1)[owner[keep]]))
                size += int(keep.sum())
                if size >= FLUSH:
                    yield from flush(held)
                    held, size, seen = [], 0, set()
        if size:
            yield from flush(held)
    return run


def _shared(buckets: int, count: bool = False):
    """The shingles of a bucket that two distinct texts have, dealt out by text, with the number of texts; or how many of them each text has."""
    def run(table):
        parts = [unpack(p) for p in table.column("payload").to_pylist()]
        hashes = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        node = np.concatenate([p[2][p[1]] for p in parts])
        m = np.concatenate([p[3][p[1]] for p in parts])
        order = np.lexsort((node, hashes))
        hashes, node, m = hashes[order], node[order], m[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (node[1:] != node[:-1]))
        hashes, node, m = hashes[new], node[new], m[new]
        begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        size = np.diff(np.append(begin, len(hashes)))
        df = np.repeat(size, size).astype(np.uint32)
        keep = df > 1
        hashes, node, m, df = hashes[keep], node[keep], m[keep], df[keep]
        if count:
            node, at, df = np.unique(node, return_index=True, return_counts=True)
            m, hashes, df = m[at], hashes[:0], df.astype(np.uint32)
        bucket = node % np.uint64(buckets)
        order = np.lexsort((node, bucket))
        hashes, node, m, df, bucket = hashes if count else hashes[order], node[order], m[order], df[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        found = np.flatnonzero(np.diff(edges)).tolist()
        packed = [pack(_differences(node[own]), m[own], hashes[own], df[own]) for own in (slice(edges[k], edges[k + 1]) for k in found)]
        return pa.table([pa.array(found, pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "payload"])
    return run


def _prefixes(similarity: float):
    """(node, m, shared, slots, tokens): the shared shingles of each text that may be in a pair, rarest first; the first ``slots`` are its prefix."""
    def run(table):
        parts = [unpack(p) for p in table.column("payload").to_pylist()]
        node = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        m, hashes, df = (np.concatenate([p[c] for p in parts]) for c in (1, 2, 3))
        order = np.lexsort((hashes, df, node))
        node, m, hashes = node[order], m[order].astype(np.int64), hashes[order]
        begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        size = np.diff(np.append(begin, len(node)))
        slots = size - least_common(m[begin], similarity) + 1
        chosen = slots > 0
        tokens = hashes[np.repeat(chosen, size)].view(np.int64)
        begin, size, slots = begin[chosen], size[chosen], slots[chosen]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(tokens))
        return pa.table([pa.array(node[begin].view(np.int64)), pa.array(m[begin], pa.int32()), pa.array(size, pa.int32()),
                         pa.array(slots, pa.int32()), lists], names=["node", "m", "shared", "slots", "tokens"])
    return run


def _partnered(similarity: float):
    """(node) of the texts of which enough early shingles are shared: what the smallest possible partner asks for."""
    def run(table):
        parts = [unpack(p) for p in table.column("payload").to_pylist()]
        node = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        m, shared = (np.concatenate([p[c] for p in parts]) for c in (1, 3))
        node, at, own = np.unique(node, return_index=True, return_inverse=True)
        shared = np.bincount(own, shared, minlength=len(node))
        chosen = shared >= np.maximum(1, least_common(m[at], similarity) // COMMON)
        return pa.table([pa.array(node[chosen].view(np.int64))], names=["node"])
    return run


def nodes(texts: pa.Array) -> np.ndarray:
    """The hash of each text's lower-cased words, as in ``shingle_sets``."""
    return np.fromiter((xxhash.xxh3_64_intdigest(b" ".join((t or "").encode().lower().split()))
                        for at in range(0, len(texts), FEW_ROWS) for t in texts.slice(at, FEW_ROWS).to_pylist()), np.uint64, len(texts))


def _bits(partnered: DataFrame) -> bytes:
    """A bitmap of ``BITS`` bits, one set for each node: of fixed size, whatever the number of nodes."""
    at = F.pmod("node", F.lit(BITS))
    parts = partnered.groupBy(F.floor(at / PART).alias("part")).agg(F.bitmap_construct_agg((at % PART)).alias("bits")).collect()
    out = bytearray(BITS // 8)
    for r in parts:
        out[r.part * PART // 8:(r.part + 1) * PART // 8] = r.bits
    return bytes(out)


def _marked(bits: bytes):
    def run(batches):
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            at = nodes(batch.column(0)) % np.uint64(BITS)
            yield batch.filter(pa.array((table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)))
    return run


def _partner_bits(texts: DataFrame, similarity: float, shingle: int) -> bytes:
    """The bitmap of the texts (text) that may have a partner, by the early shingles of all."""
    buckets = bucket_count(texts.sparkSession, 1)
    sent = texts.mapInArrow(_send(shingle, buckets, similarity), "bucket int, payload binary")
    counts = sent.groupBy("bucket").applyInArrow(_shared(buckets, count=True), "bucket int, payload binary")
    return _bits(counts.groupBy("bucket").applyInArrow(_partnered(similarity), "node long"))


def with_partners(texts: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The rows (text) that may have a partner, by the early shingles of all texts; no row with one is lost, others may stay.

    Texts are not shuffled: each task looks its own up in a bitmap of their hashes. The fuller it is, the more rows stay.
    """
    return texts.mapInArrow(_marked(_partner_bits(texts, similarity, shingle)), "text string")


def candidates(docs: DataFrame, text_col: str, similarity: float, shingle: int) -> DataFrame:
    """(node, m, shared, slots, tokens) of every distinct text that may have a partner; see ``_prefixes``.

    Texts are looked up and sent by one Python worker: two after one another would double a task's memory.
    """
    buckets = bucket_count(docs.sparkSession, 1)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    stays, send = _marked(_partner_bits(texts, similarity, shingle)), _send(shingle, buckets)
    sent = texts.mapInArrow(lambda batches: send(stays(batches)), "bucket int, payload binary")
    shared = sent.groupBy("bucket").applyInArrow(_shared(buckets), "bucket int, payload binary")
    rows = shared.groupBy("bucket").applyInArrow(_prefixes(similarity),
                                                 "node long, m int, shared int, slots int, tokens array<long>")
    return cut(rows, "prefixes")


def _possible(similarity: float) -> Column:
    """False where sizes and places of the first common shingle rule the similarity of a and b out."""
    rest = F.least(F.col("a_m") - F.col("a_place"), F.col("b_m") - F.col("b_place"))
    return rest * (1 + similarity) >= similarity * (F.col("a_m") + F.col("b_m")) - SLACK


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose exact similarity is ``similarity`` or more."""
    left = texts.select(F.col("node").alias("a"), F.col("m").alias("a_m"), F.col("tokens").alias("a_tokens"))
    right = texts.select(F.col("node").alias("b"), F.col("m").alias("b_m"), F.col("tokens").alias("b_tokens"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return pairs.join(left, "a").join(right, "b").where(
        both * (1 + similarity) >= similarity * (F.col("a_m") + F.col("b_m")) - SLACK).select("a", "b")


def links(texts: DataFrame, similarity: float, seeds: DataFrame | None = None, leads: int = LEADS) -> DataFrame:
    """(a, b): links of exact similarity that connect all pairs of it among the ``candidates``. ``seeds``: pairs to try first."""
    at = F.posexplode(F.expr("slice(tokens, 1, slots)")).alias("k", "token")
    rows = texts.select("node", "m", "shared", at).select("token", "node", "m", "shared", (F.col("m") - F.col("shared") + F.col("k")).alias("place"))
    marks = rows.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
                                      F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y")).where("n > 1")
    # of shingles with the same texts the first in the order of a text, which is that of unsigned hashes: it is where they meet
    unsigned = F.col("token").bitwiseXOR(F.lit(-1 << 63))
    rows = cut(rows.join(marks.groupBy("n", "x", "y").agg(F.min_by("token", unsigned).alias("token")).select("token"), "token"), "tokens")
    named = ("node", "m", "place")
    a, b = (rows.select("token", *[F.col(c).alias(f"{side}_{c}") for c in named], F.col("shared").alias(f"{side}_shared")) for side in "ab")
    pair = [F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")]
    rank = F.row_number().over(Window.partitionBy("token").orderBy(F.desc(F.col("a_shared") / F.col("a_m")), "a_node"))
    first = a.withColumn("rank", rank).where(F.col("rank") <= leads).drop("rank")
    tried = first.join(b, "token").where((F.col("a_node") != F.col("b_node")) & _possible(similarity)).select(*pair)
    if seeds is not None:
        tried = tried.union(seeds.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    tried = cut(tried.distinct(), "tried")
    sure = cut(verified(tried, texts, similarity), "links")
    # what the leads left apart: pairs of different components, from the classes that can hold any
    rows = rows.join(components(sure), "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = cut(rows.groupBy("token", "m", "place").agg(F.min("component").alias("low"), F.max("component").alias("high")), "classes")
    apart = classes.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("g")).where("l != g").select("token")
    a, b = (classes.join(apart, "token").select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("m", "place", "low", "high")]) for side in "ab")
    mixed = (F.col("a_low") != F.col("b_high")) | (F.col("a_high") != F.col("b_low"))
    ordered = (F.col("a_m") < F.col("b_m")) | ((F.col("a_m") == F.col("b_m")) & (F.col("a_place") <= F.col("b_place")))
    open_classes = cut(a.join(b, "token").where(ordered & mixed & _possible(similarity)).select(
        "token", "a_m", "a_place", "b_m", "b_place"), "open")
    a, b = (rows.select("token", *[F.col(c).alias(f"{side}_{c}") for c in (*named, "component")]) for side in "ab")
    rest = open_classes.join(a, ["token", "a_m", "a_place"]).join(b, ["token", "b_m", "b_place"]).where(
        F.col("a_component") != F.col("b_component")).select(*pair).distinct()
    return sure.union(verified(rest.join(tried, ["a", "b"], "left_anti"), texts, similarity))
