"""Nearest neighbours by largest inner product, over learned partitions.

A bounded sample of vectors is joined to its nearest neighbours by brute force; this graph is cut into parts of nearly equal size
with few edges between them. A small classifier learns from it in which parts the neighbours of a vector lie. Every vector
of the table is filed in its most probable part. A query is routed to its most probable parts, so many that the sample's
own neighbours would have been found at the wanted recall, and all vectors filed there are ranked by the exact product.

Equal vectors are one entry with its smallest ids (no more than can appear in a result), so a common vector costs one row.
Parts are split into blocks of bounded size, and so are the queries that meet them: one task never holds a whole part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import bounded
from .state import cut

FIT_ROWS = 6_000
PARTS = 32
RECALL = 0.95
BLOCK_ROWS = 4_096
GRAPH = 10


def usable(vector: Column) -> Column:
    """True for vectors that take part: not null, not zero, all components present and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbours(x: np.ndarray, k: int, block: int = 1_024) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out; by brute force in blocks."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for i in range(0, len(x), block):
        score = x[i:i + block] @ x.T
        score[np.arange(len(score)), np.arange(i, i + len(score))] = -np.inf
        out[i:i + block] = np.argpartition(-score, out.shape[1] - 1, axis=1)[:, :out.shape[1]] if out.shape[1] else out[i:i + block]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Part of each row: seeded by centroids, then rows move to the part of most of their neighbours while sizes stay within slack."""
    rng = np.random.default_rng(seed)
    room = int(np.ceil(len(x) / parts * (1 + slack)))
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    centres = unit[rng.choice(len(x), parts, replace=False)]
    for _ in range(rounds):
        score = unit @ centres.T
        part, size = np.full(len(x), -1), np.zeros(parts, int)
        for i in np.argsort(-score.max(axis=1)):  # the surest rows choose first; full parts are passed over
            for p in np.argsort(-score[i]):
                if size[p] < room:
                    part[i], size[p] = p, size[p] + 1
                    break
        sums = np.zeros_like(centres)
        np.add.at(sums, part, unit)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    least = int(len(x) / parts * (1 - slack))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].reshape(-1)), 1)
        np.add.at(votes, (graph.reshape(-1), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain):
            if gain[i] <= 0:
                break
            if size[best[i]] < room and size[part[i]] > least:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass(frozen=True)
class Router:
    weights: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]

    def filed(self, x: np.ndarray) -> np.ndarray:
        return self.logits(x).argmax(axis=1)

    def routes(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :self.probes]


def fit(x: np.ndarray, parts: int = PARTS, wanted: int = 20, recall: float = RECALL, epochs: int = 30, seed: int = 2) -> Router:
    """Partition the neighbour graph of ``x``, train the softmax router and choose the number of parts to probe."""
    parts = max(1, min(parts, len(x) // 50))
    if parts == 1:
        return Router(np.zeros((x.shape[1] + 1, 1)), 1)
    graph = neighbours(x, GRAPH)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].reshape(-1)), 1.0)
    target[np.arange(len(x)), part] += GRAPH / 2
    target /= target.sum(axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    scale = 1 / max(1e-12, float(np.sqrt((x * x).sum(axis=1).mean())))
    data = np.hstack([x * scale, np.ones((len(x), 1))])
    weights, first, second, step = np.zeros((data.shape[1], parts)), 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for i in range(0, len(data), 128):
            rows = data[order[i:i + 128]]
            z = rows @ weights
            z = np.exp(z - z.max(axis=1, keepdims=True))
            slope = rows.T @ (z / z.sum(axis=1, keepdims=True) - target[order[i:i + 128]]) / len(rows)
            step += 1
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
            weights = weights - 0.02 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights[:-1] *= scale
    router = Router(weights, parts)
    near = neighbours(x, wanted)
    home = router.filed(x)
    place = np.argsort(np.argsort(-router.logits(x), axis=1, kind="stable"), axis=1)
    found = place[np.arange(len(x))[:, None], home[near]]
    probes = next(m for m in range(1, parts + 1) if (found < m).mean() >= recall)
    return Router(weights, probes)


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 0))


def _file_rows(router: Router):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                part = router.filed(_matrix(batch.column("vector"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])
    return run


def _route_rows(router: Router):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                parts = router.routes(_matrix(batch.column("vector"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(parts), pa.list_(pa.int32()))],
                                                 names=[*batch.schema.names, "parts"])
    return run


def _rank(wanted: int):
    """The best entries of one block for each query of one block, ids spelled out."""
    names = ["qkey1", "qkey2", "id", "score"]

    def run(left, right):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        queries, vectors = _matrix(left.column("vector")), _matrix(right.column("vector"))
        ids = right.column("ids").combine_chunks()
        counts = np.diff(ids.offsets.to_numpy())
        flat, begin = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets.to_numpy()[0]
        least = flat[begin[:-1]]
        keys = [left.column(c).to_numpy() for c in ("key1", "key2")]
        out = [[], [], [], []]
        for i in range(0, len(queries), 256):
            score = queries[i:i + 256] @ vectors.T
            for j, row in enumerate(score):
                if len(row) > wanted:
                    edge = np.partition(row, len(row) - wanted)[len(row) - wanted]
                    chosen = np.flatnonzero(row >= edge)
                else:
                    chosen = np.arange(len(row))
                chosen = chosen[np.lexsort((least[chosen], -row[chosen]))][:wanted]
                n = counts[chosen]
                at = np.repeat(begin[chosen], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                got, value = flat[at], np.repeat(row[chosen], n)
                order = np.lexsort((got, -value))[:wanted]
                out[0].append(np.full(len(order), keys[0][i + j]))
                out[1].append(np.full(len(order), keys[1][i + j]))
                out[2].append(got[order])
                out[3].append(value[order])
        return pa.table([pa.array(np.concatenate(c), k) for c, k in zip(out, kinds)], names=names)
    return run


def search(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", is_query: Column | None = None, wanted: int = 20,
           parts: int = PARTS, recall: float = RECALL, fit_rows: int = FIT_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the nearest found of each query row, itself left out, ties to the smaller id.

    Rows without an id, unusable vectors and vectors of another than the most frequent dimension (the smaller of equals) take
    no part. Rows that repeat an id and vector count once. With fewer candidates than wanted, all are returned.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    shape = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.where(F.size("vector") == (shape["d"] if shape else 0))
    rows = rows.withColumn("key1", F.xxhash64("vector")).withColumn("key2", F.xxhash64(F.lit(1), "vector"))
    asked = F.col("id") % 20 == 0 if is_query is None else is_query
    depth = wanted + 1  # a query may find itself
    first = F.row_number().over(Window.partitionBy("key1", "key2").orderBy("id"))
    entries = (rows.dropDuplicates(["key1", "key2", "id"]).withColumn("at", first).where(F.col("at") <= depth)
               .groupBy("key1", "key2").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min_by("vector", "id").alias("vector")))
    entries = cut(entries, "entries")
    sample = bounded(entries.select("key1", "vector"), "key1", fit_rows).orderBy("key1").toPandas()
    if not len(sample):
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0.0).alias("score")).where(F.lit(False))
    router = fit(np.stack(sample["vector"]).astype(np.float64), parts, wanted, recall)
    filed = cut(entries.mapInArrow(_file_rows(router), "key1 long, key2 long, ids array<long>, vector array<float>, part int"), "filed")
    queries = rows.where(asked).select("id", "key1", "key2").distinct()
    classes = queries.select("key1", "key2").distinct().join(entries.drop("ids"), ["key1", "key2"])
    routed = cut(classes.mapInArrow(_route_rows(router), "key1 long, key2 long, vector array<float>, parts array<int>")
                 .withColumn("part", F.explode("parts")).drop("parts"), "routed")
    # blocks per part, on both sides: at most as many rows as there are parts
    sizes = {r["part"]: math.ceil(r["n"] / block_rows) for r in filed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    asks = {r["part"]: math.ceil(r["n"] / block_rows) for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect()}

    def blocks(of: dict) -> Column:
        known = [x for p, n in sorted(of.items()) for x in (F.lit(p), F.lit(n))]
        return F.element_at(F.create_map(*known), F.col("part")) if known else F.lit(1)

    def own(n: Column) -> Column:
        return F.pmod(F.xxhash64("key1", "key2"), n).cast("int")

    def every(of: dict) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(blocks(of), F.lit(1)) - 1))

    left = routed.withColumn("qblock", own(blocks(asks))).withColumn("vblock", every(sizes))
    right = filed.withColumn("vblock", own(blocks(sizes))).withColumn("qblock", every(asks)).select(
        "part", "vblock", "qblock", "vector", "ids")
    keys = ["part", "vblock", "qblock"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rank(depth), "qkey1 long, qkey2 long, id long, score double")
    order = [F.desc("score"), "id"]
    best = met.withColumn("at", F.row_number().over(Window.partitionBy("qkey1", "qkey2").orderBy(*order))).where(F.col("at") <= depth)
    pairs = queries.withColumnRenamed("id", "query_id").join(
        best, (F.col("key1") == F.col("qkey1")) & (F.col("key2") == F.col("qkey2"))).where("id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "key1", "key2").orderBy(*order))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= wanted).select("query_id", "rank", "id", "score")
