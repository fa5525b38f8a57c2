"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels in a score window.

Vectors become whole numbers, floor(scale * x), and a score is their exact inner product. Tiles of rows meet tiles of anchors,
each pair of tiles in one task of bounded size, twice: for the positives, then for the negatives in the windows that the
positives' scores set. Within a tile every anchor scans the columns by BOND: dimensions lie apart, they are read in the
anchor's order of descending magnitude, a few at a time, and after each step the least and greatest contribution that the unread
dimensions of the tile can make bound every score from both sides. Rows that cannot be among the first, or cannot fall
into any window, leave the candidate bitmap; what remains is scored to the end and is exact. Tiles return their own
first rows, and a rank per anchor picks from those.

Nothing is approximate or capped; ties go to the smaller id. Rows without an id, a label or a vector, or with a null or
non-finite component, take no part. Rows that repeat an id are rows of their own, but never a positive of an anchor with the same id;
each of several anchor rows with one id gets its own result rows. Missing dimensions of a shorter vector count as zero. Components
beyond +-2**LIMIT_BITS after scaling are taken as that bound, so that scores fit 64 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .state import cut

SCALE, LIMIT_BITS = 256, 26
TILE_ROWS, LEAST_ROWS, TILE_ANCHORS = 32_768, 512, 16_384
STEP = 8  # dimensions read between two looks at the bounds


def prepared(rows: DataFrame, id_col: str, vec_col: str, label_col: str, anchors: Column, scale: int = SCALE) -> DataFrame:
    """(row, id, label, anchor, v): the rows that take part, numbered, their vectors as whole numbers."""
    vec, bound = F.col(vec_col), float(1 << LIMIT_BITS)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vec, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(bound)), F.lit(-bound))).cast("int"))
    part = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vec.isNotNull() & finite
    return rows.where(part).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                                   F.coalesce(anchors, F.lit(False)).alias("anchor"), whole.alias("v"))


def columns_of(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as an array of dimensions x rows, filled up with zeros."""
    vectors = vectors.combine_chunks()
    vectors = pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors
    size = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == width).all():
        return np.ascontiguousarray(flat.reshape(len(size), width).T)
    out = np.zeros((width, len(size)), np.int32)
    row = np.repeat(np.arange(len(size)), size)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), row] = flat
    return out


def exact_type(columns: np.ndarray, anchors: np.ndarray) -> type:
    """The narrowest type in which every partial score of the two sets is exact."""
    most = [float(np.abs(x.astype(np.int64)).max(initial=0)) for x in (columns, anchors)]
    reach = most[0] * most[1] * max(1, len(columns))
    return np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else np.int64


class Tile:
    """Columns of some rows, in the order of their ids, with the least and greatest value of each dimension."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray):
        self.ids, self.columns = ids, columns
        self.low, self.high = (columns.min(axis=1), columns.max(axis=1)) if len(ids) else (np.zeros(len(columns), columns.dtype),) * 2

    def take(self, chosen: np.ndarray) -> Tile:
        return Tile(self.ids[chosen], np.ascontiguousarray(self.columns[:, chosen]))

    def scan(self, query: np.ndarray, alive_after, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the rows that ``alive_after(lower, upper)`` leaves on the bitmap until all dimensions are read.

        ``lower`` and ``upper`` bound the scores of the rows still on it.
        """
        order = np.argsort(-np.abs(query), kind="stable")
        ends = query[order] * np.stack([self.low[order], self.high[order]])
        rest_low, rest_high = (np.concatenate([np.cumsum(x[::-1])[::-1], x[:0].sum(keepdims=True)]) for x in (ends.min(axis=0), ends.max(axis=0)))
        rows, partial = np.arange(len(self.ids)), np.zeros(len(self.ids), self.columns.dtype)
        whole = True
        for at in range(0, len(order), step):
            dims = order[at:at + step]
            read = self.columns[dims] if whole else self.columns[np.ix_(dims, rows)]
            partial = partial + query[dims] @ read
            done = min(at + step, len(order))
            keep = alive_after(partial + rest_low[done], partial + rest_high[done])
            if not keep.all():
                rows, partial, whole = rows[keep], partial[keep], False
                if not len(rows):
                    break
        return rows, partial


def first_ones(rows: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` highest scores, ties by the smaller row."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        keep = scores >= least
        rows, scores = rows[keep], scores[keep]
    order = np.argsort(-scores, kind="stable")[:most]
    return rows[order], scores[order]


def nearest(tile: Tile, query: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the ``most`` nearest of a tile."""
    def alive(lower, upper):
        if len(lower) <= most:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, len(lower) - most)[len(lower) - most]

    return first_ones(*tile.scan(query, alive), most)


def in_windows(tile: Tile, query: np.ndarray, windows: list[tuple[int, int]], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (least, greatest score) the rows and scores of its ``most`` nearest of a tile."""
    def alive(lower, upper):
        keep = np.zeros(len(lower), bool)
        for least, greatest in windows:
            sure = lower[(lower >= least) & (upper <= greatest)]
            floor = max(least, np.partition(sure, len(sure) - most)[len(sure) - most]) if len(sure) > most else least
            keep |= (upper >= floor) & (lower <= greatest)
        return keep

    rows, scores = tile.scan(query, alive)
    out = []
    for least, greatest in windows:
        inside = (scores >= least) & (scores <= greatest)
        out.append(first_ones(rows[inside], scores[inside], most))
    return out


def _opened(rows: pa.Table, anchors: pa.Table):
    """The tile of the rows by label, and for each label that an anchor has (anchor numbers, queries, rows of it, others)."""
    width = max((int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (rows, anchors)), default=0)
    columns, queries = columns_of(rows.column("v"), width), columns_of(anchors.column("v"), width)
    kind = exact_type(columns, queries)
    ids = rows.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    tile = Tile(ids[order], columns[:, order].astype(kind))
    queries = np.ascontiguousarray(queries.T.astype(kind))
    own, theirs = (t.column("label").to_numpy(zero_copy_only=False) for t in (rows, anchors))
    own = own[order]
    for label in sorted(set(theirs)):
        yield np.flatnonzero(theirs == label), queries, tile, own == label


def _positives(most: int):
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and anchors.num_rows:
            number, anchor_ids = anchors.column("row").to_numpy(), anchors.column("id").to_numpy()
            for chosen, queries, tile, same in _opened(rows, anchors):
                part = tile.take(same)
                repeated = (part.ids[1:] == part.ids[:-1]).any()
                for a in chosen:  # a row of the anchor's own id is no positive
                    near = part.take(part.ids != anchor_ids[a]) if repeated else part
                    found, scores = nearest(near, queries[a], most + 1) if len(near.ids) else ([], [])
                    for r, s in zip(found, scores):
                        if near.ids[r] != anchor_ids[a]:
                            for column, value in zip(out, (number[a], near.ids[r], int(s))):
                                column.append(value)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)
    return run


def _negatives(most: int, low: int, high: int):
    names = ("row", "place", "id", "score")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[] for _ in names]
        if rows.num_rows and anchors.num_rows:
            number, limits = anchors.column("row").to_numpy(), anchors.column("scores").to_pylist()
            for chosen, queries, tile, same in _opened(rows, anchors):
                part = tile.take(~same)
                if not len(part.ids):
                    continue
                for a in chosen:  # integer bounds of low * positive <= 100 * negative <= high * positive
                    windows = [(-(-low * s // 100), high * s // 100) for s in limits[a]]
                    for place, (found, scores) in enumerate(in_windows(part, queries[a], windows, most)):
                        for r, s in zip(found, scores):
                            for column, value in zip(out, (number[a], place, part.ids[r], int(s))):
                                column.append(value)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)
    return run


def _meeting(rows: DataFrame, anchors: DataFrame, run, ddl: str, row_tiles: int, anchor_tiles: int) -> DataFrame:
    """``run`` over every pair of a tile of rows and a tile of anchors."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = rows.select("id", "label", "v", dealt(row_tiles).alias("tile"), every(anchor_tiles).alias("side"))
    right = anchors.withColumn("side", dealt(anchor_tiles)).withColumn("tile", every(row_tiles))
    return left.groupBy("tile", "side").cogroup(right.groupBy("tile", "side")).applyInArrow(run, ddl)


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE,
         tile_rows: int = TILE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the rows. An anchor's positives are its first ``positives`` other rows of its label; for
    each, the first ``negatives`` rows of other labels with low % to high % of the positive's score are returned.
    """
    spark = rows.sparkSession
    vectors = cut(prepared(rows, id_col, vec_col, label_col, anchors, scale), "vectors")
    total, chosen = vectors.agg(F.count("*"), F.count_if("anchor")).first()
    share = math.ceil(total / int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    row_tiles = max(1, math.ceil(total / min(tile_rows, max(LEAST_ROWS, share))))
    anchor_tiles = max(1, math.ceil(chosen / TILE_ANCHORS))
    asked = vectors.where("anchor").select("row", "id", "label", "v")

    near = _meeting(vectors, asked, _positives(positives), "row long, id long, score long", row_tiles, anchor_tiles)
    by_anchor = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    near = near.withColumn("n", F.row_number().over(by_anchor)).where(F.col("n") <= positives)
    lists = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("p"))
    aimed = cut(asked.join(lists, "row").select("row", "id", "label", "v", F.col("p.id").alias("ids"), F.col("p.score").alias("scores")), "positives")

    far = _meeting(vectors, aimed.drop("ids"), _negatives(negatives, low, high), "row long, place long, id long, score long", row_tiles, anchor_tiles)
    by_positive = Window.partitionBy("row", "place").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(by_positive)).where(F.col("rank") <= negatives)
    place = F.col("place").cast("int")
    return far.withColumnRenamed("id", "negative_id").join(aimed.select("row", "id", "ids", "scores"), "row").select(
        F.col("id").alias("anchor_id"), F.col("ids")[place].alias("positive_id"), "rank", "negative_id",
        F.col("scores")[place].alias("positive_score"), F.col("score").alias("negative_score"))
