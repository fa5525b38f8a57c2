"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import cut


def _star(edges: DataFrame, keep: str) -> DataFrame:
    """Link the neighbours of each node that pass ``keep`` to the least node among it and all that pass or are smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable over ``edges`` (a, b), for every node that has an edge.

    Alternates large stars and small stars until nothing changes; each round is a few aggregations and joins over the
    edges, which end as one star per component. Raises if ``rounds`` do not suffice (they grow with the logarithm
    of the longest path).
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
                "edges")
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "v > u").select("u", "v").distinct()
        # small star: only smaller neighbours, which move to the least of them; the node itself too
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
