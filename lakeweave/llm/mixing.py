"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size says how often each of its documents is wanted. The whole part of that number is
taken outright; the fractional part is rounded so that the words taken keep their sum: two documents exchange words
at random (fairly, so that every document's expectation is kept) until one of them is taken once more or not at all, and the
other goes on to the next document. Each source is cut into buckets of bounded size by a hash of the id; every bucket leaves at
most one unsettled document, and these residuals are combined in a reduction tree until one per source is left, which is
settled by a last draw. A source therefore misses its target by less than one document.

The draws are seeded by source, level and bucket, and rows are ordered by size and id, so reruns agree. Rows that repeat an id
are rows of their own. Null texts have size 0 and are taken 0 times.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .state import cut, fresh

WEIGHTS = (3, 1, 2)
BUCKET_ROWS = 2_000
FAN_IN = 1_000


def word_count(text: Column) -> Column:
    """Number of runs of other bytes than 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, budget: float = 1.5, weights: tuple[int, ...] = WEIGHTS, most: float = 2.0) -> DataFrame:
    """(source, source_size, weight, target) from one row (source, source_size) per source.

    The budget times all sizes is shared by weight (repeating over sources in code point order, null last); what
    exceeds ``most`` times a source's size is reshared by weight among the others until none exceeds it. In order of
    size / weight the capped sources are a prefix, so the common level follows from running sums. One row per source.
    """
    count = len(weights)
    ranked = sizes.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % count + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("room", most * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("room", "at")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (budget * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("level", level)
    # the first source whose room is not below the level of those from it on sets the level for all
    common = F.min_by(F.when(F.col("room") >= F.col("level"), F.col("level")), F.struct(
        F.col("room") < F.col("level"), "room", "at")).over(everything)
    return ranked.withColumn("common", common).select(
        "source", "source_size", "weight",
        F.when(F.col("common").isNull() | (F.col("room") < F.col("common")), most * F.col("source_size"))
        .otherwise(F.col("common") * F.col("weight")).cast("double").alias("target"))


def _settle(sizes: np.ndarray, words: np.ndarray, rng: np.random.Generator, last: bool) -> int:
    """Pivotal rounding of ``words`` (0 to ``sizes``) in place; returns the row that stays unsettled, or -1."""
    draws = rng.random(len(sizes) + 1)
    active = -1
    for i in range(len(sizes)):
        if words[i] <= 0 or words[i] >= sizes[i]:
            continue
        if active < 0:
            active = i
            continue
        a, b = words[active], words[i]
        up, down = min(sizes[active] - a, b), min(a, sizes[i] - b)
        if draws[i] * (up + down) < down:
            a, b = a + up, b - up
        else:
            a, b = a - down, b + down
        words[active], words[i] = a, b
        eps = 1e-9 * max(sizes[active], sizes[i])
        for k in (active, i):
            if words[k] <= eps:
                words[k] = 0.0
            elif words[k] >= sizes[k] - eps:
                words[k] = sizes[k]
        open_rows = [k for k in (active, i) if 0 < words[k] < sizes[k]]
        active = open_rows[0] if open_rows else -1
    if last and active >= 0:
        words[active] = sizes[active] if draws[-1] * sizes[active] < words[active] else 0.0
        return -1
    return active


def _round(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree: settle each (source, bucket); at most one row of each stays open."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "key", "words"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        words = pdf["words"].to_numpy(float).copy()
        rng = np.random.default_rng([seed, level, int(key[0]) & (2**63 - 1), int(key[1])])
        stays = _settle(pdf["size"].to_numpy(float), words, rng, last)
        pdf["words"] = words
        pdf["open"] = np.arange(len(pdf)) == stays
        return pdf

    return rows.groupBy("source_key", "bucket").applyInPandas(run, rows.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: float = 1.5,
        weights: tuple[int, ...] = WEIGHTS, most: float = 2.0, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN,
        seed: int = 5) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every row.

    ``copies`` is how often the document is taken and ``taken`` its words times that; never over ceil(``most``) copies.
    """
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                            word_count(F.col(text_col)).alias("size")), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    wanted = cut(targets(per_source.select("source", "source_size"), budget, weights, most).join(
        per_source.select(F.col("source").alias("s2"), "rows"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2"), "targets")
    largest = wanted.agg(F.max("rows")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(wanted.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    rows = rows.withColumn("base", F.floor(F.least(ratio, F.lit(most)) + 1e-12)).withColumn(
        "words", F.greatest(F.lit(0.0), ratio - F.col("base")) * F.col("size"))
    rows = rows.select(
        "id", "source", "size", "source_size", "target", "base", "words", F.xxhash64("id").alias("key"),
        F.coalesce(F.xxhash64("source"), F.lit(0)).alias("source_key"), F.lit(False).alias("open"),
        F.pmod(F.xxhash64("id", F.lit("mix")), F.ceil(F.col("rows") / bucket_rows)).cast("long").alias("bucket"))
    buckets, level, settled = max(1, math.ceil(largest / bucket_rows)), 0, None
    while True:
        done = cut(_round(rows, level, buckets == 1, seed), f"mix-{level}")
        closed = done.where(~F.col("open"))
        settled = closed if settled is None else settled.unionByName(closed)
        if buckets == 1:
            break
        rows = done.where("open").withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("long")).withColumn("open", F.lit(False))
        buckets, level = math.ceil(buckets / fan_in), level + 1
    copies = (F.col("base") + F.when((F.col("words") > 0) & (F.col("words") >= F.col("size")), 1).otherwise(0)).cast("int")
    return settled.select("id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size"))


def expand(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row as it was, with a column ``copy`` that counts its copies from 1.

    Rows that repeat an id, source and size share their copies out in equal parts, the first ones one more.
    """
    taken = mix(docs, id_col, text_col, source_col, **options)
    groups = cut(taken.groupBy("id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")), "copies")
    repeated = bool(groups.where("rows > 1").limit(1).count())
    names = {c: fresh(docs, f"__{c}") for c in (*groups.columns, "at")}
    groups = groups.where("copies > 0").select(*[F.col(c).alias(names[c]) for c in groups.columns])
    same = (docs[id_col].eqNullSafe(groups[names["id"]]) & docs[source_col].cast("string").eqNullSafe(groups[names["source"]])
            & (word_count(docs[text_col]) == groups[names["size"]]))
    rows = docs.join(groups, same)
    copies = names["copies"]
    if repeated:
        place = Window.partitionBy(names["id"], names["source"], names["size"]).orderBy(F.xxhash64(text_col))
        rows = rows.withColumn(names["at"], F.row_number().over(place)).withColumn(copies, F.expr(
            f"cast(floor({copies} / {names['rows']}) as bigint) + if({names['at']} <= {copies} % {names['rows']}, 1, 0)"))
        rows = rows.where(F.col(copies) > 0)
    return rows.withColumn("copy", F.explode(F.expr(f"sequence(1L, cast({copies} as bigint))"))).drop(*names.values())
