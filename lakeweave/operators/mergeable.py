"""Partial aggregates that are stored per fine group and merged later without a rescan: distinct counts and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS, SKETCH = "id_block", "id_bits", "sketch"
#: k of a sketch: the error of a rank is about 1.65 / k ** 0.9 of the rows or less, for any number of rows and merges.
SKETCH_K = 400


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys, id_block, id_bits): which whole numbers occur per group, exactly, one row of 4 KB per block of 32 768 numbers.

    Meant for dense numbers such as surrogate keys. Nulls are left out; a group of nulls alone has no row.
    """
    return (df.filter(F.col(number).isNotNull())
            .groupBy(*keys, F.bitmap_bucket_number(number).alias(BLOCK))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Exact distinct counts of coarser groups from stored bitmaps: blocks are united first, then counted."""
    united = bitmaps.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(keys, sketch): a mergeable quantile sketch per group, nulls left out; batch and streaming alike."""
    rows = df.filter(F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias(SKETCH))


def merged_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of a quantile's rank error, as a share of the rows, that all but about one in a hundred sketches keep."""
    return 2.3 / k ** 0.9


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """``p50``-like columns and the number of values from sketches."""
    def at(q: float) -> Column:
        return F.kll_sketch_get_quantile_double(SKETCH, F.lit(q))
    return sketches.select(*keys, F.kll_sketch_get_n_double(SKETCH).alias("n"), *[at(q).alias(f"p{round(q * 100)}") for q in quantiles])
