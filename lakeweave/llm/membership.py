"""Large rows and the keys that concern some of them, told apart without a shuffle of the rows.

A bitmap of the keys' hashes goes to every task. A row whose bit is not set has none of the keys; rows whose bit is set are left
to a join, which decides. The bitmap has a fixed bound: beyond it more rows go through the join, and no result changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .state import fresh

BITS, PART = 1 << 26, 1 << 15  # most bits of a map (8 MB), and those of each part, which is a row (4 KB)
EACH = 32  # bits for a key, below the bound: one row in so many is taken for one by chance


def told_apart(rows: DataFrame, key: Sequence[Column], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(may, cannot): the rows whose ``key`` may be one of ``keys``, and those whose key is none of them.

    The columns of ``keys`` are in the order and of the types of ``key``; nulls count as equal. ``rows`` and ``keys`` are read twice.
    """
    size = min(BITS, max(PART, 1 << (EACH * keys.count()).bit_length()))
    part, bits = fresh(rows, "__part"), fresh(rows, "__bits")
    at = F.pmod(F.xxhash64(*keys.columns), F.lit(size))
    parts = keys.groupBy(F.floor(at / PART).alias(part)).agg(F.bitmap_construct_agg(at % PART).alias(bits))
    own = F.pmod(F.xxhash64(*key), F.lit(size))
    marked = rows.join(F.broadcast(parts), F.floor(own / PART) == F.col(part), "left")
    byte = F.conv(F.hex(F.substring(bits, F.floor(own % PART / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (own % 8).cast("int")) == 1, F.lit(False))
    return marked.where(hit).drop(part, bits), marked.where(~hit).drop(part, bits)
