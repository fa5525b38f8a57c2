"""Blocks of keys: state in Python costs about a millisecond a group and batch, so that many keys share a group and its state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed for the life of a checkpoint. A batch reads and rewrites the blocks of its keys, whatever the number of keys in each.
BLOCKS = 512


def block_of(key: Column | str, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
