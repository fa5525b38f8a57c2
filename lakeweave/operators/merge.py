"""Upserts on plain files: the result is a new DataFrame, written to a new location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import latest_by_key


def last_change_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """At most one incoming row per key, the newest, so that a merge is unambiguous."""
    return latest_by_key(changes, keys, order)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str],
           update: Sequence[str]) -> DataFrame:
    """Existing keys take the ``update`` columns of the change, new keys are added whole.

    ``changes`` must hold one row per key; a null key equals a null key. The target is joined left, so it is not shuffled at
    all while the changes are small enough for Spark to broadcast.
    """
    incoming = changes.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.lit(True).alias("__hit"),
                              *[F.col(c).alias(f"__u_{c}") for c in update])
    on = None
    for key in keys:
        match = F.col(key).eqNullSafe(F.col(f"__k_{key}"))
        on = match if on is None else on & match
    merged = target.join(incoming, on, "left").select(
        *[F.when(F.col("__hit"), F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
          for c in target.columns])
    return merged.unionByName(insert_new(target, changes, keys).select(
        *[c for c in target.columns if c in changes.columns]), allowMissingColumns=True)


def insert_new(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes whose key the target does not hold."""
    held = target.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    on = None
    for key in keys:
        match = F.col(key).eqNullSafe(F.col(f"__k_{key}"))
        on = match if on is None else on & match
    return changes.join(held, on, "left_anti")


def daily_summary(summaries: DataFrame, counts: DataFrame, day: str = "summary_date") -> DataFrame:
    """One summary row per day: a re-run replaces the day's row instead of adding one."""
    measures = [name for name in summaries.columns if name != day]
    return upsert(summaries, counts, [day], measures)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace a table's whole content."""
    df.write.mode("overwrite").parquet(path)
