"""Acting on each event once: a ledger of handled ids in hash buckets, compacted, of which a batch opens its own buckets only.

``delta/epoch=E/bucket=K/batch_id=N`` holds the ids of one batch, ``base/version=E/bucket=K`` all ids up to the end of epoch
E, an epoch being ``compact_every`` batches. To look up its ids a batch reads the newest base before its epoch and the deltas of
its epoch, both only in the buckets that its ids fall into: at most one base and an epoch of small files per bucket,
however long the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import keyed
from ..sources.layout import list_partitions, table_or_none
from .sinks import BATCH, complete_versions, per_batch

BUCKET = "bucket"
Action = Callable[[DataFrame, int], None]


def _part(spark: SparkSession, path: str, opened: list[int] | None) -> DataFrame | None:
    rows = table_or_none(spark, path)
    return rows if rows is None or opened is None else rows.filter(F.col(BUCKET).isin(opened))


def handled(spark: SparkSession, log: str, before_epoch: int | None = None, opened: list[int] | None = None) -> DataFrame | None:
    """Rows of the ledger: all of it, or what a batch of epoch ``before_epoch`` sees in the ``opened`` buckets."""
    versions = [v for v in complete_versions(spark, f"{log}/base") if before_epoch is None or v < before_epoch]
    epochs = [e for e in complete_epochs(spark, log) if (not versions or e > versions[-1]) and (before_epoch is None or e <= before_epoch)]
    paths = [f"{log}/base/version={v}" for v in versions[-1:]] + [f"{log}/delta/epoch={e}" for e in epochs]
    found = None
    for path in paths:
        part = _part(spark, path, opened)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    return found


def complete_epochs(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(e) for e in list_partitions(spark, f"{log}/delta"))


def act_once(df: DataFrame, event_id: str, notice: Column, log: str, action: Action | None = None, buckets: int = 64,
             compact_every: int = 50) -> DataStreamWriter:
    """Act on each event id and then note it; a batch whose ``action`` fails notes nothing, stays pending and is taken again.

    ``action`` gets the (id, notice) rows that no other batch has handled, one per id, and may be called again for a batch that
    broke off after it: give it the batch number to recognise a repetition. Without an action the ledger itself is
    the result. Ids handled before are skipped, so producers may repeat an event at any time; rows without an id are left out.
    ``buckets`` and ``compact_every`` stay as they are for the life of a ledger.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, epoch = batch.sparkSession, batch_id // compact_every
        rows = keyed.first_by_key(batch.withColumn("notice", notice).filter(F.col(event_id).isNotNull()), [event_id], ["notice"])
        rows = rows.select(event_id, "notice", F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int").alias(BUCKET)).persist()
        try:
            opened = [row[BUCKET] for row in rows.select(BUCKET).distinct().collect()]
            if opened:
                _act(spark, rows, batch_id, epoch, opened)
        finally:
            rows.unpersist()
        if (batch_id + 1) % compact_every == 0:
            whole = handled(spark, log, epoch)
            if whole is not None:
                whole.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{log}/base/version={epoch}")

    def _act(spark: SparkSession, rows: DataFrame, batch_id: int, epoch: int, opened: list[int]) -> None:
        done = handled(spark, log, epoch, opened)
        if done is not None:
            rows = rows.join(done.filter(F.col(BATCH) != batch_id).select(event_id), [event_id], "left_anti")
        fresh = rows.withColumn(BATCH, F.lit(batch_id)).persist()  # fixed before the batch's own folders are replaced
        try:
            if action is not None:
                action(fresh.select(event_id, "notice"), batch_id)
            (fresh.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH)
             .parquet(f"{log}/delta/epoch={epoch}"))
        finally:
            fresh.unpersist()

    return per_batch(df, write)
