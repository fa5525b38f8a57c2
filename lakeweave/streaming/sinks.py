"""Sinks that may be repeated after a failure without changing the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.keyed import first_by_key, last_n_per_key
from ..sources.layout import table_or_none

BatchWriter = Callable[[DataFrame, int], None]
Fold = Callable[[DataFrame], DataFrame]
BATCH = "batch_id"


def put_batch(df: DataFrame, target: str, batch_id: int) -> None:
    """Store one micro-batch in its own directory; a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def put_state(df: DataFrame, target: str, batch_id: int, keep: int = 2) -> None:
    """Store the whole state after a batch; states older than the last ``keep`` are removed, as readers take the newest."""
    put_batch(df, target, batch_id)
    spark = df.sparkSession
    for old in complete_versions(spark, target):
        if old <= batch_id - keep:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{BATCH}={old}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_state(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/{BATCH}={complete_versions(spark, target)[-1]}")


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query: caught up and stopped by default, or triggered ``every`` interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def finish(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available and wait for the end."""
    start(writer, checkpoint).awaitTermination()


def per_batch(df: DataFrame, write: BatchWriter, sinks: int = 1) -> DataStreamWriter:
    """A foreachBatch writer; a batch that feeds several ``sinks`` is computed once and kept while they are written."""
    def cached(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()
    return df.writeStream.foreachBatch(cached if sinks > 1 else write)


def file_writer(df: DataFrame, target: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> DataStreamWriter:
    """Exactly-once append of finished rows."""
    writer = df.writeStream.outputMode("append").format(fmt).option("path", target)
    return writer.partitionBy(*partition_by) if partition_by else writer


# --- keyed tables fed by micro-batches ------------------------------------
#
# Every batch appends only its own rows (``delta/batch_id=N``); reading folds the deltas over the
# newest compacted base (``base/version=N``). A batch therefore costs what it brings, not what the
# table holds, and files are never changed in place: a repeated batch replaces its own directory and
# readers keep the files they opened.

def fold_latest(keys: Sequence[str], order: Sequence[str], n: int = 1) -> Fold:
    """The ``n`` newest rows per key."""
    return lambda df: last_n_per_key(df, keys, order, n)


def fold_first(keys: Sequence[str]) -> Fold:
    """Insert-only: the row of the first batch that brought the key."""
    return lambda df: first_by_key(df, keys, [BATCH])


def fold_upsert(keys: Sequence[str], update: Sequence[str]) -> Fold:
    """The first batch gives the row, later batches replace its ``update`` columns."""
    def fold(df: DataFrame) -> DataFrame:
        fixed = [c for c in df.columns if c not in (*keys, *update, BATCH)]
        rows = df.groupBy(*keys).agg(F.min_by(F.struct(BATCH, *fixed), BATCH).alias("__first"),
                                     F.max_by(F.struct(BATCH, *update), BATCH).alias("__last"))
        parts = {**{c: F.col(f"__first.{c}") for c in fixed}, **{c: F.col(f"__last.{c}") for c in (*update, BATCH)}}
        return rows.select(*[parts[c].alias(c) if c in parts else F.col(c) for c in df.columns])
    return fold


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions below ``path`` whose write has finished."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop_path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(int(status.getPath().getName().split("=")[1]) for status in fs.listStatus(folder)
                  if fs.exists(hadoop_path(status.getPath(), "_SUCCESS")))


def _folded(spark: SparkSession, table: str, fold: Fold, upto: int | None = None) -> DataFrame | None:
    bases = [v for v in complete_versions(spark, f"{table}/base") if upto is None or v < upto]
    parts = [spark.read.parquet(f"{table}/base/version={bases[-1]}")] if bases else []
    deltas = table_or_none(spark, f"{table}/delta")
    if deltas is not None:
        wanted = F.col(BATCH) > (bases[-1] if bases else -1)
        deltas = deltas.withColumn(BATCH, F.col(BATCH).cast("bigint")).filter(
            wanted if upto is None else wanted & (F.col(BATCH) <= upto))
        parts.append(deltas)
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return fold(rows)


def add_delta(df: DataFrame, table: str, batch_id: int, fold: Fold, compact_every: int = 50) -> None:
    """Append one batch; every ``compact_every`` batches fold everything so far into a new base."""
    put_batch(df, f"{table}/delta", batch_id)
    if (batch_id + 1) % compact_every == 0:
        base = _folded(df.sparkSession, table, fold, upto=batch_id).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        base.write.mode("overwrite").parquet(f"{table}/base/version={batch_id}")


def read_folded(spark: SparkSession, table: str, fold: Fold) -> DataFrame | None:
    """Current rows of a keyed table, or None before its first batch."""
    rows = _folded(spark, table, fold)
    return None if rows is None else rows.drop(BATCH)
