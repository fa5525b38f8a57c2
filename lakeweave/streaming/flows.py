"""General stream jobs: landing, de-duplication, running state, message upserts, dead-letter replay."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.temporal import partition_parts
from ..operators import merge, quality
from ..operators.changes import LATE_MS
from ..plans import record_jobs
from ..sources.layout import HOURLY, log_run, table_or_none
from ..sources.messages import parse_messages
from .sinks import Fold, add_delta, complete_versions, file_writer, fold_first, fold_latest, fold_upsert, finish, per_batch, put_batch, read_folded


def land(df: DataFrame, time: str, target: str, fmt: str = "parquet", rows_per_file: int = 1_000_000) -> DataStreamWriter:
    """Append raw rows under ``year=/month=/day=/hour=`` of their own time."""
    parted = df.withColumns(partition_parts(time, hour=True))
    return file_writer(parted, target, fmt, HOURLY).option("maxRecordsPerFile", rows_per_file)


def distinct_within(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First row per key among events no further apart than the watermark delay."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def distinct_keys(df: DataFrame, keys: Sequence[str], table: str, compact_every: int = 50) -> DataStreamWriter:
    """Keys seen so far without a time bound, read with ``fold_first(keys)``; a batch costs its own distinct keys."""
    fold = fold_first(keys)
    return per_batch(df.select(*keys), lambda batch, batch_id: add_delta(batch.distinct(), table, batch_id, fold, compact_every))


def running_state(df: DataFrame, keys: Sequence[str], sums: dict[str, Column], count: str = "events_processed") -> DataFrame:
    """Unbounded running aggregate per key, emitted on change (output mode update)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *[F.sum(c).alias(n) for n, c in sums.items()])


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], table: str, n: int = 1,
                compact_every: int = 50) -> DataStreamWriter:
    """Compacted view of a stream: the ``n`` latest rows per key, read with ``fold_latest(keys, order, n)``.

    With n = 40 this is a trail table whose hot keys are cut in every map task before anything moves.
    """
    fold = fold_latest(keys, order, n)
    return per_batch(df, lambda batch, batch_id: add_delta(fold(batch), table, batch_id, fold, compact_every))


def message_fold(keys: Sequence[str], update: Sequence[str], insert_only: bool = False) -> Fold:
    return fold_first(keys) if insert_only else fold_upsert(keys, update)


def upsert_messages(topic: DataFrame, schema: str, keys: Sequence[str], update: Sequence[str], bronze: str,
                    silver: str, insert_only: bool = False, compact_every: int = 50) -> DataStreamWriter:
    """Messages to a raw table and, parsed, into a keyed table read with :func:`message_fold`.

    A batch is reduced to the last message per key before it is merged; ``insert_only`` leaves keys
    that exist untouched.
    """
    columns = [field.split()[0] for field in schema.split(",")]
    fold = message_fold(keys, update, insert_only)

    def write(batch: DataFrame, batch_id: int) -> None:
        put_batch(batch, bronze, batch_id)
        parsed, _ = parse_messages(batch, schema)
        present = parsed.filter(F.col(keys[0]).isNotNull())
        rows = merge.last_change_per_key(present, keys, ["_kafka_partition", "_kafka_offset"]).select(*columns)
        add_delta(rows, silver, batch_id, fold, compact_every)
    return per_batch(topic, write, sinks=2)


def order_event_batches(topic: DataFrame, clean: str, totals: str) -> DataStreamWriter:
    """Per micro-batch: clean NEW order messages, and customer totals of that batch, ready to publish."""
    def write(batch: DataFrame, batch_id: int) -> None:
        orders, sums = record_jobs.event_batch(batch)
        put_batch(orders, clean, batch_id)
        put_batch(sums, totals, batch_id)
    return per_batch(topic, write, sinks=2)


def split_late(df: DataFrame, time: str, kept: str, late: str, marks: str, horizon: int = LATE_MS) -> DataStreamWriter:
    """Rows within ``horizon`` of the greatest time seen so far, the boundary included, and the later ones to a side table.

    Exact where a watermark is approximate: the greatest time is carried from batch to batch in ``marks``, one small row per
    batch of which only the last is read. A null time counts as 0. Times and horizon are whole numbers of one unit.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, stamp = batch.sparkSession, F.coalesce(F.col(time), F.lit(0))
        before = [v for v in complete_versions(spark, marks) if v < batch_id]
        seen = spark.read.parquet(f"{marks}/batch_id={before[-1]}").first()["mark"] if before else None
        own = batch.agg(F.max(stamp)).first()[0]
        mark = max((m for m in (seen, own) if m is not None), default=0)
        inside = stamp >= mark - horizon
        put_batch(batch.filter(inside), kept, batch_id)
        put_batch(batch.filter(~inside), late, batch_id)
        put_batch(spark.createDataFrame([(mark,)], "mark bigint").coalesce(1), marks, batch_id)
    return per_batch(df, write, sinks=3)


def replay_dead_letters(letters: DataFrame) -> DataFrame:
    """Dead letters as source rows; send them through the same validation as new input."""
    return quality.strip_dead_letter(letters)


ORDER_MESSAGE = "order_id bigint, customer_id bigint, product_id string, status string, amount double"


def run_message_orders(topic: DataFrame, warehouse: str, run_id: str, insert_only: bool = False) -> DataFrame:
    """Catch up with an order topic: raw messages, the keyed order table, and a run-log row.

    Cap the work of a run by the topic reader (offsets or files per trigger). Returns the order table.
    """
    spark, started = topic.sparkSession, datetime.now(timezone.utc)
    keys, update = ["order_id"], ["status", "amount"]
    raw, orders = f"{warehouse}/bronze/messages", f"{warehouse}/silver/orders"
    before = table_or_none(spark, raw)
    seen = 0 if before is None else before.count()
    finish(upsert_messages(topic, ORDER_MESSAGE, keys, update, raw, orders, insert_only), f"{warehouse}/_checkpoint")
    after = table_or_none(spark, raw)
    loaded = (0 if after is None else after.count()) - seen
    log_run(spark, f"{warehouse}/run_log", [(run_id, "message_orders", "stream", "silver/orders", loaded, "success", started)])
    return read_folded(spark, orders, message_fold(keys, update, insert_only))
