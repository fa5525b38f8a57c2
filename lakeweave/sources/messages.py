"""Topic reads and writes. The connector packages are optional; every reader returns the columns
``key, value, topic, partition, offset, timestamp`` so that files can stand in for a topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

MESSAGE = ("key string, value string, topic string, partition int, offset bigint, timestamp timestamp")
RUN_ID = "_lab_run_id"


def _text_columns(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"),
                     "topic", "partition", "offset", "timestamp")


def read_topic(spark: SparkSession, servers: str, topics: Sequence[str], starting: str = "earliest",
               ending: str = "latest") -> DataFrame:
    """Bounded read of all partitions between two offset positions."""
    return _text_columns(spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
                         .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
                         .option("endingOffsets", ending).load())


def stream_topic(spark: SparkSession, servers: str, topics: Sequence[str], starting: str = "earliest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """Continuous read; with ``max_per_trigger`` and an availableNow trigger, a capped catch-up read."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return _text_columns(reader.load())


def stream_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON-lines files with the message columns, as a stream."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def as_messages(df: DataFrame, key: Column | str) -> DataFrame:
    """Rows as keyed JSON messages."""
    column = F.col(key) if isinstance(key, str) else key
    return df.select(column.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, key: Column | str) -> None:
    (as_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).option("kafka.compression.type", "snappy")
     .option("kafka.enable.idempotence", "true").option("kafka.acks", "all").save())


def stream_to_topic(df: DataFrame, servers: str, topic: str, key: Column | str) -> DataStreamWriter:
    """Streaming form of :func:`write_topic`; at least once, so consumers key on the message."""
    return (as_messages(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("kafka.compression.type", "snappy"))


def parse_messages(messages: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(parsed rows with their message position, messages that are empty or no JSON object)."""
    good = F.json_object_keys("value").isNotNull()
    parsed = (messages.filter(good).withColumn("__row", F.from_json("value", schema))
              .select("__row.*", *position_columns()))
    return parsed, messages.filter(~F.coalesce(good, F.lit(False)))


def position_columns() -> list[Column]:
    return [F.col("topic").alias("_kafka_topic"), F.col("partition").alias("_kafka_partition"),
            F.col("offset").alias("_kafka_offset"), F.col("key").alias("_kafka_key")]


def only_run(df: DataFrame, run_id: str | None, marker: str = RUN_ID) -> DataFrame:
    """Rows of one run; without a run id, all rows."""
    return df.filter(F.col(marker) == run_id) if run_id else df


def decode_framed_avro(messages: DataFrame, schema_json: str, value: str = "value") -> DataFrame:
    """Registry-framed Avro: skip the five header bytes, decode the rest; bad frames become null rows."""
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring({value}, 6)")
    return messages.withColumn("record", from_avro(body, schema_json, {"mode": "PERMISSIVE"}))


def split_undecoded(decoded: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame]:
    return decoded.filter(F.col(record).isNotNull()), decoded.filter(F.col(record).isNull())
