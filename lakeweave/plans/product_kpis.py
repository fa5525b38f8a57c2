"""Nested order events: raw landing with hashes, current orders, product KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trimmed
from ..operators.aggregates import CANCELLED, product_kpis, signed_totals
from ..operators.keyed import latest_by_key
from ..operators.rolling import running_totals
from ..sources.files import read_json_lines, with_record_hash, write_table

EVENT = ("specversion string, id string, source string, type string, time string, subject string, "
         "data struct<order_id: string, customer_id: string, product: string, quantity: int, "
         "unit_price: double, status: string>")


def order_lines(events: DataFrame) -> DataFrame:
    """Typed order columns of an event, money exact."""
    data = F.col("data")
    return events.select(
        data["order_id"].alias("order_id"), data["customer_id"].alias("customer_id"),
        trimmed(data["product"], "lower").alias("product"), data["quantity"].alias("quantity"),
        data["unit_price"].cast("decimal(12,2)").alias("unit_price"), data["status"].alias("status"),
        F.col("time").alias("event_time"), F.col("id").alias("source_event_id"))


def line_value():
    return F.col("unit_price") * F.col("quantity")


def current_orders(lines: DataFrame) -> DataFrame:
    return latest_by_key(lines, ["order_id"], ["event_time", "source_event_id"])


def rolling_state(lines: DataFrame) -> DataFrame:
    """Net value and event count per product after each event."""
    signed = F.when(F.col("status") == CANCELLED, -line_value()).otherwise(line_value())
    timed = lines.withColumn("__time", F.try_to_timestamp("event_time"))
    return running_totals(timed, "product", "__time", "source_event_id", {"net_value": signed},
                          "events_processed").drop("__time")


def cancellation_alerts(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("status") == CANCELLED).select(
        "event_time", F.concat(F.lit("REVIEW cancellation for "), "order_id").alias("alert"))


def batch_summary(lines: DataFrame) -> DataFrame:
    return signed_totals(lines, ["product"], line_value(), F.col("status") == CANCELLED)


def run(spark: SparkSession, source: str, lake: str) -> dict[str, DataFrame]:
    """Write bronze, silver and gold below ``lake`` and return them."""
    events = read_json_lines(spark, source, EVENT)
    bronze = with_record_hash(events, length=64).withColumn("_source_file", F.col("_metadata.file_name"))
    write_table(bronze, f"{lake}/bronze/order_events")
    lines = order_lines(spark.read.parquet(f"{lake}/bronze/order_events"))
    write_table(current_orders(lines), f"{lake}/silver/orders")
    silver = spark.read.parquet(f"{lake}/silver/orders")
    write_table(product_kpis(silver, ["product"], line_value(), F.col("status") == CANCELLED), f"{lake}/gold/product_kpis")
    return {name: spark.read.parquet(f"{lake}/{name}")
            for name in ("bronze/order_events", "silver/orders", "gold/product_kpis")}
