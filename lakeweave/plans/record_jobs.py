"""Small file and message jobs: customer clean-up, order enrichment, order event batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import order_charges
from ..functions.text import blank_to_null, international_phone, trimmed
from ..operators import keyed, quality
from ..operators.enrich import last_row_wins, lookup
from ..sources import files
from ..sources.messages import as_messages, parse_messages

CUSTOMER = "customer_id int, name string, email string, phone string, country string, order_amount double"
ORDER = "order_id int, customer_id int, product_id string, status string, amount double"
PRODUCT = "product_id string, product_name string, category string"
ORDER_EVENT = "order_id string, customer_id string, product_id string, status string, amount string, event_time string"


def normalised_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id", trimmed(F.coalesce("name", F.lit(""))).alias("customer_name"),
        F.lower(blank_to_null("email")).alias("email"), international_phone("phone").alias("phone"),
        trimmed(F.coalesce("country", F.lit("")), "upper").alias("country"), "order_amount")


def clean_customers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per customer with its number of copies, customers without email)."""
    valid, rejected = quality.split_valid(normalised_customers(raw), F.col("email").isNotNull())
    order = ["customer_name", "email", "phone", "country", "order_amount"]
    return keyed.unique_with_count(valid, ["customer_id"], order, "duplicate_count"), rejected


def enrich_orders(orders: DataFrame, products: DataFrame, load_order: list[str] | None = None) -> DataFrame:
    """Orders with product data and charges; products are unique per id, the row loaded last winning."""
    unique = last_row_wins(products, ["product_id"], load_order or ["product_name", "category"])
    found = lookup(orders, unique, ["product_id"], {"product_name": "UNKNOWN", "category": "UNKNOWN"})
    return found.select(*orders.columns, "product_name", trimmed("category", "upper").alias("product_category"),
                        *[column.alias(name) for name, column in order_charges("amount").items()],
                        F.current_timestamp().alias("processed_at"))


def new_order_events(messages: DataFrame) -> DataFrame:
    """NEW order events of a message batch, one per order, the first by position."""
    parsed, _ = parse_messages(messages, ORDER_EVENT)
    typed = parsed.select(
        F.col("order_id").try_cast("int").alias("order_id"), F.col("customer_id").try_cast("int").alias("customer_id"),
        F.coalesce("product_id", F.lit("")).alias("product_id"), F.upper(F.coalesce("status", F.lit(""))).alias("status"),
        F.col("amount").try_cast("double").alias("amount"), F.coalesce("event_time", F.lit("")).alias("event_time"),
        "_kafka_partition", "_kafka_offset")
    first = keyed.first_by_key(typed.filter("status = 'NEW'"), ["order_id"], ["_kafka_partition", "_kafka_offset"])
    return first.drop("_kafka_partition", "_kafka_offset")


def customer_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("total_amount"),
        (F.sum("amount") / F.count("amount")).alias("average_amount"))


def event_batch(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean order messages keyed by order, customer total messages keyed by customer)."""
    clean = new_order_events(messages)
    return as_messages(clean, "order_id"), as_messages(customer_totals(clean), "customer_id")


def run(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """File jobs: clean customers with rejects, enriched orders."""
    clean, rejected = clean_customers(files.read_csv(spark, f"{source}/customers.csv", CUSTOMER, trim=True))
    enriched = enrich_orders(files.read_csv(spark, f"{source}/orders.csv", ORDER, trim=True),
                             files.with_row_order(files.read_csv(spark, f"{source}/products.csv", PRODUCT, trim=True)), ["_row"])
    results = {"customers_clean": clean, "customers_rejected": rejected, "orders_enriched": enriched}
    for name, df in results.items():
        files.write_table(df, f"{target}/{name}", fmt="csv", header="true")
    return {name: spark.read.option("header", True).csv(f"{target}/{name}") for name in results}
