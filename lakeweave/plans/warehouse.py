"""Order warehouse: raw CSV loads, clean orders and customers, customer 360, sales and product tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import strict_date
from ..functions.text import blank_to_null, trimmed
from ..operators import aggregates as agg
from ..operators import keyed, quality
from ..sources import files
from ..sources.layout import log_run

ORDER = ("order_id int, customer_id int, product_id string, product_name string, category string, quantity int, "
         "unit_price decimal(12,2), total_amount decimal(12,2), order_date string, status string")
CUSTOMER = "customer_id int, customer_name string, email string, city string, country string, signup_date string"


def load_bronze(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    loaded = files.read_csv(spark, path, schema, trim=True, encoding=encoding, lower_names=True)
    return loaded.select("*", F.current_timestamp().alias("_loaded_at"), F.col("_metadata.file_name").alias("_source_file"),
                         F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_source_position"))


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Positive, not cancelled orders; the last load of an order id wins."""
    kept = bronze.filter((F.col("quantity") > 0) & (F.col("status") != agg.CANCELLED))
    latest = keyed.latest_by_key(kept, ["order_id"], ["_loaded_at", "_source_position", "order_date", "total_amount"])
    return latest.withColumn("order_date", strict_date("order_date")).drop("_loaded_at", "_source_file", "_source_position")


def silver_customers(bronze: DataFrame) -> DataFrame:
    named = bronze.filter(blank_to_null("customer_name").isNotNull())
    latest = keyed.latest_by_key(named, ["customer_id"], ["_loaded_at", "_source_position", "signup_date"])
    return latest.select("customer_id", trimmed("customer_name", "title").alias("customer_name"),
                         F.lower(blank_to_null("email")).alias("email"), trimmed("city").alias("city"),
                         trimmed("country", "upper").alias("country"), strict_date("signup_date").alias("signup_date"))


def gold(customers: DataFrame, orders: DataFrame) -> dict[str, DataFrame]:
    amount = F.col("total_amount")
    return {
        "customer_360": agg.customer_360(customers, orders, "customer_id", ["customer_name", "email", "city", "country"],
                                         "order_id", amount, "order_date", "category"),
        "daily_sales": agg.daily_sales(orders, "order_date", "customer_id", "product_name", amount),
        "product_performance": agg.product_performance(orders, ["product_id", "product_name", "category"],
                                                       F.col("quantity"), amount, F.col("unit_price")),
    }


def run(spark: SparkSession, orders_csv: str, customers_csv: str, warehouse: str, run_id: str,
        encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """Full refresh of all layers; stops at the bronze gate, and logs the run."""
    started = datetime.now(timezone.utc)
    tables = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        files.write_table(df, f"{warehouse}/{name}")
        tables[name] = spark.read.parquet(f"{warehouse}/{name}")
        return tables[name]

    raw_orders = store("bronze/orders", load_bronze(spark, orders_csv, ORDER, encoding))
    raw_customers = store("bronze/customers", load_bronze(spark, customers_csv, CUSTOMER, encoding))
    gate = store("quality/results", quality.bronze_gate(raw_orders, raw_customers))
    failed = [row["rule"] for row in gate.filter(F.col("status") == quality.FAIL).collect()]
    if failed:
        raise ValueError(f"bronze gate failed: {failed}")
    orders = store("silver/orders", silver_orders(raw_orders))
    customers = store("silver/customers", silver_customers(raw_customers))
    for name, df in gold(customers, orders).items():
        store(f"gold/{name}", df)
    counts = agg.layer_counts({name: df for name, df in tables.items() if not name.startswith("quality")})
    log_run(spark, f"{warehouse}/run_log", [
        (run_id, "warehouse", row["table_name"].split("/")[0], row["table_name"], row["row_count"], "success", started)
        for row in counts.collect()])
    return tables
