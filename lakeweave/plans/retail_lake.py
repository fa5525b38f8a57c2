"""Retail order lake: raw events to valid, de-duplicated, current, enriched orders and revenue tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import converted
from ..functions.temporal import with_event_time
from ..functions.text import clean_columns
from ..operators import aggregates as agg
from ..operators import keyed, quality
from ..operators.enrich import broadcast_if_small, enrich
from ..sources import files
from ..sources.layout import ingest_manifest, ingest_new_files, list_partitions, replace_partitions, table_or_none

# Input columns, and the columns that make two events the same.
ORDER_EVENT = ("event_id string, order_id int, customer_id int, product_id string, status string, amount double, "
               "currency string, channel string, event_time string, coupon_code string, delivery_promise string")
CUSTOMER = ("customer_id int, customer_name string, email string, country string, region string, signup_date string, "
            "loyalty_tier string")
PRODUCT = "product_id string, product_name string, category string, unit_cost double"
RATE = "currency string, rate_to_usd double, as_of_date string"
BUSINESS_KEY = ("order_id", "customer_id", "product_id", "status", "amount", "currency", "channel", "event_time_ts")
LAYERS = ("bronze/orders_raw", "silver/orders_checked", "silver/orders_deduplicated", "silver/orders_current",
          "silver/orders_enriched", "gold/daily_revenue", "gold/category_revenue", "gold/segment_revenue")


def checked_orders(bronze: DataFrame) -> DataFrame:
    """Cleaned events with their list of rule violations."""
    cleaned = clean_columns(bronze, upper=["status", "currency", "product_id"], lower=["channel"],
                            casts={"amount": "double", "order_id": "int", "customer_id": "int"})
    return quality.with_errors(with_event_time(cleaned, "event_time", "event_time_ts", "event_date"), quality.order_rules())


def deduplicated_orders(valid: DataFrame) -> DataFrame:
    return keyed.business_key_dedup(valid, BUSINESS_KEY, "event_id")


def current_orders(unique: DataFrame) -> DataFrame:
    return keyed.latest_by_key(unique, ["order_id"], ["event_time_ts", "event_id"])


def enriched_orders(current: DataFrame, customers: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    unknown = "UNKNOWN"
    # by a handful of products or currencies every order would be shuffled to as many tasks
    priced = broadcast_if_small(products.withColumn("product_category", F.upper("category")))
    out = enrich(current, customers, ["customer_id"], ["customer_name", "email", "country", "region", "loyalty_tier"],
                 flag="customer_match_status", missing="MISSING_CUSTOMER",
                 defaults={"region": unknown, "loyalty_tier": unknown})
    out = enrich(out, priced, ["product_id"], ["product_name", "product_category", "unit_cost"],
                 flag="product_match_status", missing="MISSING_PRODUCT", defaults={"product_category": unknown})
    out = enrich(out, broadcast_if_small(rates), ["currency"], ["rate_to_usd"]).withColumn("amount_usd", converted("amount", "rate_to_usd"))
    return out.withColumn("gross_margin_usd", F.round(F.col("amount_usd") - F.col("unit_cost"), 2))


def gold(enriched: DataFrame) -> dict[str, DataFrame]:
    sold = enriched.filter(F.col("status") != agg.CANCELLED).withColumnRenamed("event_date", "order_date")
    orders, usd = {"order_count": F.col("order_id")}, {"total_revenue_usd": F.col("amount_usd")}
    return {
        "daily_revenue": agg.revenue_by(sold, ["order_date"], distincts=orders | {"customer_count": F.col("customer_id")},
                                        sums=usd, means={"avg_order_value_usd": F.col("amount_usd")}),
        "category_revenue": agg.revenue_by(sold, ["product_category"], distincts=orders,
                                           sums=usd | {"gross_margin_usd": F.col("gross_margin_usd")}),
        "segment_revenue": agg.revenue_by(sold, ["region", "loyalty_tier"], distincts=orders, sums=usd),
    }


def control_table(checked: DataFrame) -> DataFrame:
    return agg.count_by(checked, ["is_valid"]).orderBy("is_valid")


def quarantine_report(invalid: DataFrame) -> DataFrame:
    return invalid.select("event_id", "order_id", "status", "amount", "currency",
                          F.concat_ws("|", "quality_errors").alias("quality_errors")).orderBy("event_id")


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """Checked orders; a filter on ``is_valid`` still prunes folders through the cast."""
    stored = spark.read.parquet(path)
    return stored.withColumn("is_valid", F.col("is_valid").cast("boolean"))


def refine(spark: SparkSession, lake: str, dimensions: dict[str, DataFrame]) -> dict[str, int]:
    """Everything behind bronze. Each stage is written once and read back, so no stage runs twice;
    valid and quarantined rows share one table partitioned by ``is_valid``."""
    def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        files.write_table(df, f"{lake}/{name}", partition_by=partition_by)
        return spark.read.parquet(f"{lake}/{name}")

    bronze = spark.read.parquet(f"{lake}/bronze/orders_raw")
    stage(checked_orders(bronze), "silver/orders_checked", ["is_valid"])
    checked = read_checked(spark, f"{lake}/silver/orders_checked")
    unique = stage(deduplicated_orders(checked.filter("is_valid")), "silver/orders_deduplicated")
    current = stage(current_orders(unique), "silver/orders_current")
    enriched = stage(enriched_orders(current, **dimensions), "silver/orders_enriched")
    for name, df in gold(enriched).items():
        stage(df, f"gold/{name}")
    counts = {row["is_valid"]: row["row_count"] for row in control_table(checked).collect()}
    return {"bronze_rows": bronze.count(), "silver_valid_rows": counts.get(True, 0), "quarantine_rows": counts.get(False, 0),
            "silver_deduplicated_rows": unique.count(), "current_order_rows": current.count(),
            "enriched_rows": enriched.count()}


def read_dimensions(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    return {"customers": files.read_csv(spark, f"{source}/customers.csv", CUSTOMER),
            "products": files.read_csv(spark, f"{source}/products.csv", PRODUCT),
            "rates": files.read_csv(spark, f"{source}/fx_rates.csv", RATE)}


def run(spark: SparkSession, source: str, event_files: Sequence[str], lake: str, batch_id: str,
        expected: dict[str, int] | None = None) -> dict[str, int]:
    """Full run from raw files; ``expected`` is the layer contract to hold."""
    events = files.with_source_metadata(files.read_json_lines(spark, event_files, ORDER_EVENT), batch_id)
    files.write_table(events, f"{lake}/bronze/orders_raw")
    manifest = refine(spark, lake, read_dimensions(spark, source))
    if expected:
        quality.assert_metrics(manifest, expected)
    return manifest


BUCKET, BUCKETS = "bucket", 64
PERIOD, DAYS, MONTHS, YEARS = "period", "yyyy-MM-dd", "yyyy-MM", "yyyy"


def order_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int")


def in_period(day: str, periods: str) -> Column:
    """The folder of a day: the day itself, or its month or year where days are small."""
    return F.date_format(day, periods)


def day_parts(enriched: DataFrame) -> dict[str, DataFrame]:
    """Gold rows per day. An order stands in one day only, so that counts and sums of days add up to totals."""
    sold = enriched.filter(F.col("status") != agg.CANCELLED).withColumnRenamed("event_date", "order_date")
    orders, usd = F.count("order_id").alias("order_count"), F.sum("amount_usd").alias("total_revenue_usd")
    return {"daily_revenue": gold(enriched)["daily_revenue"],
            "category_by_day": sold.groupBy("order_date", "product_category").agg(orders, usd, F.sum("gross_margin_usd").alias("gross_margin_usd")),
            "segment_by_day": sold.groupBy("order_date", "region", "loyalty_tier").agg(orders, usd)}


def totals_of_days(category_by_day: DataFrame, segment_by_day: DataFrame) -> dict[str, DataFrame]:
    def total(parts: DataFrame, keys: Sequence[str], *sums: str) -> DataFrame:
        return parts.groupBy(*keys).agg(F.sum("order_count").alias("order_count"), *[F.round(F.sum(c), 2).alias(c) for c in sums])
    return {"category_revenue": total(category_by_day, ["product_category"], "total_revenue_usd", "gross_margin_usd"),
            "segment_revenue": total(segment_by_day, ["region", "loyalty_tier"], "total_revenue_usd")}


def refresh(spark: SparkSession, lake: str, dimensions: dict[str, DataFrame], buckets: int = BUCKETS, periods: str = DAYS) -> list[str]:
    """Carry the bronze batches that no refresh has taken yet through silver and gold; returns the periods replaced.

    Only orders that occur in those batches are refined again: their history comes from the buckets of the de-duplicated
    table that hold them, and of silver and gold only the periods (days) that such an order left or reached are replaced. ``buckets``
    and ``periods`` belong to a lake and stay as they are in its first refresh. Batches are noted as refined at the end, and the de-duplicated history, from which the days before are derived, is replaced after
    everything that depends on it: a run that broke off is repeated with the same result.

    Silver keeps the dimension values of an order's last refresh; after a change of the dimensions run into a new lake.
    """
    bronze, checked_path = f"{lake}/bronze/orders_raw", f"{lake}/silver/orders_checked"
    unique_path, enriched_path, stage = f"{lake}/silver/orders_deduplicated", f"{lake}/silver/orders_enriched", f"{lake}/state/stage"
    done = table_or_none(spark, f"{lake}/state/refined")
    taken = set() if done is None else {row["batch_id"] for row in done.select("batch_id").distinct().collect()}
    new = sorted(int(b) for b in list_partitions(spark, bronze, complete=True) if int(b) not in taken)
    if not new:
        return []
    landed = spark.read.option("basePath", bronze).parquet(*[f"{bronze}/batch_id={b}" for b in new])
    (checked_orders(landed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", "is_valid").parquet(checked_path))
    valid = read_checked(spark, checked_path).filter(F.col("batch_id").isin(new) & F.col("is_valid")).drop("batch_id")
    valid = valid.withColumn(BUCKET, order_bucket(buckets))
    touched = valid.select("order_id").distinct()
    opened = [row[BUCKET] for row in valid.select(BUCKET).distinct().collect()]

    history = table_or_none(spark, unique_path)
    held = valid.limit(0) if history is None else history.filter(F.col(BUCKET).isin(opened))
    before = held.join(touched, "order_id", "left_semi")
    files.write_table(deduplicated_orders(before.unionByName(valid)), f"{stage}/unique")
    unique = spark.read.parquet(f"{stage}/unique")
    placed = enriched_orders(current_orders(unique), **dimensions).withColumn(PERIOD, in_period("event_date", periods))
    files.write_table(placed, f"{stage}/enriched")
    enriched = spark.read.parquet(f"{stage}/enriched")

    touched = enriched.select("order_id")  # the same orders, written once each
    stood = held.join(touched, "order_id", "left_semi").groupBy("order_id").agg(F.max("event_date").alias("event_date"))
    left = stood.select(in_period("event_date", periods).alias(PERIOD))
    moved = sorted(row[PERIOD] for row in left.union(enriched.select(PERIOD)).distinct().collect())
    replaced = F.col(PERIOD).isin(moved)
    standing = table_or_none(spark, enriched_path)
    if standing is not None:
        others = standing.withColumn(PERIOD, F.col(PERIOD).cast("string")).filter(replaced)
        enriched = enriched.unionByName(others.join(touched, "order_id", "left_anti"))
    replace_partitions(enriched, enriched_path, PERIOD, moved)
    fresh = spark.read.parquet(enriched_path).filter(F.col(PERIOD).cast("string").isin(moved))
    for name, rows in day_parts(fresh).items():
        replace_partitions(rows.withColumn(PERIOD, in_period("order_date", periods)), f"{lake}/gold/{name}", PERIOD, moved)
    parts = [spark.read.parquet(f"{lake}/gold/{name}") for name in ("category_by_day", "segment_by_day")]
    for name, rows in totals_of_days(*parts).items():
        files.write_table(rows, f"{lake}/gold/{name}")

    replace_partitions(unique.unionByName(held.join(touched, "order_id", "left_anti")), unique_path, BUCKET, opened)
    spark.createDataFrame([(b,) for b in new], "batch_id int").coalesce(1).write.mode("append").parquet(f"{lake}/state/refined")
    return moved


def layer_metrics(spark: SparkSession, lake: str) -> dict[str, int]:
    """Rows of every layer; counts come from file footers and partition names."""
    counts = {row["is_valid"]: row["row_count"] for row in control_table(read_checked(spark, f"{lake}/silver/orders_checked")).collect()}
    rows = {name: spark.read.parquet(f"{lake}/{path}").count() for name, path in (
        ("bronze_rows", "bronze/orders_raw"), ("silver_deduplicated_rows", "silver/orders_deduplicated"),
        ("enriched_rows", "silver/orders_enriched"))}
    return rows | {"silver_valid_rows": counts.get(True, 0), "quarantine_rows": counts.get(False, 0),
                   "current_order_rows": rows["enriched_rows"]}


def run_incremental(spark: SparkSession, source: str, lake: str, checkpoint: str,
                    pattern: str = "order_events_*.jsonl") -> dict[str, int]:
    """Ingest only event files not seen before, then carry their orders through the layers behind bronze."""
    ingest_new_files(spark, source, ORDER_EVENT, "json", f"{lake}/bronze/orders_raw", checkpoint,
                     options={"pathGlobFilter": pattern})
    refresh(spark, lake, read_dimensions(spark, source))
    manifest = ingest_manifest(spark.read.parquet(f"{lake}/bronze/orders_raw"))
    return layer_metrics(spark, lake) | {"processed_files": manifest.count()}
