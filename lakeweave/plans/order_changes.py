"""Order change log, clickstream and shipments: bronze, current orders, facts, quarantine, KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import changes, quality
from ..operators.enrich import last_row_wins, lookup, with_membership
from ..sources import files, messages
from ..sources.layout import table_or_none

ORDER_EVENT = ("amount double, customer_id bigint, event_id string, op string, order_id bigint, order_ts string, "
               "source string, source_lsn bigint, status string, table string")
CLICK = "event_id string, event_ts string, event_type string, order_id bigint, session_id string, user_id string"
SHIPMENT = "shipment_id string, order_id string, carrier string, status string, event_ts string"
CUSTOMER = "customer_id bigint, customer_name string, customer_tier string, region string"
PROPOSAL = "change string, classification string, recommended_policy string, why string"
UNKNOWN = "UNKNOWN"


def bronze_orders(raw: DataFrame) -> DataFrame:
    return files.with_record_hash(raw)


def bronze_shipments(raw: DataFrame) -> DataFrame:
    """Blank CSV fields count as empty text, so that they hash and validate alike everywhere."""
    return files.with_record_hash(raw.fillna("", subset=raw.columns))


def current_orders(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current order rows, duplicate events)."""
    current, duplicates = changes.replay(bronze, ["order_id"], "event_id", "source_lsn")
    return current.select("order_id", "customer_id", F.substring("order_ts", 1, 10).alias("order_date"), "status",
                          F.col("amount").cast("double").alias("amount"),
                          F.col("source_lsn").alias("last_source_lsn")), duplicates


def current_inventory(bronze: DataFrame) -> DataFrame:
    """Current stock from inventory changes, ordered by (file, position, partition, offset)."""
    order = ["source_file", "source_pos", "_kafka_partition", "_kafka_offset"]
    state = changes.current_state(bronze, ["inventory_id"], order, F.col("op") == changes.DELETE)
    return state.select("inventory_id", "product_name", "quantity", "last_updated",
                        F.col("source_pos").alias("last_source_pos"))


def checked_shipments(bronze: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipments with the list of rules they break; an order must be among the current ones."""
    known = orders.select(F.col("order_id").cast("string").alias("known_id"))
    checked = with_membership(bronze, known, "order_id", "known_id", "__known")
    return quality.with_errors(checked, quality.shipment_rules("__known"), "errors").drop("__known")


def valid_shipments(checked: DataFrame) -> DataFrame:
    return checked.filter("is_valid").select("shipment_id", "order_id", "carrier", "status", "event_ts")


def rejected_shipments(checked: DataFrame) -> DataFrame:
    record = [name for name in checked.columns if name not in ("errors", "is_valid")]
    return checked.filter("NOT is_valid").select(F.lit("logistics_batch").alias("source"), "errors",
                                                 F.struct(*record).alias("record"))


def customer_dimension(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("customer_id").alias("customer_key"), "customer_id", "customer_name", "customer_tier", "region")


def order_facts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    found = lookup(orders, customers.select("customer_id", "region"), ["customer_id"], {"region": UNKNOWN})
    return found.select("order_id", "order_date", F.col("customer_id").alias("customer_key"), "region", "status", "amount")


def gold(facts: DataFrame, clicks: DataFrame) -> dict[str, DataFrame]:
    amount = F.col("amount").cast("decimal(14,2)")
    return {
        "daily_order_kpis": agg.daily_kpis(facts, "order_date", amount, F.col("status").isin(*agg.RECOGNISED)),
        "region_order_summary": agg.gross_by(facts, ["region"], amount),
        "clickstream_event_summary": agg.count_by(clicks, ["event_type"], "event_count"),
    }


def quality_report(orders: DataFrame, duplicates: DataFrame, valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """(metric, value) rows of one run."""
    counted = [(duplicates, "duplicate_events"), (orders, "valid_current_orders"), (valid, "valid_shipments"),
               (rejected, "dlq_records")]
    report = None
    for df, name in counted:
        part = df.agg(F.lit(name).alias("metric"), F.count(F.lit(1)).alias("value"))
        report = part if report is None else report.unionByName(part)
    latest = changes.latest_position(orders, "last_source_lsn", "value").select(F.lit("latest_order_lsn").alias("metric"), "value")
    return report.unionByName(latest)


def bronze_from_messages(topic: DataFrame, schema: str, run_id: str | None = None) -> DataFrame:
    """Flat JSON messages of one run with hash and message position, the run marker kept apart."""
    parsed, _ = messages.parse_messages(topic, f"{schema}, {messages.RUN_ID} string")
    payload = [name for name in parsed.columns if not name.startswith("_")]
    return files.with_record_hash(messages.only_run(parsed, run_id), payload)


def bronze_from_envelopes(topic: DataFrame) -> DataFrame:
    """Order change envelopes as bronze rows."""
    rows = changes.order_envelopes(topic)
    payload = ["event_id", "op", "order_id", "customer_id", "status", "amount", "order_ts", "source", "table", "source_lsn"]
    return files.with_record_hash(rows.select(*payload, *messages.position_columns()), payload)


def run(spark: SparkSession, inputs: str, outputs: str, orders: DataFrame | None = None) -> dict[str, int]:
    """Whole job from input files (or from given bronze orders); returns the run metrics."""
    raw = orders if orders is not None else bronze_orders(files.read_json_array(spark, f"{inputs}/orders_cdc.json", ORDER_EVENT))
    bronze = {
        "orders_cdc": raw,
        "clickstream_events": files.with_record_hash(files.read_json_array(spark, f"{inputs}/clickstream_events.json", CLICK)),
        "logistics_batch": bronze_shipments(files.read_csv(spark, f"{inputs}/logistics_batch.csv", SHIPMENT)),
    }
    for name, df in bronze.items():
        files.write_table(df, f"{outputs}/bronze/{name}")
    stored = {name: spark.read.parquet(f"{outputs}/bronze/{name}") for name in bronze}
    loaded = files.with_row_order(files.read_csv(spark, f"{inputs}/customers.csv", CUSTOMER))
    customers = last_row_wins(loaded, ["customer_id"], ["_row"])

    current, duplicates = current_orders(stored["orders_cdc"])
    files.write_table(current, f"{outputs}/silver/orders_current")
    files.write_table(duplicates, f"{outputs}/quarantine/duplicate_events")
    current = spark.read.parquet(f"{outputs}/silver/orders_current")
    files.write_table(checked_shipments(stored["logistics_batch"], current), f"{outputs}/silver/shipments_checked")
    checked = spark.read.parquet(f"{outputs}/silver/shipments_checked")
    files.write_table(valid_shipments(checked), f"{outputs}/silver/shipments_valid")
    files.write_table(rejected_shipments(checked), f"{outputs}/quarantine/dlq_logistics")
    files.write_table(customer_dimension(customers), f"{outputs}/silver/dim_customer")
    files.write_table(order_facts(current, customers), f"{outputs}/silver/fact_orders")
    facts = spark.read.parquet(f"{outputs}/silver/fact_orders")
    for name, df in gold(facts, stored["clickstream_events"]).items():
        files.write_table(df, f"{outputs}/gold/{name}")
    proposals = table_or_none(spark, f"{inputs}/schema_change_proposals.parquet")
    if proposals is None:
        proposals = files.read_json_array(spark, f"{inputs}/schema_change_proposals.json", PROPOSAL)
    files.write_table(quality.decide_proposals(proposals), f"{outputs}/silver/schema_change_decisions")

    written = {name: spark.read.parquet(f"{outputs}/{name}") for name in (
        "quarantine/duplicate_events", "silver/shipments_valid", "quarantine/dlq_logistics")}
    report = quality_report(current, written["quarantine/duplicate_events"], written["silver/shipments_valid"],
                            written["quarantine/dlq_logistics"])
    files.write_table(report, f"{outputs}/silver/data_quality_report")
    return {row["metric"]: row["value"] for row in report.collect()}
