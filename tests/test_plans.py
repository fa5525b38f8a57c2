"""Golden results of the layered jobs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeweave.plans import order_changes, product_kpis, record_jobs, retail_lake, warehouse
from lakeweave.sources import files, layout

from . import fixtures as fx


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_product_kpis(spark, tmp_path):
    fx.write_json_lines(tmp_path / "order_events.jsonl", fx.order_events())
    out = product_kpis.run(spark, str(tmp_path / "order_events.jsonl"), str(tmp_path / "lake"))
    assert rows(out["gold/product_kpis"], "product", "order_count", F.col("net_sales").cast("string")) == [
        ("cable", 1, "24.00"), ("dock", 1, "98.75"), ("headset", 1, "134.00"), ("keyboard", 1, "42.50"), ("monitor", 1, "420.00")]
    assert out["silver/orders"].count() == 6
    assert [r[0] for r in out["bronze/order_events"].select(F.length("_record_hash")).distinct().collect()] == [64]
    lines = product_kpis.order_lines(files.read_json_lines(spark, str(tmp_path / "order_events.jsonl"), product_kpis.EVENT))
    assert rows(product_kpis.batch_summary(lines), "product", "submitted_orders", "cancelled_orders", "net_value") == [
        ("cable", 1, 0, Decimal("24.00")), ("dock", 1, 0, Decimal("98.75")), ("headset", 1, 0, Decimal("134.00")),
        ("keyboard", 1, 0, Decimal("42.50")), ("monitor", 1, 1, Decimal("210.00"))]
    state = product_kpis.rolling_state(lines)
    assert rows(state.filter("product = 'monitor'"), "source_event_id", "events_processed", "net_value") == [
        ("ev-1002", 1, Decimal("420.00")), ("ev-1005", 2, Decimal("210.00"))]
    assert rows(product_kpis.cancellation_alerts(lines), "alert") == [("REVIEW cancellation for O-1005",)]


def test_order_changes(spark, tmp_path):
    inputs, outputs = tmp_path / "in", tmp_path / "out"
    inputs.mkdir()
    fx.write_change_inputs(inputs)
    metrics = order_changes.run(spark, str(inputs), str(outputs))
    assert metrics == {"duplicate_events": 1, "valid_current_orders": 2, "valid_shipments": 2, "dlq_records": 2,
                       "latest_order_lsn": 104}
    read = lambda name: spark.read.parquet(f"{outputs}/{name}")
    assert rows(read("silver/orders_current"), "order_id", "customer_id", "order_date", "status", "amount", "last_source_lsn") == [
        (1001, 501, "2026-06-01", "SHIPPED", 120.5, 104), (1002, 502, "2026-06-01", "PAID", 75.0, 103)]
    assert rows(read("gold/daily_order_kpis"), "order_date", "order_count", "paid_or_shipped_count", "recognized_revenue") == [
        ("2026-06-01", 2, 2, 195.5)]
    assert rows(read("gold/region_order_summary"), "region", "order_count", F.col("gross_order_amount").cast("string")) == [
        ("Delta", 1, "75.00"), ("Fjord", 1, "120.50")]
    assert rows(read("gold/clickstream_event_summary"), "event_type", "event_count") == [
        ("cart_add", 1), ("checkout_start", 1), ("product_view", 2)]
    rejected = {r["record"]["order_id"]: r["errors"] for r in read("quarantine/dlq_logistics").collect()}
    assert rejected == {"1003": ["missing shipment_id", "unknown order_id"], "9999": ["unknown order_id"]}
    assert rows(read("silver/shipments_valid"), "shipment_id") == [("SHP-9001",), ("SHP-9002",)]
    assert [d for _, d in rows(read("silver/schema_change_decisions"), "change", "decision")] == ["ACCEPT", "ACCEPT", "REJECT"]
    hashes = dict(rows(read("bronze/orders_cdc"), "event_id", "_record_hash"))
    assert [hashes[row[0]] for row in fx.ORDER_CHANGES[:6]] == fx.ORDER_HASHES
    assert [h for _, h in rows(read("bronze/clickstream_events"), "event_id", "_record_hash")] == fx.CLICK_HASHES
    shipped = dict(rows(read("bronze/logistics_batch"), "order_id", "_record_hash"))
    assert [shipped[row[1]] for row in fx.SHIPMENTS] == fx.SHIPMENT_HASHES


def test_order_changes_from_messages(spark, tmp_path):
    import json

    def envelope(change):
        image = {"id": change["order_id"], "customer_id": change["customer_id"], "status": change["status"],
                 "amount": str(change["amount"]), "order_ts": change["order_ts"]}
        deleted = change["op"] == "d"
        body = {"before": image if deleted else None, "after": None if deleted else image, "op": change["op"],
                "source": {"lsn": change["source_lsn"], "name": "orders-db", "table": "orders"}, "ts_ms": 1780000000000}
        return {"payload": body} if change["source_lsn"] % 2 else body

    topic = [(None, json.dumps(envelope(c)), "orders", 0, i) for i, c in enumerate(fx.order_changes())]
    topic += [(None, None, "orders", 0, 90), (None, '{"before": null, "after": null, "op": "u"}', "orders", 0, 91)]
    messages = spark.createDataFrame(topic, "key string, value string, topic string, partition int, offset bigint")
    bronze = order_changes.bronze_from_envelopes(messages)
    current, duplicates = order_changes.current_orders(bronze)
    # offsets make every delivered message its own event, so the copy counts as a further update
    assert rows(current, "order_id", "status", "amount") == [(1001, "SHIPPED", 120.5), (1002, "PAID", 75.0)]
    assert duplicates.count() == 0
    assert bronze.filter("event_id = 'dbz-105-d-1003-6'").count() == 1

    flat = [(None, json.dumps(c | {"_lab_run_id": "run-1" if i else "other"}), "orders", 0, i)
            for i, c in enumerate(fx.order_changes())]
    raw = spark.createDataFrame(flat, "key string, value string, topic string, partition int, offset bigint")
    one_run = order_changes.bronze_from_messages(raw, order_changes.ORDER_EVENT, "run-1")
    assert one_run.count() == 6
    assert dict(rows(one_run, "event_id", "_record_hash"))["evt-002"] == fx.ORDER_HASHES[1]


def test_inventory_current(spark):
    data = [("c", 1, "bolt", 5, "f1", 10, 0, 0), ("u", 1, "bolt", 3, "f1", 20, 0, 1), ("c", 2, "nut", 9, "f1", 30, 0, 2),
            ("d", 2, "nut", 9, "f2", 5, 0, 3)]
    bronze = spark.createDataFrame(data, "op string, inventory_id bigint, product_name string, quantity bigint, source_file string, "
                                         "source_pos bigint, _kafka_partition int, _kafka_offset bigint").withColumn("last_updated", F.lit(""))
    assert rows(order_changes.current_inventory(bronze), "inventory_id", "quantity", "last_source_pos") == [(1, 3, 20)]


CONTRACT = {"bronze_rows": 12, "silver_valid_rows": 10, "silver_deduplicated_rows": 9, "quarantine_rows": 2,
            "current_order_rows": 7, "enriched_rows": 7}


def test_retail_lake(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    source.mkdir()
    fx.write_retail_inputs(source)
    events = [str(source / f"order_events_batch_{i}.jsonl") for i in (1, 2)]
    assert retail_lake.run(spark, str(source), events, str(lake), "run-1", CONTRACT) == CONTRACT
    with pytest.raises(AssertionError):
        retail_lake.run(spark, str(source), events[:1], str(tmp_path / "other"), "run-2", CONTRACT)
    checked = retail_lake.read_checked(spark, f"{lake}/silver/orders_checked")
    report = retail_lake.quarantine_report(checked.filter("NOT is_valid"))
    assert rows(report, "event_id", "quality_errors") == [("r-11", "non_positive_amount"), ("r-23", "missing_product_id")]
    enriched = {r["order_id"]: r for r in spark.read.parquet(f"{lake}/silver/orders_enriched").collect()}
    assert enriched[68]["customer_match_status"] == "MISSING_CUSTOMER" and enriched[68]["region"] == "UNKNOWN"
    assert enriched[66]["amount_usd"] == 62.5 and enriched[62]["status"] == "CANCELLED"
    assert RETAIL_DAYS == retail_days(spark, lake)
    assert enriched[63]["coupon_code"] == "MORE-5" and enriched[61]["coupon_code"] is None
    unique = spark.read.parquet(f"{lake}/silver/orders_deduplicated")
    assert rows(unique.filter("order_id = 62"), "event_id") == [("r-09",), ("r-24",)]


RETAIL_DAYS = [("2025-11-03", 1, 84.25), ("2025-11-05", 4, 181.5)]


def retail_days(spark, lake):
    return rows(spark.read.parquet(f"{lake}/gold/daily_revenue"), F.col("order_date").cast("string"), "order_count", "total_revenue_usd")


def test_retail_lake_incremental(spark, tmp_path):
    source, lake, checkpoint = tmp_path / "in", tmp_path / "lake", str(tmp_path / "checkpoint")
    source.mkdir()
    fx.write_retail_inputs(source)
    held = (source / "order_events_batch_2.jsonl").read_text()
    (source / "order_events_batch_2.jsonl").unlink()
    first = retail_lake.run_incremental(spark, str(source), str(lake), checkpoint)
    assert (first["bronze_rows"], first["processed_files"]) == (6, 1)
    (source / "order_events_batch_2.jsonl").write_text(held)
    for _ in range(2):  # the second run finds nothing new
        metrics = retail_lake.run_incremental(spark, str(source), str(lake), checkpoint)
        assert metrics == CONTRACT | {"processed_files": 2}
    assert RETAIL_DAYS == retail_days(spark, lake)


def retail_gold(spark, lake):
    """All of gold and the current orders, without the folder columns of the incremental layout."""
    out = {}
    for name in ("gold/daily_revenue", "gold/category_revenue", "gold/segment_revenue", "silver/orders_enriched"):
        frame = spark.read.parquet(f"{lake}/{name}")
        kept = sorted(c for c in frame.columns if c not in ("period", "bucket", "batch_id") and not c.startswith("_"))
        out[name] = sorted(map(tuple, frame.select(kept).collect()), key=repr)
    return out


def retail_dimensions(spark, tmp_path):
    source = tmp_path / "dimensions"
    source.mkdir()
    fx.write_retail_inputs(source)
    return retail_lake.read_dimensions(spark, str(source))


def land_retail(spark, lake, batch, events):
    records = spark.createDataFrame([(*e, None, None) for e in events], ", ".join(
        f"{c} {'int' if c in ('order_id', 'customer_id') else 'double' if c == 'amount' else 'string'}" for c in fx.RETAIL_COLUMNS)
        + ", coupon_code string, delivery_promise string")
    records.write.mode("overwrite").parquet(f"{lake}/bronze/orders_raw/batch_id={batch}")


def data_files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_retail_refresh_touches_only_the_orders_of_new_files(spark, tmp_path):
    """Several loads end as one; days that no order left or reached keep their files; a day that its last order left goes."""
    dimensions, lake, whole = retail_dimensions(spark, tmp_path), tmp_path / "lake", tmp_path / "whole"
    loads = [fx.RETAIL_BATCH_1, fx.RETAIL_BATCH_2,
             [("r-31", 61, 301, "POT-1", "PAID", 84.25, "USD", "web", "2025-11-09T10:00:00Z"),  # leaves its day empty
              ("r-05", 65, 304, "PAN-2", "CANCELLED", 62.00, "USD", "web", "2025-11-03T09:02:00Z")],  # an older id of a copy
             [("r-41", 70, 301, "POT-1", "NEW", 5.00, "USD", "web", "bad time")]]
    touched = []
    for batch, events in enumerate(loads):
        before = data_files(lake / "gold/daily_revenue") if batch else {}
        land_retail(spark, lake, batch, events)
        touched.append(retail_lake.refresh(spark, str(lake), dimensions, buckets=4))
        after = data_files(lake / "gold/daily_revenue")
        for name, changed in before.items():
            if name.split("/")[0].split("=")[1] not in touched[-1]:
                assert after[name] == changed
    assert touched == [["2025-11-03"], ["2025-11-03", "2025-11-05"], ["2025-11-03", "2025-11-09"], []]
    assert not list((lake / "gold/daily_revenue/period=2025-11-03").glob("*.parquet"))
    assert retail_lake.refresh(spark, str(lake), dimensions) == []
    land_retail(spark, whole, 0, [e for load in loads for e in load])
    retail_lake.refresh(spark, str(whole), dimensions, buckets=4)
    assert retail_gold(spark, lake) == retail_gold(spark, whole)
    unique = spark.read.parquet(f"{lake}/silver/orders_deduplicated")
    assert rows(unique.filter("order_id = 65"), "event_id") == [("r-05",)]
    refined = retail_lake.refine(spark, str(whole), dimensions)  # the batch form over the same bronze table
    assert refined["current_order_rows"] == len(retail_gold(spark, lake)["silver/orders_enriched"])
    assert {k: v for k, v in retail_gold(spark, whole).items() if k.startswith("gold")} == {
        k: v for k, v in retail_gold(spark, lake).items() if k.startswith("gold")}


def test_replaced_partitions_are_computed_once(spark, tmp_path):
    """A touched folder that gets no row goes, one that is not touched stays, and the rows run once, not first for their folders."""
    path = str(tmp_path / "table")
    layout.replace_partitions(spark.createDataFrame([("a b", 1), ("b", 2), ("c", 3)], "part string, v int"), path, "part", ["a b", "b", "c"])
    rows_run = spark.sparkContext.accumulator(0)

    def counted(part):
        rows_run.add(1)
        return part

    again = spark.createDataFrame([("b", 5), ("d", 6)], "part string, v int")
    again = again.withColumn("part", F.udf(counted, "string").asNondeterministic()("part"))
    layout.replace_partitions(again, path, "part", ["a b", "b", "d"])
    assert rows(spark.read.parquet(path), "part", "v") == [("b", 5), ("c", 3), ("d", 6)]
    assert sorted(layout.list_partitions(spark, path)) == ["b", "c", "d"] and rows_run.value == 2


def test_orders_are_not_shuffled_to_a_handful_of_products(spark):
    """Few products out of a large source: its size estimate must not send every order to one of four tasks."""
    current = spark.range(10**9).select(F.col("id").cast("int").alias("order_id"), F.col("id").cast("int").alias("customer_id"),
                                        F.concat(F.lit("P-"), F.col("id") % 4).alias("product_id"), F.lit(2.0).alias("amount"),
                                        F.lit("USD").alias("currency"))
    customers = spark.range(3).selectExpr("CAST(id AS INT) AS customer_id", "'n' AS customer_name", "'e' AS email", "'c' AS country",
                                          "'r' AS region", "'g' AS loyalty_tier")
    products = spark.range(10**7).select(F.concat(F.lit("P-"), F.col("id") % 4).alias("product_id")).distinct().selectExpr(
        "product_id", "'n' AS product_name", "'c' AS category", "1.0D AS unit_cost")
    rates = spark.sql("SELECT 'USD' AS currency, 1.0D AS rate_to_usd")
    plan = retail_lake.enriched_orders(current, customers, products, rates)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("broken", ["gold/segment_by_day", "silver/orders_deduplicated"])
def test_retail_refresh_that_broke_off_is_repeated(spark, tmp_path, monkeypatch, broken):
    dimensions, lake, whole = retail_dimensions(spark, tmp_path), tmp_path / "lake", tmp_path / "whole"
    land_retail(spark, lake, 0, fx.RETAIL_BATCH_1)
    retail_lake.refresh(spark, str(lake), dimensions, buckets=4)
    land_retail(spark, lake, 1, fx.RETAIL_BATCH_2)
    own = retail_lake.replace_partitions

    def failing(df, path, *rest):
        if path.endswith(broken):
            raise OSError("executor lost")
        own(df, path, *rest)

    monkeypatch.setattr(retail_lake, "replace_partitions", failing)
    with pytest.raises(OSError):
        retail_lake.refresh(spark, str(lake), dimensions, buckets=4)
    monkeypatch.undo()
    assert retail_lake.refresh(spark, str(lake), dimensions, buckets=4) == ["2025-11-03", "2025-11-05"]
    land_retail(spark, whole, 0, fx.RETAIL_BATCH_1 + fx.RETAIL_BATCH_2)
    retail_lake.refresh(spark, str(whole), dimensions, buckets=4)
    assert retail_gold(spark, lake) == retail_gold(spark, whole)


def test_warehouse(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(fx.WAREHOUSE_ORDERS)
    (tmp_path / "customers.csv").write_bytes(fx.WAREHOUSE_CUSTOMERS.encode("latin-1"))
    tables = warehouse.run(spark, str(tmp_path / "orders.csv"), str(tmp_path / "customers.csv"), str(tmp_path / "wh"), "r1",
                           encoding="ISO-8859-1")
    assert tables["silver/orders"].count() == 7
    assert rows(tables["silver/customers"].filter("customer_id IN (11, 17, 20)"), "customer_id", "customer_name", "email", "city",
                "country") == [(11, "Tove Lind", "tove.lind@post.test", "Oslo", "NO"),
                               (17, "Jon Berg", None, "Bergen", "NO"),
                               (20, "Max Huber", "max@post.test", "Zürich", "CH")]
    top = {r["customer_id"]: r for r in tables["gold/customer_360"].collect()}
    assert (top[11]["total_orders"], round(top[11]["total_revenue"], 2), top[11]["top_category"], top[11]["customer_segment"]
            ) == (4, 256.75, "Light", "Premium")
    assert (top[17]["total_orders"], top[17]["total_revenue"], top[17]["customer_segment"]) == (0, 0.0, "New")
    assert top[13]["total_orders"] == 0 and top[12]["customer_segment"] == "New"
    sales = {str(r["order_date"]): r for r in tables["gold/daily_sales"].collect()}
    assert (sales["2026-03-01"]["total_orders"], sales["2026-03-01"]["unique_customers"], sales["2026-03-01"]["top_product"]
            ) == (2, 2, "Bulb")
    log = spark.read.parquet(f"{tmp_path}/wh/run_log")
    assert dict(rows(log, "table_name", "records_processed"))["silver/orders"] == 7
    assert tables["quality/results"].filter("status = 'PASS'").count() == 4


def test_warehouse_gate_stops_bad_load(spark, tmp_path):
    spoiled = fx.WAREHOUSE_ORDERS.replace("21.00", "-21.00")
    assert spoiled != fx.WAREHOUSE_ORDERS
    (tmp_path / "orders.csv").write_text(spoiled)
    (tmp_path / "customers.csv").write_text(fx.WAREHOUSE_CUSTOMERS)
    with pytest.raises(ValueError, match="no_negative_amounts"):
        warehouse.run(spark, str(tmp_path / "orders.csv"), str(tmp_path / "customers.csv"), str(tmp_path / "wh"), "r1")


def test_record_jobs(spark, tmp_path):
    fx.write_csv(tmp_path / "customers.csv", ["customer_id", "name", "email", "phone", "country", "order_amount"], [
        (101, "Alice Meyer", "ALICE@EXAMPLE.COM", "0049123456789", "de", 100.0), (102, "Bob Singh", "bob@example.com", "00919876543210", "in", 50.0),
        (103, "Charlie Rossi", "charlie@example.com", "0039061234567", "it", 30.0), (101, "Alice Meyer", "ALICE@EXAMPLE.COM", "0049123456789", "de", 100.0),
        (104, "Dana Null", "", "0015550104", "us", 75.0)])
    fx.write_csv(tmp_path / "orders.csv", ["order_id", "customer_id", "product_id", "status", "amount"],
                 [(1, 101, "P1", "NEW", 100.0), (2, 102, "P2", "NEW", 50.0), (3, 103, "P9", "CANCELED", 30.0)])
    fx.write_csv(tmp_path / "products.csv", ["product_id", "product_name", "category"],
                 [("P1", "Laptop", "Electronics"), ("P2", "Zzz", "Old"), ("P2", "Smartphone", "Electronics")])
    out = record_jobs.run(spark, str(tmp_path), str(tmp_path / "out"))
    assert rows(out["customers_clean"], "customer_id", "email", "phone", "country", "duplicate_count") == [
        ("101", "alice@example.com", "+49123456789", "DE", "2"), ("102", "bob@example.com", "+919876543210", "IN", "1"),
        ("103", "charlie@example.com", "+39061234567", "IT", "1")]
    assert rows(out["customers_rejected"], "customer_id") == [("104",)]
    charges = {r["order_id"]: r for r in out["orders_enriched"].collect()}
    assert float(charges["1"]["net_amount"]) == pytest.approx(105.0) and charges["3"]["product_category"] == "UNKNOWN"
    assert float(charges["2"]["discount_amount"]) == 0.0 and charges["2"]["product_name"] == "Smartphone"

    batch = [("1", '{"order_id": 1, "customer_id": 7, "product_id": "P1", "status": "new", "amount": 10}', "t", 0, 0),
             ("1", '{"order_id": 1, "customer_id": 7, "product_id": "P1", "status": "NEW", "amount": 99}', "t", 0, 1),
             ("2", '{"order_id": 2, "customer_id": 7, "status": "NEW", "amount": "5.5"}', "t", 0, 2),
             ("3", '{"order_id": 3, "customer_id": 8, "status": "UPDATED", "amount": 1}', "t", 0, 3), ("4", "broken", "t", 0, 4)]
    topic = spark.createDataFrame(batch, "key string, value string, topic string, partition int, offset bigint")
    clean, totals = record_jobs.event_batch(topic)
    assert rows(clean, "key") == [("1",), ("2",)]
    assert rows(totals, "key", "value") == [("7", '{"customer_id":7,"order_count":2,"total_amount":15.5,"average_amount":7.75}')]
