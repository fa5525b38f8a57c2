"""Whole flows and the command line."""

import json

from pyspark.sql import functions as F

from lakeweave.__main__ import main
from lakeweave.plans import rides

from . import fixtures as fx
from .test_streaming import BATCHES


def test_command_line(spark, tmp_path, capsys):
    inputs = tmp_path / "in"
    inputs.mkdir()
    fx.write_change_inputs(inputs)
    assert main(["order-changes", str(inputs), str(tmp_path / "out")])["valid_current_orders"] == 2
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["dlq_records"] == 2
    retail = tmp_path / "retail"
    retail.mkdir()
    fx.write_retail_inputs(retail)
    files = [str(retail / f"order_events_batch_{i}.jsonl") for i in (1, 2)]
    assert main(["retail-lake", str(retail), str(tmp_path / "lake"), "--events", *files])["current_order_rows"] == 7
    assert main(["geo-checks", str(tmp_path / "no-silver")]) == {}
    assert set(main(["geo-gold", str(tmp_path / "no-silver"), str(tmp_path / "gold"), "s1"]).values()) == {"skipped"}


def test_message_orders_job(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    message = lambda o, status, offset: json.dumps({"key": str(o), "topic": "orders", "partition": 0, "offset": offset, "value": json.dumps(
        {"order_id": o, "customer_id": 1, "product_id": "p", "status": status, "amount": 1.0})}) + "\n"
    (topic / "0.json").write_text(message(1, "NEW", 0) + message(2, "NEW", 1))
    target = str(tmp_path / "wh")
    assert main(["message-orders", target, "--files", str(topic), "--run-id", "r1"]) == {"orders": 2}
    (topic / "1.json").write_text(message(2, "PAID", 2))
    assert main(["message-orders", target, "--files", str(topic), "--run-id", "r2"]) == {"orders": 2}
    log = {r["run_id"]: r["records_processed"] for r in spark.read.parquet(f"{target}/run_log").collect()}
    assert log == {"r1": 2, "r2": 1}


def test_ride_flow(spark, tmp_path):
    rows = [t for batch in BATCHES for t in batch]
    (tmp_path / "trips.json").write_text("".join(json.dumps(t) + "\n" for t in rows))
    trips = spark.read.schema(rides.TRIP).json(str(tmp_path / "trips.json"))
    pings = spark.createDataFrame([("d1", 40.7549, -73.9840, "IDLE", None, "2026-06-01T10:00:00Z")], rides.PING)
    drivers = spark.createDataFrame([("d1", "One", "L1", 4.9, "T", "Y", 2020, None, True), ("d2", "Two", "L2", None, "T", "Y", 2021, None, True)], rides.DRIVER)
    out = rides.run(trips, pings, drivers, str(tmp_path / "out"), F.unix_micros(F.lit("2026-06-01T10:02:20Z").cast("timestamp")))
    counts = {name: df.count() for name, df in out.items()}
    assert (counts["clean"], counts["dead_letters"], counts["enriched"], counts["unknown_drivers"]) == (6, 4, 5, 1)
    assert counts["surge_trips"] == 1 and counts["shifts"] == 4
    surge = {r["zone"]: (r["trips_per_min"], r["idle_drivers"], r["surge_multiplier"]) for r in out["surge"].collect()}
    assert surge["MIDTOWN"] == (4, 1, 2.5) and surge["HARLEM"] == (0, 0, 1.0)
