"""Command line: run one layered job. Paths may be any URI Spark can read."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from .plans import geo_lake, order_changes, product_kpis, record_jobs, retail_lake, warehouse
from .session import build_session
from .sources.messages import stream_message_files, stream_topic
from .streaming import flows


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakeweave", description=__doc__)
    parser.add_argument("--master", help="Spark master; by default that of spark-submit")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    job("product-kpis", "nested order events to product KPIs", "events", "lake")
    job("order-changes", "change log, clicks and shipments to facts and KPIs", "inputs", "outputs")
    retail = job("retail-lake", "retail order events to revenue tables", "source", "lake")
    retail.add_argument("--events", nargs="+", required=True, help="event files")
    retail.add_argument("--batch-id", default="manual")
    job("retail-incremental", "ingest new event files and refresh the lake", "source", "lake", "checkpoint")
    loads = job("warehouse", "order and customer CSV files to the warehouse", "orders", "customers", "warehouse")
    loads.add_argument("--run-id", default="manual")
    loads.add_argument("--encoding", default="UTF-8")
    job("record-jobs", "customer clean-up and order enrichment", "source", "target")
    topic = job("message-orders", "order messages to the keyed order table", "warehouse")
    topic.add_argument("--files", help="folder of JSON-lines messages instead of a topic")
    topic.add_argument("--servers")
    topic.add_argument("--topic", default="orders")
    topic.add_argument("--run-id", default="manual")
    topic.add_argument("--max-per-trigger", type=int)
    silver = job("geo-silver", "add the bronze files of the last hours to the silver tables", "bronze", "silver")
    silver.add_argument("--hours", type=float, default=2, help="how far back changed files are taken")
    silver.add_argument("--loaded-at", help="time of the load, which also names the run; default now")
    silver.add_argument("--format", help="avro or parquet, default what the lake writes")
    gold = job("geo-gold", "publish the geographic marts from silver tables", "silver", "gold", "snapshot")
    gold.add_argument("--as-of-ms", type=int, help="reference time, default now")
    job("geo-checks", "dataset rules over the silver tables", "silver")
    return parser


def main(argv: list[str] | None = None) -> object:
    args = _parser().parse_args(argv)
    spark = build_session(f"lakeweave-{args.job}", master=args.master)
    now = F.unix_millis(F.current_timestamp())
    if args.job == "product-kpis":
        result = {name: df.count() for name, df in product_kpis.run(spark, args.events, args.lake).items()}
    elif args.job == "order-changes":
        result = order_changes.run(spark, args.inputs, args.outputs)
    elif args.job == "retail-lake":
        result = retail_lake.run(spark, args.source, args.events, args.lake, args.batch_id)
    elif args.job == "retail-incremental":
        result = retail_lake.run_incremental(spark, args.source, args.lake, args.checkpoint)
    elif args.job == "warehouse":
        tables = warehouse.run(spark, args.orders, args.customers, args.warehouse, args.run_id, args.encoding)
        result = {name: df.count() for name, df in tables.items()}
    elif args.job == "record-jobs":
        result = {name: df.count() for name, df in record_jobs.run(spark, args.source, args.target).items()}
    elif args.job == "message-orders":
        topic = (stream_message_files(spark, args.files, args.max_per_trigger) if args.files
                 else stream_topic(spark, args.servers, [args.topic], max_per_trigger=args.max_per_trigger))
        result = {"orders": flows.run_message_orders(topic, args.warehouse, args.run_id).count()}
    elif args.job == "geo-silver":
        moment = datetime.now(timezone.utc)
        loaded_at = args.loaded_at or moment.strftime("%Y-%m-%d %H:%M:%S")
        changed_after = (moment - timedelta(hours=args.hours)).strftime("%Y-%m-%dT%H:%M:%S")
        schemas = geo_lake.bronze_schemas(spark, args.bronze, args.format)
        rows = geo_lake.read_bronze(spark, args.bronze, schemas, changed_after, args.format)
        result = {row["entity"]: row["status"] for row in geo_lake.build_silver(spark, rows, args.silver, loaded_at).collect()}
    elif args.job == "geo-gold":
        as_of = now if args.as_of_ms is None else F.lit(args.as_of_ms)
        outcome = geo_lake.build_gold(spark, args.silver, args.gold, as_of, args.snapshot)
        result = {row["mart"]: row["status"] for row in outcome.collect()}
    else:
        checks = geo_lake.check_silver(spark, args.silver, now)
        result = {} if checks is None else {row["rule"]: row["status"] for row in checks.collect()}
    print(json.dumps(result, sort_keys=True, default=str))
    return result


if __name__ == "__main__":
    main()
