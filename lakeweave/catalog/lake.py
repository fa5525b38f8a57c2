"""File layouts, ingest and whole layered jobs on the test tables: written to the shared folder, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import merge
from ..plans import order_changes, product_kpis, record_jobs, retail_lake, warehouse
from ..session import scratch_dir
from ..sources import files, layout, messages
from .changes import OP_CASE
from .registry import Lake, day, query, real, us, whole


def out(lake: Lake, name: str) -> str:
    return scratch_dir(lake.spark, name)


@query("""SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def csv_round_trip(lake: Lake):
    """Written with padded fields and odd header case, read trimmed with lower-case names."""
    path = out(lake, "csv")
    padded = lake("customer").withColumn("c_mktsegment", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
    padded = padded.toDF(*[c.upper() for c in padded.columns])
    files.write_table(padded, path, fmt="csv", header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    schema = "C_CUSTKEY bigint, C_NAME string, C_NATIONKEY bigint, C_ACCTBAL double, C_MKTSEGMENT string"
    return files.read_csv(lake.spark, path, schema, trim=True, lower_names=True)


@query("""SELECT s_suppkey, s_name, COALESCE(CASE WHEN s_nationkey < 5 THEN NULL ELSE s_acctbal END, -1) AS s_acctbal FROM supplier""")
def json_lines_round_trip(lake: Lake):
    path = out(lake, "json")
    rows = lake("supplier").withColumn("s_acctbal", F.when(F.col("s_nationkey") >= 5, F.col("s_acctbal")))
    rows.write.json(path)
    read = files.read_json_lines(lake.spark, path, "s_suppkey bigint, s_name string, s_acctbal double, note string")
    return read.select("s_suppkey", "s_name", F.coalesce("s_acctbal", F.lit(-1.0)).alias("s_acctbal"))


@query("SELECT o_orderstatus, count(*) AS row_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def partitioned_write(lake: Lake):
    path = out(lake, "by-status")
    files.write_table(lake("orders"), path, partition_by=["o_orderstatus"])
    return agg.count_by(lake.spark.read.parquet(path).filter("o_orderstatus <> 'P'"), ["o_orderstatus"])


@query("""SELECT strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS row_count FROM events GROUP BY 1""")
def hourly_landing(lake: Lake):
    path = out(lake, "hourly")
    layout.land_hourly(lake("events"), path, "ts")
    hour = F.format_string("%04d-%02d-%02d %02d", *[F.col(p).cast("int") for p in layout.HOURLY])
    return agg.count_by(lake.spark.read.parquet(path).withColumn("hour", hour), ["hour"])


@query("SELECT event_id, value, CAST(day(ts) AS BIGINT) AS day FROM events")
def daily_rewrite(lake: Lake):
    """Two runs, the first repeated: nothing is added twice and neither run removes the other."""
    path = out(lake, "daily")
    for run_id, condition in (("a", "value < 10"), ("b", "value >= 10"), ("a", "value < 10")):
        layout.land_daily(lake("events").filter(condition), path, "ts", run_id)
    return lake.spark.read.parquet(path).select("event_id", "value", whole("day").alias("day"))


@query("SELECT p_type AS category, count(*) AS row_count FROM part GROUP BY 1")
def snapshot_and_latest(lake: Lake):
    path = out(lake, "gold")
    mart = agg.count_by(lake("part").withColumnRenamed("p_type", "category"), ["category"])
    layout.write_snapshot(mart.filter("row_count < 0"), path, "first")
    layout.write_snapshot(mart, path, "second")
    return layout.read_latest(lake.spark, path)


@query("""SELECT 'orders.parquet' AS "_source_file", count(*) AS "rows", CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders""")
def incremental_ingest(lake: Lake):
    """Two runs over the same folder: the second finds nothing new."""
    base = out(lake, "ingest")
    for _ in range(2):
        layout.ingest_new_files(lake.spark, f"{lake.root}/orders.parque[t]", lake("orders").schema, "parquet", f"{base}/table",
                                f"{base}/checkpoint")
    table = lake.spark.read.parquet(f"{base}/table")
    return table.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"),
                                             real(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).alias("total"))


@query("""SELECT o_orderkey, 'orders.parquet' AS "_source_file", 'batch-1' AS "_ingestion_batch_id", true AS stamped FROM orders""")
def source_metadata(lake: Lake):
    rows = files.with_source_metadata(lake("orders"), "batch-1")
    return rows.select("o_orderkey", "_source_file", "_ingestion_batch_id", F.col("_bronze_ingested_at").isNotNull().alias("stamped"))


@query("""SELECT 'orders' AS source, true AS "exists", count(*) AS row_count FROM orders UNION ALL SELECT 'absent', false, 0""")
def source_inventory(lake: Lake):
    return layout.source_inventory(lake.spark, {"orders": ("parquet", f"{lake.root}/orders.parquet"),
                                                "absent": ("parquet", f"{lake.root}/absent.parquet")})


@query("""SELECT user_id AS order_id, event_id AS last_source_lsn, CASE event_type WHEN 'purchase' THEN 'PAID' ELSE 'CREATED' END AS status, value AS amount,
  strftime(ts, '%Y-%m-%d') AS order_date, COALESCE(r.r_name, 'UNKNOWN') AS region FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) e
 LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey
WHERE rn = 1 AND event_type <> 'error'""")
def layered_order_facts(lake: Lake):
    """Change log with repeated messages: replay, drop deletes, and build facts with a region."""
    log = lake("events").select(
        F.col("value").alias("amount"), F.col("user_id").alias("customer_id"), F.col("event_id").cast("string").alias("event_id"),
        F.expr(OP_CASE).alias("op"), F.col("user_id").alias("order_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_ts"),
        F.lit("shop").alias("source"), F.col("event_id").alias("source_lsn"),
        F.expr("CASE event_type WHEN 'purchase' THEN 'PAID' ELSE 'CREATED' END").alias("status"), F.lit("orders").alias("table"))
    repeated = log.unionByName(log.filter("op = 'u'"))
    current, _ = order_changes.current_orders(repeated)
    place = lake("nation").join(lake("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = lake("customer").filter("c_acctbal > 0").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("r_name").alias("region"))
    facts = order_changes.order_facts(current, customers).join(current.select("order_id", "last_source_lsn"), "order_id")
    return facts.select("order_id", "last_source_lsn", "status", "amount", "order_date", "region")


@query("""SELECT product, count(*) AS order_count, CAST(sum(unit_price * quantity) AS DOUBLE) AS net_sales FROM (
  SELECT lower(l_returnflag || '-' || l_linestatus) AS product, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price, CAST(l_quantity AS INT) AS quantity,
   l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY strftime(l_shipdate, '%Y-%m-%dT00:00:00Z') DESC,
   l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(CAST(l_extendedprice * 100 AS BIGINT) AS VARCHAR) DESC) AS rn FROM lineitem) WHERE rn = 1 AND l_linenumber <> 7 GROUP BY 1""")
def layered_product_kpis(lake: Lake):
    """Lines as nested events: current line per order, then sales without cancelled ones."""
    key = F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    events = lake("lineitem").select(
        key.alias("id"), F.date_format("l_shipdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("time"),
        F.struct(F.col("l_orderkey").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
                 F.concat(F.lit(" "), F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("product"),
                 F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
                 F.when(F.col("l_linenumber") == 7, "CANCELLED").otherwise("SUBMITTED").alias("status")).alias("data"))
    current = product_kpis.current_orders(product_kpis.order_lines(events))
    kpis = agg.product_kpis(current, ["product"], product_kpis.line_value(), F.col("status") == agg.CANCELLED)
    return kpis.withColumn("net_sales", real("net_sales"))


def retail_events(lake: Lake) -> DataFrame:
    """Orders as retail events: shaky codes, some unknown currencies and times."""
    return lake("orders").select(
        F.concat(F.lit("evt-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("event_id"),
        F.col("o_custkey").cast("int").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"),
        F.concat(F.lit(" p-"), F.col("o_orderpriority")).alias("product_id"),
        F.expr("CASE o_orderstatus WHEN 'O' THEN 'new ' WHEN 'F' THEN 'Shipped' ELSE 'cancelled' END").alias("status"),
        F.when(F.col("o_totalprice") > 5000, F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).alias("amount"),
        F.expr("CASE WHEN o_totalprice > 490000 THEN 'XXX' ELSE 'usd' END").alias("currency"), F.lit("WEB").alias("channel"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("bad time")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("event_time"))


SQL_RETAIL = """r AS (SELECT *, CASE WHEN o_totalprice > 5000 THEN o_totalprice ELSE -o_totalprice END AS amount FROM orders),
  v AS (SELECT * FROM r WHERE amount > 0 AND o_totalprice <= 490000 AND o_orderpriority <> '5-LOW' AND o_custkey IS NOT NULL),
  u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderstatus, amount, o_orderdate ORDER BY o_orderkey) AS d FROM v) WHERE d = 1),
  c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM u) WHERE rn = 1)"""


@query(f"""WITH {SQL_RETAIL} SELECT 'bronze' AS stage, count(*) AS row_count FROM orders UNION ALL SELECT 'valid', count(*) FROM v
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM orders) - count(*) FROM v UNION ALL SELECT 'deduplicated', count(*) FROM u UNION ALL SELECT 'current', count(*) FROM c""")
def retail_lake_counts(lake: Lake):
    base = out(lake, "retail")
    bronze = retail_events(lake)
    files.write_table(retail_lake.checked_orders(bronze), f"{base}/checked", partition_by=["is_valid"])
    checked = retail_lake.read_checked(lake.spark, f"{base}/checked")
    unique = retail_lake.deduplicated_orders(checked.filter("is_valid"))
    return agg.layer_counts({"bronze": bronze, "valid": checked.filter("is_valid"), "quarantine": checked.filter("NOT is_valid"),
                             "deduplicated": unique, "current": retail_lake.current_orders(unique)}
                            ).withColumnRenamed("table_name", "stage")


def retail_dimensions(lake: Lake) -> dict[str, DataFrame]:
    customers = lake("customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("int").alias("customer_id"), F.col("c_name").alias("customer_name"), F.lit("e").alias("email"),
        F.lit("c").alias("country"), F.lit("r").alias("region"), F.col("c_mktsegment").alias("loyalty_tier"))
    products = lake("orders").select(F.concat(F.lit("P-"), "o_orderpriority").alias("product_id")).distinct().select(
        "product_id", F.lit("n").alias("product_name"), F.lit("c").alias("category"), F.lit(10.0).alias("unit_cost"))
    rates = lake("region").filter("r_regionkey = 0").select(F.lit("USD").alias("currency"), F.lit(1.0).alias("rate_to_usd"))
    return {"customers": customers, "products": products, "rates": rates}


@query(f"""WITH {SQL_RETAIL} SELECT COALESCE(c_mktsegment, 'UNKNOWN') AS loyalty_tier, count(DISTINCT o_custkey) AS order_count FROM c
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 WHERE o_orderstatus <> 'P' GROUP BY 1""")
def retail_lake_segments(lake: Lake):
    checked = retail_lake.checked_orders(retail_events(lake))
    current = retail_lake.current_orders(retail_lake.deduplicated_orders(checked.filter("is_valid")))
    enriched = retail_lake.enriched_orders(current, **retail_dimensions(lake))
    return retail_lake.gold(enriched)["segment_revenue"].select("loyalty_tier", "order_count")


@query(f"""WITH {SQL_RETAIL}, s AS (SELECT * FROM c WHERE o_orderstatus <> 'P'),
  d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS k, count(*) AS order_count, count(DISTINCT o_custkey) AS customers, sum(CAST(amount AS DECIMAL(18,2))) AS revenue FROM s GROUP BY 1),
  g AS (SELECT COALESCE(c_mktsegment, 'UNKNOWN') AS k, count(*) AS order_count, NULL AS customers, sum(CAST(amount AS DECIMAL(18,2))) AS revenue FROM s LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 GROUP BY 1)
SELECT 'day' AS kind, k, order_count, customers, CAST(round(revenue, 2) AS DOUBLE) AS revenue FROM d UNION ALL
SELECT 'segment', k, order_count, customers, CAST(round(revenue, 2) AS DOUBLE) FROM g""")
def retail_lake_incremental(lake: Lake):
    """Orders landed in two batches by a hash of their key, each carried through the lake before the next one lands."""
    base, events = out(lake, "retail-steps"), retail_events(lake)
    for batch in range(2):
        part = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == batch)
        files.write_table(part, f"{base}/bronze/orders_raw/batch_id={batch}")
        retail_lake.refresh(lake.spark, base, retail_dimensions(lake), buckets=8, periods=retail_lake.YEARS)
    days = lake.spark.read.parquet(f"{base}/gold/daily_revenue").select(
        F.lit("day").alias("kind"), F.col("order_date").cast("string").alias("k"), "order_count",
        F.col("customer_count").alias("customers"), F.col("total_revenue_usd").alias("revenue"))
    segments = lake.spark.read.parquet(f"{base}/gold/segment_revenue").select(
        F.lit("segment").alias("kind"), F.col("loyalty_tier").alias("k"), "order_count",
        F.lit(None).cast("bigint").alias("customers"), F.col("total_revenue_usd").alias("revenue"))
    return days.unionByName(segments)


@query("""SELECT c_custkey AS customer_id, upper(c_mktsegment[1]) || lower(substr(c_mktsegment, 2)) AS customer_name, 'N' || c_nationkey AS country,
  COALESCE(CASE WHEN c_acctbal < 0 THEN NULL ELSE 'u@x.com' END, '-') AS email FROM customer""")
def warehouse_customers(lake: Lake):
    bronze = lake("customer").select(
        F.col("c_custkey").alias("customer_id"), F.concat(F.lit(" "), "c_mktsegment").alias("customer_name"),
        F.when(F.col("c_acctbal") >= 0, " U@x.com").otherwise("").alias("email"), F.lit("x").alias("city"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("country"), F.lit("2024-01-01").alias("signup_date"),
        F.lit(1).alias("_loaded_at"), F.lit(1).alias("_source_position"))
    reloaded = bronze.unionByName(bronze.filter("email = ''").withColumn("_loaded_at", F.lit(0)))
    return warehouse.silver_customers(reloaded).select("customer_id", "customer_name", "country",
                                                       F.coalesce("email", F.lit("-")).alias("email"))


@query("""SELECT user_id AS customer_id, count(*) AS order_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id) AS rn FROM events WHERE event_type <> 'error') WHERE rn = 1 GROUP BY 1""")
def order_event_batch(lake: Lake):
    """NEW order messages, one per order (user and day), and totals per customer."""
    order_id = F.col("user_id") * 100 + F.dayofmonth("ts")
    body = F.struct(order_id.cast("string").alias("order_id"), F.col("user_id").cast("string").alias("customer_id"),
                    F.expr("CASE event_type WHEN 'error' THEN 'UPDATED' ELSE 'new' END").alias("status"),
                    F.col("value").cast("string").alias("amount"))
    topic = lake("events").select(F.lit("k").alias("key"), F.to_json(body).alias("value"), F.lit("t").alias("topic"),
                                  F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "ts")
    events = record_jobs.new_order_events(topic)
    exact = events.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return record_jobs.customer_totals(exact).select(whole("customer_id").alias("customer_id"), "order_count",
                                                     real("total_amount").alias("total"))


@query("""SELECT c_custkey AS customer_id, c_name AS customer_name, CASE WHEN c_nationkey < 10 THEN '+1' ELSE '1' END AS phone, upper(c_mktsegment) AS country, 2 AS duplicate_count
FROM customer WHERE c_acctbal >= 0""")
def customer_cleanup(lake: Lake):
    raw = lake("customer").select(
        F.col("c_custkey").alias("customer_id"), F.concat("c_name", F.lit("  ")).alias("name"),
        F.when(F.col("c_acctbal") < 0, " ").otherwise("A@B.com").alias("email"),
        F.when(F.col("c_nationkey") < 10, "001").otherwise("1").alias("phone"), F.lower("c_mktsegment").alias("country"),
        F.col("c_acctbal").alias("order_amount"))
    clean, _ = record_jobs.clean_customers(raw.unionByName(raw))
    return clean.select("customer_id", "customer_name", "phone", "country", F.col("duplicate_count").cast("int").alias("duplicate_count"))


@query("""SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date, epoch_us(o_orderdate) AS order_us FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def partition_pruned_scan(lake: Lake):
    """A year of orders from a table laid out by year: only its folder is read."""
    path = out(lake, "by-year")
    files.write_table(lake("orders").withColumn("order_year", F.year("o_orderdate")), path, partition_by=["order_year"])
    return lake.spark.read.parquet(path).filter("order_year = 1996").select(
        F.col("o_orderkey").alias("order_id"), day("o_orderdate").alias("order_date"), us("o_orderdate").alias("order_us"))


@query("""SELECT c_custkey, c_name || ' Ö' || chr(233) AS c_name FROM customer""")
def encoded_csv(lake: Lake):
    """Accented names, written and read in a one-byte encoding."""
    path = out(lake, "latin")
    named = lake("customer").select("c_custkey", F.concat("c_name", F.lit(" Öé")).alias("c_name"))
    files.write_table(named, path, fmt="csv", header="true", encoding="ISO-8859-1")
    return files.read_csv(lake.spark, path, "c_custkey bigint, c_name string", encoding="ISO-8859-1")


@query("""SELECT n_nationkey AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation""")
def json_array_files(lake: Lake):
    """One file per region that holds an array of its nations."""
    path = out(lake, "arrays")
    entry = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    arrays = lake("nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(entry)).alias("value"))
    arrays.select("value").repartition(arrays.count(), F.monotonically_increasing_id()).write.option("maxRecordsPerFile", 1).text(path)
    return files.read_json_array(lake.spark, path, "id int, name string, region bigint")


@query("""SELECT o_orderstatus, count(*) AS row_count FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1""")
def recent_files(lake: Lake):
    """Files of nested folders changed since a moment; those of finished orders are made older than it."""
    path = out(lake, "recent")
    files.write_table(lake("orders"), f"{path}/nested", partition_by=["o_orderstatus"])
    hadoop_path = lake.spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop_path(f"{path}/nested/o_orderstatus=F")
    fs = folder.getFileSystem(lake.spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        fs.setTimes(status.getPath(), 1_500_000_000_000, -1)
    schema = lake("orders").drop("o_orderstatus").schema
    rows = files.read_recent(lake.spark, path, schema, "2020-01-01T00:00:00").withColumn(
        "o_orderstatus", F.regexp_extract(F.col("_metadata.file_path"), "o_orderstatus=(.)", 1))
    return agg.count_by(rows, ["o_orderstatus"])


@query("""SELECT p_type AS category, count(*) AS row_count FROM part GROUP BY 1""")
def full_refresh(lake: Lake):
    """A table replaced as a whole, twice."""
    path = out(lake, "refresh")
    counted = agg.count_by(lake("part").withColumnRenamed("p_type", "category"), ["category"])
    for rows in (counted.filter("row_count < 0"), counted):
        merge.full_refresh(rows, path)
    return lake.spark.read.parquet(path)


@query("""SELECT unnest(['orders', 'finished', 'large']) AS metric, unnest([count(*), count(*) FILTER (o_orderstatus = 'F'),
  count(*) FILTER (o_totalprice > 200000)]) AS value FROM orders""")
def metric_rows(lake: Lake):
    row = lake("orders").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
                             F.count_if(F.col("o_totalprice") > 200_000).alias("large"))
    return agg.metric_rows(row)


@query("""SELECT event_id, user_id FROM events WHERE event_type = 'purchase'""")
def only_one_run(lake: Lake):
    """Messages of one run of several in the same topic."""
    marked = lake("events").withColumn(messages.RUN_ID, F.when(F.col("event_type") == "purchase", "r2").otherwise("r1"))
    return messages.only_run(marked, "r2").select("event_id", "user_id")
