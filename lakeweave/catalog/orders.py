"""Order, customer and product queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import converted, money, order_charges
from ..functions.temporal import partition_parts, strict_date
from ..functions.text import blank_to_null, clean_columns, international_phone, prefix_number
from ..operators import aggregates as agg, mergeable
from ..operators import keyed, merge, quality
from ..operators.enrich import enrich, last_row_wins, lookup, members, pending, with_membership
from ..session import scratch_dir
from .registry import Lake, day, query, real, whole


def is_cancelled() -> Column:
    return F.col("o_orderstatus") == "P"


def amount() -> Column:
    return money("o_totalprice")


def line_revenue() -> Column:
    return money("l_extendedprice") * (F.lit(Decimal("1.00")) - F.col("l_discount").cast("decimal(4,2)"))


SQL_LINE_REVENUE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1.00 - CAST(l_discount AS DECIMAL(4,2)))"


def customer_dimension(lake: Lake) -> DataFrame:
    """Customers in credit, with nation and region; the others play unknown customers."""
    nation = lake("nation").join(lake("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (lake("customer").filter("c_acctbal > 0")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("r_name").alias("region"),
                    F.col("c_mktsegment").alias("tier")))


SQL_DIMENSION = """SELECT c_custkey, c_name, r_name AS region, c_mktsegment AS tier FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > 0"""


def order_rules() -> list[quality.Rule]:
    return [
        ("missing_customer", quality.missing("o_custkey")),
        ("non_positive_amount", F.col("o_totalprice") <= 0),
        ("amount_too_large", F.col("o_totalprice") > 450000),
        ("invalid_status", quality.not_in("status", ("O", "F", "P"))),
    ]


def current_orders(lake: Lake) -> DataFrame:
    cleaned = clean_columns(lake("orders").withColumn("status", F.col("o_orderstatus")),
                            upper=["status"], casts={"o_totalprice": "double"})
    checked = quality.with_errors(cleaned, order_rules())
    valid, _ = quality.split_valid(checked, F.col("is_valid"))
    unique = keyed.business_key_dedup(valid, ["o_custkey", "o_orderdate", "status", "o_totalprice"], "o_orderkey")
    return keyed.latest_by_key(unique, ["o_custkey"], ["o_orderdate", "o_orderkey"])


SQL_CURRENT = """valid AS (SELECT *, upper(trim(o_orderstatus)) AS status FROM orders
    WHERE o_custkey IS NOT NULL AND o_totalprice > 0 AND o_totalprice <= 450000 AND upper(trim(o_orderstatus)) IN ('O','F','P')),
  uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate, status, o_totalprice
    ORDER BY o_orderkey) AS rn FROM valid) WHERE rn = 1),
  cur AS (SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM uniq) WHERE rn = 1)"""


@query(f"""WITH {SQL_CURRENT}, dim AS ({SQL_DIMENSION})
SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, COALESCE(region, 'UNKNOWN') AS region,
  count(DISTINCT o_orderkey) AS order_count, count(DISTINCT o_custkey) AS customer_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value,
  sum(CASE WHEN c_name IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing_customers
FROM cur LEFT JOIN dim ON o_custkey = c_custkey WHERE status <> 'P' GROUP BY 1, 2""")
def layered_daily_revenue(lake: Lake) -> DataFrame:
    """Clean, check, de-duplicate, take the current order, enrich, and report revenue per day."""
    enriched = enrich(current_orders(lake), customer_dimension(lake), ["o_custkey"], ["c_name", "region", "tier"],
                      flag="customer_match", missing="MISSING_CUSTOMER",
                      defaults={"region": "UNKNOWN", "tier": "UNKNOWN"})
    revenue = agg.revenue_by(
        enriched.filter(F.col("status") != "P").withColumn("order_date", F.to_date("o_orderdate")), ["order_date", "region"],
        distincts={"order_count": F.col("o_orderkey"), "customer_count": F.col("o_custkey")},
        sums={"total_revenue": amount(), "missing_customers": F.when(F.col("customer_match") != "MATCHED", 1).otherwise(0)},
        means={"avg_order_value": amount()}, digits=None)
    return revenue.withColumns({"order_date": day("order_date"), "total_revenue": real("total_revenue")})


@query("""SELECT o_orderstatus AS status, count(*) AS event_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount_total FROM orders GROUP BY 1 ORDER BY 2 DESC, 1""")
def status_counts(lake: Lake) -> DataFrame:
    lake("orders").createOrReplaceTempView("raw_orders")
    return lake.spark.sql("""SELECT o_orderstatus AS status, count(*) AS event_count,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount_total
        FROM raw_orders GROUP BY o_orderstatus ORDER BY event_count DESC, status""")


@query("""SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus <> 'P') AS submitted_orders,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS cancelled_orders,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS net_value
FROM orders GROUP BY 1""")
def signed_net_by_priority(lake: Lake) -> DataFrame:
    return agg.signed_totals(lake("orders"), ["o_orderpriority"], amount(), is_cancelled()).withColumn(
        "net_value", real("net_value"))


@query("""SELECT o_orderpriority, count(*) AS order_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS net_sales
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def net_sales_without_cancelled(lake: Lake) -> DataFrame:
    return agg.product_kpis(lake("orders"), ["o_orderpriority"], amount(), is_cancelled()).withColumn(
        "net_sales", real("net_sales"))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(*) AS order_count,
  count(*) FILTER (WHERE o_orderstatus IN ('F','O')) AS paid_or_shipped_count,
  COALESCE(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus IN ('F','O')) AS DOUBLE), 0) AS recognized_revenue
FROM orders GROUP BY 1""")
def kpi_conditional_daily(lake: Lake) -> DataFrame:
    dated = lake("orders").withColumn("order_date", F.to_date("o_orderdate"))
    kpis = agg.daily_kpis(dated, "order_date", amount(), F.col("o_orderstatus").isin("F", "O"))
    return kpis.withColumns({"order_date": day("order_date"), "recognized_revenue": real("recognized_revenue")})


@query(f"""WITH dim AS ({SQL_DIMENSION})
SELECT COALESCE(region, 'UNKNOWN') AS region, count(*) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_order_amount
FROM orders LEFT JOIN dim ON o_custkey = c_custkey GROUP BY 1""")
def region_gross(lake: Lake) -> DataFrame:
    facts = lookup(lake("orders"), customer_dimension(lake), ["o_custkey"], {"region": "UNKNOWN"})
    return agg.gross_by(facts, ["region"], amount()).withColumn("gross_order_amount", real("gross_order_amount"))


@query(f"""SELECT p_type AS category, count(DISTINCT l_orderkey) AS order_count,
  CAST(sum({SQL_LINE_REVENUE}) AS DOUBLE) AS total_revenue,
  CAST(sum({SQL_LINE_REVENUE} - CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_margin
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 3 DESC""")
def category_revenue(lake: Lake) -> DataFrame:
    priced = lake("lineitem").join(lake("part"), F.col("l_partkey") == F.col("p_partkey"))
    frame = agg.revenue_by(priced.withColumn("category", F.col("p_type")), ["category"],
                           distincts={"order_count": F.col("l_orderkey")},
                           sums={"total_revenue": line_revenue(),
                                 "gross_margin": line_revenue() - money("p_retailprice")}, digits=None)
    return frame.withColumns({c: real(c) for c in ("total_revenue", "gross_margin")}).orderBy(F.desc("total_revenue"))


@query(f"""WITH dim AS ({SQL_DIMENSION})
SELECT COALESCE(region, 'UNKNOWN') AS region, COALESCE(tier, 'UNKNOWN') AS tier, count(DISTINCT o_orderkey) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM orders LEFT JOIN dim ON o_custkey = c_custkey GROUP BY 1, 2""")
def segment_revenue(lake: Lake) -> DataFrame:
    facts = lookup(lake("orders"), customer_dimension(lake), ["o_custkey"], {"region": "UNKNOWN", "tier": "UNKNOWN"})
    return agg.revenue_by(facts, ["region", "tier"], distincts={"order_count": F.col("o_orderkey")},
                          sums={"total_revenue": amount()}, digits=None).withColumn("total_revenue", real("total_revenue"))


SQL_360 = """o AS (SELECT * FROM orders WHERE o_totalprice > 1000 AND o_orderstatus <> 'P'),
 modes AS (SELECT o_custkey, o_orderpriority AS top_category FROM (SELECT o_custkey, o_orderpriority,
   row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM o GROUP BY 1, 2) WHERE rn = 1),
 sums AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s,
   min(o_orderdate) AS f, max(o_orderdate) AS l FROM o GROUP BY 1),
 c360 AS (SELECT c_custkey AS customer_id, c_name AS customer_name, COALESCE(n, 0) AS total_orders,
   COALESCE(s, 0) AS total_revenue, COALESCE(s / n, 0) AS avg_order_value,
   COALESCE(strftime(f, '%Y-%m-%d'), '-') AS first_order_date, COALESCE(strftime(l, '%Y-%m-%d'), '-') AS last_order_date,
   COALESCE(top_category, '-') AS top_category,
   CASE WHEN s >= 200 THEN 'Premium' WHEN s >= 50 THEN 'Regular' ELSE 'New' END AS customer_segment
   FROM customer LEFT JOIN sums ON c_custkey = sums.o_custkey LEFT JOIN modes ON c_custkey = modes.o_custkey)"""


def customers_360(lake: Lake) -> DataFrame:
    orders = (lake("orders").filter("o_totalprice > 1000 AND o_orderstatus <> 'P'")
              .withColumnRenamed("o_custkey", "customer_id"))
    customers = lake("customer").withColumnsRenamed({"c_custkey": "customer_id", "c_name": "customer_name"})
    return agg.customer_360(customers, orders, "customer_id", ["customer_name"], "o_orderkey", amount(),
                            "o_orderdate", "o_orderpriority")


@query(f"WITH {SQL_360} SELECT * FROM c360")
def customer_360(lake: Lake) -> DataFrame:
    frame = customers_360(lake)
    return frame.withColumns({
        "first_order_date": F.coalesce(day("first_order_date"), F.lit("-")),
        "last_order_date": F.coalesce(day("last_order_date"), F.lit("-")),
        "top_category": F.coalesce("top_category", F.lit("-"))})


@query(f"WITH {SQL_360} SELECT customer_segment, count(*) AS customers FROM c360 GROUP BY 1 ORDER BY 2 DESC")
def segment_distribution(lake: Lake) -> DataFrame:
    return agg.segment_distribution(customers_360(lake))


@query("""WITH m AS (SELECT d, l_partkey FROM (SELECT l_shipdate AS d, l_partkey,
   row_number() OVER (PARTITION BY l_shipdate ORDER BY count(*) DESC, l_partkey) AS rn FROM lineitem GROUP BY 1, 2) WHERE rn = 1)
SELECT strftime(l_shipdate, '%Y-%m-%d') AS order_date, count(*) AS total_orders,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(DISTINCT l_suppkey) AS unique_customers,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value, any_value(m.l_partkey) AS top_product
FROM lineitem JOIN m ON m.d = l_shipdate GROUP BY 1""")
def daily_sales_top_product(lake: Lake) -> DataFrame:
    lines = lake("lineitem").withColumn("order_date", F.to_date("l_shipdate"))
    sales = agg.daily_sales(lines, "order_date", "l_suppkey", "l_partkey", money("l_extendedprice"))
    return sales.withColumn("order_date", day("order_date"))


@query("""SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
  CAST(sum(l_quantity) AS BIGINT) AS total_sold, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_unit_price, count(*) AS order_count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def product_performance(lake: Lake) -> DataFrame:
    lines = lake("lineitem").join(lake("part"), F.col("l_partkey") == F.col("p_partkey")).withColumnsRenamed(
        {"p_partkey": "product_id", "p_name": "product_name", "p_type": "category"})
    frame = agg.product_performance(lines, ["product_id", "product_name", "category"], whole("l_quantity"),
                                    money("l_extendedprice"), money("p_retailprice"))
    return frame.withColumn("total_revenue", real("total_revenue"))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(o_totalprice) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS average_amount,
  count(DISTINCT o_custkey) AS distinct_count FROM orders GROUP BY 1""")
def rollup_by_date(lake: Lake) -> DataFrame:
    dated = lake("orders").withColumn("order_date", F.to_date("o_orderdate"))
    return agg.rollup_by(dated, ["order_date"], amount(), "o_custkey").withColumns(
        {"order_date": day("order_date"), "total_amount": real("total_amount")})


@query("""SELECT o_custkey, count(o_totalprice) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS average_amount FROM orders GROUP BY 1""")
def batch_customer_totals(lake: Lake) -> DataFrame:
    return agg.rollup_by(lake("orders"), ["o_custkey"], amount()).withColumn("total_amount", real("total_amount"))


@query("""WITH s AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS c, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s FROM orders)
SELECT n AS total_orders, c AS unique_customers, s AS total_revenue, s / n AS avg_order_value, s / c AS revenue_per_customer FROM s""")
def global_kpis(lake: Lake) -> DataFrame:
    return agg.global_kpis(lake("orders"), "o_custkey", amount())


@query("""SELECT COALESCE(o_orderpriority, 'ALL') AS category, count(*) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ROLLUP (o_orderpriority)""")
def category_analysis(lake: Lake) -> DataFrame:
    return agg.category_analysis(lake("orders").withColumn("category", F.col("o_orderpriority")), "category", amount())


@query("""SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, count(o_orderkey) AS non_null_rows, count(*) - count(o_orderkey) AS null_rows FROM orders
UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey), count(*) - count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), count(*) - count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice), count(*) - count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate), count(*) - count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority), count(*) - count(o_orderpriority) FROM orders""")
def column_profile(lake: Lake) -> DataFrame:
    return agg.column_profile(lake("orders"))


@query("""SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'not_loaded', 0""")
def layer_counts(lake: Lake) -> DataFrame:
    return agg.layer_counts({"orders": lake("orders"), "customer": lake("customer"), "lineitem": lake("lineitem"),
                             "not_loaded": None})


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
  COALESCE(upper(trim(p_type)), 'UNKNOWN') AS product_category,
  l_extendedprice * 1.1::DOUBLE AS amount_with_tax,
  CASE WHEN l_extendedprice >= 50000 THEN l_extendedprice * 0.05::DOUBLE ELSE 0 END AS discount_amount,
  l_extendedprice * 1.1::DOUBLE - CASE WHEN l_extendedprice >= 50000 THEN l_extendedprice * 0.05::DOUBLE ELSE 0 END AS net_amount
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey""")
def order_metrics(lake: Lake) -> DataFrame:
    parts = lake("part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    found = lookup(lake("lineitem"), parts, ["l_partkey"], {"p_type": "UNKNOWN"})
    charges = order_charges("l_extendedprice", discount_from=50000)
    return found.select("l_orderkey", whole("l_linenumber").alias("l_linenumber"), "l_partkey",
                        F.upper(F.trim("p_type")).alias("product_category"),
                        *[c.alias(n) for n, c in charges.items()])


@query("""SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * r.rate, 2) AS DOUBLE) AS amount_usd,
  CAST(round(round(CAST(o_totalprice AS DECIMAL(18,2)) * r.rate, 2) - 25.00, 2) AS DOUBLE) AS gross_margin_usd
FROM orders JOIN (VALUES ('O', 1.000::DECIMAL(6,3)), ('F', 1.080::DECIMAL(6,3)), ('P', 0.012::DECIMAL(6,3))) r(code, rate)
  ON o_orderstatus = r.code""")
def currency_conversion(lake: Lake) -> DataFrame:
    rate = F.col("rate").cast("decimal(6,3)")
    rates = (lake("orders").select("o_orderstatus").distinct()
             .withColumn("rate", F.expr("CASE o_orderstatus WHEN 'O' THEN 1.000 WHEN 'F' THEN 1.080 ELSE 0.012 END")))
    usd = lake("orders").join(rates, "o_orderstatus").withColumn("amount_usd", converted(amount(), rate))
    return usd.select("o_orderkey", real("amount_usd").alias("amount_usd"),
                      real(F.round(F.col("amount_usd") - F.lit(Decimal("25.00")), 2)).alias("gross_margin_usd"))


@query(f"""WITH dim AS ({SQL_DIMENSION})
SELECT o_orderkey, CASE WHEN c_name IS NULL THEN 'MISSING_CUSTOMER' ELSE 'MATCHED' END AS customer_match,
  COALESCE(region, 'UNKNOWN') AS region, COALESCE(tier, 'UNKNOWN') AS tier FROM orders LEFT JOIN dim ON o_custkey = c_custkey""")
def enrich_match_flags(lake: Lake) -> DataFrame:
    frame = enrich(lake("orders"), customer_dimension(lake), ["o_custkey"], ["c_name", "region", "tier"],
                   flag="customer_match", missing="MISSING_CUSTOMER", defaults={"region": "UNKNOWN", "tier": "UNKNOWN"})
    return frame.select("o_orderkey", "customer_match", "region", "tier")


@query("""WITH d AS (SELECT * FROM (SELECT p_size, p_name, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey DESC) AS rn
  FROM part WHERE p_retailprice > 1000) WHERE rn = 1)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, COALESCE(p_name, 'UNKNOWN') AS p_name
FROM lineitem LEFT JOIN d ON CAST(l_quantity AS INT) = p_size""")
def lookup_default(lake: Lake) -> DataFrame:
    """Lookup on a dimension with duplicate keys: the row loaded last wins."""
    dimension = last_row_wins(lake("part").filter("p_retailprice > 1000"), ["p_size"], ["p_partkey"])
    lines = lake("lineitem").withColumn("p_size", F.col("l_quantity").cast("int"))
    return lookup(lines, dimension, ["p_size"], {"p_name": "UNKNOWN"}).select(
        "l_orderkey", whole("l_linenumber").alias("l_linenumber"), "l_partkey", "p_name")


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 250000 THEN true ELSE false END AS kept FROM orders""")
def split_valid_rejected(lake: Lake) -> DataFrame:
    valid, rejected = quality.split_valid(lake("orders"), F.col("o_totalprice") > 250000)
    columns = ["o_orderkey", "o_custkey"]
    return valid.select(*columns, F.lit(True).alias("kept")).union(rejected.select(*columns, F.lit(False).alias("kept")))


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_text, CAST(o_totalprice AS BIGINT) AS amount_whole,
  strftime(o_orderdate, '%Y-%m-%d') AS order_date,
  CASE WHEN o_orderstatus = 'P' THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
  CASE WHEN o_orderstatus = 'P' THEN false ELSE true END AS date_parsed FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""")
def select_cast_strict_date(lake: Lake) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.lit("bad")).otherwise(day("o_orderdate"))
    return lake("orders").withColumn("date_text", text).select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer_text"),
        whole(F.floor("o_totalprice")).alias("amount_whole"), day("o_orderdate").alias("order_date"), "date_text",
        strict_date("date_text").isNotNull().alias("date_parsed"))


@query("""SELECT c_custkey, trim(c_name) AS customer_name, lower(trim(c_mktsegment)) AS segment_lower,
  upper(trim(c_mktsegment)) AS segment_upper,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment_title,
  CASE WHEN c_acctbal < 0 THEN true ELSE false END AS email_blank,
  CASE WHEN c_nationkey < 10 THEN '+' ELSE '01' END || CAST(c_custkey AS VARCHAR) AS phone,
  'auto-' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS region_name FROM customer""")
def string_clean(lake: Lake) -> DataFrame:
    raw = lake("customer").withColumns({
        "customer_name": F.concat(F.lit("  "), "c_name", F.lit(" ")),
        "segment_lower": F.concat(F.lit(" "), "c_mktsegment"), "segment_upper": F.concat("c_mktsegment", F.lit(" ")),
        "segment_title": F.col("c_mktsegment"),
        "email": F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise("x@example.com"),
        "phone": F.concat(F.when(F.col("c_nationkey") < 10, F.lit(" 00")).otherwise("01"), F.col("c_custkey").cast("string"))})
    cleaned = clean_columns(raw, plain=["customer_name"], lower=["segment_lower"], upper=["segment_upper"],
                            title=["segment_title"])
    return cleaned.select("c_custkey", "customer_name", "segment_lower", "segment_upper", "segment_title",
                          blank_to_null("email").isNull().alias("email_blank"),
                          international_phone("phone").alias("phone"),
                          prefix_number("auto-", "c_nationkey", 4).alias("region_name"))


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 100000 AND o_totalprice >= 100001
  AND o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderpriority NOT IN ('5-LOW')
  AND o_totalprice BETWEEN 120000 AND 400000""")
def row_predicates(lake: Lake) -> DataFrame:
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return lake("orders").filter(F.col("o_custkey").isNotNull() & (price > 100000) & (price >= 100001)
                                 & (F.col("o_orderstatus") != "P") & priority.isin("1-URGENT", "2-HIGH")
                                 & ~priority.isin("5-LOW") & price.between(120000, 400000)).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def pending_orders(lake: Lake) -> DataFrame:
    done = lake("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return pending(lake("orders"), done, ["o_orderkey"]).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def member_orders(lake: Lake) -> DataFrame:
    done = lake("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return members(lake("orders"), done, ["o_orderkey"]).select("o_orderkey")


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
  EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') AS known_order FROM lineitem""")
def order_membership_flag(lake: Lake) -> DataFrame:
    current = lake("orders").filter("o_orderstatus <> 'P'")
    return with_membership(lake("lineitem"), current, "l_orderkey", "o_orderkey", "known_order").select(
        "l_orderkey", whole("l_linenumber").alias("l_linenumber"), "l_partkey", "known_order")


def order_changes(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Orders of one status as the target; events as changes keyed by the order number."""
    target = lake("orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"))
    changes = lake("events").filter("event_type IN ('purchase', 'signup')").select(
        (F.col("user_id") * 3).alias("order_id"), F.col("event_type").alias("status"),
        F.col("value").alias("amount"), F.lit("new").alias("priority"), "ts", "event_id")
    return target, merge.last_change_per_key(changes, ["order_id"], ["ts", "event_id"]).drop("ts", "event_id")


SQL_CHANGES = """t AS (SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount, o_orderpriority AS priority
    FROM orders WHERE o_orderstatus = 'F'),
  c AS (SELECT user_id * 3 AS order_id, event_type AS status, value AS amount, 'new' AS priority FROM (SELECT *, row_number()
    OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type IN ('purchase', 'signup')) WHERE rn = 1)"""


@query(f"""WITH {SQL_CHANGES} SELECT COALESCE(t.order_id, c.order_id) AS order_id, COALESCE(c.status, t.status) AS status,
  COALESCE(c.amount, t.amount) AS amount, COALESCE(t.priority, c.priority) AS priority FROM t FULL JOIN c ON t.order_id = c.order_id""")
def upsert_merge(lake: Lake) -> DataFrame:
    target, changes = order_changes(lake)
    return merge.upsert(target, changes, ["order_id"], ["status", "amount"])


@query(f"WITH {SQL_CHANGES} SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = c.order_id)")
def insert_new(lake: Lake) -> DataFrame:
    target, changes = order_changes(lake)
    return merge.insert_new(target, changes, ["order_id"]).select("order_id", "status", "amount", "priority")


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS summary_date, count(*) AS total_bronze,
  count(*) FILTER (WHERE o_orderstatus <> 'P') AS total_silver FROM orders GROUP BY 1""")
def daily_summary_upsert(lake: Lake) -> DataFrame:
    """A summary loaded from urgent orders only, then corrected by a full re-run: one row per day."""
    dated = lake("orders").withColumn("summary_date", F.to_date("o_orderdate"))

    def counts(df: DataFrame) -> DataFrame:
        return df.groupBy("summary_date").agg(F.count(F.lit(1)).alias("total_bronze"),
                                              F.count_if(~is_cancelled()).alias("total_silver"))

    first = counts(dated.filter("o_orderpriority = '1-URGENT'"))
    return merge.daily_summary(first, counts(dated)).withColumn("summary_date", day("summary_date"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice, copies FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS copies,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def unique_with_count(lake: Lake) -> DataFrame:
    return keyed.unique_with_count(lake("orders"), ["o_custkey"], ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice", "copies")


@query("""SELECT o_orderkey, o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def business_key_dedup(lake: Lake) -> DataFrame:
    keys = ["o_custkey", "o_orderstatus", "o_orderpriority", "not_in_this_feed"]
    return keyed.business_key_dedup(lake("orders"), keys, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderpriority")


@query("""SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey FROM (SELECT *, row_number() OVER (
  PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer WHERE c_name <> '') WHERE rn = 1""")
def distinct_on_key(lake: Lake) -> DataFrame:
    order = [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc()]
    rows = keyed.top_per_key(lake("customer").filter("c_name <> ''"), ["c_nationkey", "c_mktsegment"], order)
    return rows.select("c_custkey", "c_name", whole("c_nationkey").alias("c_nationkey"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def sort_then_unique(lake: Lake) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keyed.first_by_key(lake("lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_suppkey")


@query("""SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders
  GROUP BY 1 ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_custkey LIMIT 200""")
def top_customers(lake: Lake) -> DataFrame:
    totals = lake("orders").groupBy("o_custkey").agg(F.sum(amount()).alias("revenue"))
    return keyed.top_n(totals, [F.desc("revenue"), F.col("o_custkey").asc()], 200).withColumn("revenue", real("revenue"))


@query("""SELECT order_month, o_custkey, revenue, rank FROM (SELECT *, row_number() OVER (PARTITION BY order_month
   ORDER BY revenue DESC, o_custkey) AS rank FROM (SELECT strftime(o_orderdate, '%Y-%m') AS order_month, o_custkey,
   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2)) WHERE rank <= 10""")
def top_k_per_month(lake: Lake) -> DataFrame:
    monthly = (lake("orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), "o_custkey")
               .agg(real(F.sum(amount())).alias("revenue")))
    return keyed.top_k_in_group(monthly, ["order_month"], "revenue", ["o_custkey"], 10).withColumn("rank", whole("rank"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 300")
def newest_300(lake: Lake) -> DataFrame:
    return keyed.newest_n(lake("orders"), "o_orderdate", "o_orderkey", 300).select("o_orderkey", "o_custkey")


@query("""SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, COALESCE(c_mktsegment, '-') AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, '-' FROM supplier""")
def union_with_drift(lake: Lake) -> DataFrame:
    """Two batches by name; the second lacks an optional column."""
    first = lake("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                    F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    second = lake("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"),
                                     F.col("s_name").alias("name"))
    return first.unionByName(second, allowMissingColumns=True).fillna({"segment": "-"})


@query("SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL")
def distinct_categories(lake: Lake) -> DataFrame:
    return lake("part").filter("p_type IS NOT NULL").select(F.col("p_type").alias("category")).distinct()


@query("""SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
  count(*) AS row_count FROM orders GROUP BY 1, 2, 3""")
def date_parts(lake: Lake) -> DataFrame:
    return agg.count_by(lake("orders").withColumns(partition_parts("o_orderdate")), ["year", "month", "day"])


@query("""SELECT o_orderkey, o_custkey, CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS position_text FROM orders
  ORDER BY o_orderdate, o_orderkey""")
def ordered_by_position(lake: Lake) -> DataFrame:
    return lake("orders").orderBy("o_orderdate", "o_orderkey").select(
        "o_orderkey", "o_custkey", F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("position_text"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS period, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1 UNION ALL
SELECT strftime(o_orderdate, '%Y'), count(DISTINCT o_custkey) FROM orders GROUP BY 1""")
def distinct_customers_by_period(lake: Lake) -> DataFrame:
    """Months and years from the stored bitmaps of days, without going back to the orders."""
    path = scratch_dir(lake.spark, "daily-customers")
    mergeable.distinct_bitmaps(lake("orders"), [day("o_orderdate").alias("day")], "o_custkey").write.parquet(path)
    stored = lake.spark.read.parquet(path)
    periods = [mergeable.distinct_counts(stored.withColumn("period", F.substring("day", 1, n)), ["period"], "customers") for n in (7, 4)]
    return periods[0].unionByName(periods[1])
