"""Quality queries: rules per row, rules per table, service levels and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import changes, quality, rolling
from ..operators.enrich import harmonise_shipments
from ..plans import geo_lake
from .registry import Lake, query, us, whole


def line_rules() -> list[quality.Rule]:
    return [
        ("missing_part", quality.missing("l_partkey")),
        ("quantity_out_of_range", quality.outside("l_quantity", 3, 48)),
        ("price_out_of_range", quality.outside("l_extendedprice", 1000, 90000)),
        ("flag_not_in_set", quality.not_in("l_returnflag", ("A", "N"), null_fails=True)),
        ("heavy_discount", F.col("l_discount") > 0.09),
    ]


SQL_ERRORS = """list_filter([CASE WHEN l_partkey IS NULL THEN 'missing_part' END,
  CASE WHEN l_quantity NOT BETWEEN 3 AND 48 THEN 'quantity_out_of_range' END,
  CASE WHEN l_extendedprice NOT BETWEEN 1000 AND 90000 THEN 'price_out_of_range' END,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag_not_in_set' END,
  CASE WHEN l_discount > 0.09 THEN 'heavy_discount' END], lambda x: x IS NOT NULL)"""
LINE_KEY = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey"


def line_key() -> list[Column]:
    return [F.col("l_orderkey"), whole("l_linenumber").alias("l_linenumber"), F.col("l_partkey")]


@query(f"""SELECT {LINE_KEY}, array_to_string({SQL_ERRORS}, '|') AS quality_errors, len({SQL_ERRORS}) = 0 AS is_valid FROM lineitem""")
def quality_errors(lake: Lake):
    checked = quality.with_errors(lake("lineitem"), line_rules())
    return checked.select(*line_key(), F.concat_ws("|", "quality_errors").alias("quality_errors"), "is_valid")


@query(f"""SELECT 'lineitem' AS source, array_to_string({SQL_ERRORS}, ',') AS errors, l_orderkey, l_partkey, l_quantity
FROM lineitem WHERE len({SQL_ERRORS}) > 0""")
def nested_rejects(lake: Lake):
    rejects = quality.nested_rejects(lake("lineitem"), line_rules(), "lineitem")
    return rejects.select("source", F.array_join("errors", ",").alias("errors"), "record.l_orderkey", "record.l_partkey",
                          "record.l_quantity")


@query(f"""SELECT {LINE_KEY}, COALESCE(({SQL_ERRORS})[1], '-') AS reason FROM lineitem""")
def first_error(lake: Lake):
    return lake("lineitem").select(*line_key(), F.coalesce(quality.first_error(line_rules()), F.lit("-")).alias("reason"))


@query(f"""WITH e AS (SELECT {SQL_ERRORS} AS e FROM lineitem), r AS (SELECT unnest(['missing_part', 'quantity_out_of_range',
  'price_out_of_range', 'flag_not_in_set', 'heavy_discount']) AS rule)
SELECT rule, count(*) FILTER (WHERE NOT list_contains(e, rule)) AS passed, count(*) FILTER (WHERE list_contains(e, rule)) AS failed
FROM r, e GROUP BY 1""")
def expectation_counts(lake: Lake):
    return quality.rule_counts(lake("lineitem"), line_rules())


@query(f"""SELECT {LINE_KEY}, unnest({SQL_ERRORS}) AS _dlq_reason FROM lineitem""")
def dead_letter_rows(lake: Lake):
    return quality.dead_letters(lake("lineitem"), line_rules()).select(*line_key(), "_dlq_reason")


@query(f"""WITH e AS (SELECT len({SQL_ERRORS}) AS e FROM lineitem)
SELECT count(*) AS "rows", count(*) FILTER (WHERE e = 0) AS passed_rows, count(*) FILTER (WHERE e > 0) AS failed_rows,
  CAST(sum(e) AS BIGINT) AS failed_checks, 100.0::DOUBLE * (count(*) * 5 - CAST(sum(e) AS BIGINT)) / (count(*) * 5) AS score FROM e""")
def batch_score(lake: Lake):
    return quality.batch_score(lake("lineitem"), line_rules())


@query(f"""SELECT r AS rule, count(*) AS failed FROM (SELECT unnest({SQL_ERRORS}) AS r FROM lineitem) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def top_failing_rules(lake: Lake):
    return quality.top_failing(quality.rule_counts(lake("lineitem"), line_rules())).select("rule", "failed")


@query(f"""SELECT r AS reason, count(*) AS row_count FROM (SELECT COALESCE(({SQL_ERRORS})[1], 'unknown') AS r FROM lineitem) GROUP BY 1""")
def reason_histogram(lake: Lake):
    return agg.most_common(lake("lineitem"), quality.first_error(line_rules()))


def shipments(lake: Lake) -> DataFrame:
    """Lines as shipments with blank ids and codes outside the contract."""
    return lake("lineitem").select(
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.col("l_partkey").cast("string")).alias("shipment_id"),
        F.col("l_orderkey").cast("string").alias("order_id"), F.lit("BlueDart").alias("carrier"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).alias("status"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'DELIVERED' WHEN 'N' THEN 'LOST' ELSE 'CREATED' END").alias("shipment_status"),
        F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("updated_at"))


@query("""SELECT order_id, shipment_id, status, array_to_string(list_filter([
    CASE WHEN shipment_id = '' THEN 'missing shipment_id' END, CASE WHEN status = 'LOST' THEN 'invalid shipment status' END],
    lambda x: x IS NOT NULL), '|') AS errors, event_ts FROM (SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
  CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS shipment_id,
  CASE l_returnflag WHEN 'A' THEN 'DELIVERED' WHEN 'N' THEN 'LOST' ELSE 'CREATED' END AS status,
  CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y-%m-%d') ELSE 'now' END AS event_ts FROM lineitem)""")
def contract_errors(lake: Lake):
    rows = harmonise_shipments(shipments(lake), now=F.lit("now"))
    checked = quality.with_errors(rows, quality.shipment_contract(), "errors")
    return checked.select("order_id", "shipment_id", "status", F.concat_ws("|", "errors").alias("errors"), "event_ts")


@query("""SELECT 'positive_value' AS rule, 'PASS' AS status, 0.0::DOUBLE AS measure, count(*) AS rows_scanned FROM events WHERE value >= 0
UNION ALL SELECT 'error_rate', CASE WHEN 100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*) < 5 THEN 'PASS' ELSE 'FAIL' END,
  100.0::DOUBLE * count(*) FILTER (WHERE event_type = 'error') / count(*), count(*) FROM events
UNION ALL SELECT 'late_rate', CASE WHEN 100.0 * count(*) FILTER (WHERE epoch_us(ts) < m - 864000000000) / count(*) < 1 THEN 'PASS' ELSE 'FAIL' END,
  100.0::DOUBLE * count(*) FILTER (WHERE epoch_us(ts) < m - 864000000000) / count(*), count(*) FROM events, (SELECT max(epoch_us(ts)) AS m FROM events)
UNION ALL SELECT 'active_users', CASE WHEN count(DISTINCT user_id) >= 50 THEN 'PASS' ELSE 'FAIL' END, count(DISTINCT user_id)::DOUBLE, count(*) FROM events""")
def dataset_rules(lake: Lake):
    rows, measure = lake("events").withColumn("ts_us", us("ts")), F.col("measure")
    late = F.col("ts_us") < changes.late_cutoff(rows, "ts_us", 864_000_000_000)
    checks = [("positive_value", quality.count_of(F.col("value") < 0), measure == 0),
              ("error_rate", quality.share_of(F.col("event_type") == "error"), measure < 5),
              ("late_rate", quality.share_of(late), measure < 1),
              ("active_users", F.countDistinct("user_id"), measure >= 50)]
    return quality.dataset_rules(rows, checks, F.current_timestamp()).drop("checked_at")


@query("""WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms FROM events), t AS (SELECT max(ms) AS newest, count(*) AS n FROM e),
  m AS (SELECT 'seismic.has_magnitude' AS rule, count(*) FILTER (WHERE value IS NULL OR value = 0 OR user_id % 50 = 3)::DOUBLE AS measure, count(*) AS rows_scanned FROM e
    UNION ALL SELECT 'seismic.freshness', 700, n FROM t
    UNION ALL SELECT 'noaa.obs_coords_present', 100.0::DOUBLE * count(*) FILTER (WHERE user_id % 25 = 0) / count(*), count(*) FROM e
    UNION ALL SELECT 'noaa.freshness', 700, n FROM t
    UNION ALL SELECT 'ogn.positions_have_pk', 100.0::DOUBLE * count(*) FILTER (WHERE user_id % 6 = 0) / count(*), count(*) FROM e
    UNION ALL SELECT 'ogn.late_events_lt_1pct', 100.0::DOUBLE * count(*) FILTER (WHERE ms < newest - 86400000) / count(*), count(*) FROM e, t
    UNION ALL SELECT 'config.regions_active_min', count(*) FILTER (WHERE s_acctbal > 0), count(*) FROM supplier)
SELECT rule, CASE WHEN CASE rule WHEN 'seismic.has_magnitude' THEN measure = 0 WHEN 'seismic.freshness' THEN measure <= 600 WHEN 'noaa.obs_coords_present' THEN measure < 5
  WHEN 'noaa.freshness' THEN measure <= 1800 WHEN 'ogn.positions_have_pk' THEN measure < 10 WHEN 'ogn.late_events_lt_1pct' THEN measure < 1 ELSE measure >= 50 END
  THEN 'PASS' ELSE 'FAIL' END AS status, measure, rows_scanned FROM m""")
def standing_rules(lake: Lake):
    """The standing rules of the geographic silver tables; events play quakes, observations and positions, suppliers regions."""
    events = lake("events").withColumn("ts_ms", F.floor(us("ts") / 1000))
    tables = {
        "seismic_events": events.select(F.when(F.col("user_id") % 50 != 3, F.col("value")).alias("magnitude"), F.col("ts_ms").alias("ingested_ms")),
        "noaa_observations": events.select(F.when(F.col("user_id") % 25 != 0, F.col("value")).alias("lat"), F.lit(1.0).alias("lon"),
                                           F.col("ts_ms").alias("ingested_ms")),
        "ogn_positions": events.select("ts_ms", F.when(F.col("user_id") % 2 != 0, F.col("event_type")).alias("address"),
                                       F.when(F.col("user_id") % 3 != 0, F.col("event_type")).otherwise("").alias("callsign")),
        "regions": lake("supplier").select((F.col("s_acctbal") > 0).alias("is_active"))}
    now = events.agg((F.max("ts_ms") + 700_000).alias("now")).scalar()
    return geo_lake.check_tables(tables, now).drop("checked_at")


@query("""SELECT 'bronze_orders_not_empty' AS rule, 'PASS' AS status, count(*)::DOUBLE AS measure, count(*) AS rows_scanned FROM orders
UNION ALL SELECT 'no_null_order_ids', 'PASS', 0, count(*) FROM orders UNION ALL SELECT 'no_negative_amounts', 'PASS', 0, count(*) FROM orders
UNION ALL SELECT 'customers_loaded', 'PASS', count(*), count(*) FROM customer""")
def bronze_gate(lake: Lake):
    orders = lake("orders").withColumnsRenamed({"o_orderkey": "order_id", "o_totalprice": "total_amount"})
    return quality.bronze_gate(orders, lake("customer")).drop("checked_at")


@query("""SELECT 'bronze' AS layer, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations, count(*) FILTER (WHERE o_orderkey IS NULL) = 0 AS passed FROM orders
UNION ALL SELECT 'silver', count(*) FILTER (WHERE l_quantity <= 2), count(*) FILTER (WHERE l_quantity <= 2) = 0 FROM lineitem
UNION ALL SELECT 'gold', -1, true""")
def layer_checks(lake: Lake):
    return quality.layer_checks({"bronze": (lake("orders"), F.col("o_orderkey").isNull()),
                                 "silver": (lake("lineitem"), F.col("l_quantity") <= 2), "gold": (None, F.lit(True))})


@query("""SELECT count(*) AS row_count, epoch_us(max(ts)) AS latest_us,
  (epoch_us(TIMESTAMP '2024-02-15') - epoch_us(max(ts))) / 60000000.0::DOUBLE AS age_minutes FROM events""")
def freshness(lake: Lake):
    row = quality.freshness(lake("events"), "ts", F.to_timestamp_ntz(F.lit("2024-02-15")))
    return row.select("row_count", us("latest").alias("latest_us"), "age_minutes")


@query("""SELECT count(*) FILTER (WHERE value < 20) AS passed, count(*) AS total,
  count(*) FILTER (WHERE value < 20) / count(*)::DOUBLE AS pass_rate FROM events
WHERE epoch_us(ts) > (SELECT max(epoch_us(ts)) - 86400000000 FROM events)""")
def pass_rate_last_day(lake: Lake):
    rows = lake("events").withColumn("ts_us", us("ts"))
    since = changes.late_cutoff(rows, "ts_us", 86_400_000_000)
    return agg.pass_rate(rows, F.col("value") < 20, since, "ts_us", digits=None)


@query("""SELECT event_type AS rule, 100.0::DOUBLE * count(*) FILTER (WHERE value < 20) / count(*) AS pass_percentage FROM events GROUP BY 1""")
def pass_percentage_by_rule(lake: Lake):
    return agg.pass_percentage(lake("events").withColumnRenamed("event_type", "rule"), ["rule"], F.col("value") < 20)


@query("""WITH m AS (SELECT (epoch_us(TIMESTAMP '2024-02-15') - epoch_us(max(ts))) / 60000000.0 AS age,
    count(*) FILTER (WHERE value < 20) / count(*)::DOUBLE AS rate FROM events)
SELECT 'Bronze data is stale (>60 min old)' AS issue FROM m WHERE age > 60
UNION ALL SELECT 'Quality pass rate below 0.95' FROM m WHERE rate < 0.95""")
def sla_issues(lake: Lake):
    rows = lake("events")
    metrics = quality.freshness(rows, "ts", F.to_timestamp_ntz(F.lit("2024-02-15"))).select(
        F.col("age_minutes").alias("bronze_freshness_minutes"),
        rows.agg((F.count_if(F.col("value") < 20) / F.count(F.lit(1))).alias("r")).scalar().alias("quality_pass_rate"),
        F.col("row_count").alias("silver_orders_count"))
    return quality.sla_issues(metrics)


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn FROM events),
  d AS (SELECT * FROM k WHERE rn = 1), c AS (SELECT max(epoch_us(ts)) - 1209600000000 AS cut FROM d)
SELECT 'events' AS entity, (SELECT count(*) FROM events) AS rows_in, count(*) FILTER (WHERE epoch_us(ts) >= cut) AS rows_out,
  count(*) FILTER (WHERE epoch_us(ts) < cut) AS late_dropped,
  (SELECT count(*) FROM events) - count(*) AS dedup_dropped FROM d, c""")
def stage_metrics(lake: Lake):
    rows = lake("events").select(
        F.concat_ws("-", "user_id", "event_type", F.date_trunc("hour", "ts").cast("string")).alias("pk"),
        us("ts").alias("ts_us"))
    return geo_lake.stage_metrics("events", rows, "pk", "ts_us", horizon=1_209_600_000_000)


@query("""SELECT window_start, event_type, per_second, alert, severity FROM (SELECT epoch_us(date_trunc('day', ts)) AS window_start, event_type,
  count(*) / 86400.0::DOUBLE AS per_second FROM events GROUP BY 1, 2),
  (VALUES ('HighRate', 0.0008, 'warning'), ('Active', 0.0005, 'info')) a(alert, floor, severity) WHERE per_second > floor""")
def rate_alerts(lake: Lake):
    rates = rolling.rates_and_latency(lake("events"), ["event_type"], "ts", "1 day", 86_400)
    metrics = rates.select(us("window_start").alias("window_start"), "event_type", "per_second")
    return quality.alert_rows(metrics, [("HighRate", F.col("per_second") > 0.0008, "warning"),
                                        ("Active", F.col("per_second") > 0.0005, "info")])


@query("""WITH m AS (SELECT max(ts) AS m FROM events), r AS (SELECT CASE event_type WHEN 'view' THEN 'noaa.freshness' ELSE event_type END AS rule,
    value > 20 AS failed, (epoch_us(m) - epoch_us(ts)) / 60000000.0 AS age FROM events, m WHERE ts >= m - INTERVAL 900 MINUTE)
SELECT rule, 'QualityRuleFailing' AS alert, 'warning' AS severity FROM r WHERE failed AND age <= 600 GROUP BY 1
UNION ALL SELECT rule, 'IngestorStale', 'critical' FROM r WHERE failed AND rule LIKE '%.freshness' GROUP BY 1
UNION ALL SELECT '*', 'NoQualityResults', 'warning' WHERE (SELECT count(*) FROM r) = 0""")
def result_alerts(lake: Lake):
    rows = lake("events")
    results = rows.select(F.expr("CASE event_type WHEN 'view' THEN 'noaa.freshness' ELSE event_type END").alias("rule"),
                          F.when(F.col("value") > 20, "FAIL").otherwise("PASS").alias("status"), F.col("ts").alias("checked_at"))
    return quality.result_alerts(results, rows.agg(F.max("ts").alias("m")).scalar(),
                                 fail_minutes=600, silent_minutes=900)


@query("""SELECT event_id, event_type AS change, CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'ACCEPT' END AS decision FROM events""")
def schema_decisions(lake: Lake):
    proposals = lake("events").select("event_id", F.col("event_type").alias("change"), F.expr(
        "CASE event_type WHEN 'error' THEN 'reject' WHEN 'view' THEN 'FULL' END").alias("recommended_policy"))
    return quality.decide_proposals(proposals).select("event_id", "change", "decision")


def rides(lake: Lake) -> DataFrame:
    """Events as rides, some of them broken."""
    return lake("events").select(
        F.col("event_id").cast("string").alias("trip_id"),
        F.when(F.col("user_id") % 20 != 0, F.col("user_id").cast("string")).alias("driver_id"),
        F.col("event_type").alias("pickup_zone"),
        F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value")).alias("fare_amount"),
        (F.col("value") * 5).alias("distance_miles"), (F.col("user_id") % 10).cast("int").alias("passenger_count"),
        F.expr("CASE event_type WHEN 'click' THEN 'barter' ELSE 'cash' END").alias("payment_type"),
        (F.lit(40.0) + F.col("value") / 100).alias("pickup_lat"), F.lit(-74.0).alias("pickup_lon"),
        F.when(F.col("user_id") == 7, F.lit("outlier_dist")).alias("_corruption"), us("ts").alias("ts_us"))


SQL_RIDE_REASON = """CASE WHEN user_id = 7 THEN 'outlier_dist' WHEN user_id % 20 = 0 THEN 'missing_driver_id'
  WHEN event_type = 'error' AND value > 0 THEN 'negative_fare' WHEN NOT (value * 5 > 0 AND value * 5 < 200) THEN 'distance_out_of_range' ELSE 'ok' END"""


@query(f"SELECT CAST(event_id AS VARCHAR) AS trip_id, {SQL_RIDE_REASON} AS reason FROM events")
def ride_reasons(lake: Lake):
    return rides(lake).select("trip_id", F.coalesce(quality.ride_reason(), F.lit("ok")).alias("reason"))


@query("""SELECT rule, CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS passed, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM (
  SELECT unnest(['trip_id_not_null', 'driver_id_not_null', 'fare_amount_in_range', 'distance_in_range', 'passengers_in_range',
     'payment_type_in_set', 'pickup_lat_in_nyc', 'pickup_lon_in_nyc']) AS rule, unnest([false, user_id % 20 = 0,
     event_type = 'error' AND value > 0 OR value > 1000, value * 5 > 150, user_id % 10 NOT BETWEEN 1 AND 8, event_type = 'click',
     40.0::DOUBLE + value / 100 NOT BETWEEN 40.4 AND 41.0, false]) AS bad FROM events) GROUP BY 1""")
def ride_expectations(lake: Lake):
    return quality.rule_counts(rides(lake), quality.ride_expectations())


@query(f"""SELECT CAST(event_id AS VARCHAR) AS trip_id, pickup_zone FROM (SELECT event_id, event_type AS pickup_zone,
  {SQL_RIDE_REASON} AS r FROM events) WHERE r <> 'ok'""")
def dead_letter_replay(lake: Lake):
    """Dead letters stripped of their marks, as they go back to the source."""
    bad = rides(lake).withColumn("_dlq_reason", quality.ride_reason()).filter("_dlq_reason IS NOT NULL")
    return quality.strip_dead_letter(bad).select("trip_id", "pickup_zone")
