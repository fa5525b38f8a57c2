"""Event-stream queries in batch form: latest rows, trails, running and rolling totals, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import record_hash
from ..functions.numeric import money
from ..functions.temporal import from_epoch, minutes_between
from ..operators import keyed, rolling
from .registry import Lake, query, real, us, whole

SQL_MONEY = "CAST(value AS DECIMAL(18,2))"


@query("""SELECT user_id, event_id, event_type, value, epoch_us(ts) AS ts_us FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_by_key(lake: Lake):
    return keyed.latest_by_key(lake("events"), ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value", us("ts").alias("ts_us"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
  COALESCE(CASE WHEN event_type = 'view' THEN NULL ELSE epoch_us(ts) END, 0) DESC, event_id DESC) AS rn
  FROM events WHERE user_id IS NOT NULL) WHERE rn = 1""")
def latest_known_time(lake: Lake):
    """Latest per key where a missing time counts as 0 and the later arrival wins."""
    rows = lake("events").withColumn("ts_us", F.when(F.col("event_type") != "view", us("ts")))
    return keyed.latest_known(rows, "user_id", "ts_us", ["event_id"]).select("user_id", "event_id", "event_type")


@query("""SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS trail,
  arg_max(event_type, event_id) AS event_type, count(*) AS points
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 40 GROUP BY 1""")
def last_n_trail(lake: Lake):
    trails = keyed.trail_per_key(lake("events"), ["user_id"], "ts", "event_id", ["event_type"], 40)
    ids = F.array_join(F.transform("trail", lambda p: p["event_id"].cast("string")), ",")
    return trails.select("user_id", ids.alias("trail"), "event_type", whole(F.size("trail")).alias("points"))


@query("""SELECT event_type AS rule, user_id, value, CASE WHEN value > 20 THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT *,
  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_rule_result(lake: Lake):
    results = lake("events").select(F.col("event_type").alias("rule"), "user_id", "value", "ts", "event_id",
                                    F.when(F.col("value") > 20, "FAIL").otherwise("PASS").alias("status"))
    return keyed.latest_by_key(results, ["rule"], ["ts", "event_id"]).drop("ts", "event_id")


@query(f"""SELECT event_id, event_type, count(*) OVER w AS running_count,
  CAST(sum(CASE WHEN user_id % 5 = 0 THEN -1 ELSE 1 END * {SQL_MONEY}) OVER w AS DOUBLE) AS running_net
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_total(lake: Lake):
    signed = F.when(F.col("user_id") % 5 == 0, -money("value")).otherwise(money("value"))
    totals = rolling.running_totals(lake("events"), "event_type", "ts", "event_id", {"running_net": signed})
    return totals.select("event_id", "event_type", "running_count", real("running_net").alias("running_net"))


@query(f"""SELECT event_id, user_id, count(*) OVER w AS trailing_count, CAST(sum({SQL_MONEY}) OVER w AS DOUBLE) AS trailing_value
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW)""")
def rolling_hour(lake: Lake):
    ranged = rolling.trailing_sums(lake("events"), ["event_type"], "ts", 3600, {"trailing_value": money("value")})
    return ranged.select("event_id", "user_id", "trailing_count", real("trailing_value").alias("trailing_value"))


@query("""SELECT event_id, min(value) OVER w AS least_value, max(value) OVER w AS greatest_value, count(*) OVER w AS trailing_count
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECOND PRECEDING AND CURRENT ROW)""")
def rolling_extremes(lake: Lake):
    """Least and greatest value of each user's last day, beside the count of its rows."""
    found = rolling.trailing_extremes(lake("events"), ["user_id"], "ts", 86_400, {"least_value": F.col("value")}, {"greatest_value": F.col("value")})
    counted = rolling.trailing_sums(found, ["user_id"], "ts", 86_400, {}, chunk_seconds=7 * 86_400)
    return counted.select("event_id", "least_value", "greatest_value", "trailing_count")


@query("""SELECT event_id, user_id, rn > 1 AS is_duplicate FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)""")
def flag_duplicates(lake: Lake):
    return keyed.flag_duplicates(lake("events"), ["user_id", "event_type"], ["ts", "event_id"]).select(
        "event_id", "user_id", "is_duplicate")


@query("""SELECT event_id, user_id, CASE WHEN rn = 1 THEN 'kept' ELSE 'quarantined' END AS route FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)""")
def dedup_with_quarantine(lake: Lake):
    kept, later = keyed.split_duplicates(lake("events"), ["user_id"], ["ts", "event_id"])
    return kept.select("event_id", "user_id", F.lit("kept").alias("route")).union(
        later.select("event_id", "user_id", F.lit("quarantined").alias("route")))


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, rank() OVER (PARTITION BY user_id, event_type
  ORDER BY date_trunc('day', ts) DESC) AS r FROM events) WHERE r = 1""")
def latest_with_ties(lake: Lake):
    """All events of the last active day of each (user, type)."""
    daily = lake("events").withColumn("d", F.date_trunc("day", "ts"))
    return keyed.latest_with_ties(daily, ["user_id", "event_type"], "d").select("user_id", "event_type", "event_id", "value")


@query(f"""SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '2000-01-01')) AS window_start, event_type,
  count(*) AS trip_count, CAST(sum({SQL_MONEY}) AS DOUBLE) AS revenue,
  CAST(sum({SQL_MONEY}) AS DOUBLE) / count(*) AS avg_fare FROM events GROUP BY 1, 2""")
def tumbling_window(lake: Lake):
    frame = rolling.windowed(lake("events"), ["event_type"], "ts", "1 hour", {
        "trip_count": F.count(F.lit(1)), "total": F.sum(money("value"))})
    return frame.select(us("window_start").alias("window_start"), "event_type", "trip_count",
                        real("total").alias("revenue"), (real("total") / F.col("trip_count")).alias("avg_fare"))


@query(f"""SELECT w AS window_start, event_type, CAST(sum({SQL_MONEY}) AS DOUBLE) AS revenue FROM (SELECT *,
  unnest([epoch_us(ts) // 3600000000 * 3600000000 - i * 3600000000 for i in [0, 1, 2, 3, 4]]) AS w FROM events) GROUP BY 1, 2""")
def hopping_window(lake: Lake):
    frame = rolling.windowed(lake("events"), ["event_type"], "ts", "5 hours", {"revenue": F.sum(money("value"))}, "1 hour")
    return frame.select(us("window_start").alias("window_start"), "event_type", real("revenue").alias("revenue"))


@query(f"""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    <= 7200000000 THEN 0 ELSE 1 END AS opens FROM events),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, epoch_us(min(ts)) AS shift_start, epoch_us(max(ts)) AS shift_end, count(*) AS trips_in_shift,
  CAST(sum({SQL_MONEY}) AS DOUBLE) AS shift_earnings FROM s GROUP BY user_id, sid""")
def session_window(lake: Lake):
    frame = rolling.session_totals(lake("events"), "user_id", "ts", 7200, {"shift_earnings": money("value")},
                                   "trips_in_shift")
    return frame.select("user_id", us("session_start").alias("shift_start"), us("session_end").alias("shift_end"),
                        "trips_in_shift", real("shift_earnings").alias("shift_earnings"))


@query("""SELECT epoch_us(date_trunc('day', ts)) AS window_start, event_type, count(*) AS events,
  count(*) / 86400.0::DOUBLE AS per_second FROM events GROUP BY 1, 2""")
def window_rates(lake: Lake):
    frame = rolling.rates_and_latency(lake("events"), ["event_type"], "ts", "1 day", 86_400, "value")
    return frame.select(us("window_start").alias("window_start"), "event_type", "events", "per_second")


@query("""SELECT epoch_us(date_trunc('day', ts)) AS window_start, event_type, quantile_disc(value, 0.5) AS p50,
  quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1, 2""")
def window_latency_quantiles(lake: Lake):
    """Exact quantiles per window."""
    frame = rolling.rates_and_latency(lake("events"), ["event_type"], "ts", "1 day", 86_400, "value")
    return frame.select(us("window_start").alias("window_start"), "event_type", "p50", "p95", "p99")


@query("""SELECT event_id, substr(sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":"' ||
  replace(props, '"', '\\"') || '","user_id":' || user_id || '}'), 1, 16) AS record_hash FROM events""")
def record_hash_of_events(lake: Lake):
    rows = lake("events")
    return rows.select("event_id", record_hash(rows, ["user_id", "event_type", "event_id", "props"]).alias("record_hash"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  COALESCE(json_extract_string(props, '$.missing'), '-') AS missing, json_extract_string(props, '$.k') || 'x' AS k_text FROM events""")
def json_extract(lake: Lake):
    k = F.get_json_object("props", "$.k")
    return lake("events").select(
        "event_id", k.try_cast("bigint").alias("k"),
        F.coalesce(F.get_json_object("props", "$.missing"), F.lit("-")).alias("missing"),
        F.concat(F.from_json("props", "k string")["k"], F.lit("x")).alias("k_text"))


@query("""SELECT event_id, 'REVIEW cancellation for ' || user_id AS alert FROM events WHERE event_type = 'error'""")
def cancellation_alerts(lake: Lake):
    return lake("events").filter("event_type = 'error'").select(
        "event_id", F.concat(F.lit("REVIEW cancellation for "), F.col("user_id").cast("string")).alias("alert"))


@query("SELECT event_id, value FROM events WHERE value / 10 > 1.5")
def surge_filter(lake: Lake):
    return lake("events").withColumn("surge_multiplier", F.col("value") / 10).filter("surge_multiplier > 1.5").select(
        "event_id", "value")


@query("""SELECT event_id, epoch_us(ts) // 1000 * 1000 AS from_ms, epoch_us(ts) // 1000000 * 1000000 AS from_s,
  (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 60000000.0::DOUBLE AS age_minutes FROM events""")
def epoch_conversions(lake: Lake):
    ms, s = F.floor(us("ts") / 1000), F.floor(us("ts") / 1_000_000)
    return lake("events").select(
        "event_id", F.unix_micros(from_epoch(ms, "ms")).alias("from_ms"), F.unix_micros(from_epoch(s, "s")).alias("from_s"),
        minutes_between(F.to_timestamp_ntz(F.lit("2024-02-01")), F.col("ts")).alias("age_minutes"))
