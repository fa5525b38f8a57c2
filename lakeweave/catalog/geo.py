"""Geographic marts; events play positions and quakes, suppliers play regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import haversine_miles, magnitude_bucket, metered_fare, surge_multiplier
from ..functions.text import distinct_prefixes
from ..operators import geo
from ..operators.enrich import evaluate_thresholds
from ..plans import geo_lake
from ..plans import rides as ride_plans
from ..session import scratch_dir
from .registry import Lake, query, real, us, whole

SQL_POINTS = """pts AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms,
   CASE WHEN user_id = 3 THEN NULL ELSE ((event_id * 7919) % 14000)::DOUBLE / 100 - 70 END AS lat,
   ((event_id * 104729) % 36000)::DOUBLE / 100 - 180 AS lon, CAST(floor(value * 100) AS BIGINT) AS altitude_m FROM events)"""
SQL_REGIONS = """regs AS (SELECT s_suppkey AS region_id, s_name AS name, 'N' || s_nationkey AS country, 'metro' AS kind,
   ((s_suppkey * 37) % 130)::DOUBLE - 68 AS min_lat, ((s_suppkey * 37) % 130)::DOUBLE - 68 + (s_suppkey % 9 + 1) * 0.5::DOUBLE AS max_lat,
   ((s_suppkey * 71) % 340)::DOUBLE - 175 AS min_lon, ((s_suppkey * 71) % 340)::DOUBLE - 175 + (s_suppkey % 13 + 1) * 1.5::DOUBLE AS max_lon,
   CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS station_code, s_acctbal > -500 AS is_active FROM supplier)"""


def points(lake: Lake) -> DataFrame:
    lat = F.when(F.col("user_id") != 3, ((F.col("event_id") * 7919) % 14000).cast("double") / 100 - 70)
    return lake("events").select(
        "event_id", "user_id", "event_type", "value", F.floor(us("ts") / 1000).alias("ts_ms"), lat.alias("lat"),
        (((F.col("event_id") * 104729) % 36000).cast("double") / 100 - 180).alias("lon"),
        F.floor(F.col("value") * 100).alias("altitude_m"))


def regions(lake: Lake) -> DataFrame:
    key = F.col("s_suppkey")
    south, west = ((key * 37) % 130).cast("double") - 68, ((key * 71) % 340).cast("double") - 175
    return lake("supplier").select(
        key.alias("region_id"), F.col("s_name").alias("name"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country"),
        F.lit("metro").alias("kind"), south.alias("min_lat"), (south + (key % 9 + 1) * F.lit(0.5)).alias("max_lat"),
        west.alias("min_lon"), (west + (key % 13 + 1) * F.lit(1.5)).alias("max_lon"),
        F.when(key % 2 == 0, key.cast("string")).alias("station_code"), (F.col("s_acctbal") > -500).alias("is_active"))


@query(f"WITH {SQL_POINTS}, {SQL_REGIONS} SELECT event_id, region_id FROM regs JOIN pts ON lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon")
def box_join(lake: Lake):
    return geo.box_join(points(lake), regions(lake)).select("event_id", "region_id")


@query(f"""WITH {SQL_POINTS}, {SQL_REGIONS} SELECT name AS region, country, kind, count(*) AS positions_last_1h,
  count(DISTINCT user_id) AS unique_aircraft, CAST(sum(altitude_m) AS DOUBLE) / count(*) AS avg_altitude_m, max(altitude_m) AS max_altitude_m,
  max(ts_ms) AS last_seen_ms FROM regs JOIN pts ON lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon
WHERE is_active AND ts_ms >= (SELECT max(ts_ms) FROM pts) - 1209600000
GROUP BY 1, 2, 3 ORDER BY 4 DESC, region LIMIT 200""")
def box_density(lake: Lake):
    positions = points(lake).select("*", F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).alias("address"),
                                    F.col("user_id").cast("string").alias("callsign"),
                                    F.lit(1.0).alias("ground_speed_kmh"))
    as_of = positions.agg(F.max("ts_ms").alias("m")).scalar()
    mart = geo_lake.aircraft_density(positions, regions(lake), as_of, horizon_ms=1_209_600_000)
    return mart.drop("avg_speed_kmh")


@query(f"""WITH {SQL_POINTS}, {SQL_REGIONS} SELECT CAST(user_id AS VARCHAR) AS station_id, COALESCE(name, '-') AS region, p.ts_ms, event_id
FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts_ms DESC) AS r FROM pts) p LEFT JOIN regs ON station_code = CAST(user_id AS VARCHAR)
WHERE r = 1 ORDER BY p.ts_ms DESC, station_id LIMIT 500""")
def latest_snapshot_lookup(lake: Lake):
    observations = points(lake).withColumn("station_id", F.col("user_id").cast("string"))
    snapshot = geo_lake.weather_snapshot(observations, regions(lake), measures=["event_id"])
    return snapshot.select("station_id", F.coalesce("region", F.lit("-")).alias("region"), "ts_ms", "event_id")


@query("""WITH q AS (SELECT event_type, epoch_us(ts) // 1000 AS ts_ms, CAST(floor(value) AS BIGINT) AS m FROM events)
SELECT event_type AS region, CASE WHEN m < 3.0 THEN '<3' WHEN m < 4.5 THEN '3-4.5' WHEN m < 5.5 THEN '4.5-5.5' WHEN m < 6.5 THEN '5.5-6.5' ELSE '6.5+' END AS mag_bucket,
  count(*) AS events, CAST(sum(m) AS DOUBLE) / count(*) AS avg_magnitude, min(m) AS min_mag, max(m) AS max_mag, max(ts_ms) AS last_event_ms
FROM q WHERE ts_ms >= (SELECT max(ts_ms) FROM q) - 1209600000 GROUP BY 1, 2 ORDER BY events DESC, 1, 2 LIMIT 500""")
def bucket_summary(lake: Lake):
    quakes = lake("events").select(F.col("event_type").alias("region"), F.floor(us("ts") / 1000).alias("ts_ms"),
                                   F.floor("value").alias("magnitude"), F.lit(1.0).alias("depth_km"))
    as_of = quakes.agg(F.max("ts_ms").alias("m")).scalar()
    return geo_lake.seismic_summary(quakes, as_of, horizon_ms=1_209_600_000).drop("avg_depth_km")


@query(f"""WITH {SQL_POINTS}, {SQL_REGIONS}, th AS (SELECT min(p_size) * 0.25::DOUBLE AS t FROM part WHERE p_type = 'SMALL' AND p_size > 10),
 q AS (SELECT * FROM pts WHERE altitude_m >= COALESCE((SELECT t FROM th), 5.5) * 100 AND ts_ms >= (SELECT max(ts_ms) FROM pts) - 1209600000),
 w AS (SELECT c_custkey % 100 AS region_id, CASE WHEN c_nationkey < 10 THEN 'seismic' WHEN c_nationkey < 12 THEN '*' ELSE 'noaa' END AS source,
   c_mktsegment AS recipient, c_acctbal > 0 AS is_active FROM customer)
SELECT r.name AS region, r.country, count(DISTINCT event_id) AS quake_count_24h, CAST(sum(altitude_m) AS DOUBLE) / count(*) AS avg_magnitude,
  max(altitude_m) AS max_magnitude, count(DISTINCT recipient) AS subscribers_notified, max(ts_ms) AS last_event_ms
FROM regs r JOIN q ON lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon
LEFT JOIN w ON w.region_id = r.region_id AND w.source IN ('seismic', '*') AND w.is_active WHERE r.is_active
GROUP BY 1, 2 ORDER BY max_magnitude DESC, quake_count_24h DESC, region LIMIT 100""")
def threshold_correlation(lake: Lake):
    quakes = points(lake).withColumn("magnitude", F.col("altitude_m"))
    thresholds = lake("part").filter("p_type = 'SMALL' AND p_size > 10").select(
        F.lit("seismic").alias("source"), F.lit("magnitude").alias("metric"), F.lit(">=").alias("op"),
        (F.col("p_size") * 0.25 * 100).alias("threshold"), F.lit(True).alias("is_active"))
    watchlist = lake("customer").select(
        (F.col("c_custkey") % 100).alias("region_id"),
        F.expr("CASE WHEN c_nationkey < 10 THEN 'seismic' WHEN c_nationkey < 12 THEN '*' ELSE 'noaa' END").alias("source"),
        F.col("c_mktsegment").alias("recipient"), (F.col("c_acctbal") > 0).alias("is_active"))
    as_of = quakes.agg(F.max("ts_ms").alias("m")).scalar()
    return geo_lake.alert_correlation(quakes, regions(lake), thresholds, watchlist, as_of, horizon_ms=1_209_600_000)


SQL_ZONE = """CASE WHEN lat IS NULL THEN 'UNKNOWN' ELSE (SELECT arg_min(z.name, ((z.lat - p.lat) * (z.lat - p.lat) + (z.lon - p.lon) * (z.lon - p.lon), z.i))
  FROM (VALUES (0, 'TIMES_SQUARE', 40.758::DOUBLE, -73.9855::DOUBLE), (1, 'MIDTOWN', 40.7549, -73.984), (2, 'WALL_STREET', 40.7074, -74.0113),
  (3, 'JFK_AIRPORT', 40.6413, -73.7781), (4, 'BROOKLYN', 40.6782, -73.9442), (5, 'HARLEM', 40.8116, -73.9465)) z(i, name, lat, lon)) END"""
SQL_NYC = """p AS (SELECT event_id, user_id, event_type, CASE WHEN user_id = 3 THEN NULL ELSE 40.5::DOUBLE + (event_id % 400)::DOUBLE / 1000 END AS lat,
  -74.2::DOUBLE + ((event_id * 31) % 500)::DOUBLE / 1000 AS lon, ts FROM events)"""


def city_points(lake: Lake) -> DataFrame:
    return lake("events").select(
        "event_id", "user_id", "event_type", "ts",
        F.when(F.col("user_id") != 3, F.lit(40.5) + (F.col("event_id") % 400).cast("double") / 1000).alias("lat"),
        (F.lit(-74.2) + ((F.col("event_id") * 31) % 500).cast("double") / 1000).alias("lon"))


@query(f"WITH {SQL_NYC} SELECT event_id, {SQL_ZONE} AS zone FROM p")
def nearest_centre(lake: Lake):
    return city_points(lake).select("event_id", geo.nearest_centre("lat", "lon").alias("zone"))


@query(f"""WITH {SQL_NYC}, z AS (SELECT *, {SQL_ZONE} AS zone FROM p),
  supply AS (SELECT zone, count(*) AS idle FROM (SELECT zone, event_type, row_number() OVER (PARTITION BY zone, user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM z WHERE event_type <> 'purchase') WHERE rn = 1 AND event_type = 'view' GROUP BY 1),
  demand AS (SELECT zone, count(*) FILTER (WHERE epoch_us(ts) >= (SELECT max(epoch_us(ts)) FROM events) - 864000000000) AS trips FROM z WHERE event_type = 'purchase' GROUP BY 1)
SELECT zone, trips AS trips_per_min, COALESCE(idle, 0) AS idle_drivers, CASE WHEN COALESCE(idle, 0) = 0 AND trips > 0 THEN 3.0::DOUBLE
  WHEN trips / greatest(COALESCE(idle, 0), 1) < 0.5 THEN 1.0 WHEN trips / greatest(COALESCE(idle, 0), 1) < 1.0 THEN 1.2
  WHEN trips / greatest(COALESCE(idle, 0), 1) < 2.0 THEN 1.6 WHEN trips / greatest(COALESCE(idle, 0), 1) < 3.0 THEN 2.0 ELSE 2.5 END AS surge_multiplier
FROM demand LEFT JOIN supply USING (zone)""")
def surge_by_zone(lake: Lake):
    rows = city_points(lake).withColumns({"zone": geo.nearest_centre("lat", "lon"), "ts_us": us("ts"),
                                          "state": F.when(F.col("event_type") == "view", "IDLE").otherwise("ON_TRIP")})
    trips = rows.filter("event_type = 'purchase'").withColumnRenamed("zone", "pickup_zone")
    pings = rows.filter("event_type <> 'purchase'").withColumnRenamed("user_id", "driver_id")
    as_of = rows.agg(F.max("ts_us").alias("m")).scalar()
    return ride_plans.surge_table(trips, pings, as_of, horizon_us=864_000_000_000, order=["ts_us", "event_id"])


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, metric, metric_value, threshold_id, severity FROM (
  SELECT *, unnest(['l_quantity', 'l_discount']) AS metric, unnest([l_quantity, l_discount]) AS metric_value FROM lineitem)
 JOIN (SELECT CAST(n_nationkey AS BIGINT) AS threshold_id, CASE WHEN n_nationkey % 2 = 0 THEN 'l_quantity' ELSE 'l_discount' END AS m, ['>=', '>', '<=', '<'][n_nationkey % 4 + 1] AS op,
   CASE WHEN n_nationkey % 2 = 0 THEN CASE WHEN n_nationkey % 4 = 0 THEN 40.0::DOUBLE + n_nationkey / 4.0 ELSE 5.0 + n_nationkey / 20.0 END
     ELSE CASE WHEN n_nationkey % 4 = 1 THEN 0.09::DOUBLE ELSE 0.01 END END AS threshold, n_name AS severity FROM nation WHERE n_regionkey < 3)
 ON m = metric WHERE CASE op WHEN '>=' THEN metric_value >= threshold WHEN '>' THEN metric_value > threshold
   WHEN '<=' THEN metric_value <= threshold ELSE metric_value < threshold END""")
def threshold_alerts(lake: Lake):
    rules = lake("nation").select(
        F.lit("lines").alias("source"), whole("n_nationkey").alias("threshold_id"),
        F.expr("CASE WHEN n_nationkey % 2 = 0 THEN 'l_quantity' ELSE 'l_discount' END").alias("metric"),
        F.expr("element_at(array('>=', '>', '<=', '<'), n_nationkey % 4 + 1)").alias("op"),
        F.expr("""CASE WHEN n_nationkey % 4 = 0 THEN 40.0D + n_nationkey / 4.0D WHEN n_nationkey % 2 = 0 THEN 5.0D + n_nationkey / 20.0D
                  WHEN n_nationkey % 4 = 1 THEN 0.09D ELSE 0.01D END""").alias("threshold"),
        F.col("n_name").alias("severity"), (F.col("n_regionkey") < 3).alias("is_active"))
    lines = lake("lineitem").withColumn("l_linenumber", whole("l_linenumber"))
    alerts = evaluate_thresholds(lines, rules, "lines", ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"])
    return alerts.select("l_orderkey", "l_linenumber", "metric", "metric_value", "threshold_id", "severity")


@query(f"""WITH {SQL_POINTS} SELECT CAST(event_id AS VARCHAR) AS event_id, lat, lon, value AS magnitude, event_type AS region, ts_ms // 1000 * 1000 AS ts_ms
FROM pts WHERE lat IS NOT NULL AND event_type <> 'click'""")
def feature_flatten(lake: Lake):
    p = points(lake)
    props = F.struct(F.when(F.col("event_type") != "click", F.col("value")).alias("mag"), F.col("event_type").alias("flynn_region"),
                     F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"))
    data = F.struct(F.col("event_id").cast("string").alias("id"), props.alias("properties"),
                    F.struct(F.array("lon", "lat", F.lit(5.0)).alias("coordinates")).alias("geometry"))
    messages = p.select(F.to_json(F.struct(data.alias("data")), {"ignoreNullFields": "false"}).alias("value"))
    return geo.quake_rows(messages).select("event_id", "lat", "lon", "magnitude", "region", "ts_ms")


@query("""SELECT event_id AS station_id, value AS temperature_c, value AS wind_gust_kmh, COALESCE(CASE WHEN event_type <> 'view' THEN value END, -1) AS humidity_pct,
  event_type AS text_description FROM events""")
def observation_flatten(lake: Lake):
    node = F.struct(F.col("value").alias("value"))
    props = F.struct(node.alias("temperature"), F.col("value").alias("windGust"),
                     F.when(F.col("event_type") != "view", node).alias("relativeHumidity"), F.col("event_type").alias("textDescription"))
    messages = lake("events").select(F.col("event_id").alias("station_id"), F.to_json(F.struct(props.alias("properties"))).alias("value"))
    return geo.observation_rows(messages).select("station_id", "temperature_c", "wind_gust_kmh",
                                                 F.coalesce("humidity_pct", F.lit(-1.0)).alias("humidity_pct"), "text_description")


@query("""SELECT user_id, array_to_string(list_sort(list_distinct(list(substr(event_type, 1, 2)))), ',') AS states FROM events GROUP BY 1""")
def alert_states(lake: Lake):
    codes = lake("events").groupBy("user_id").agg(F.collect_set("event_type").alias("codes"))
    return codes.select("user_id", distinct_prefixes("codes").alias("states"))


@query("""SELECT event_id, COALESCE(CASE WHEN user_id % 2 = 0 THEN 'A' || user_id END, CASE WHEN user_id % 3 = 0 THEN 'C' || user_id END, CAST(event_id AS VARCHAR)) AS key
FROM events WHERE event_type IN ('click', 'view')""")
def beacon_filter_key(lake: Lake):
    rows = lake("events").select(
        F.expr("CASE event_type WHEN 'click' THEN 'flarm' WHEN 'view' THEN 'fanet' ELSE 'receiver' END").alias("beacon_type"),
        F.expr("CASE WHEN user_id % 2 = 0 THEN concat('A', user_id) ELSE ' ' END").alias("address"),
        F.expr("CASE WHEN user_id % 3 = 0 THEN concat('C', user_id) END").alias("callsign"),
        F.col("event_id").cast("string").alias("event_text"), "event_id")
    return geo.aircraft_only(rows).select("event_id", geo.message_key("address", "callsign", "event_text").alias("key"))


@query(f"""WITH {SQL_POINTS} SELECT event_id, round(2 * 3958.8 * asin(sqrt(pow(sin(radians(40.758 - lat) / 2), 2) +
  cos(radians(lat)) * cos(radians(40.758)) * pow(sin(radians(-73.9855 - lon) / 2), 2))), 3) AS miles FROM pts WHERE lat IS NOT NULL""")
def haversine(lake: Lake):
    rows = points(lake).filter("lat IS NOT NULL")
    miles = haversine_miles("lat", "lon", F.lit(40.758), F.lit(-73.9855))
    return rows.select("event_id", F.round(miles, 3).alias("miles"))


@query("""SELECT event_id, CASE WHEN user_id < 1 THEN 3.0::DOUBLE WHEN value / greatest(user_id, 1) < 0.5 THEN 1.0 WHEN value / greatest(user_id, 1) < 1.0 THEN 1.2
  WHEN value / greatest(user_id, 1) < 2.0 THEN 1.6 WHEN value / greatest(user_id, 1) < 3.0 THEN 2.0 ELSE 2.5 END AS surge_multiplier,
  CASE WHEN value < 3.0 THEN '<3' WHEN value < 4.5 THEN '3-4.5' WHEN value < 5.5 THEN '4.5-5.5' WHEN value < 6.5 THEN '5.5-6.5' ELSE '6.5+' END AS bucket,
  round(2.55::DOUBLE + 1.75::DOUBLE * CAST(floor(value) AS BIGINT), 2) AS fare FROM events WHERE value > 0""")
def step_functions(lake: Lake):
    fare = metered_fare(F.floor("value"), F.lit(0))
    return lake("events").filter("value > 0").select(
        "event_id", surge_multiplier("value", "user_id").alias("surge_multiplier"), magnitude_bucket("value").alias("bucket"),
        real(fare["fare_amount"]).alias("fare"))


SILVER_LOADS = """q AS (SELECT CAST(user_id AS VARCHAR) AS event_id, epoch_us(ts) // 1000 AS ts_ms, value AS magnitude, event_type AS region,
    CASE WHEN ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN 0 ELSE 1 END AS load FROM events),
  k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY load, event_id ORDER BY ts_ms DESC) AS rn, max(ts_ms) OVER (PARTITION BY load) AS newest FROM q)
    WHERE rn = 1 AND ts_ms >= newest - 86400000),
  f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY load DESC) AS last FROM k) WHERE last = 1)"""


@query(f"""WITH {SILVER_LOADS} SELECT 'silver' AS stage, event_id AS name, ts_ms, magnitude, 1 AS row_count FROM f
UNION ALL SELECT 'mart', region, max(ts_ms), max(magnitude), count(*) FROM f WHERE ts_ms >= (SELECT max(ts_ms) FROM q) - 43200000 GROUP BY region
UNION ALL SELECT 'run', CAST(load AS VARCHAR), max(ts_ms), NULL, count(*) FROM k GROUP BY load""")
def silver_refresh(lake: Lake):
    """Events land in two loads of bronze files, each is conformed into silver, and a mart reads the runs that reach its horizon."""
    bronze, silver = scratch_dir(lake.spark, "bronze"), scratch_dir(lake.spark, "silver")
    events = lake("events").withColumn("ts", F.col("ts").cast("timestamp"))
    middle = events.agg(((F.min(us("ts")) + F.max(us("ts"))) / 2).alias("m")).scalar()
    rows = events.select(F.col("user_id").cast("string").alias("event_id"), F.floor(us("ts") / 1000).alias("ts_ms"), F.col("value").alias("magnitude"),
                         F.col("event_type").alias("region"), F.lit(1.0).alias("depth_km"), (us("ts") >= middle).cast("int").alias("load"))
    runs = ("2026-01-01 00:00:00", "2026-01-02 00:00:00")
    for load, loaded_at in enumerate(runs):
        rows.filter(F.col("load") == load).drop("load").write.parquet(f"{bronze}/{load}/seismic_events/part")
        landed = geo_lake.read_bronze(lake.spark, f"{bronze}/{load}", geo_lake.bronze_schemas(lake.spark, f"{bronze}/{load}", "parquet"),
                                      "2020-01-01T00:00:00", "parquet")
        outcome = geo_lake.build_silver(lake.spark, landed, silver, loaded_at).filter("status <> 'ok'").collect()
        if outcome:
            raise RuntimeError(outcome[0]["detail"])
    as_of = rows.agg(F.max("ts_ms").alias("m")).scalar()
    whole_table = geo_lake.silver_table(lake.spark, silver, "seismic_events")
    since = geo_lake.silver_table(lake.spark, silver, "seismic_events", F.lit(rows.agg(F.max("ts_ms")).first()[0] - 43_200_000))
    mart = geo_lake.seismic_summary(since, as_of, horizon_ms=43_200_000, limit=None).groupBy(F.col("region").alias("name")).agg(
        F.max("last_event_ms").alias("ts_ms"), F.max("max_mag").alias("magnitude"), F.sum("events").cast("int").alias("row_count"))
    notes = lake.spark.read.parquet(f"{silver}/{geo_lake.BOUNDS}/seismic_events").select(
        (F.col("run") > 20260101000000).cast("int").cast("string").alias("name"), F.col("max_ts_ms").alias("ts_ms"),
        F.lit(None).cast("double").alias("magnitude"), F.col("rows").cast("int").alias("row_count"))
    kept = whole_table.select(F.col("event_id").alias("name"), "ts_ms", "magnitude", F.lit(1).alias("row_count"))
    parts = [frame.select(F.lit(stage).alias("stage"), "name", "ts_ms", "magnitude", F.col("row_count").cast("bigint").alias("row_count"))
             for stage, frame in (("silver", kept), ("mart", mart), ("run", notes))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
