"""Streaming jobs run to the end of the events table; results are read back from their sinks."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import money
from ..functions.temporal import micros
from ..operators import geo, mergeable
from ..operators.keyed import latest_by_key
from ..session import scratch_dir
from ..sources.messages import MESSAGE
from ..streaming import alarms, flows, ledger, rides, trails
from ..streaming.sinks import file_writer, finish, fold_first, fold_latest, per_batch, put_batch, put_state, read_folded, read_state
from .geo import SQL_ZONE
from .quality import SQL_RIDE_REASON
from .quality import rides as ride_rows
from .registry import Lake, query, real, us

SQL_MONEY = "CAST(value AS DECIMAL(18,2))"
FILES_PER_BATCH = 1_000
CLOSED = "(SELECT max(epoch_us(ts)) - 3600000000 FROM events)"


def stream_path(lake: Lake, table: str) -> str:
    """The table's own path as a pattern that only it matches: a stream takes a single file only through a pattern."""
    return f"{lake.root}/{table}.parque[t]"


def event_stream(lake: Lake) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of part files, in batches of bounded file count."""
    schema = lake("events").schema
    stream = lake.spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return stream.parquet(stream_path(lake, "events")).withColumn("ts", F.col("ts").cast("timestamp"))


class StreamLake(Lake):
    """The same tables, the events among them as a stream."""

    def __call__(self, table: str) -> DataFrame:
        return event_stream(Lake(self.spark, self.root)) if table == "events" else super().__call__(table)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The state store that processors with several states and timers need, for sessions that have another one set."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)


def dirs(lake: Lake, *names: str) -> list[str]:
    root = scratch_dir(lake.spark, "stream")
    return [f"{root}/{name}" for name in ("checkpoint", *names)]


@query(f"""SELECT CAST(event_id AS VARCHAR) AS trip_id, {SQL_RIDE_REASON} AS reason FROM events""")
def stream_route(lake: Lake):
    checkpoint, clean, dead = dirs(lake, "clean", "dead")
    finish(rides.route(ride_rows(StreamLake(lake.spark, lake.root)), clean, dead), checkpoint)
    read = lake.spark.read.parquet
    return read(clean).select("trip_id", F.lit("ok").alias("reason")).union(
        read(dead).select("trip_id", F.col("_dlq_reason").alias("reason")))


@query("""SELECT rule, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM (
  SELECT unnest(['trip_id_not_null', 'driver_id_not_null', 'fare_amount_in_range', 'distance_in_range', 'passengers_in_range',
     'payment_type_in_set', 'pickup_lat_in_nyc', 'pickup_lon_in_nyc']) AS rule, unnest([false, user_id % 20 = 0,
     event_type = 'error' AND value > 0 OR value > 1000, value * 5 > 150, user_id % 10 NOT BETWEEN 1 AND 8, event_type = 'click',
     40.0::DOUBLE + value / 100 NOT BETWEEN 40.4 AND 41.0, false]) AS bad FROM events) GROUP BY 1""")
def stream_validate(lake: Lake):
    checkpoint, dead, counts, scores = dirs(lake, "dead", "counts", "scores")
    finish(rides.validate(ride_rows(StreamLake(lake.spark, lake.root)), dead, counts, scores), checkpoint)
    return lake.spark.read.parquet(counts).groupBy("rule").agg(F.sum("failed").alias("failed"))


@query(f"""SELECT window_start, event_type, trip_count, revenue FROM (SELECT epoch_us(date_trunc('hour', ts)) AS window_start, event_type,
  count(*) AS trip_count, CAST(sum({SQL_MONEY}) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2) WHERE window_start + 3600000000 <= {CLOSED}""")
def stream_tumbling(lake: Lake):
    """Closed one-hour windows, one hour of allowed lateness."""
    from ..operators.rolling import windowed

    checkpoint, out = dirs(lake, "windows")
    frame = windowed(event_stream(lake).withWatermark("ts", "1 hour"), ["event_type"], "ts", "1 hour",
                     {"trip_count": F.count(F.lit(1)), "revenue": F.sum(money("value"))})
    finish(file_writer(frame, out), checkpoint)
    return lake.spark.read.parquet(out).select(us("window_start").alias("window_start"), "event_type", "trip_count",
                                               real("revenue").alias("revenue"))


@query(f"""SELECT w AS window_start, event_type, CAST(sum({SQL_MONEY}) AS DOUBLE) AS revenue FROM (SELECT *,
  unnest([epoch_us(ts) // 3600000000 * 3600000000 - i * 3600000000 for i in [0, 1, 2, 3, 4]]) AS w FROM events)
WHERE w + 18000000000 <= {CLOSED} GROUP BY 1, 2""")
def stream_hopping(lake: Lake):
    from ..operators.rolling import windowed

    checkpoint, out = dirs(lake, "windows")
    frame = windowed(event_stream(lake).withWatermark("ts", "1 hour"), ["event_type"], "ts", "5 hours",
                     {"revenue": F.sum(money("value"))}, "1 hour")
    finish(file_writer(frame, out), checkpoint)
    return lake.spark.read.parquet(out).select(us("window_start").alias("window_start"), "event_type",
                                               real("revenue").alias("revenue"))


@query(f"""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    <= 7200000000 THEN 0 ELSE 1 END AS opens FROM events),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, epoch_us(min(ts)) AS shift_start, epoch_us(max(ts)) AS shift_end, count(*) AS trips_in_shift,
  CAST(sum({SQL_MONEY}) AS DOUBLE) AS shift_earnings FROM s GROUP BY user_id, sid HAVING epoch_us(max(ts)) + 7200000000 <= {CLOSED}""")
def stream_sessions(lake: Lake):
    checkpoint, out = dirs(lake, "sessions")
    frame = rides.session_frame(event_stream(lake), "user_id", "ts", "2 hours", "1 hour",
                                {"shift_earnings": money("value")}, "trips_in_shift")
    finish(file_writer(frame, out), checkpoint)
    return lake.spark.read.parquet(out).select("user_id", us("session_start").alias("shift_start"),
                                               us("session_end").alias("shift_end"), "trips_in_shift",
                                               real("shift_earnings").alias("shift_earnings"))


@query(f"""SELECT event_type, count(*) AS events_processed, CAST(sum({SQL_MONEY}) AS DOUBLE) AS net_value FROM events GROUP BY 1""")
def stream_running_state(lake: Lake):
    checkpoint, out = dirs(lake, "state")
    frame = flows.running_state(event_stream(lake), ["event_type"], {"net_value": money("value")})
    finish(per_batch(frame, lambda batch, i: put_state(batch, out, i)).outputMode("complete"), checkpoint)
    return read_state(lake.spark, out).select("event_type", "events_processed", real("net_value").alias("net_value"))


@query("SELECT event_id, user_id, value FROM events WHERE value / 10 > 1.5")
def stream_filtered(lake: Lake):
    checkpoint, out = dirs(lake, "surge")
    frame = event_stream(lake).withColumn("surge_multiplier", F.col("value") / 10)
    finish(file_writer(rides.rides.surge_trips(frame), out), checkpoint)
    return lake.spark.read.parquet(out).select("event_id", "user_id", "value")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(lake: Lake):
    """Alert ids seen once, however far apart their copies lie: a keyed table whose first batch wins."""
    checkpoint, table = dirs(lake, "unique")
    keys = ["user_id", "event_type"]
    finish(flows.distinct_keys(event_stream(lake), keys, table), checkpoint)
    return read_folded(lake.spark, table, fold_first(keys)).select(*keys)


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def stream_latest_table(lake: Lake):
    checkpoint, table = dirs(lake, "table")
    finish(flows.keep_latest(event_stream(lake), ["user_id"], ["ts", "event_id"], table), checkpoint)
    return read_folded(lake.spark, table, fold_latest(["user_id"], ["ts", "event_id"])).select("user_id", "event_id", "event_type")


@query("""SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
  count(*) AS row_count FROM events GROUP BY 1, 2, 3, 4""")
def stream_hourly_landing(lake: Lake):
    checkpoint, out = dirs(lake, "landing")
    finish(flows.land(event_stream(lake), "ts", out), checkpoint)
    text = [F.lpad(F.col(p).cast("string"), 4 if p == "year" else 2, "0").alias(p) for p in ("year", "month", "day", "hour")]
    return lake.spark.read.parquet(out).select(*text).groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("row_count"))


@query("""SELECT user_id AS order_id, event_type AS status, value AS amount FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_message_upsert(lake: Lake):
    checkpoint, bronze, silver = dirs(lake, "bronze", "silver")
    body = F.to_json(F.struct(F.col("user_id").alias("order_id"), F.col("event_type").alias("status"), F.col("value").alias("amount")))
    topic = event_stream(lake).select(
        F.col("user_id").cast("string").alias("key"), body.alias("value"), F.lit("orders").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    assert topic.columns == [field.split()[0] for field in MESSAGE.split(", ")]
    writer = flows.upsert_messages(topic, "order_id bigint, status string, amount double", ["order_id"], ["status", "amount"],
                                   bronze, silver)
    finish(writer, checkpoint)
    return read_folded(lake.spark, silver, flows.message_fold(["order_id"], ["status", "amount"]))


@query("""SELECT event_id, c_name AS full_name FROM events JOIN customer ON user_id = c_custkey WHERE c_acctbal > 0""")
def stream_table_enrich(lake: Lake):
    checkpoint, table, out, misses = dirs(lake, "drivers", "enriched", "misses")
    put_batch(driver_log(lake("customer"), "c_acctbal > 0"), f"{table}/delta", 0)
    trips = event_stream(lake).withColumn("driver_id", F.col("user_id").cast("string"))
    finish(rides.enrich(trips, table, out, misses), checkpoint)
    return lake.spark.read.parquet(out).select("event_id", F.col("driver_name").alias("full_name"))


@query("""WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC) AS rn FROM events)
SELECT CAST(user_id AS VARCHAR) AS key, least(count(*), 40) AS points, max(epoch_us(ts) // 1000) AS ts_ms FROM p GROUP BY 1""")
def stream_trail_state(lake: Lake):
    """Active tracks after the whole stream."""
    checkpoint, out = dirs(lake, "tracks")
    positions = event_stream(lake).select(
        "user_id", "ts", F.floor(micros("ts") / 1000).alias("ts_ms"), F.col("value").alias("lat"), F.col("value").alias("lon"))
    with rocksdb_state(lake.spark):
        finish(trails.track(positions, "user_id", "ts").writeStream.outputMode("append").format("parquet").option("path", out),
               checkpoint)
    # a key has a row per batch that brought it: its newest is its track
    tracks = latest_by_key(lake.spark.read.parquet(out).filter("status = 'active'"), ["key"], ["ts_ms", "points"])
    return tracks.select("key", F.col("points").cast("bigint").alias("points"), "ts_ms")


@query(f"""WITH p AS (SELECT event_id, user_id, event_type, ts, 40.5::DOUBLE + (event_id % 400)::DOUBLE / 1000 AS lat,
    -74.2::DOUBLE + ((event_id * 31) % 500)::DOUBLE / 1000 AS lon FROM events),
  z AS (SELECT *, {SQL_ZONE} AS zone FROM p),
  supply AS (SELECT zone, count(*) AS idle FROM (SELECT zone, event_type, row_number() OVER (PARTITION BY zone, user_id ORDER BY ts DESC) AS rn
    FROM z WHERE event_type <> 'purchase') WHERE rn = 1 AND event_type = 'view' GROUP BY 1),
  demand AS (SELECT zone, w + 60000000 AS window_ts, count(*) AS trips FROM (SELECT zone,
    unnest([epoch_us(ts) // 30000000 * 30000000, epoch_us(ts) // 30000000 * 30000000 - 30000000]) AS w FROM z WHERE event_type = 'purchase') GROUP BY 1, 2)
SELECT zone, window_ts, trips AS trips_per_min, COALESCE(idle, 0) AS idle_drivers, CASE WHEN COALESCE(idle, 0) = 0 THEN 3.0::DOUBLE
  WHEN trips / greatest(COALESCE(idle, 0), 1) < 0.5 THEN 1.0 WHEN trips / greatest(COALESCE(idle, 0), 1) < 1.0 THEN 1.2
  WHEN trips / greatest(COALESCE(idle, 0), 1) < 2.0 THEN 1.6 WHEN trips / greatest(COALESCE(idle, 0), 1) < 3.0 THEN 2.0 ELSE 2.5 END AS surge_multiplier
FROM demand LEFT JOIN supply USING (zone)""")
def stream_surge(lake: Lake):
    """Demand windows priced against the idle supply of the same events."""
    checkpoint, supply, out = dirs(lake, "supply", "surge")
    events = event_stream(lake).withColumns({
        "lat": F.lit(40.5) + (F.col("event_id") % 400) / 1000, "lon": F.lit(-74.2) + ((F.col("event_id") * 31) % 500) / 1000,
        "ts_us": micros("ts")})
    pings = events.filter("event_type <> 'purchase'").withColumns({
        "driver_id": F.col("user_id"), "state": F.expr("CASE event_type WHEN 'view' THEN 'IDLE' ELSE 'ON_TRIP' END")})
    finish(rides.supply_table(pings, supply), f"{checkpoint}/supply")
    trips = events.filter("event_type = 'purchase'").withColumn("pickup_zone", geo.nearest_centre("lat", "lon"))
    finish(rides.surge(trips, "ts", supply, out), f"{checkpoint}/surge")
    # an open window is priced again by every batch that adds to it: the last price holds
    prices = latest_by_key(lake.spark.read.parquet(out), ["zone", "window_ts"], ["batch_id"])
    return prices.select("zone", us("window_ts").alias("window_ts"), "trips_per_min", "idle_drivers", "surge_multiplier")


def driver_log(customers: DataFrame, live: str, offset: int = 0) -> DataFrame:
    """A change message for every customer: its row where ``live`` holds, else a removal."""
    body = F.to_json(F.struct(F.col("c_name").alias("full_name"), F.col("c_acctbal").alias("rating"), F.lit(2020).alias("vehicle_year")))
    return customers.select(F.col("c_custkey").cast("string").alias("key"), F.when(F.expr(live), body).alias("value"),
                                   F.lit(0).alias("partition"), (F.col("c_custkey") + offset).alias("offset"))


@query("""SELECT CAST(user_id AS VARCHAR) AS driver_id, count(*) AS trips FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""")
def stream_table_misses(lake: Lake):
    """Trips per driver that the table does not hold, from the miss sink of the stream-table join."""
    checkpoint, table, out, misses = dirs(lake, "drivers", "enriched", "misses")
    put_batch(driver_log(lake("customer"), "c_acctbal > 0"), f"{table}/delta", 0)
    finish(rides.enrich(event_stream(lake).withColumn("driver_id", F.col("user_id").cast("string")), table, out, misses), checkpoint)
    return lake.spark.read.parquet(misses).groupBy("driver_id").agg(F.sum("trips").alias("trips"))


@query("""WITH live AS (SELECT c_custkey AS user_id, 0 AS half FROM customer WHERE c_acctbal > 0 UNION ALL
    SELECT c_custkey, 1 FROM customer WHERE CASE WHEN c_nationkey % 3 = 0 THEN c_acctbal <= 0 ELSE c_acctbal > 0 END)
SELECT CAST(e.user_id AS VARCHAR) AS driver_id, CASE WHEN l.user_id IS NOT NULL THEN e.event_id % 2 END AS half, count(*) AS trips,
  CASE WHEN l.user_id IS NOT NULL THEN CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) END AS total,
  CASE WHEN l.user_id IS NOT NULL THEN max(epoch_us(ts)) END AS last_us
FROM events e LEFT JOIN live l ON l.user_id = e.user_id AND l.half = e.event_id % 2 GROUP BY e.user_id, 2, l.user_id""")
def stream_table_state(lake: Lake):
    """Trips joined with a table held in state: half of them, then changes to a third of the table, then the rest."""
    checkpoint, log, trips, out, misses = dirs(lake, "log", "trips", "enriched", "misses")
    events = lake("events").withColumn("driver_id", F.col("user_id").cast("string"))
    base = driver_log(lake("customer"), "c_acctbal > 0")
    later = driver_log(lake("customer").filter("c_nationkey % 3 = 0"), "c_acctbal <= 0", 1_000_000_000)
    read = lake.spark.readStream.option("maxFilesPerTrigger", FILES_PER_BATCH)
    with rocksdb_state(lake.spark):
        for half, changes in enumerate((base.limit(0), later)):
            events.filter(F.col("event_id") % 2 == half).write.parquet(f"{trips}/half={half}")
            changes.write.parquet(f"{log}/half={half}")
            finish(rides.enrich_in_state(read.schema(events.schema).parquet(f"{trips}/*"), read.schema(base.schema).parquet(f"{log}/*"),
                                         out, misses, base=base, salts=2), checkpoint)
    hits = lake.spark.read.parquet(out).groupBy("driver_id", (F.col("event_id") % 2).alias("half")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(money("value")).cast("double").alias("total"), F.max(micros("ts")).alias("last_us"))
    unknown = lake.spark.read.parquet(misses).groupBy("driver_id").agg(F.sum("trips").alias("trips"))
    return hits.unionByName(unknown, allowMissingColumns=True)


@query(f"""SELECT window_start, trip_count, revenue, revenue / trip_count AS avg_fare, users / trip_count AS avg_user FROM (
  SELECT epoch_us(date_trunc('minute', ts)) AS window_start, count(*) AS trip_count, CAST(sum({SQL_MONEY}) AS DOUBLE) AS revenue,
    CAST(sum(user_id) AS DOUBLE) AS users FROM events GROUP BY 1) WHERE window_start + 60000000 <= {CLOSED}""")
def stream_minute_stats(lake: Lake):
    """Closed one-minute windows with count, sum and two averages."""
    from ..operators.rolling import windowed

    checkpoint, out = dirs(lake, "windows")
    frame = windowed(event_stream(lake).withWatermark("ts", "1 hour"), [], "ts", "1 minute",
                     {"trip_count": F.count(F.lit(1)), "revenue": F.sum(money("value")), "users": F.sum("user_id")})
    finish(file_writer(frame, out), checkpoint)
    count = F.col("trip_count")
    return lake.spark.read.parquet(out).select(us("window_start").alias("window_start"), "trip_count", real("revenue").alias("revenue"),
                                               (real("revenue") / count).alias("avg_fare"), (real("users") / count).alias("avg_user"))


@query("""WITH t AS (SELECT DISTINCT user_id, epoch_us(ts) // 1000 AS ms FROM events), w AS (SELECT max(ms) - 3600000 AS mark FROM t),
  g AS (SELECT user_id, ms, lead(ms) OVER (PARTITION BY user_id ORDER BY ms) AS next, mark FROM t, w),
  s AS (SELECT user_id, 'pending' AS state, ms + 43200000 AS at_ms, next, mark FROM g UNION ALL SELECT user_id, 'firing', ms + 86400000, next, mark FROM g
    UNION ALL SELECT user_id, 'resolved', next, NULL, mark + 1 FROM g WHERE next - ms > 43200000)
SELECT CAST(user_id AS VARCHAR) AS rule, state, at_ms FROM s WHERE at_ms < mark AND (next IS NULL OR at_ms < next)""")
def stream_silence_alarms(lake: Lake):
    """Users as rules: pending after half a day without an event, firing after a day, resolved by the next event."""
    checkpoint, out = dirs(lake, "alarms")
    with rocksdb_state(lake.spark):
        steps = alarms.silence_alarms(event_stream(lake), "user_id", "ts", 43_200, 86_400, "1 hour")
        finish(file_writer(steps, out), checkpoint)
    return lake.spark.read.parquet(out).select("rule", "state", F.unix_millis("at").alias("at_ms"))


@query("""SELECT id, 'Notify ' || id AS notice, min(half) AS batch_id FROM (
  SELECT user_id || '-' || event_type AS id, event_id % 2 AS half FROM events) GROUP BY id""")
def act_once(lake: Lake):
    """Users and event types as ids, in two batches of which the second fails once: each id is acted on in its first batch."""
    checkpoint, source, log = dirs(lake, "inbox", "log")
    events = lake("events").select(F.concat_ws("-", "user_id", "event_type").alias("id"), "event_id")
    failures = [1]

    def action(rows: DataFrame, batch_id: int) -> None:
        if batch_id in failures:
            failures.clear()
            raise OSError("the endpoint is unavailable")

    for half in range(2):
        events.filter(F.col("event_id") % 2 == half).write.parquet(f"{source}/half={half}")
        stream = lake.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(f"{source}/*")
        job = lambda: ledger.act_once(stream, "id", F.concat(F.lit("Notify "), "id"), log, action, buckets=8, compact_every=2)
        try:
            finish(job(), f"{checkpoint}/act")
        except Exception:  # the first try of the second batch; it stays pending
            if half == 0 or failures:
                raise
            finish(job(), f"{checkpoint}/act")
    return ledger.handled(lake.spark, log).select("id", "notice", F.col("batch_id").cast("bigint").alias("batch_id"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(value) AS n, quantile_name, true AS within_bound
FROM events, (SELECT unnest(['p50', 'p95', 'p99']) AS quantile_name) WHERE value IS NOT NULL GROUP BY 1, 2, 4""")
def stream_sketched_quantiles(lake: Lake):
    """Sketches of a stream's batches, stored per hour and merged per day; the exact rank of every quantile keeps the stated bound."""
    checkpoint, out = dirs(lake, "sketches")

    def write(batch: DataFrame, batch_id: int) -> None:
        hourly = mergeable.quantile_sketches(batch.withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH")), ["hour", "event_type"], "value")
        put_batch(hourly, out, batch_id)

    finish(per_batch(event_stream(lake), write), checkpoint)
    daily = mergeable.merged_sketches(lake.spark.read.parquet(out).withColumn("day", F.substring("hour", 1, 10)), ["day", "event_type"])
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = mergeable.sketched_quantiles(daily, ["day", "event_type"], list(names.values())).unpivot(
        ["day", "event_type", "n"], list(names), "quantile_name", "estimate")
    values = lake("events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value").filter("value IS NOT NULL")
    ranks = values.join(found, ["day", "event_type"]).groupBy("day", "event_type", "n", "quantile_name").agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto"))
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("quantile_name")) * F.col("n")
    slack = F.lit(mergeable.rank_error()) * F.col("n") + 1
    return ranks.select("day", "event_type", "n", "quantile_name",
                        ((F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)).alias("within_bound"))


@query("""WITH e AS (SELECT *, event_id % 2 AS half, epoch_us(ts) AS us FROM events), m AS (SELECT half, max(max(us)) OVER (ORDER BY half) AS mark FROM e GROUP BY half)
SELECT event_id, us >= mark - 864000000000 AS kept FROM e JOIN m USING (half)""")
def stream_late_filter(lake: Lake):
    """Ten days behind the newest event so far: the even events, then the odd ones, each event kept or set aside."""
    checkpoint, source, kept, late, marks = dirs(lake, "events", "kept", "late", "marks")
    events = lake("events").select("event_id", us("ts").alias("us"))
    for half in range(2):
        events.filter(F.col("event_id") % 2 == half).write.parquet(f"{source}/half={half}")
        stream = lake.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(f"{source}/*")
        finish(flows.split_late(stream, "us", kept, late, marks, 864_000_000_000), checkpoint)
    read = lake.spark.read.parquet
    return read(kept).select("event_id", F.lit(True).alias("kept")).union(read(late).select("event_id", F.lit(False).alias("kept")))
