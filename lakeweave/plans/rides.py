"""Ride stream: validation, driver enrichment, expectations, windows and surge, as batch frames.

The same functions run inside the streaming jobs of :mod:`lakeweave.streaming`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import surge_multiplier
from ..operators import quality, rolling
from ..operators.enrich import driver_columns, stream_table_join
from ..operators.geo import nearest_centre
from ..operators.keyed import newest, top_per_key

TRIP = ("trip_id string, driver_id string, pickup_zone string, dropoff_zone string, pickup_lat double, pickup_lon double, "
        "dropoff_lat double, dropoff_lon double, distance_miles double, duration_minutes double, passenger_count int, "
        "payment_type string, pickup_time string, base_fare double, distance_charge double, time_charge double, "
        "surge_multiplier double, fare_amount double, tip_amount double, total_amount double, _corruption string")
PING = "driver_id string, lat double, lon double, state string, trip_id string, ts string"
DRIVER = ("driver_id string, full_name string, license_number string, rating double, vehicle_make string, "
          "vehicle_model string, vehicle_year int, hire_date string, is_active boolean")
DEMAND_US = 60_000_000


def route(trips: DataFrame, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean trips, dead letters with reason and time)."""
    checked = trips.withColumn("_dlq_reason", quality.ride_reason())
    clean = checked.filter(F.col("_dlq_reason").isNull()).drop("_dlq_reason", "_corruption")
    dead = checked.filter(F.col("_dlq_reason").isNotNull()).withColumn("_dlq_ts", at if at is not None else F.current_timestamp())
    return clean, dead


def enrich(trips: DataFrame, drivers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trips with their driver, trips whose driver is unknown)."""
    return stream_table_join(trips, drivers, "driver_id", driver_columns())


def missing_drivers(unknown: DataFrame) -> DataFrame:
    """Trips per driver that the table lacks."""
    return unknown.groupBy("driver_id").agg(F.count(F.lit(1)).alias("trips"))


def validate(trips: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dead letter per broken expectation, pass/fail per expectation, batch score)."""
    rules = quality.ride_expectations()
    return quality.dead_letters(trips, rules), quality.rule_counts(trips, rules), quality.batch_score(trips, rules)


def surge_trips(trips: DataFrame, above: float = 1.5) -> DataFrame:
    return trips.filter(F.col("surge_multiplier") > above)


def revenue_per_minute(trips: DataFrame, time: str) -> DataFrame:
    return rolling.windowed(trips, ["pickup_zone"], time, "1 minute", {
        "trip_count": F.count(F.lit(1)), "revenue": F.sum("total_amount"), "avg_fare": F.avg("fare_amount"),
        "avg_distance": F.avg("distance_miles")})


def revenue_hopping(trips: DataFrame, time: str) -> DataFrame:
    return rolling.windowed(trips, ["pickup_zone"], time, "5 minutes", {"revenue_5m": F.sum("total_amount")}, "1 minute")


def shifts(trips: DataFrame, time: str) -> DataFrame:
    frame = rolling.session_totals(trips, "driver_id", time, 600, {"shift_earnings": F.col("total_amount")}, "trips_in_shift")
    return frame.withColumnsRenamed({"session_start": "shift_start", "session_end": "shift_end"})


def top_earners(shift_table: DataFrame, n: int = 10) -> DataFrame:
    totals = shift_table.groupBy("driver_id").agg(F.sum("shift_earnings").alias("total"))
    return totals.orderBy(F.desc("total"), "driver_id").limit(n)


def zone_pings(pings: DataFrame) -> DataFrame:
    return pings.withColumn("zone", nearest_centre("lat", "lon"))


def surge_table(trips: DataFrame, pings: DataFrame, as_of_us: Column, horizon_us: int = DEMAND_US,
                order: Sequence[str] = ("ts_us",)) -> DataFrame:
    """Demand, idle supply and price step per zone that ever had demand.

    A driver is idle in a zone while the latest ping there says so, also after moving on.
    """
    in_window = F.col("ts_us").between(as_of_us - F.lit(horizon_us), as_of_us)
    demand = (trips.filter(F.col("pickup_zone") != "").groupBy(F.col("pickup_zone").alias("zone"))
              .agg(F.count_if(in_window).alias("trips_per_min")))
    latest = top_per_key(pings, ["zone", "driver_id"], newest(*order))
    supply = latest.filter(F.col("state") == "IDLE").groupBy("zone").agg(F.count(F.lit(1)).alias("idle"))
    joined = demand.join(supply, "zone", "left").withColumn("idle_drivers", F.coalesce("idle", F.lit(0)))
    return joined.select("zone", "trips_per_min", "idle_drivers",
                         surge_multiplier("trips_per_min", "idle_drivers").alias("surge_multiplier"))


def run(trips: DataFrame, pings: DataFrame, drivers: DataFrame, out: str, as_of_us: Column) -> dict[str, DataFrame]:
    """Batch form of the whole ride flow: every result is written once below ``out`` and read back.

    ``trips`` carry ``pickup_time`` text, ``pings`` carry ``ts`` text.
    """
    spark = trips.sparkSession
    tables: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        tables[name] = spark.read.parquet(f"{out}/{name}")
        return tables[name]

    timed = trips.withColumn("ts", F.try_to_timestamp("pickup_time"))
    checked = store("checked", timed.withColumn("_dlq_reason", quality.ride_reason()))
    store("dead_letters", checked.filter(F.col("_dlq_reason").isNotNull()).withColumn("_dlq_ts", F.current_timestamp()))
    clean = store("clean", checked.filter(F.col("_dlq_reason").isNull()).drop("_dlq_reason", "_corruption"))
    enriched, misses = enrich(clean, drivers)
    store("enriched", enriched)
    store("unknown_drivers", misses)
    letters, counts, score = validate(clean)
    for name, df in {"expectation_failures": letters, "expectation_counts": counts, "score": score,
                     "revenue_1m": revenue_per_minute(clean, "ts"), "revenue_5m": revenue_hopping(clean, "ts"),
                     "shifts": shifts(clean, "ts"), "surge_trips": surge_trips(clean)}.items():
        store(name, df)
    demand = timed.withColumn("ts_us", F.unix_micros("ts"))
    supply = zone_pings(pings.withColumn("ts_us", F.unix_micros(F.try_to_timestamp("ts"))))
    store("surge", surge_table(demand, supply, as_of_us))
    return tables
