"""Ride stream jobs: route, enrich, validate, windows, shifts, surge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.numeric import surge_multiplier
from ..operators.changes import changelog_table
from ..operators.enrich import driver_columns
from ..plans import rides
from . import lookups
from .sinks import add_delta, file_writer, fold_latest, per_batch, put_batch, read_folded


def route(trips: DataFrame, clean: str, dead: str) -> DataStreamWriter:
    """Raw trips to a clean table and a dead-letter table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = rides.route(batch)
        put_batch(good, clean, batch_id)
        put_batch(bad, dead, batch_id)
    return per_batch(trips, write, sinks=2)


def validate(trips: DataFrame, dead: str, counts: str, scores: str) -> DataStreamWriter:
    """Expectation suite per micro-batch: dead letters, counts per rule, batch score."""
    def write(batch: DataFrame, batch_id: int) -> None:
        letters, per_rule, score = rides.validate(batch)
        put_batch(letters, dead, batch_id)
        put_batch(per_rule, counts, batch_id)
        put_batch(score, scores, batch_id)
    return per_batch(trips, write, sinks=3)


def enrich(trips: DataFrame, drivers: str, enriched: str, misses: str) -> DataStreamWriter:
    """Join each micro-batch with the driver table as it stands; ``misses`` gets the trips per unknown driver of each batch.

    The table is folded for every batch: for small tables. ``enrich_in_state`` keeps the rows in the state store instead.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        joined, unknown = rides.enrich(batch, current_drivers(batch.sparkSession, drivers))
        put_batch(joined, enriched, batch_id)
        put_batch(rides.missing_drivers(unknown), misses, batch_id)
    return per_batch(trips, write, sinks=2)


def enrich_in_state(trips: DataFrame, changelog: DataFrame, enriched: str, misses: str, base: DataFrame | None = None,
                    salts: int = 1) -> DataStreamWriter:
    """The same join with every driver's row in the state store: a batch costs its trips and changes, not the table.

    ``base`` (key, value, partition, offset) fills the table before the first batch. See ``lookups.join_table``.
    """
    schema = T.StructType.fromDDL(rides.DRIVER)
    rows = lookups.join_table(trips, "driver_id", lookups.keyed_changes(changelog, "driver_id"),
                              base=None if base is None else lookups.keyed_changes(base, "driver_id"), salts=salts)

    def write(batch: DataFrame, batch_id: int) -> None:
        facts = lookups.facts_of(batch, trips.schema)
        known = facts.filter(F.col(lookups.TABLE_ROW).isNotNull()).select(
            F.struct(*trips.columns).alias("__trip"), F.from_json(lookups.TABLE_ROW, schema).alias("__row"))
        parts = known.select("__trip", *[f"__row.{name}" for name in schema.fieldNames() if name != "driver_id"])
        put_batch(parts.select("__trip.*", *[c.alias(n) for n, c in driver_columns().items()]), enriched, batch_id)
        put_batch(rides.missing_drivers(facts.filter(F.col(lookups.TABLE_ROW).isNull())), misses, batch_id)
    return per_batch(rows, write, sinks=2)


DRIVER_FOLD = fold_latest(["key"], ["partition", "offset"])
SUPPLY_FOLD = fold_latest(["zone", "driver_id"], ["ts_us"])


def current_drivers(spark: SparkSession, drivers: str) -> DataFrame:
    """Live drivers, parsed from the latest changelog message of each key."""
    messages = read_folded(spark, drivers, DRIVER_FOLD)
    if messages is None:
        return spark.createDataFrame([], rides.DRIVER)
    return changelog_table(messages, T.StructType.fromDDL(rides.DRIVER), "driver_id")


def driver_table(changelog: DataFrame, drivers: str, compact_every: int = 50) -> DataStreamWriter:
    """Keep the driver table current from its changelog topic; an empty value removes the driver.

    Messages are stored as they are, tombstones included, so that a replay of older messages cannot
    revive a removed driver.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        latest = DRIVER_FOLD(batch.select("key", "value", "partition", "offset"))
        add_delta(latest, drivers, batch_id, DRIVER_FOLD, compact_every)
    return per_batch(changelog, write)


def windows(trips: DataFrame, time: str, target: str, delay: str, hopping: bool = False) -> DataStreamWriter:
    """Closed one-minute (or five-minute hopping) revenue windows per zone, appended once each."""
    marked = trips.withWatermark(time, delay)
    frame = rides.revenue_hopping(marked, time) if hopping else rides.revenue_per_minute(marked, time)
    return file_writer(frame, target)


def session_frame(df: DataFrame, key: str, time: str, gap: str, delay: str, sums: dict[str, Column],
                  count: str) -> DataFrame:
    """Closed sessions per key; the end is the last event, not the end of the gap."""
    session = F.session_window(time, gap)
    grouped = df.withWatermark(time, delay).groupBy(session.alias("__s"), key).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(c).alias(n) for n, c in sums.items()])
    return grouped.select(key, F.col("__s.start").alias("session_start"),
                          (F.col("__s.end") - F.expr(f"INTERVAL {gap}")).alias("session_end"), count, *sums)


def shifts(trips: DataFrame, time: str, target: str, delay: str) -> DataStreamWriter:
    frame = session_frame(trips, "driver_id", time, "10 minutes", delay, {"shift_earnings": F.col("total_amount")}, "trips_in_shift")
    return file_writer(frame.withColumnsRenamed({"session_start": "shift_start", "session_end": "shift_end"}), target)


def supply_table(pings: DataFrame, table: str, compact_every: int = 50) -> DataStreamWriter:
    """Latest ping per (zone, driver); of each batch only its own latest pings are stored."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = rides.zone_pings(batch).select("zone", "driver_id", "state", "ts_us")
        add_delta(SUPPLY_FOLD(fresh), table, batch_id, SUPPLY_FOLD, compact_every)
    return per_batch(pings, write)


def idle_supply(spark: SparkSession, table: str) -> DataFrame:
    pings = read_folded(spark, table, SUPPLY_FOLD)
    if pings is None:
        return spark.createDataFrame([], "zone string, idle bigint")
    return pings.filter("state = 'IDLE'").groupBy("zone").agg(F.count(F.lit(1)).alias("idle"))


def surge(trips: DataFrame, time: str, supply: str, target: str, delay: str = "30 seconds") -> DataStreamWriter:
    """Price step per zone from a sliding 60 s demand window every 30 s and the current idle supply."""
    demand = (trips.filter(F.col("pickup_zone") != "").withWatermark(time, delay)
              .groupBy(F.window(time, "60 seconds", "30 seconds").alias("w"), F.col("pickup_zone").alias("zone"))
              .agg(F.count(F.lit(1)).alias("trips_per_min")))

    def write(batch: DataFrame, batch_id: int) -> None:
        joined = batch.join(idle_supply(batch.sparkSession, supply), "zone", "left").select(
            "zone", F.col("w.end").alias("window_ts"), "trips_per_min", F.coalesce("idle", F.lit(0)).alias("idle_drivers"))
        put_batch(joined.withColumn("surge_multiplier", surge_multiplier("trips_per_min", "idle_drivers")), target, batch_id)
    return per_batch(demand, write).outputMode("update")
