"""Position, weather and quake streams plus changed configuration tables: raw to silver to marts."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.numeric import magnitude_bucket
from ..operators import geo, quality
from ..operators.changes import LATE_MS, late_cutoff, unify_flat_time
from ..operators.enrich import default_if_empty
from ..operators.keyed import latest_by_key, latest_known, latest_with_ties, top_n
from ..session import scratch_dir
from ..sources.files import lake_format, read_recent, with_arrival
from ..sources.layout import land_daily, table_or_none, write_snapshot

HOUR_MS = 3_600_000
SEISMIC_DEFAULT = 5.5
# Silver tables, their key columns, and whether they come from change capture.
ENTITIES = {
    "ogn_positions": ("event_id", False),
    "noaa_observations": ("event_id", False),
    "noaa_alerts": ("alert_id", False),
    "seismic_events": ("event_id", False),
    "regions": ("region_id", True),
    "alert_thresholds": ("threshold_id", True),
    "subscriber_watchlist": ("watchlist_id", True),
}
OBSERVED = ("lat", "lon", "temperature_c", "humidity_pct", "wind_speed_kmh", "wind_gust_kmh", "wind_dir_deg",
            "pressure_pa", "visibility_m", "precip_last_1h_mm", "text_description")


def conform_entity(rows: DataFrame, key: str, time: str = "ts_ms", arrival: Sequence[str] = ("_arrival",),
                   horizon: int = LATE_MS) -> DataFrame:
    """Latest row per key, then without rows later than the horizon behind the newest one.

    The newest kept time equals the newest time of all keyed rows, so the cut-off needs only one
    plain maximum over the input.
    """
    keyed_rows = rows.filter(F.col(key).isNotNull())
    cutoff = late_cutoff(keyed_rows, time, horizon)
    return latest_known(keyed_rows, key, time, arrival).filter(F.coalesce(F.col(time), F.lit(0)) >= cutoff)


def stage_metrics(entity: str, rows: DataFrame, key: str, time: str = "ts_ms", horizon: int = LATE_MS) -> DataFrame:
    """One row: rows in, rows out, late and duplicate rows dropped (null keys count as duplicates)."""
    stamp = F.coalesce(F.col(time), F.lit(0))
    cutoff = late_cutoff(rows.filter(F.col(key).isNotNull()), time, horizon)
    per_key = rows.groupBy(key).agg(F.max(stamp).alias("__latest"), F.count(F.lit(1)).alias("__n"))
    present, kept = F.col(key).isNotNull(), F.col("__latest") >= cutoff
    row = per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_in"), F.count_if(present & kept).alias("rows_out"),
                      F.count_if(present & ~kept).alias("late_dropped"))
    return row.select(F.lit(entity).alias("entity"), "*",
                      (F.col("rows_in") - F.col("rows_out") - F.col("late_dropped")).alias("dedup_dropped"))


def read_bronze(spark: SparkSession, bronze: str, schemas: dict[str, str], modified_after: str,
                fmt: str | None = None) -> dict[str, DataFrame]:
    """Rows of every entity from the files changed after ``modified_after``, with their arrival order."""
    chosen = fmt or lake_format(spark)
    return {entity: with_arrival(read_recent(spark, f"{bronze}/{entity}", schema, modified_after, chosen))
            for entity, schema in schemas.items()}


def bronze_schemas(spark: SparkSession, bronze: str, fmt: str | None = None) -> dict[str, str]:
    """Schema of every entity that has landed, from its own files."""
    found, chosen = {}, fmt or lake_format(spark)
    for entity in ENTITIES:
        try:
            found[entity] = spark.read.format(chosen).option("recursiveFileLookup", True).load(f"{bronze}/{entity}").schema
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return found


def drop_deleted(rows: DataFrame, keep_deleted: bool = False) -> DataFrame:
    """Remove keys whose latest change is a delete."""
    if keep_deleted or "__deleted" not in rows.columns:
        return rows
    return rows.filter(F.coalesce(F.col("__deleted").cast("string"), F.lit("false")) != "true").drop("__deleted")


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], silver: str, loaded_at: str,
                 keep_deleted: bool = False) -> DataFrame:
    """Add every entity's rows of this run to its silver day, and metrics; one failing entity does not
    stop the others. ``loaded_at`` also names the run, so a repeated run replaces itself.

    Returns (entity, status, detail).
    """
    outcome, run_id = [], re.sub(r"\D", "", loaded_at)
    for entity, rows in bronze.items():
        key, captured = ENTITIES[entity]
        try:
            staged = unify_flat_time(rows) if captured else rows
            conformed = drop_deleted(conform_entity(staged, key), keep_deleted and captured)
            land_daily(conformed.drop("_arrival"), f"{silver}/{entity}", F.lit(loaded_at).cast("timestamp"), run_id)
            note_bounds(spark, silver, entity, run_id)
            metrics = stage_metrics(entity, staged, key).withColumn("ran_at", F.lit(loaded_at))
            metrics.write.mode("overwrite").parquet(f"{silver}/_quality/{entity}/run={run_id}")
            outcome.append((entity, "ok", ""))
        except Exception as error:  # isolation per entity is the contract of this job
            outcome.append((entity, "failed", f"{type(error).__name__}: {str(error)[:500]}"))
    return spark.createDataFrame(outcome, "entity string, status string, detail string")


BOUNDS = "_bounds"


def note_bounds(spark: SparkSession, silver: str, entity: str, run_id: str) -> None:
    """Note the least and greatest time that a run brought, taken from what it has written."""
    written = spark.read.parquet(f"{silver}/{entity}").filter(F.col("run").cast("string") == run_id)
    row = written.agg(F.min("ts_ms").alias("min_ts_ms"), F.max("ts_ms").alias("max_ts_ms"), F.count(F.lit(1)).alias("rows"))
    row.write.mode("overwrite").parquet(f"{silver}/{BOUNDS}/{entity}/run={run_id}")


def outdated_runs(spark: SparkSession, silver: str, entity: str, since_ms: Column) -> list[str]:
    """Runs known to hold no row at or after ``since_ms``. Runs without a note may hold some and are not among them."""
    notes = table_or_none(spark, f"{silver}/{BOUNDS}/{entity}")
    if notes is None:
        return []
    old = notes.filter(F.col("max_ts_ms").isNull() | (F.col("max_ts_ms") < since_ms))
    return [row["run"] for row in old.select(F.col("run").cast("string").alias("run")).collect()]


def silver_table(spark: SparkSession, silver: str, entity: str, since_ms: Column | None = None) -> DataFrame | None:
    """A silver table with one row per key, although overlapping loads may have stored a key twice.

    With ``since_ms`` folders of runs that ended before it are not read at all. Keys whose newest row is older may then show
    an older row or none; rows at or after ``since_ms`` are those of the whole table.
    """
    table = table_or_none(spark, f"{silver}/{entity}")
    if table is None:
        return None
    if since_ms is not None and (old := outdated_runs(spark, silver, entity, since_ms)):
        table = table.filter(~F.col("run").cast("string").isin(old))
    key, _ = ENTITIES[entity]
    order = [name for name in ("ts_ms", "updated_at", "run") if name in table.columns]
    return latest_by_key(table, [key], order)


def _recent(df: DataFrame, as_of_ms: Column, horizon_ms: int) -> DataFrame:
    return df.filter(F.col("ts_ms") >= as_of_ms - F.lit(horizon_ms))


def _active(regions: DataFrame, *columns: str) -> DataFrame:
    return regions.filter("is_active").select(*columns, "min_lat", "max_lat", "min_lon", "max_lon")


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written and read back, so that what follows does not compute it again."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _matching(df: DataFrame, keys: Sequence[str], others: DataFrame, how: str) -> DataFrame:
    """Join on equal keys, nulls included; the keys of ``others`` are dropped."""
    named = others.withColumnsRenamed({key: f"__{key}" for key in keys})
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    return df.join(named, same, how).drop(*[f"__{key}" for key in keys])


def _over_places(points: DataFrame, regions: DataFrame, place: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates over the points in the boxes of each place that has any; places with the same boxes are computed once."""
    boxes, places = geo.shared_boxes(regions, place)
    shapes = geo.box_join(points, boxes).groupBy("shape").agg(*aggregates)
    return places.join(shapes, "shape").drop("shape")


def aircraft_density(positions: DataFrame, regions: DataFrame, as_of_ms: Column, horizon_ms: int = HOUR_MS,
                     limit: int | None = 200) -> DataFrame:
    """Positions, distinct aircraft, speed and altitude per active region, busiest first.

    Positions at one spot are added up before they meet the regions. The order does not ask for the distinct aircraft, which
    take a row per position and region: they are counted for the regions of the report only.
    """
    seen = _recent(positions, as_of_ms, horizon_ms).select(
        "lat", "lon", "ts_ms", "altitude_m", "ground_speed_kmh", F.coalesce("address", "callsign").alias("aircraft"))
    active, place = _active(regions, "name", "country", "kind"), ["name", "country", "kind"]
    spots = seen.groupBy("lat", "lon").agg(
        F.count(F.lit(1)).alias("n"), F.max("altitude_m").alias("max_altitude_m"), F.max("ts_ms").alias("ts_ms"),
        *[f(c).alias(f"{c}_{n}") for c in ("altitude_m", "ground_speed_kmh") for f, n in ((F.sum, "sum"), (F.count, "count"))])
    mean = lambda c: F.try_divide(F.sum(f"{c}_sum").cast("double"), F.sum(f"{c}_count"))
    places = _over_places(spots, active, place, F.sum("n").alias("positions_last_1h"), mean("altitude_m").alias("avg_altitude_m"),
                          mean("ground_speed_kmh").alias("avg_speed_kmh"), F.max("max_altitude_m").alias("max_altitude_m"),
                          F.max("ts_ms").alias("last_seen_ms"))
    order = [F.desc("positions_last_1h"), F.asc("name"), F.asc("country"), F.asc("kind")]
    told = _stored(top_n(places, order, limit), "density")
    known = seen.filter("aircraft IS NOT NULL").select("lat", "lon", "aircraft")
    aircraft = _over_places(known, _matching(active, place, told.select(*place), "left_semi"), place,
                            F.countDistinct("aircraft").alias("unique_aircraft"))
    density = _matching(told, place, aircraft, "left").orderBy(*order)
    return density.select(F.col("name").alias("region"), "country", "kind", "positions_last_1h",
                          F.coalesce("unique_aircraft", F.lit(0)).alias("unique_aircraft"), "avg_altitude_m", "avg_speed_kmh",
                          "max_altitude_m", "last_seen_ms")


def weather_snapshot(observations: DataFrame, regions: DataFrame, measures: Sequence[str] = OBSERVED,
                     limit: int | None = 500) -> DataFrame:
    """Newest observation of each station with its region, ties included."""
    newest = latest_with_ties(observations.select("station_id", "ts_ms", *measures), ["station_id"], "ts_ms")
    places = regions.select(F.col("station_code").alias("__code"), F.col("name").alias("region"), "country")
    joined = newest.join(places, F.col("station_id") == F.col("__code"), "left")
    columns = ["station_id", "region", "country", "ts_ms", *measures]
    return top_n(joined.select(*columns), [F.desc("ts_ms"), F.asc("station_id"), F.asc("region")], limit)


def seismic_summary(quakes: DataFrame, as_of_ms: Column, horizon_ms: int = 24 * HOUR_MS, limit: int | None = 500) -> DataFrame:
    """Quakes per region and magnitude bucket, most frequent first."""
    recent = _recent(quakes, as_of_ms, horizon_ms).withColumn("mag_bucket", magnitude_bucket("magnitude"))
    summary = recent.groupBy("region", "mag_bucket").agg(
        F.count(F.lit(1)).alias("events"), F.avg("magnitude").alias("avg_magnitude"), F.avg("depth_km").alias("avg_depth_km"),
        F.min("magnitude").alias("min_mag"), F.max("magnitude").alias("max_mag"), F.max("ts_ms").alias("last_event_ms"))
    named = summary.withColumn("region", F.coalesce("region", F.lit("Unknown")))
    return top_n(named, [F.desc("events"), F.asc("region"), F.asc("mag_bucket")], limit)


def alert_correlation(quakes: DataFrame, regions: DataFrame, thresholds: DataFrame, watchlist: DataFrame,
                      as_of_ms: Column, horizon_ms: int = 24 * HOUR_MS, limit: int | None = 100) -> DataFrame:
    """Strong recent quakes per watched region and how many recipients hear of them.

    The averages weigh a quake once per active watcher of its region, as a join of the two would; the
    weights are counted per region instead, so quakes and watchers are never multiplied out. Quakes at one spot are added up
    before they meet the regions; distinct quakes are counted for the regions alone that are strong enough for the report.
    """
    rule = ((F.col("source") == "seismic") & (F.col("metric") == "magnitude") & F.col("op").isin(">", ">=")
            & F.col("is_active"))
    strong = _recent(quakes, as_of_ms, horizon_ms).filter(
        F.col("magnitude") >= default_if_empty(thresholds, rule, "threshold", SEISMIC_DEFAULT))
    active, place = _active(regions, "region_id", "name", "country"), ["name", "country"]
    spots = strong.groupBy("lat", "lon").agg(F.sum("magnitude").alias("s"), F.count("magnitude").alias("c"),
                                             F.max("magnitude").alias("m"), F.max("ts_ms").alias("t"))
    per_region = _stored(_over_places(spots, active, [*place, "region_id"], F.sum("s").alias("s"), F.sum("c").alias("c"),
                                      F.max("m").alias("m"), F.max("t").alias("t")), "correlation")
    watchers = watchlist.filter(F.col("source").isin("seismic", "*") & F.col("is_active")).select("region_id", "recipient")
    weights = watchers.groupBy("region_id").agg(F.count(F.lit(1)).alias("w"))
    weighted = per_region.join(weights, "region_id", "left").withColumn("w", F.coalesce("w", F.lit(1)))
    facts = weighted.groupBy(*place).agg(
        (F.sum(F.col("s") * F.col("w")) / F.sum(F.col("c") * F.col("w"))).alias("avg_magnitude"),
        F.max("m").alias("max_magnitude"), F.max("t").alias("last_event_ms"))
    heard = (per_region.select(*place, "region_id").join(watchers, "region_id").select(*place, "recipient").distinct()
             .groupBy(*place).agg(F.count("recipient").alias("n")))
    if limit is not None:  # who is weaker than the last of the strongest is not in the report, whatever its count
        least = facts.orderBy(F.desc("max_magnitude")).limit(limit).agg(F.min("max_magnitude").alias("m")).scalar()
        facts = facts.filter(F.col("max_magnitude") >= least)
    facts = _stored(facts, "correlation")
    counts = _over_places(strong.filter("event_id IS NOT NULL").select("lat", "lon", "event_id"),
                          _matching(active, place, facts.select(*place), "left_semi"), place,
                          F.countDistinct("event_id").alias("quake_count_24h"))
    mart = _matching(_matching(facts, place, counts, "left"), place, heard, "left").select(
        F.col("name").alias("region"), "country", F.coalesce("quake_count_24h", F.lit(0)).alias("quake_count_24h"), "avg_magnitude",
        "max_magnitude", F.coalesce("n", F.lit(0)).alias("subscribers_notified"), "last_event_ms")
    return top_n(mart, [F.desc("max_magnitude"), F.desc("quake_count_24h"), F.asc("region"), F.asc("country")], limit)


def marts(spark: SparkSession, silver: str, as_of_ms: Column, limit: int | None = None) -> dict[str, Callable[[], DataFrame | None]]:
    """The four marts, whole or their first ``limit`` rows; each is None while one of its tables is missing."""

    def build(make: Callable[..., DataFrame], *entities: str, horizon_ms: int | None = None) -> Callable[[], DataFrame | None]:
        """The first entity is read as far back as the mart looks, the others whole."""
        since = None if horizon_ms is None else as_of_ms - F.lit(horizon_ms)

        def run() -> DataFrame | None:
            tables = [silver_table(spark, silver, entity, None if i else since) for i, entity in enumerate(entities)]
            return None if any(table is None for table in tables) else make(*tables)
        return run

    return {
        "aircraft_density_by_region": build(lambda p, r: aircraft_density(p, r, as_of_ms, limit=limit), "ogn_positions", "regions",
                                            horizon_ms=HOUR_MS),
        "weather_snapshot": build(lambda o, r: weather_snapshot(o, r, limit=limit), "noaa_observations", "regions"),
        "seismic_24h_summary": build(lambda q: seismic_summary(q, as_of_ms, limit=limit), "seismic_events", horizon_ms=24 * HOUR_MS),
        "region_alert_correlation": build(
            lambda q, r, t, w: alert_correlation(q, r, t, w, as_of_ms, limit=limit),
            "seismic_events", "regions", "alert_thresholds", "subscriber_watchlist", horizon_ms=24 * HOUR_MS),
    }


def build_gold(spark: SparkSession, silver: str, gold: str, as_of_ms: Column, snapshot: str, limit: int | None = None) -> DataFrame:
    """Publish every mart, whole unless there is a ``limit``, as a snapshot, the latest to readers; a failing mart does not stop the others."""
    outcome = []
    for name, make in marts(spark, silver, as_of_ms, limit).items():
        try:
            mart = make()
            if mart is not None:
                write_snapshot(mart, f"{gold}/{name}", snapshot)
            outcome.append((name, "skipped" if mart is None else "ok", ""))
        except Exception as error:  # isolation per mart is the contract of this job
            outcome.append((name, "failed", f"{type(error).__name__}: {str(error)[:500]}"))
    return spark.createDataFrame(outcome, "mart string, status string, detail string")


CHECKED = ("seismic_events", "noaa_observations", "ogn_positions", "regions")


def check_tables(tables: dict[str, DataFrame], now_ms: Column) -> DataFrame | None:
    """Standing dataset rules over the tables that there are; None without any."""
    results = None
    for entity in CHECKED:
        if entity not in tables:
            continue
        table = tables[entity]
        cutoff = late_cutoff(table, "ts_ms", LATE_MS) if entity == "ogn_positions" else None
        part = quality.dataset_rules(table, quality.rule_table(entity, now_ms, cutoff), F.current_timestamp())
        results = part if results is None else results.unionByName(part)
    return results


def check_silver(spark: SparkSession, silver: str, now_ms: Column) -> DataFrame | None:
    """Standing dataset rules over the silver tables that exist."""
    tables = {entity: silver_table(spark, silver, entity) for entity in CHECKED}
    return check_tables({entity: table for entity, table in tables.items() if table is not None}, now_ms)
