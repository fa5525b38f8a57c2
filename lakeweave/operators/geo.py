"""Points in boxes, nearest centres and feature flattening."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import squared_distance
from ..functions.text import as_column, first_non_blank
from .enrich import BROADCAST_ROWS

# Beacon kinds that are aircraft, and the zone centres of the ride data.
AIRCRAFT_BEACONS = ("aprs_aircraft", "flarm", "ogn_tracker", "fanet")
ZONES = (
    ("TIMES_SQUARE", 40.7580, -73.9855),
    ("MIDTOWN", 40.7549, -73.9840),
    ("WALL_STREET", 40.7074, -74.0113),
    ("JFK_AIRPORT", 40.6413, -73.7781),
    ("BROOKLYN", 40.6782, -73.9442),
    ("HARLEM", 40.8116, -73.9465),
)
UNKNOWN_ZONE = "UNKNOWN"
BASE_CELL = 0.25
LEAST_EXTENT = 1e-7  # degrees; about a centimetre


def _level(extent: Column) -> Column:
    """Level of the cells for boxes of this extent: a power of four of the base cell, an eighth to half of the extent."""
    return (F.ceil(F.log2(F.greatest(extent, F.lit(LEAST_EXTENT)) / F.lit(BASE_CELL)) / 2) * 2 - 3).cast("int")


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size)


def box_join(points: DataFrame, boxes: DataFrame, lat: str = "lat", lon: str = "lon",
             bounds: Sequence[str] = ("min_lat", "max_lat", "min_lon", "max_lon"),
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Pairs of a point and a box around it, borders included.

    Every box is filed under a grid whose cell is an eighth to half as high and as wide as the box, so it
    touches at most a hundred cells (some thirty on average) that reach little beyond it: of the points that meet
    it more than half lie inside, however long and thin it is. A point lies in exactly one cell per grid, which makes this an
    equi-join on (levels, cell) with the exact bounds checked after it: no pair is compared twice and
    none is missed. One small job counts the filed boxes per grid (powers of four in height and width; at most a few dozen
    for boxes of sane shapes): up to ``broadcast_rows`` they are broadcast and the points stay where
    they are, beyond that both sides are shuffled by cell and AQE splits crowded cells. The pairs themselves grow with
    points times boxes.
    """
    south, north, west, east = (F.col(name) for name in bounds)
    size = lambda level: F.lit(BASE_CELL) * F.pow(F.lit(2.0), level)
    filed = (boxes.filter((south <= north) & (west <= east))
             .withColumns({"__box_high": _level(north - south), "__box_wide": _level(east - west)}))
    rows, columns = (F.sequence(_cell(low, size(F.col(level))), _cell(high, size(F.col(level))))
                     for low, high, level in ((south, north, "__box_high"), (west, east, "__box_wide")))
    filed = filed.withColumn("__box_row", F.explode(rows)).withColumn("__box_col", F.explode(columns))
    per_grid = {(row["__box_high"], row["__box_wide"]): row["count"]
                for row in filed.groupBy("__box_high", "__box_wide").count().collect()}
    grids = [F.struct(*[F.lit(v).alias(n) for n, v in (("high", high), ("wide", wide))],
                      size(F.lit(high)).alias("height"), size(F.lit(wide)).alias("width"))
             for high, wide in sorted(per_grid) or [(0, 0)]]
    if sum(per_grid.values()) <= broadcast_rows:
        filed = F.broadcast(filed)
    placed = (points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
              .withColumn("__grid", F.explode(F.array(*grids)))
              .withColumns({"__high": F.col("__grid.high"), "__wide": F.col("__grid.wide"),
                            "__row": _cell(F.col(lat), F.col("__grid.height")), "__col": _cell(F.col(lon), F.col("__grid.width"))})
              .drop("__grid"))
    names = ("high", "wide", "row", "col")
    same_cell = reduce(and_, [F.col(f"__{name}") == F.col(f"__box_{name}") for name in names])
    inside = F.col(lat).between(south, north) & F.col(lon).between(west, east)
    joined = placed.join(filed, same_cell & inside)
    return joined.drop(*[f"__{name}" for name in names], *[f"__box_{name}" for name in names])


def shared_boxes(boxes: DataFrame, place: Sequence[str], bounds: Sequence[str] = ("min_lat", "max_lat", "min_lon", "max_lon"),
                 shape: str = "shape") -> tuple[DataFrame, DataFrame]:
    """(shape, bounds) and (place, shape): places with the same boxes share a shape, named by the least of them.

    What is aggregated over the points in the boxes of a place need be found once per shape only.
    """
    south, north, west, east = (F.col(name) for name in bounds)
    listed = boxes.filter((south <= north) & (west <= east)).groupBy(*place).agg(
        F.sort_array(F.collect_list(F.struct(*bounds))).alias("__boxes"))
    shapes = listed.groupBy("__boxes").agg(F.min(F.struct(*place)).alias(shape))
    return shapes.select(shape, F.inline("__boxes")), listed.join(shapes, "__boxes").select(*place, shape)


def nearest_centre(lat: Column | str, lon: Column | str,
                   centres: Sequence[tuple[str, float, float]] = ZONES,
                   unknown: str = UNKNOWN_ZONE) -> Column:
    """Name of the closest configured centre, the first listed on a tie; null coordinates are unknown.

    The centres are a configuration list, compiled into the expression: no join at all.
    """
    here_lat, here_lon = as_column(lat), as_column(lon)
    candidates = F.array(*[
        F.struct(squared_distance(F.lit(c_lat), F.lit(c_lon), here_lat, here_lon).alias("d"),
                 F.lit(i).alias("i"), F.lit(name).alias("name"))
        for i, (name, c_lat, c_lon) in enumerate(centres)])
    known = here_lat.isNotNull() & here_lon.isNotNull()
    return F.when(known, F.array_min(candidates)["name"]).otherwise(F.lit(unknown))


def quake_rows(messages: DataFrame, value: str = "value") -> DataFrame:
    """Flatten point features with magnitude; rows without magnitude or position are dropped."""
    shape = ("action string, data struct<id string, geometry struct<coordinates array<double>>, "
             "properties struct<unid string, mag double, time string, lastupdate string, magtype string, "
             "flynn_region string, source_id string, source_catalog string, auth string, evtype string>>")
    doc = messages.withColumn("__m", F.from_json(value, shape))
    props, spot = F.col("__m.data.properties"), F.col("__m.data.geometry.coordinates")
    iso_ms = lambda text: F.unix_millis(F.try_to_timestamp(text))
    rows = doc.select(
        F.coalesce(F.col("__m.data.id"), props["unid"]).alias("event_id"),
        F.coalesce(F.col("__m.action"), F.lit("create")).alias("action"),
        iso_ms(props["time"]).alias("ts_ms"),
        F.get(spot, 1).alias("lat"), F.get(spot, 0).alias("lon"), F.get(spot, 2).alias("depth_km"),
        props["mag"].alias("magnitude"), props["magtype"].alias("magnitude_type"),
        props["flynn_region"].alias("region"), props["source_id"].alias("source_id"),
        props["source_catalog"].alias("source_catalog"), props["auth"].alias("auth"),
        props["evtype"].alias("evtype"), iso_ms(props["lastupdate"]).alias("lastupdate_ms"))
    return rows.filter(F.col("magnitude").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())


def observation_rows(messages: DataFrame, station: str = "station_id", value: str = "value") -> DataFrame:
    """Flatten station observations; each measure may be a number or a ``{value: number}`` node."""
    measures = {"elevation_m": "elevation", "temperature_c": "temperature", "dewpoint_c": "dewpoint",
                "humidity_pct": "relativeHumidity", "wind_dir_deg": "windDirection",
                "wind_speed_kmh": "windSpeed", "wind_gust_kmh": "windGust",
                "pressure_pa": "barometricPressure", "visibility_m": "visibility",
                "precip_last_1h_mm": "precipitationLastHour"}

    def measure(node: str) -> Column:
        nested = F.get_json_object(value, f"$.properties.{node}.value")
        return F.coalesce(nested, F.get_json_object(value, f"$.properties.{node}")).try_cast("double")

    return messages.select(
        station,
        F.unix_millis(F.try_to_timestamp(F.get_json_object(value, "$.properties.timestamp"))).alias("ts_ms"),
        F.get_json_object(value, "$.geometry.coordinates[1]").try_cast("double").alias("lat"),
        F.get_json_object(value, "$.geometry.coordinates[0]").try_cast("double").alias("lon"),
        *[measure(node).alias(name) for name, node in measures.items()],
        F.get_json_object(value, "$.properties.textDescription").alias("text_description"))


def aircraft_only(df: DataFrame, kind: str = "beacon_type") -> DataFrame:
    return df.filter(F.col(kind).isin(*AIRCRAFT_BEACONS))


def message_key(*names: str) -> Column:
    """First identifier present, in order of preference."""
    return first_non_blank(*names)
