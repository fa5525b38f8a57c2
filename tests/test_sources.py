"""File, message, JDBC and layout edges."""

import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from lakeweave.plans import geo_lake
from lakeweave.session import scratch_dir, sized_for
from lakeweave.sources import files, jdbc, layout, messages


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_csv_trims_types_and_survives_bad_values(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("ID,Name,Amount\n 1 , Zoë ,2.5\n2,Bob,oops\n".encode("latin-1"))
    df = files.read_csv(spark, str(tmp_path / "a.csv"), "ID int, Name string, Amount double", trim=True,
                        encoding="ISO-8859-1", lower_names=True)
    assert collected(df, "id", "name", "amount") == [(1, "Zoë", 2.5), (2, "Bob", None)]


def test_recent_files_only(spark, tmp_path):
    for name, age in (("old", 7200), ("new", 0)):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / name))
        stamp = time.time() - age
        for path in (tmp_path / name).glob("*.parquet"):
            os.utime(path, (stamp, stamp))
    since = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 3600))
    assert files.read_recent(spark, str(tmp_path), "id bigint", since).count() == 3


def test_avro_is_optional(spark):
    assert files.lake_format(spark) == ("avro" if files.avro_available(spark) else "parquet")


def test_metadata_and_report_writers(spark, tmp_path):
    (tmp_path / "events_1.jsonl").write_text('{"id": 1}\n')
    df = files.with_source_metadata(files.read_json_lines(spark, str(tmp_path / "events_1.jsonl"), "id int"), "b1")
    assert collected(df, "id", "_source_file", "_ingestion_batch_id") == [(1, "events_1.jsonl", "b1")]
    files.write_report_csv(df.select("id"), str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("*.csv"))) == 1
    files.write_report_json(df.select("id"), str(tmp_path / "report.json"))
    assert spark.read.json(str(tmp_path / "report.json")).count() == 1


def test_jdbc_options(spark, monkeypatch):
    """What is handed to Spark's JDBC writer and reader; no database is started for the tests."""
    from pyspark.sql import DataFrameReader, DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: calls.append((k, v)) or self)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, properties: calls.append((self._df.columns, url, table, properties)))
    rows = spark.createDataFrame([(1, "a")], "customer int, name string")
    jdbc.write_jdbc(rows, "jdbc:x", "customers", "overwrite", truncate=True, columns={"customer": "ID", "name": "NAME"}, user="u")
    assert calls == [("truncate", True), ("batchsize", 1000), (["ID", "NAME"], "jdbc:x", "customers", {"user": "u"})]
    seen = {}
    monkeypatch.setattr(DataFrameReader, "option", lambda self, k, v: seen.__setitem__(k, v) or self)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: seen)
    assert jdbc.read_jdbc(spark, "jdbc:x", "SELECT 1", user="u") == {"url": "jdbc:x", "query": "SELECT 1", "user": "u"}


def test_messages_parse_reject_and_rekey(spark):
    rows = [("k", '{"a":1,"_lab_run_id":"r1"}', "t", 0, 0), ("k", "", "t", 0, 1), ("k", None, "t", 0, 2), ("k", "[1]", "t", 1, 0),
            ("k", '{"a":2,"_lab_run_id":"r2"}', "t", 1, 1)]
    topic = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")
    parsed, rejected = messages.parse_messages(topic, "a int, _lab_run_id string")
    assert collected(parsed, "a", "_kafka_partition", "_kafka_offset") == [(1, 0, 0), (2, 1, 1)] and rejected.count() == 3
    assert collected(messages.only_run(parsed, "r1"), "a") == [(1,)] and messages.only_run(parsed, None).count() == 2
    assert collected(messages.as_messages(parsed.select("a"), "a"), "key", "value") == [("1", '{"a":1}'), ("2", '{"a":2}')]


def test_daily_landing_is_idempotent_and_keeps_other_runs(spark, tmp_path):
    days = spark.createDataFrame([(1, "2024-01-01 05:00:00"), (2, "2024-01-02 06:00:00")], "id int, t string").withColumn(
        "ts", F.to_timestamp("t"))
    path = str(tmp_path / "daily")
    for _ in range(2):
        layout.land_daily(days, path, "ts", "run1")
    layout.land_daily(days.filter("id = 2").withColumn("id", F.lit(3)), path, "ts", "run2")
    assert collected(spark.read.parquet(path), "id", "day") == [(1, 1), (2, 2), (3, 2)]


def test_missing_table_is_none_but_other_errors_are_raised(spark, tmp_path):
    assert layout.table_or_none(spark, str(tmp_path / "none")) is None
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        layout.table_or_none(spark, str(bad)).count()


def test_scratch_dir_follows_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shuffle_sizing():
    assert sized_for(100 * 10**12, 8000)["spark.sql.shuffle.partitions"] == "372530"
    assert sized_for(10**9, 8)["spark.sql.shuffle.partitions"] == "16"


REGIONS = [(1, "JFK", "US", "airport", 40.55, 40.78, -73.95, -73.65, "KJFK", True, 10, False),
           (2, "Metro", "US", "metro", 40.45, 41.05, -74.30, -73.55, None, True, 10, False),
           (3, "Closed", "US", "metro", 40.0, 41.0, -75.0, -73.0, None, False, 10, False),
           (4, "Gone", "US", "metro", 40.0, 41.0, -75.0, -73.0, None, True, 10, True)]


def geo_bronze(spark):
    now = 1_780_000_000_000
    position = ("event_id string, address string, callsign string, ts_ms bigint, ingested_ms bigint, lat double, lon double, "
                "altitude_m double, ground_speed_kmh double, _arrival bigint")
    positions = [("p1", "A", None, now - 1000, now, 40.6, -73.8, 100.0, 200.0, 1), ("p1", "A", None, now - 1000, now, 40.6, -73.8, 300.0, 200.0, 2),
                 ("p2", None, "B", now - 2000, now, 40.9, -74.0, 500.0, 100.0, 3), (None, "X", None, now, now, 40.6, -73.8, 1.0, 1.0, 4),
                 ("late", "A", None, now - 86_401_001, now, 40.6, -73.8, 1.0, 1.0, 5), ("edge", "C", None, now - 86_401_000, now, 40.6, -73.8, 1.0, 1.0, 6)]
    observation = ("event_id string, station_id string, ts_ms bigint, ingested_ms bigint, lat double, lon double, temperature_c double, humidity_pct double, "
                   "wind_speed_kmh double, wind_gust_kmh double, wind_dir_deg double, pressure_pa double, visibility_m double, precip_last_1h_mm double, "
                   "text_description string, _arrival bigint")
    observations = [(f"o{i}", s, now - age, now, 40.0, -73.0, float(i), *[1.0] * 7, "clear", i)
                    for i, (s, age) in enumerate([("KJFK", 5), ("KJFK", 0), ("EGLL", 3), ("EGLL", 3)])]
    quake = "event_id string, ts_ms bigint, ingested_ms bigint, lat double, lon double, magnitude double, depth_km double, region string, _arrival bigint"
    quakes = [("q1", now - 10, now, 40.6, -73.8, 6.0, 5.0, "NY", 1), ("q2", now - 20, now, 40.6, -73.8, 4.0, 5.0, None, 2),
              ("q3", now - 30, now, 40.9, -74.0, 7.0, 5.0, "NY", 3)]
    region = ("region_id int, name string, country string, kind string, min_lat double, max_lat double, min_lon double, max_lon double, "
              "station_code string, is_active boolean, __ts_ms bigint, __deleted boolean")
    threshold = "threshold_id int, source string, metric string, op string, threshold double, severity string, is_active boolean, __ts_ms bigint"
    thresholds = [(1, "seismic", "magnitude", ">=", 5.5, "warning", True, 1), (2, "seismic", "magnitude", "<=", 1.0, "info", True, 1)]
    watch = "watchlist_id int, region_id int, source string, recipient string, is_active boolean, __ts_ms bigint"
    watchlist = [(1, 1, "seismic", "a@x", True, 1), (2, 1, "*", "b@x", True, 1), (3, 2, "noaa", "c@x", True, 1), (4, 2, "*", "d@x", False, 1)]
    arrive = lambda df: df.withColumn("_arrival", F.lit(1))
    return now, {
        "ogn_positions": spark.createDataFrame(positions, position),
        "noaa_observations": spark.createDataFrame(observations, observation),
        "seismic_events": spark.createDataFrame(quakes, quake),
        "regions": arrive(spark.createDataFrame(REGIONS, region)),
        "alert_thresholds": arrive(spark.createDataFrame(thresholds, threshold)),
        "subscriber_watchlist": arrive(spark.createDataFrame(watchlist, watch)),
        "noaa_alerts": spark.createDataFrame([("x", 1)], "wrong_column string, _arrival bigint"),
    }


def test_geo_lake_end_to_end(spark, tmp_path):
    now, bronze = geo_bronze(spark)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    outcome = dict(collected(geo_lake.build_silver(spark, bronze, silver, "2026-05-28 20:00:00"), "entity", "status"))
    assert outcome.pop("noaa_alerts") == "failed" and set(outcome.values()) == {"ok"}
    metrics = spark.read.parquet(f"{silver}/_quality/ogn_positions").first()
    assert (metrics["rows_in"], metrics["rows_out"], metrics["late_dropped"], metrics["dedup_dropped"]) == (6, 3, 1, 2)
    geo_lake.build_silver(spark, bronze, silver, "2026-05-28 21:00:00")  # same day again
    assert geo_lake.silver_table(spark, silver, "ogn_positions").count() == 3
    assert collected(geo_lake.silver_table(spark, silver, "regions"), "region_id") == [(1,), (2,), (3,)]

    done = dict(collected(geo_lake.build_gold(spark, silver, gold, F.lit(now), "s1"), "mart", "status"))
    assert set(done.values()) == {"ok"}
    latest = lambda mart: layout.read_latest(spark, f"{gold}/{mart}")
    assert collected(latest("aircraft_density_by_region"), "region", "positions_last_1h", "unique_aircraft", "max_altitude_m") == [
        ("JFK", 1, 1, 300.0), ("Metro", 2, 2, 500.0)]
    assert collected(latest("weather_snapshot"), "station_id", "region", "temperature_c") == [
        ("EGLL", None, 2.0), ("EGLL", None, 3.0), ("KJFK", "JFK", 1.0)]
    assert collected(latest("seismic_24h_summary"), "region", "mag_bucket", "events") == [
        ("NY", "5.5-6.5", 1), ("NY", "6.5+", 1), ("Unknown", "3-4.5", 1)]
    assert collected(latest("region_alert_correlation"), "region", "quake_count_24h", "max_magnitude", "subscribers_notified", "avg_magnitude") == [
        ("JFK", 1, 6.0, 2, 6.0), ("Metro", 2, 7.0, 0, 6.5)]
    checks = dict(collected(geo_lake.check_silver(spark, silver, F.lit(now + 700_000)), "rule", "status"))
    assert checks["seismic.freshness"] == "FAIL" and checks["noaa.freshness"] == "PASS" and checks["config.regions_active_min"] == "FAIL"


def test_marts_read_only_runs_that_reach_their_horizon(spark, tmp_path):
    """Run folders older than the horizon are not scanned; runs without a note are; results stay those of the whole table."""
    now, bronze = geo_bronze(spark)
    silver, hour = str(tmp_path / "silver"), 3_600_000
    names = ["2026-05-26 20:00:00", "2026-05-27 20:00:00", "2026-05-28 20:00:00"]
    for back, loaded_at in zip((48, 30, 0), names):  # the same quakes again, each time as other, later events
        moved = bronze["seismic_events"].withColumns({"ts_ms": F.col("ts_ms") - back * hour,
                                                      "event_id": F.when(F.lit(back == 30), F.col("event_id")).otherwise(F.concat("event_id", F.lit(f"-{back}")))})
        geo_lake.build_silver(spark, {"seismic_events": moved, "regions": bronze["regions"]}, silver, loaded_at)

    def scanned(hours):
        """Runs left by the partition filter of the scan, and the table."""
        table = geo_lake.silver_table(spark, silver, "seismic_events", F.lit(now - hours * hour))
        filters = re.search(r"PartitionFilters: \[(.*?)\]", table._jdf.queryExecution().executedPlan().toString())[1]
        return [run for run in runs if run not in filters], table

    runs = ["20260526200000", "20260527200000", "20260528200000"]
    assert [scanned(h)[0] for h in (24, 31, 60)] == [runs[2:], runs[1:], runs]
    whole = geo_lake.silver_table(spark, silver, "seismic_events")
    for hours in (24, 31, 60):
        recent = F.col("ts_ms") >= now - hours * hour
        assert collected(scanned(hours)[1].filter(recent), "event_id", "ts_ms") == collected(whole.filter(recent), "event_id", "ts_ms")
    marts = geo_lake.marts(spark, silver, F.lit(now))
    assert runs[0] in marts["seismic_24h_summary"]()._jdf.queryExecution().executedPlan().toString()
    assert collected(marts["seismic_24h_summary"](), "region", "events") == [("NY", 1), ("NY", 1), ("Unknown", 1)]
    geo_lake.land_daily(whole.filter("event_id = 'q1-0'").drop("year", "month", "day", "run"), f"{silver}/seismic_events",
                        F.lit("2026-05-20 20:00:00").cast("timestamp"), "unnoted")
    assert {r.run for r in scanned(24)[1].select("run").distinct().collect()} == {"unnoted", runs[2]}


def test_gold_publishes_whole_marts(spark, tmp_path):
    now, bronze = geo_bronze(spark)
    silver, one = str(tmp_path / "silver"), bronze["noaa_observations"].where("station_id = 'KJFK'").limit(1)
    stations = one.drop("event_id", "station_id").crossJoin(spark.range(600).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.concat(F.lit("S"), "id").alias("station_id"))).select(one.columns)
    geo_lake.build_silver(spark, {"noaa_observations": stations, "regions": bronze["regions"]}, silver, "2026-05-28 20:00:00")
    for limit, rows in ((None, 600), (7, 7)):
        gold = str(tmp_path / f"gold{limit}")
        geo_lake.build_gold(spark, silver, gold, F.lit(now), "s1", limit=limit)
        assert layout.read_latest(spark, f"{gold}/weather_snapshot").count() == rows


def test_correlation_average_is_weighted_like_the_join(spark):
    """Two regions of one name, two watchers on one of them: the mean weighs pairs as the join would."""
    regions = spark.createDataFrame([(1, "R", "C", 0.0, 1.0, 0.0, 1.0, True), (2, "R", "C", 2.0, 3.0, 0.0, 1.0, True)],
                                    "region_id int, name string, country string, min_lat double, max_lat double, min_lon double, max_lon double, is_active boolean")
    quakes = spark.createDataFrame([("a", 0.5, 0.5, 6.0, 10), ("b", 2.5, 0.5, 8.0, 10)], "event_id string, lat double, lon double, magnitude double, ts_ms bigint")
    watch = spark.createDataFrame([(1, "*", "x", True), (1, "seismic", "y", True)], "region_id int, source string, recipient string, is_active boolean")
    none = spark.createDataFrame([], "source string, metric string, op string, threshold double, is_active boolean")
    row = geo_lake.alert_correlation(quakes, regions, none, watch, F.lit(10)).first()
    assert (row["quake_count_24h"], row["subscribers_notified"]) == (2, 2) and abs(row["avg_magnitude"] - (6 + 6 + 8) / 3) < 1e-9


def test_run_log_and_inventory(spark, tmp_path):
    import datetime

    layout.log_run(spark, str(tmp_path / "log"), [("r", "p", "bronze", "t", 5, "success", datetime.datetime(2024, 1, 1))])
    layout.log_run(spark, str(tmp_path / "log"), [("r2", "p", "bronze", "t", 6, "success", datetime.datetime(2024, 1, 2))])
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    (tmp_path / "a.csv").write_text("x\n1\n2\n")
    found = layout.source_inventory(spark, {"a": ("csv", str(tmp_path / "a.csv")), "b": ("csv", str(tmp_path / "b.csv"))})
    assert collected(found, "source", "exists", "row_count") == [("a", True, 2), ("b", False, 0)]
    assert json.dumps(found.columns) == '["source", "exists", "row_count"]'


def test_bronze_read_to_silver(spark, tmp_path):
    """Two loads of a key with equal times: the later file wins."""
    schema = "event_id string, ts_ms bigint, ingested_ms bigint, magnitude double"
    for i, magnitude in enumerate((1.0, 2.0)):
        spark.createDataFrame([("q", 10, 10, magnitude)], schema).coalesce(1).write.parquet(str(tmp_path / "bronze" / "seismic_events" / str(i)))
        for path in (tmp_path / "bronze" / "seismic_events" / str(i)).glob("*.parquet"):
            os.utime(path, (time.time() - 60 + i, time.time() - 60 + i))
    bronze = geo_lake.read_bronze(spark, str(tmp_path / "bronze"), {"seismic_events": schema}, "2020-01-01T00:00:00", "parquet")
    geo_lake.build_silver(spark, bronze, str(tmp_path / "silver"), "2026-01-01 00:00:00")
    assert collected(geo_lake.silver_table(spark, str(tmp_path / "silver"), "seismic_events"), "event_id", "magnitude") == [("q", 2.0)]


def test_unreadable_files_fail_or_are_listed(spark, tmp_path):
    from pyspark.errors import PySparkException

    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 not really PAR1")
    since = "2020-01-01T00:00:00"
    with pytest.raises((PySparkException, Exception)):
        files.read_recent(spark, str(tmp_path), "id bigint", since).count()
    rows = files.read_recent(spark, str(tmp_path), "id bigint", since, skip_unreadable=True)
    assert rows.count() == 3
    unread = [r.path for r in files.unread_files(spark, str(tmp_path), rows, since).collect() if r.path.endswith(".parquet")]
    assert [p.rsplit("/", 1)[1] for p in unread] == ["bad.parquet"]


def test_snapshots_are_published_without_touching_older_ones(spark, tmp_path):
    path = str(tmp_path / "mart")
    layout.write_snapshot(spark.range(2), path, "s1")
    held = layout.read_latest(spark, path)
    layout.write_snapshot(spark.range(5), path, "s2")
    assert held.count() == 2 and layout.read_latest(spark, path).count() == 5


def test_density_of_places_that_share_boxes(spark):
    """Places of two overlapping boxes, equal boxes, a null name and no aircraft at all, as a whole and as the first rows of the report."""
    bounds = {"a": [(0, 4, 0, 4), (2, 6, 2, 6)], "b": [(2, 6, 2, 6), (0, 4, 0, 4)], None: [(0, 4, 0, 4)], "empty": [(50, 51, 0, 1)], "mute": [(9, 9, 9, 9)]}
    regions = spark.createDataFrame([(name, "c", "k", True, *map(float, box)) for name, boxes in bounds.items() for box in boxes],
                                    "name string, country string, kind string, is_active boolean, min_lat double, max_lat double, min_lon double, max_lon double")
    rows = [(float(i % 7), float(i % 5), i, i * 3 % 11, f"p{i % 13}") for i in range(200)] + [(9.0, 9.0, 5, None, None)]
    seen = spark.createDataFrame([(*row, None, 1.0) for row in rows],
                                 "lat double, lon double, ts_ms long, altitude_m long, address string, callsign string, ground_speed_kmh double")
    want = []
    for name, boxes in bounds.items():
        met = [r for s, n, w, e in boxes for r in rows if s <= r[0] <= n and w <= r[1] <= e]
        heights = [r[3] for r in met if r[3] is not None]
        if met:
            want.append((-len(met), name or "", len({r[4] for r in met} - {None}), sum(heights) / len(heights) if heights else None,
                         max(heights, default=None), max(r[2] for r in met)))
    want.sort(key=lambda r: r[:2])
    for limit in (None, 2):
        mart = geo_lake.aircraft_density(seen, regions, F.lit(200), 200, limit)
        got = [(-r.positions_last_1h, r.region or "", r.unique_aircraft, r.avg_altitude_m, r.max_altitude_m, r.last_seen_ms) for r in mart.collect()]
        assert got == want[:limit]
        assert mart.inputFiles() and "density" in mart.inputFiles()[0]
