"""Streaming jobs over several files, compared with their batch form, and repeated runs."""

import json
import random
import os

import pytest
from pyspark.sql import functions as F

from lakeweave.operators import quality
from lakeweave.plans import rides as ride_plans
from lakeweave.sources import messages
from lakeweave.streaming import alarms, flows, ledger, lookups, rides, sinks, trails


def in_order(folder):
    """Give the files of a stream source rising modification times, the order in which they are read."""
    for i, path in enumerate(sorted(folder.iterdir())):
        os.utime(path, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def trip(i, second, zone="MIDTOWN", driver="d1", fare=10.0, miles=2.0, **extra):
    return {"trip_id": f"t{i}", "driver_id": driver, "pickup_zone": zone, "fare_amount": fare, "distance_miles": miles, "total_amount": fare + 2,
            "passenger_count": 1, "payment_type": "cash", "pickup_lat": 40.7, "pickup_lon": -74.0,
            "pickup_time": f"2026-06-01T10:{second // 60:02d}:{second % 60:02d}Z", "surge_multiplier": 1.0} | extra


BATCHES = [
    [trip(1, 0), trip(2, 30, fare=-4.0), trip(3, 61, zone="HARLEM"), trip(4, 70, driver=None)],
    [trip(5, 100, miles=9999.0), trip(6, 110, driver="d2"), trip(7, 130, surge_multiplier=2.0), trip(8, 140, _corruption="neg_fare")],
    [trip(9, 1500, driver="d2"), trip(10, 3000, driver="d9")],
]


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "trips"
    source.mkdir()
    for i, batch in enumerate(BATCHES):
        (source / f"{i}.json").write_text("".join(json.dumps(t) + "\n" for t in batch))
    in_order(source)
    return source


def trip_stream(spark, folder):
    stream = spark.readStream.schema(ride_plans.TRIP).option("maxFilesPerTrigger", 1).json(str(folder))
    return stream.withColumn("ts", F.try_to_timestamp("pickup_time"))


def trip_table(spark, folder):
    return spark.read.schema(ride_plans.TRIP).json(str(folder)).withColumn("ts", F.try_to_timestamp("pickup_time"))


def test_route_then_validate_then_replay(spark, folder, tmp_path):
    clean, dead = str(tmp_path / "clean"), str(tmp_path / "dead")
    sinks.finish(rides.route(trip_stream(spark, folder), clean, dead), str(tmp_path / "c1"))
    letters = spark.read.parquet(dead)
    assert collected(letters, "trip_id", "_dlq_reason") == [("t2", "negative_fare"), ("t4", "missing_driver_id"), ("t5", "distance_out_of_range"), ("t8", "neg_fare")]
    assert collected(spark.read.parquet(clean), "trip_id") == [("t1",), ("t10",), ("t3",), ("t6",), ("t7",), ("t9",)]
    sinks.finish(rides.route(trip_stream(spark, folder), clean, dead), str(tmp_path / "c1"))  # nothing new
    assert spark.read.parquet(clean).count() == 6
    again = flows.replay_dead_letters(letters.drop("batch_id"))
    assert "_corruption" not in again.columns and collected(again, "trip_id") == [("t2",), ("t4",), ("t5",), ("t8",)]
    good, bad = ride_plans.route(again.withColumn("_corruption", F.lit(None).cast("string")))
    assert collected(good, "trip_id") == [("t8",)] and bad.count() == 3


def test_validate_matches_batch(spark, folder, tmp_path):
    out = [str(tmp_path / n) for n in ("dead", "counts", "scores")]
    sinks.finish(rides.validate(trip_stream(spark, folder), *out), str(tmp_path / "c"))
    counts = spark.read.parquet(out[1]).groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    expected = quality.rule_counts(trip_table(spark, folder), quality.ride_expectations())
    assert collected(counts, "rule", "passed", "failed") == collected(expected, "rule", "passed", "failed")
    assert spark.read.parquet(out[2]).count() == 3


def test_windows_match_batch_for_closed_windows(spark, folder, tmp_path):
    for hopping, batch_form, measure in ((False, ride_plans.revenue_per_minute, "revenue"), (True, ride_plans.revenue_hopping, "revenue_5m")):
        out = str(tmp_path / f"w{hopping}")
        sinks.finish(rides.windows(trip_stream(spark, folder), "ts", out, "10 minutes", hopping), str(tmp_path / f"c{hopping}"))
        watermark = F.lit("2026-06-01 10:40:00").cast("timestamp")  # newest trip minus ten minutes
        closed = batch_form(trip_table(spark, folder), "ts").filter(F.col("window_end") <= watermark)
        columns = ["window_start", "pickup_zone", measure]
        assert collected(spark.read.parquet(out), *columns) == collected(closed, *columns)


def test_shifts_match_batch_for_closed_sessions(spark, folder, tmp_path):
    out = str(tmp_path / "shifts")
    sinks.finish(rides.shifts(trip_stream(spark, folder), "ts", out, "5 minutes"), str(tmp_path / "c"))
    columns = ["driver_id", "shift_start", "shift_end", "trips_in_shift", "shift_earnings"]
    closed = ride_plans.shifts(trip_table(spark, folder), "ts").filter("shift_end + INTERVAL 10 MINUTES <= TIMESTAMP '2026-06-01 10:45:00'")
    assert collected(spark.read.parquet(out).filter("driver_id IS NOT NULL"), *columns) == collected(closed, *columns)
    earners = ride_plans.top_earners(spark.read.parquet(out).filter("driver_id IS NOT NULL"), 1)
    assert earners.count() == 1


def test_driver_table_and_enrichment(spark, folder, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    driver = lambda name, **extra: json.dumps({"full_name": name, "rating": 4.5, "vehicle_year": 2020, "vehicle_make": "T", "vehicle_model": "Y"} | extra)
    rows = [("d1", driver("Old"), 0), ("d2", driver("Two"), 1), ("d1", driver("New", rating=None), 2), ("d3", driver("Three"), 3), ("d3", None, 4)]
    for i, (key, value, offset) in enumerate(rows):
        message = {"key": key, "value": value, "topic": "drivers", "partition": 0, "offset": offset}
        (log / f"{i}.json").write_text(json.dumps(message) + "\n")
    in_order(log)
    drivers = str(tmp_path / "drivers")
    sinks.finish(rides.driver_table(messages.stream_message_files(spark, str(log), 2), drivers), str(tmp_path / "c1"))
    assert collected(rides.current_drivers(spark, drivers), "driver_id", "full_name") == [("d1", "New"), ("d2", "Two")]
    out, misses = str(tmp_path / "enriched"), str(tmp_path / "misses")
    sinks.finish(rides.enrich(trip_stream(spark, folder).filter("driver_id IS NOT NULL"), drivers, out, misses), str(tmp_path / "c2"))
    got = spark.read.parquet(out)
    assert got.count() == 8 and collected(got.filter("driver_id = 'd1'").select("driver_name", "driver_rating", "vehicle").distinct(),
                                          "driver_name", "driver_rating", "vehicle") == [("New", None, "2020 T Y")]
    unknown = spark.read.parquet(misses)
    assert unknown.columns == ["driver_id", "trips", "batch_id"] and unknown.agg(F.sum("trips")).first()[0] == 1


def test_table_in_state_follows_its_changelog(spark, tmp_path):
    """Trips of three batches meet a table that changes between them; removals, late and broken messages, keys of all kinds."""
    trips, log = tmp_path / "trips", tmp_path / "log"
    trips.mkdir(), log.mkdir()
    row = lambda name, **extra: json.dumps({"full_name": name, "rating": 4.5, "vehicle_year": 2020} | extra)
    message = lambda key, value, offset, partition=0: json.dumps({"key": key, "value": value, "partition": partition, "offset": offset}) + "\n"
    base = spark.createDataFrame([("a", row("A0"), 0, 1), ("b", row("B0"), 0, 2), ("gone", None, 0, 9)],
                                 "key string, value string, partition int, offset bigint")
    changes = [message("a", row("A1"), 5) + message("a", row("A older"), 4) + message("c", row("C0", rating=None), 6) + message("b", "not json", 7),
               message("b", None, 8) + message("b", row("B older"), 3) + message('{"driver_id": "d"}', row("D0"), 10),
               message(None, row("E0", driver_id="e"), 11) + message("gone", row("late"), 4) + message(None, None, 12)]
    big = 9_007_199_254_740_993
    asked = [["a", "b", "c", "gone", None], ["a", "b", "b", "c", "x", "d"], ["a", "b", "e", "gone", "x", None]]
    for i in range(3):
        (log / f"{i}.json").write_text(changes[i])
        (trips / f"{i}.json").write_text("".join(json.dumps({"driver_id": d, "n": big + i, "at": f"2025-01-0{i + 1}T00:00:00.000123Z"}) + "\n" for d in asked[i]))
    in_order(log), in_order(trips)
    out, misses = str(tmp_path / "enriched"), str(tmp_path / "misses")
    read = spark.readStream.option("maxFilesPerTrigger", 1)
    for salts in (1, 3):
        stream = read.schema("driver_id string, n bigint, at timestamp").json(str(trips))
        changed = read.schema("key string, value string, partition int, offset bigint").json(str(log))
        sinks.finish(rides.enrich_in_state(stream, changed, f"{out}{salts}", f"{misses}{salts}", base=base, salts=salts), str(tmp_path / f"c{salts}"))
        got = spark.read.parquet(f"{out}{salts}")
        assert collected(got, "batch_id", "driver_id", "driver_name", "n") == [
            (0, "a", "A1", big), (0, "b", "B0", big), (0, "c", "C0", big), (1, "a", "A1", big + 1), (1, "c", "C0", big + 1), (1, "d", "D0", big + 1),
            (2, "a", "A1", big + 2), (2, "e", "E0", big + 2)]
        assert got.filter("date_format(at, 'SSSSSS') <> '000123'").count() == 0
        assert collected(got.filter("driver_id = 'c' AND batch_id = 0"), "driver_rating", "vehicle") == [(None, "2020 None None")]
        unknown = spark.read.parquet(f"{misses}{salts}")
        assert sorted(map(tuple, unknown.select("batch_id", "driver_id", "trips").collect()), key=repr) == sorted([
            (0, "gone", 1), (0, None, 1), (1, "b", 2), (1, "x", 1), (2, "b", 1), (2, "gone", 1), (2, "x", 1), (2, None, 1)], key=repr)


def silent_steps(times, mark, pending, firing):
    out, times = [], sorted(set(times))
    for i, t in enumerate(times):
        following = times[i + 1] if i + 1 < len(times) else None
        for after, name in ((pending, "pending"), (firing, "firing")):
            if t + after < mark and (following is None or t + after < following):
                out.append((name, t + after))
        if following is not None and following - t > pending and following <= mark:
            out.append(("resolved", following))
    return out


@pytest.mark.parametrize("files", [1, 4])
def test_silence_is_told_once_however_results_arrive(spark, tmp_path, files):
    """Gaps of all sizes, rows out of order within the delay, rules that never come back, in one or several batches."""
    rng, source = random.Random(11), tmp_path / "results"
    source.mkdir()
    times = {f"r{k}": sorted(rng.sample(range(0, 4000), 25) + [100 + 60, 100]) for k in range(6)} | {"once": [5], "end": [3990]}
    rows = sorted(((t, rule) for rule, own in times.items() for t in own), key=lambda r: r[0] + rng.random() * 20)
    rows += [(4200, "last"), (4200, None)]
    size = -(-len(rows) // files)
    for i in range(files):
        (source / f"{i}.json").write_text("".join(json.dumps({"rule": r, "s": t}) + "\n" for t, r in rows[i * size:(i + 1) * size]))
    in_order(source)
    stream = spark.readStream.schema("rule string, s bigint").option("maxFilesPerTrigger", 1).json(str(source))
    steps = alarms.silence_alarms(stream.withColumn("ts", F.timestamp_seconds("s")), "rule", "ts", 60, 200, "30 seconds")
    sinks.finish(sinks.file_writer(steps, str(tmp_path / "out")), str(tmp_path / "c"))
    got = sorted((r.rule, r.state, r.at) for r in spark.read.parquet(str(tmp_path / "out")).select("rule", "state", F.unix_seconds("at").alias("at")).collect())
    assert got == sorted((rule, name, at) for rule, own in times.items() for name, at in silent_steps(own, 4170, 60, 200))
    assert ("once", "firing", 205) in got and {name for _, name, _ in got} == {"pending", "firing", "resolved"}


def test_trail_state_across_batches_and_expiry(spark, tmp_path):
    source = tmp_path / "pos"
    source.mkdir()
    point = lambda key, s, lat=1.0: json.dumps({"key": key, "s": s, "lat": lat, "lon": 2.0}) + "\n"
    (source / "0.json").write_text("".join(point("a", s) for s in (30, 10, 20)) + point("b", 5) + json.dumps({"key": "n", "s": 1}) + "\n")
    (source / "1.json").write_text(point("a", 40, 9.0) + point("a", 35))
    (source / "2.json").write_text(point("c", 5000))
    in_order(source)
    stream = spark.readStream.schema("key string, s bigint, lat double, lon double").option("maxFilesPerTrigger", 1).json(str(source))
    stream = stream.select("key", "lat", "lon", (F.col("s") * 1000).alias("ts_ms"), F.timestamp_seconds("s").alias("ts"))
    out = str(tmp_path / "out")
    writer = sinks.file_writer(trails.track(stream, "key", "ts", limit=4), out)
    sinks.finish(writer, str(tmp_path / "c"))
    rows = spark.read.parquet(out)
    assert collected(rows.filter("key = 'a' AND status = 'active'"), "ts_ms", "lat", "points") == [(30000, 1.0, 3), (40000, 9.0, 4)]
    assert collected(rows.filter("status = 'gone'"), "key", "points") == [("a", 4), ("b", 1)]
    last = rows.filter("key = 'a' AND ts_ms = 40000 AND status = 'active'").first()
    assert last["trail_ms"] == [20000, 30000, 35000, 40000]


def test_message_upsert_and_insert_only(spark, tmp_path):
    source = tmp_path / "topic"
    source.mkdir()
    message = lambda o, s, a, offset: json.dumps({"key": "k", "value": json.dumps({"order_id": o, "status": s, "amount": a}), "topic": "t",
                                                  "partition": 0, "offset": offset}) + "\n"
    (source / "0.json").write_text(message(1, "NEW", 5.0, 0) + message(1, "PAID", 6.0, 1) + message(2, "NEW", 7.0, 2) + message(None, "X", 1.0, 3))
    (source / "1.json").write_text(message(2, "SHIPPED", 8.0, 4) + message(3, "NEW", 9.0, 5))
    in_order(source)
    for insert_only, expected in ((False, [(1, "PAID", 6.0), (2, "SHIPPED", 8.0), (3, "NEW", 9.0)]), (True, [(1, "PAID", 6.0), (2, "NEW", 7.0), (3, "NEW", 9.0)])):
        base = tmp_path / str(insert_only)
        writer = flows.upsert_messages(messages.stream_message_files(spark, str(source), 1), "order_id bigint, status string, amount double", ["order_id"],
                                       ["status", "amount"], str(base / "bronze"), str(base / "silver"), insert_only)
        sinks.finish(writer, str(base / "c"))
        fold = flows.message_fold(["order_id"], ["status", "amount"], insert_only)
        assert collected(sinks.read_folded(spark, str(base / "silver"), fold), "order_id", "status", "amount") == expected
        assert spark.read.parquet(str(base / "bronze")).count() == 6


@pytest.mark.parametrize("compact_every", [1, 2, 3, 100])
def test_keyed_table_folds_batches_in_any_compaction(spark, tmp_path, compact_every):
    """Upserts over seven batches, some repeated as after a failure, against a dictionary."""
    table, fold, state = str(tmp_path / "t"), sinks.fold_upsert(["k"], ["v"]), {}
    for batch in range(7):
        rows = [(k, f"made in {batch}", k * 100 + batch) for k in range(batch % 3, 6, 2)]
        for k, note, v in rows:
            state[k] = (state.get(k, (note,))[0], v)
        df = spark.createDataFrame(rows, "k int, note string, v int")
        for _ in range(1 + batch % 2):
            sinks.add_delta(df, table, batch, fold, compact_every)
        got = {r["k"]: (r["note"], r["v"]) for r in sinks.read_folded(spark, table, fold).collect()}
        assert got == state


def test_trail_table_keeps_last_n(spark, tmp_path):
    table, fold = str(tmp_path / "t"), sinks.fold_latest(["k"], ["ts"], 3)
    for batch in range(4):
        df = spark.createDataFrame([(k, batch * 10 + i) for k in ("a", "b") for i in range(2)], "k string, ts int")
        sinks.add_delta(fold(df), table, batch, fold, 2)
    assert collected(sinks.read_folded(spark, table, fold), "k", "ts") == [(k, t) for k in ("a", "b") for t in (21, 30, 31)]
    assert sinks.read_folded(spark, str(tmp_path / "nothing"), fold) is None


def test_repeated_batch_changes_nothing(spark, tmp_path):
    for _ in range(2):
        sinks.put_batch(spark.range(4), str(tmp_path / "batches"), 7)
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 4


def test_late_rows_fall_behind_the_newest_row_so_far(spark, tmp_path):
    """The newest time is carried across batches and runs, the boundary is kept, a repeated batch changes nothing."""
    source, paths = tmp_path / "rows", [str(tmp_path / name) for name in ("kept", "late", "marks")]
    source.mkdir()
    batches = [[100, 90, 40], [95, 50, 49, None], [200, 100, 99], [60, 190]]

    def run():
        stream = spark.readStream.schema("t bigint").option("maxFilesPerTrigger", 1).json(str(source))
        sinks.finish(flows.split_late(stream, "t", *paths, horizon=50), str(tmp_path / "c"))

    for i, times in enumerate(batches):
        (source / f"{i}.json").write_text("".join(json.dumps({"t": t}) + "\n" for t in times))
        in_order(source)
        if i != 1:
            run()
    newest, kept, late = 0, [], []
    for i, times in enumerate(batches):
        newest = max(newest, *[t or 0 for t in times])
        for t in times:
            (kept if (t or 0) >= newest - 50 else late).append((i, t))
    got = [sorted(map(tuple, spark.read.parquet(p).select("batch_id", "t").collect()), key=repr) for p in paths[:2]]
    assert got == [sorted(kept, key=repr), sorted(late, key=repr)]


def test_events_are_acted_on_once(spark, tmp_path):
    """Repeated ids within and across batches and over compactions; a batch whose action fails notes nothing and is taken again."""
    source, log, acted = tmp_path / "inbox", str(tmp_path / "log"), []
    source.mkdir()
    failing = set()

    def action(rows, batch_id):
        acted.append((batch_id, sorted(r.id for r in rows.collect())))
        if batch_id in failing:
            raise OSError("endpoint is unavailable")

    def run():
        stream = spark.readStream.schema("id string").option("maxFilesPerTrigger", 1).json(str(source))
        sinks.finish(ledger.act_once(stream, "id", F.concat(F.lit("Notify "), "id"), log, action, buckets=4, compact_every=3), str(tmp_path / "c"))

    batches = [["e1", "e2", "e1"], ["e2", "e3"], [], ["e1", "e4"], ["e5"], ["e3", "e5", "e6"], ["e6", "e1", "e7"]]
    for i, ids in enumerate(batches):
        (source / f"{i}.json").write_text("".join(json.dumps({"id": e}) + "\n" for e in [*ids, None]))
    in_order(source)
    failing.add(3)
    with pytest.raises(Exception, match="unavailable"):
        run()
    assert collected(ledger.handled(spark, log), "id", "batch_id") == [("e1", 0), ("e2", 0), ("e3", 1)]
    failing.clear()
    run()
    assert collected(ledger.handled(spark, log), "id", "notice", "batch_id") == [
        (e, f"Notify {e}", b) for e, b in [("e1", 0), ("e2", 0), ("e3", 1), ("e4", 3), ("e5", 4), ("e6", 5), ("e7", 6)]]
    assert acted == [(0, ["e1", "e2"]), (1, ["e3"]), (3, ["e4"]), (3, ["e4"]), (4, ["e5"]), (5, ["e6"]), (6, ["e7"])]


def test_a_batch_opens_its_own_buckets_only(spark, tmp_path):
    """What a batch looks up does not grow with the history: one base and the deltas of its epoch, in its buckets."""
    source, log = tmp_path / "inbox", str(tmp_path / "log")
    source.mkdir()
    for i in range(12):
        (source / f"{i:02}.json").write_text("".join(json.dumps({"id": f"e{k}"}) + "\n" for k in range(i * 20, i * 20 + 40)))
    in_order(source)
    stream = spark.readStream.schema("id string").option("maxFilesPerTrigger", 1).json(str(source))
    sinks.finish(ledger.act_once(stream, "id", F.col("id"), log, buckets=4, compact_every=4), str(tmp_path / "c"))
    seen = ledger.handled(spark, log, 3, [2])
    assert {name.split("bucket=")[0].rsplit("/", 2)[-2] for name in seen.inputFiles()} == {"version=2"}
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and ledger.handled(spark, log).count() == 260
    assert ledger.handled(spark, log, 1, [2]).filter("batch_id >= 8").count() == 0
    for epoch in range(1, 3):  # a batch of an epoch finds one base file and a file per batch of the epoch in its bucket
        folders = [tmp_path / f"log/base/version={epoch - 1}/bucket=2", tmp_path / f"log/delta/epoch={epoch}/bucket=2"]
        assert [len(list(f.rglob("*.parquet"))) for f in folders] == [1, 4]


def test_surge_stream(spark, tmp_path):
    pings = tmp_path / "pings"
    pings.mkdir()
    ping = lambda d, state, s, lat=40.7580, lon=-73.9855: json.dumps({"driver_id": d, "lat": lat, "lon": lon, "state": state, "ts": f"2026-06-01T10:00:{s:02d}Z"}) + "\n"
    # d1 is idle at TIMES_SQUARE and then seen idle at JFK: it stays counted in both zones
    (pings / "0.json").write_text(ping("d1", "IDLE", 1) + ping("d2", "IDLE", 2) + ping("d1", "IDLE", 5, 40.6413, -73.7781))
    (pings / "1.json").write_text(ping("d2", "ON_TRIP", 9))
    in_order(pings)
    stream = spark.readStream.schema(ride_plans.PING).option("maxFilesPerTrigger", 1).json(str(pings))
    stream = stream.withColumn("ts_us", F.unix_micros(F.try_to_timestamp("ts")))
    supply, out = str(tmp_path / "supply"), str(tmp_path / "surge")
    sinks.finish(rides.supply_table(stream, supply), str(tmp_path / "c1"))
    assert collected(rides.idle_supply(spark, supply), "zone", "idle") == [("JFK_AIRPORT", 1), ("TIMES_SQUARE", 1)]
    source = tmp_path / "trips"
    source.mkdir()
    (source / "0.json").write_text("".join(json.dumps(trip(i, 5, zone)) + "\n" for i, zone in enumerate(["TIMES_SQUARE"] * 2 + ["HARLEM"])))
    sinks.finish(rides.surge(trip_stream(spark, source), "ts", supply, out), str(tmp_path / "c2"))
    got = spark.read.parquet(out).filter("window_ts = TIMESTAMP '2026-06-01 10:01:00'")
    assert collected(got, "zone", "trips_per_min", "idle_drivers", "surge_multiplier") == [("HARLEM", 1, 0, 3.0), ("TIMES_SQUARE", 2, 1, 2.0)]


def test_hourly_landing_stream(spark, folder, tmp_path):
    out = str(tmp_path / "landing")
    sinks.finish(flows.land(trip_stream(spark, folder), "ts", out), str(tmp_path / "c"))
    assert collected(spark.read.parquet(out).groupBy("year", "month", "day", "hour").count(), "hour", "count") == [(10, 10)]


def test_running_state_and_dedup(spark, folder, tmp_path):
    out = str(tmp_path / "unique")
    unique = flows.distinct_within(trip_stream(spark, folder), ["pickup_zone"], "ts", "2 hours")
    sinks.finish(sinks.file_writer(unique, out), str(tmp_path / "c1"))
    assert collected(spark.read.parquet(out), "pickup_zone") == [("HARLEM",), ("MIDTOWN",)]
    totals = str(tmp_path / "totals")
    frame = flows.running_state(trip_stream(spark, folder), ["pickup_zone"], {"revenue": F.col("total_amount")})
    sinks.finish(sinks.per_batch(frame, lambda b, i: sinks.put_batch(b, totals, i)).outputMode("update"), str(tmp_path / "c2"))
    stored = spark.read.parquet(totals)
    assert stored.filter("pickup_zone = 'MIDTOWN'").agg(F.max("events_processed")).first()[0] == 9


def test_order_event_batches(spark, tmp_path):
    source = tmp_path / "topic"
    source.mkdir()
    order = lambda o, c, status, amount, offset: json.dumps({"key": "k", "topic": "t", "partition": 0, "offset": offset, "value": json.dumps(
        {"order_id": o, "customer_id": c, "status": status, "amount": amount})}) + "\n"
    (source / "0.json").write_text(order(1, 7, "NEW", 5, 0) + order(1, 7, "NEW", 6, 1) + order(2, 7, "UPDATED", 9, 2))
    (source / "1.json").write_text(order(3, 7, "new", 1.5, 3))
    in_order(source)
    clean, totals = str(tmp_path / "clean"), str(tmp_path / "totals")
    sinks.finish(flows.order_event_batches(messages.stream_message_files(spark, str(source), 1), clean, totals), str(tmp_path / "c"))
    assert collected(spark.read.parquet(clean), "key", "batch_id") == [("1", 0), ("3", 1)]
    assert collected(spark.read.parquet(totals), "key", F.get_json_object("value", "$.total_amount")) == [("7", "1.5"), ("7", "5.0")]


def test_keys_of_one_block_share_a_state_and_stay_apart(spark, tmp_path):
    """Thousands of keys fill, change and join in a few dozen groups: state in Python costs by the group."""
    trips, log = tmp_path / "trips", tmp_path / "log"
    trips.mkdir(), log.mkdir()
    (trips / "0.json").write_text("".join(json.dumps({"d": f"k{i}", "n": i}) + "\n" for i in range(0, 6000, 2)))
    (log / "0.json").write_text("".join(json.dumps({"key": f"k{i}", "partition": 0, "offset": 9, "body": None if i % 8 else f"new{i}"}) + "\n"
                                        for i in range(0, 6000, 4)))
    base = spark.range(5000).selectExpr("concat('k', id) AS key", "0 AS partition", "id % 7 AS offset", "concat('old', id) AS body")
    facts = spark.readStream.schema("d string, n bigint").json(str(trips))
    changes = spark.readStream.schema("key string, partition int, offset bigint, body string").json(str(log))
    met = lookups.join_table(facts, "d", changes, base=base, salts=2, blocks=16)
    out = str(tmp_path / "met")
    sinks.finish(sinks.file_writer(met, out), str(tmp_path / "c"))
    want = {f"k{i}": (f"new{i}" if i % 8 == 0 else None) if i % 4 == 0 else f"old{i}" if i < 5000 else None for i in range(0, 6000, 2)}
    assert {r.key: r.table_row for r in spark.read.parquet(out).collect()} == want
    groups = spark.read.format("statestore").option("stateVarName", "rows").load(str(tmp_path / "c")).count()
    assert groups == 32


def test_trails_of_one_block_stay_apart(spark, tmp_path):
    """Hundreds of keys in three states: each keeps its own points and ends by its own silence, not by that of its block."""
    source = tmp_path / "pos"
    source.mkdir()
    point = lambda key, s: json.dumps({"key": key, "s": s, "lat": float(s), "lon": 2.0}) + "\n"
    (source / "0.json").write_text("".join(point(f"k{k}", s + k) for k in range(300) for s in (30, 10, 20)))
    (source / "1.json").write_text("".join(point(f"k{k}", 700 + k) for k in range(0, 300, 2)))
    (source / "2.json").write_text(point("last", 1500))
    in_order(source)
    stream = spark.readStream.schema("key string, s bigint, lat double, lon double").option("maxFilesPerTrigger", 1).json(str(source))
    stream = stream.select("key", "lat", "lon", (F.col("s") * 1000).alias("ts_ms"), F.timestamp_seconds("s").alias("ts"))
    out = str(tmp_path / "out")
    sinks.finish(sinks.file_writer(trails.track(stream, "key", "ts", limit=4, blocks=3), out), str(tmp_path / "c"))
    rows = spark.read.parquet(out)
    active = rows.filter("status = 'active'")
    assert active.count() == 300 + 150 + 1 and active.filter("points = 4").count() == 150
    gone = {r.key: (r.ts_ms // 1000, r.points, [t // 1000 for t in r.trail_ms]) for r in rows.filter("status = 'gone'").collect()}
    # the last watermark is 1440: what is older than 840 is over
    want = {f"k{k}": (30 + k, 3, [10 + k, 20 + k, 30 + k]) for k in range(1, 300, 2)}
    want |= {f"k{k}": (700 + k, 4, [10 + k, 20 + k, 30 + k, 700 + k]) for k in range(0, 140, 2)}
    assert gone == want
    assert spark.read.format("statestore").option("stateVarName", "trails").load(str(tmp_path / "c")).count() == 3


@pytest.mark.parametrize("files", [1, 3])
def test_rules_of_one_block_are_told_apart(spark, tmp_path, files):
    """Hundreds of rules in two states, among them a step and a result right at the last watermark."""
    rng, source = random.Random(12), tmp_path / "results"
    source.mkdir()
    times = {f"r{k}": sorted(rng.sample(range(0, 4000), rng.randrange(1, 9))) for k in range(300)} | {"edge": [4000, 4170], "brim": [4109]}
    rows = sorted((t, rule) for rule, own in times.items() for t in own) + [(4200, "last")]
    size = -(-len(rows) // files)
    for i in range(files):
        (source / f"{i}.json").write_text("".join(json.dumps({"rule": r, "s": t}) + "\n" for t, r in rows[i * size:(i + 1) * size]))
    in_order(source)
    stream = spark.readStream.schema("rule string, s bigint").option("maxFilesPerTrigger", 1).json(str(source))
    steps = alarms.silence_alarms(stream.withColumn("ts", F.timestamp_seconds("s")), "rule", "ts", 60, 200, "30 seconds", blocks=2)
    sinks.finish(sinks.file_writer(steps, str(tmp_path / "out")), str(tmp_path / "c"))
    got = sorted((r.rule, r.state, r.at) for r in spark.read.parquet(str(tmp_path / "out")).select("rule", "state", F.unix_seconds("at").alias("at")).collect())
    assert got == sorted((rule, name, at) for rule, own in times.items() for name, at in silent_steps(own, 4170, 60, 200))
    assert spark.read.format("statestore").option("stateVarName", "seen").load(str(tmp_path / "c")).count() == 2
