"""Operators against brute force, with hot keys, ties and nulls."""

import bisect
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.hashing import record_hash
from lakeweave.functions.numeric import customer_segment, haversine_miles, magnitude_bucket, surge_multiplier
from lakeweave.functions.temporal import epoch_iso, strict_date
from lakeweave.functions.text import distinct_prefixes, file_name, first_non_blank
from lakeweave.operators import aggregates as agg, mergeable
from lakeweave.operators import changes, enrich, geo, keyed, merge, quality, rolling


def make_events(seed=7, n=600, keys=6, hot=0.4):
    """(id, key, seconds, amount): one key holds ``hot`` of the rows, times repeat, ids are unique."""
    rng = random.Random(seed)
    return [(i, 0 if rng.random() < hot else rng.randrange(1, keys), rng.randrange(0, 4000), rng.randrange(1, 100))
            for i in range(n)]


@pytest.fixture(scope="module")
def events(spark):
    rows = make_events()
    df = spark.createDataFrame(rows, "id bigint, key bigint, s bigint, amount bigint").repartition(16)
    return rows, df.withColumn("ts", F.timestamp_seconds("s"))


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_and_last_n(events):
    rows, df = events
    by_key = defaultdict(list)
    for i, key, s, _ in rows:
        by_key[key].append((s, i))
    assert collected(keyed.latest_by_key(df, ["key"], ["ts", "id"]), "key", "id") == sorted(
        (k, max(v)[1]) for k, v in by_key.items())
    trail = keyed.trail_per_key(df, ["key"], "s", "id", ["amount"], 5)
    assert {r["key"]: [p["id"] for p in r["trail"]] for r in trail.collect()} == {
        k: [i for _, i in sorted(v)[-5:]] for k, v in by_key.items()}


def test_rank_filters_are_cut_before_the_shuffle(events):
    _, df = events
    plan = keyed.latest_by_key(df, ["key"], ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_with_ties_keeps_all_ties(events):
    rows, df = events
    best = defaultdict(int)
    for _, key, s, _ in rows:
        best[key] = max(best[key], s // 500)
    binned = df.withColumn("bin", F.floor(F.col("s") / 500))
    for salts in (1, 3, 1024):
        assert collected(keyed.latest_with_ties(binned, ["key"], "bin", salts), "id") == sorted(
            (i,) for i, key, s, _ in rows if s // 500 == best[key])


def test_latest_with_ties_null_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 5), (None, 3, 4), ("a", 4, 1)], "key string, id int, t int")
    assert collected(keyed.latest_with_ties(df, ["key"], "t"), "id") == [(1,), (2,), (4,)]


@pytest.mark.parametrize("salts", [1, 4, 1024])
def test_duplicates_are_split_exactly(events, salts):
    rows, df = events
    doubled = df.unionByName(df.filter("key = 0")).repartition(12)  # exact copies of the hot key
    first = {}
    for i, key, s, _ in rows:
        first[key] = min(first.get(key, (s, i)), (s, i))
    kept, later = keyed.split_duplicates(doubled, ["key"], ["s", "id"], salts)
    assert collected(kept, "key", "id") == sorted((k, i) for k, (_, i) in first.items())
    expected = [(i,) for i, key, _, _ in rows if (key, i) not in {(k, f[1]) for k, f in first.items()}]
    expected += [(i,) for i, key, _, _ in rows if key == 0]
    assert collected(later, "id") == sorted(expected)
    flagged = keyed.flag_duplicates(doubled, ["key"], ["s", "id"], salts)
    assert flagged.count() == doubled.count() and flagged.filter("NOT is_duplicate").count() == len(first)


def test_unique_with_count_and_mode(events):
    rows, df = events
    counts, values = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for _, key, _, amount in rows:
        counts[key] += 1
        values[key][amount] += 1
    assert collected(keyed.unique_with_count(df.drop("ts"), ["key"], ["s", "id"]), "key", "copies") == sorted(counts.items())
    modes = {k: min(v, key=lambda a: (-v[a], a)) for k, v in values.items()}
    assert dict(collected(keyed.modal_value(df, ["key"], "amount", "mode"), "key", "mode")) == modes


def test_mode_ignores_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), ("b", None)], "k string, v string")
    assert collected(keyed.modal_value(df, ["k"], "v", "m"), "k", "m") == [("a", "x"), ("b", None)]


@pytest.mark.parametrize("chunk", [10, 700, 86_400])
def test_running_totals(events, chunk):
    rows, df = events
    expected, state = [], defaultdict(lambda: [0, 0])
    for i, key, s, amount in sorted(rows, key=lambda r: (r[2], r[0])):
        state[key][0] += 1
        state[key][1] += amount
        expected.append((i, state[key][0], state[key][1]))
    got = rolling.running_totals(df, "key", "ts", "id", {"total": F.col("amount")}, "n", chunk)
    assert collected(got, "id", "n", "total") == sorted(expected)


def test_running_totals_split_inside_one_instant(spark):
    df = spark.createDataFrame([("a", 5, i) for i in range(100)], "k string, s bigint, id bigint").withColumn("ts", F.timestamp_seconds("s"))
    chunk = F.struct("ts", F.floor(F.col("id") / 7))
    got = rolling.running_totals(df, "k", "ts", "id", {"t": F.col("id")}, "n", chunk=chunk)
    assert collected(got, "id", "n", "t") == [(i, i + 1, i * (i + 1) // 2) for i in range(100)]


def test_running_totals_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 3, 7)], "k string, s bigint, v bigint").withColumn(
        "ts", F.timestamp_seconds("s"))
    assert collected(rolling.running_totals(df, "k", "ts", "s", {"t": F.col("v")}), "s", "t") == [(1, 5), (2, 11), (3, 7)]


@pytest.mark.parametrize("seconds,chunk", [(60, 30), (60, 3600), (1000, 100)])
def test_trailing_range(events, seconds, chunk):
    rows, df = events
    expected = [(i, sum(1 for _, k, t, _ in rows if k == key and s - seconds <= t <= s),
                 sum(a for _, k, t, a in rows if k == key and s - seconds <= t <= s)) for i, key, s, _ in rows]
    got = rolling.trailing_range(df, ["key"], "ts", seconds, {"n": F.count(F.lit(1)), "total": F.sum("amount")}, chunk)
    assert collected(got, "id", "n", "total") == sorted(expected)


@pytest.mark.parametrize("seconds,chunk", [(60, 30), (60, 3600), (1000, 100), (0, 50)])
def test_trailing_sums_and_extremes(events, seconds, chunk):
    rows, df = events
    inside = {i: [a for _, k, t, a in rows if k == key and s - seconds <= t <= s] for i, key, s, _ in rows}
    got = rolling.trailing_sums(df, ["key"], "ts", seconds, {"total": F.col("amount")}, "n", chunk)
    assert collected(got, "id", "n", "total") == sorted((i, len(v), sum(v)) for i, v in inside.items())
    got = rolling.trailing_extremes(df, ["key"], "ts", seconds, {"low": F.col("amount")}, {"high": F.col("amount")})
    assert collected(got, "id", "low", "high") == sorted((i, min(v), max(v)) for i, v in inside.items())


def test_trailing_sums_of_nulls_and_doubles(spark):
    df = spark.createDataFrame([("a", None, 1, None), ("a", None, 2, 0.5), ("a", 5, 4, None), ("a", 6, None, 2.0), (None, 5, 7, 1.0), ("a", 90, None, None)],
                               "k string, s bigint, v int, d double").withColumn("ts", F.timestamp_seconds("s"))
    got = rolling.trailing_sums(df, ["k"], "ts", 60, {"total": F.col("v"), "exact": F.col("d").cast("decimal(18,2)")}, "n", 10)
    assert sorted(((r.k, r.s, r.v, r.n, r.total, r.exact and float(r.exact)) for r in got.collect()), key=repr) == sorted([
        ("a", None, 1, 2, 3, 0.5), ("a", None, 2, 2, 3, 0.5), ("a", 5, 4, 1, 4, None), ("a", 6, None, 2, 4, 2.0), (None, 5, 7, 1, 7, 1.0),
        ("a", 90, None, 1, None, None)], key=repr)
    with pytest.raises(TypeError):
        rolling.trailing_sums(df, ["k"], "ts", 60, {"total": F.col("d")})
    got = rolling.trailing_extremes(df, ["k"], "ts", 60, {"low": F.col("v")})
    assert sorted(((r.k, r.s, r.low) for r in got.collect()), key=repr) == sorted([
        ("a", None, 1), ("a", None, 1), ("a", 5, 4), ("a", 6, 4), (None, 5, 7), ("a", 90, None)], key=repr)


def test_trailing_range_keeps_rows_without_time(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", 5, 4)], "k string, s bigint, v int").withColumn("ts", F.timestamp_seconds("s"))
    got = rolling.trailing_range(df, ["k"], "ts", 60, {"total": F.sum("v")})
    assert collected(got, "v", "total") == [(1, 3), (2, 3), (4, 4)]


@pytest.mark.parametrize("gap", [1, 20, 300])
def test_sessions(events, gap):
    rows, df = events
    by_key = defaultdict(list)
    for _, key, s, amount in rows:
        by_key[key].append((s, amount))
    expected = []
    for key, items in by_key.items():
        current = None
        for s, amount in sorted(items):
            if current and s - current[1] <= gap:
                current = [current[0], s, current[2] + 1, current[3] + amount]
            else:
                if current:
                    expected.append((key, *current))
                current = [s, s, 1, amount]
        expected.append((key, *current))
    got = rolling.session_totals(df, "key", "ts", gap, {"total": F.col("amount")}, "n")
    assert collected(got, "key", F.unix_seconds("session_start"), F.unix_seconds("session_end"), "n", "total") == sorted(expected)


def test_replay_equals_sequential_replay(spark):
    rng = random.Random(3)
    log = []
    for lsn in range(400):
        log.append((f"e{rng.randrange(300)}", rng.choice("crud"), rng.randrange(25), lsn, rng.randrange(100)))
    state, seen, duplicates = {}, set(), 0
    for event, op, key, lsn, value in sorted(log, key=lambda r: (r[3], r[0])):
        if event in seen:
            duplicates += 1
            continue
        seen.add(event)
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = value
    shuffled = log[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "event_id string, op string, key int, lsn bigint, value int")
    current, later = changes.replay(df, ["key"], "event_id", "lsn")
    assert dict(collected(current, "key", "value")) == state and later.count() == duplicates


def test_field_changes_across_chunks(spark):
    documents = ['{"a":1}', '{"a":1,"b":null}', '{"b":2,"a":3}', '{"b":1}', '{"b":1}', '{"b":1,"c":2}']
    df = spark.createDataFrame([(i, i * 10, d) for i, d in enumerate(documents)], "id int, us bigint, doc string")
    for chunk in (10, 25, 1000):
        got = changes.field_changes(df, "doc", "us", "id", chunk)
        assert collected(got, "id", "added", "removed") == [(1, "b", ""), (3, "", "a"), (5, "c", "")]


def test_declared_schema_drift():
    before = T.StructType.fromDDL("id bigint, email string, age int")
    after = T.StructType.fromDDL("id bigint, age bigint, phone string")
    assert changes.schema_drift(before, after) == [
        ("age", "retyped", "int -> bigint"), ("email", "removed", "string"), ("phone", "added", "string")]
    assert [changes.widened_kind(k) for k in (["bigint", "double"], ["void"], ["boolean", "bigint"], ["string", "double"])] == [
        "double", "string", "bigint", "string"]


def test_changelog_keys(spark):
    rows = [('{"driver_id":"d1"}', '{"full_name":"A"}', 0, 0), ("d2", '{"full_name":"B"}', 0, 1), (None, '{"driver_id":"d3","full_name":"C"}', 0, 2),
            ("d2", None, 0, 3), ("d1", '{"full_name":"A2"}', 0, 4), ("d1", "broken", 0, 5), (None, None, 0, 6)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset bigint")
    table = changes.changelog_table(df, T.StructType.fromDDL("driver_id string, full_name string"), "driver_id")
    assert collected(table, "driver_id", "full_name") == [("d1", "A2"), ("d3", "C")]


def test_late_boundary_and_null_time(spark):
    df = spark.createDataFrame([("a", 100), ("b", 90), ("c", 89), ("d", None)], "k string, ts_ms bigint")
    assert collected(changes.drop_late(df, "ts_ms", 10), "k") == [("a",), ("b",)]
    assert changes.drop_late(df.filter("false"), "ts_ms", 10).count() == 0


def test_upsert_modes(spark):
    target = spark.createDataFrame([(1, "NEW", 10.0, "x"), (2, "NEW", 20.0, "y")], "order_id int, status string, amount double, note string")
    change = spark.createDataFrame([(2, "PAID", None), (3, "NEW", 5.0)], "order_id int, status string, amount double")
    merged = merge.upsert(target, change, ["order_id"], ["status", "amount"])
    assert collected(merged, "order_id", "status", "amount", "note") == [
        (1, "NEW", 10.0, "x"), (2, "PAID", None, "y"), (3, "NEW", 5.0, None)]
    again = merge.upsert(merged, change, ["order_id"], ["status", "amount"])
    assert collected(again, "order_id", "status") == collected(merged, "order_id", "status")
    assert collected(merge.insert_new(target, change, ["order_id"]), "order_id") == [(3,)]


def boxes_and_points(seed=11):
    rng = random.Random(seed)
    boxes = [(i, *sorted((rng.uniform(-90, 90), rng.uniform(-90, 90))), *sorted((rng.uniform(-180, 180), rng.uniform(-180, 180))))
             for i in range(12)]
    boxes += [(100 + i, y, y + rng.choice([0, 0.1, 0.25, 3]), x, x + rng.choice([0, 0.25, 0.5, 40]))
              for i, (y, x) in enumerate((rng.randrange(-80, 80) / 4, rng.randrange(-160, 120) / 4) for _ in range(40))]
    boxes += [(200, 5.0, 1.0, 0.0, 9.0)]  # reversed: matches nothing
    points = [(i, rng.randrange(-320, 320) / 4, rng.randrange(-640, 640) / 4) for i in range(300)] + [(999, None, 1.0)]
    return boxes, points


@pytest.mark.parametrize("broadcast_rows", [10_000, 0])
def test_box_join_equals_nested_loop(spark, broadcast_rows):
    boxes, points = boxes_and_points()
    expected = sorted((p, b) for p, lat, lon in points if lat is not None
                      for b, south, north, west, east in boxes if south <= lat <= north and west <= lon <= east)
    got = geo.box_join(spark.createDataFrame(points, "p int, lat double, lon double"),
                       spark.createDataFrame(boxes, "b int, min_lat double, max_lat double, min_lon double, max_lon double"),
                       broadcast_rows=broadcast_rows)
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == (broadcast_rows > 0)
    assert collected(got, "p", "b") == expected and len(expected) > 100
    assert geo.box_join(spark.createDataFrame(points, "p int, lat double, lon double"), spark.createDataFrame(
        [], "b int, min_lat double, max_lat double, min_lon double, max_lon double")).count() == 0


def test_nearest_centre_ties_and_nulls(spark):
    centres = (("first", 0.0, 1.0), ("second", 0.0, -1.0))
    df = spark.createDataFrame([(0.0, 0.0), (0.0, -0.5), (None, 1.0)], "lat double, lon double")
    assert [r[0] for r in df.select(geo.nearest_centre("lat", "lon", centres)).collect()] == ["first", "second", "UNKNOWN"]


def test_thresholds_honour_their_operator(spark):
    rules = spark.createDataFrame([(1, "s", "m", ">=", 5.0, "w", True), (2, "s", "m", ">", 5.0, "w", True), (3, "s", "m", "<=", 5.0, "w", True),
                                   (4, "s", "m", ">", 0.0, "w", False), (5, "other", "m", ">", 0.0, "w", True)],
                                  "threshold_id int, source string, metric string, op string, threshold double, severity string, is_active boolean")
    readings = spark.createDataFrame([("a", 5.0), ("b", 6.0), ("c", None)], "id string, m double")
    assert collected(enrich.evaluate_thresholds(readings, rules, "s", ["id"], ["m"]), "id", "threshold_id") == [
        ("a", 1), ("a", 3), ("b", 1), ("b", 2)]


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(100)
    hinted = lambda frame: "ResolvedHint" in frame._jdf.queryExecution().analyzed().toString()
    assert hinted(enrich.broadcast_if_small(df, 100)) and not hinted(enrich.broadcast_if_small(df, 99))


def test_rules_and_routing(spark):
    df = spark.createDataFrame([("a", 5.0, "NEW"), ("b", -1.0, None), (None, None, "BAD")], "id string, amount double, status string")
    rules = [("missing_id", quality.blank("id")), ("non_positive", F.col("amount") <= 0), ("bad_status", quality.not_in("status", ("NEW",)))]
    checked = {r["id"]: (r["quality_errors"], r["is_valid"]) for r in quality.with_errors(df, rules).collect()}
    assert checked == {"a": ([], True), "b": (["non_positive"], False), None: (["missing_id", "bad_status"], False)}
    valid, rejected = quality.split_valid(df, F.col("amount") > 0)
    assert valid.count() == 1 and rejected.count() == 2  # null goes to the rejected side
    assert [r[0] for r in df.select(quality.first_error(rules)).collect()] == [None, "non_positive", "missing_id"]
    assert collected(quality.rule_counts(df, rules), "rule", "passed", "failed") == [
        ("bad_status", 2, 1), ("missing_id", 2, 1), ("non_positive", 2, 1)]
    assert quality.dead_letters(df, rules).count() == 3
    score = quality.batch_score(df, rules).first()
    assert (score["passed_rows"], score["failed_rows"], round(score["score"], 3)) == (1, 2, 66.667)
    assert quality.batch_score(df.filter("false"), rules).first()["failed_checks"] == 0


def test_expectation_bounds_on_text(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,), ("11",)], "v string")
    assert [r[0] for r in df.select(quality.outside("v", 0, 10)).collect()] == [False, True, True, True]


def test_dataset_rules_and_empty_tables(spark):
    now = F.lit(1_000_000)
    quakes = spark.createDataFrame([(5.0, 900_000), (0.0, 400_000)], "magnitude double, ingested_ms bigint")
    results = lambda df, kind, *a: {r["rule"]: r["status"] for r in quality.dataset_rules(df, quality.rule_table(kind, *a), now).collect()}
    assert results(quakes, "seismic_events", now) == {"seismic.has_magnitude": "FAIL", "seismic.freshness": "PASS"}
    assert results(quakes.filter("false"), "seismic_events", now) == {"seismic.has_magnitude": "PASS", "seismic.freshness": "FAIL"}
    regions = spark.range(60).withColumn("is_active", F.col("id") < 50)
    assert results(regions, "regions") == {"config.regions_active_min": "PASS"}
    positions = spark.createDataFrame([("a", None, 10), ("", "", 9), (None, "c", 1)], "address string, callsign string, ts_ms bigint")
    assert results(positions, "ogn_positions", None, F.lit(5)) == {"ogn.positions_have_pk": "FAIL", "ogn.late_events_lt_1pct": "FAIL"}


def test_alerts_and_sla(spark):
    metrics = spark.createDataFrame([(61.0, 0.9, 0)], "bronze_freshness_minutes double, quality_pass_rate double, silver_orders_count bigint")
    assert quality.sla_issues(metrics).count() == 3
    rates = spark.createDataFrame([("z", 6.0, 1.6, 0), ("y", 1.0, 1.0, 101)], "zone string, invalid_per_second double, surge_multiplier double, dlq_size int")
    assert collected(quality.alert_rows(rates, quality.standing_alerts()), "zone", "alert") == [
        ("y", "DeadLetterBacklog"), ("z", "HighErrorRate"), ("z", "SurgeActive")]


def test_scalar_functions(spark):
    one = spark.createDataFrame([("s3://bucket/a/b.jsonl", "C:\\x\\y.csv", ["NY123", "CA1", "NY9", None], " ", "k")],
                                "p string, w string, codes array<string>, a string, b string")
    row = one.select(file_name("p"), file_name("w"), distinct_prefixes("codes"), first_non_blank("a", "b"),
                     epoch_iso(F.lit(1780305300123)), epoch_iso(F.lit(1780305300), "s")).first()
    assert tuple(row) == ("b.jsonl", "y.csv", "CA,NY", "k", "2026-06-01T09:15:00.123000Z", "2026-06-01T09:15:00Z")
    dates = spark.createDataFrame([("2026-05-01",), ("2026-5-1",), ("bad",), (None,)], "t string")
    assert [str(r[0]) for r in dates.select(strict_date("t")).collect()] == ["2026-05-01", "None", "None", "None"]
    steps = spark.createDataFrame([(0, 0), (5, 0), (1, 4), (3, 4), (4, 4), (9, 4), (99, 4)], "d int, s int")
    assert [r[0] for r in steps.select(surge_multiplier("d", "s")).collect()] == [1.0, 3.0, 1.0, 1.2, 1.6, 2.0, 2.5]
    values = spark.createDataFrame([(None,), (2.9,), (3.0,), (200.0,)], "v double")
    assert [tuple(r) for r in values.select(magnitude_bucket("v"), customer_segment("v")).collect()] == [
        ("6.5+", "New"), ("<3", "New"), ("3-4.5", "New"), ("6.5+", "Premium")]
    miles = spark.range(1).select(haversine_miles(F.lit(40.7580), F.lit(-73.9855), F.lit(40.6413), F.lit(-73.7781))).first()[0]
    assert abs(miles - 13.53) < 0.05


def test_record_hash_ignores_column_order(spark):
    df = spark.createDataFrame([(1, None, (2, "x"))], "b int, a string, n struct<z:int,y:string>")
    again = df.select("n", "a", "b")
    assert df.select(record_hash(df)).first() == again.select(record_hash(again)).first()


def test_daily_sales_null_customers(spark):
    rows = [("d", 1, "x", 5), ("d", None, "y", 6), ("d", 1, "x", None), ("e", None, None, 1)]
    df = spark.createDataFrame(rows, "day string, customer int, product string, amount int")
    got = agg.daily_sales(df, "day", "customer", "product", F.col("amount"))
    assert collected(got, "day", "total_orders", "total_revenue", "unique_customers", "avg_order_value", "top_product") == [
        ("d", 3, 11.0, 1, 5.5, "x"), ("e", 1, 1.0, 0, 1.0, None)]


def test_global_kpis_of_empty_table(spark):
    empty = spark.createDataFrame([], "c int, v double")
    assert tuple(agg.global_kpis(empty, "c", F.col("v")).first()) == (0, 0, 0.0, 0.0, 0.0)


def test_result_alerts(spark):
    at = lambda minute: f"2026-01-01 10:{minute:02d}:00"
    rows = [("a", "FAIL", at(25)), ("a", "FAIL", at(12)), ("x.freshness", "FAIL", at(17)), ("b", "PASS", at(29)), ("c", "FAIL", at(40))]
    results = spark.createDataFrame(rows, "rule string, status string, t string").withColumn("checked_at", F.to_timestamp("t"))
    now = F.to_timestamp(F.lit(at(30)))
    assert collected(quality.result_alerts(results, now), "rule", "alert") == [("a", "QualityRuleFailing"), ("x.freshness", "IngestorStale")]
    assert collected(quality.result_alerts(results.filter("rule = 'c'"), now), "rule", "alert") == [("*", "NoQualityResults")]


def test_hot_key_is_spread_over_tasks(spark):
    """One key holds a third of all rows: after each operator no task may hold more than a fraction of it."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(0, n, numPartitions=64).select("id", key.alias("key"), (F.col("id") * 7 % 1_000_003).alias("s")).withColumn(
        "ts", F.timestamp_seconds("s"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        results = {
            "flag": keyed.flag_duplicates(df, ["key"], ["s", "id"]),
            "running": rolling.running_totals(df, "key", "ts", "id", {"t": F.col("id")}),
            "trailing": rolling.trailing_range(df, ["key"], "ts", 60, {"c": F.count(F.lit(1))}),
            "trailing sums": rolling.trailing_sums(df, ["key"], "ts", 60, {"c": F.lit(1)}),
        }
        for name, result in results.items():
            sizes = [r[0] for r in result.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
            assert sum(sizes) == n and max(sizes) < n * 0.06, (name, max(sizes))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_quantiles_are_exact_for_large_groups(spark):
    rng = random.Random(5)
    rows = [("big", rng.choice([rng.random() * 100, float(rng.randrange(30))])) for _ in range(100_000)]
    rows += [("small", 3.0), ("small", 1.0), ("same", 7.0), ("same", 7.0), ("none", None), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    got = {r.k: (r.p1, r.p50, r.p95, r.p100) for r in rolling.exact_quantiles(df, ["k"], "v", (0.01, 0.5, 0.95, 1.0)).collect()}
    big = sorted(v for k, v in rows if k == "big")
    assert got["big"] == tuple(big[max(1, -(-len(big) * q // 100)) - 1] for q in (1, 50, 95, 100))
    assert got["small"] == (1.0, 1.0, 3.0, 3.0) and got["same"] == (7.0,) * 4 and got[None] == (2.0,) * 4 and "none" not in got


def test_unique_with_count_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (2, None, "z"), (2, None, "z")], "k int, o int, v string")
    got = sorted((r.k, r.o, r.v, r.copies) for r in keyed.unique_with_count(df, ["k"], ["o"]).collect())
    assert got == [(1, 5, "y", 2), (2, None, "z", 2)]
    kept = {(r.k, r.v) for r in keyed.first_by_key(df, ["k"], ["o"]).collect()}
    assert kept == {(k, v) for k, _, v, _ in got}


def test_upsert_repeats_without_growing_on_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    changes = spark.createDataFrame([(None, "m"), (2, "b")], "k int, v string")
    once = merge.upsert(target, changes, ["k"], ["v"])
    twice = merge.upsert(once, changes, ["k"], ["v"])
    want = {(1, "a"), (None, "m"), (2, "b")}
    assert {tuple(r) for r in once.collect()} == want and once.count() == 3
    assert {tuple(r) for r in twice.collect()} == want and twice.count() == 3


def test_small_boxes_meet_only_their_own_points(spark):
    rng = random.Random(9)
    points = [(i, rng.random() * 0.25, rng.random() * 0.25) for i in range(2_000)]
    boxes = [(j, y, y + 0.0005, x, x + 0.0005) for j in range(4_000) for y, x in [(rng.random() * 0.25, rng.random() * 0.25)]]
    boxes.append((9_999, 0.1, 0.1, 0.1, 0.1))
    points.append((9_999, 0.1, 0.1))
    joined = geo.box_join(spark.createDataFrame(points, "p int, lat double, lon double"), spark.createDataFrame(
        boxes, "b int, min_lat double, max_lat double, min_lon double, max_lon double"), broadcast_rows=0)
    want = {(p, b) for p, y, x in points for b, s, n, w, e in boxes if s <= y <= n and w <= x <= e}
    assert {(r.p, r.b) for r in joined.select("p", "b").collect()} == want and (9_999, 9_999) in want


def test_layer_reports_without_any_table(spark):
    assert [tuple(r) for r in agg.layer_counts({"a": None, "b": None}).orderBy("table_name").collect()] == [("a", 0), ("b", 0)]
    assert [tuple(r) for r in quality.layer_checks({"a": (None, F.lit(True))}).collect()] == [("a", -1, True)]


def test_bitmaps_of_parts_unite_to_distinct_counts(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(12), rng.choice("ab"), rng.choice([rng.randrange(80), 32_768 + rng.randrange(5), 2**40, 0, None])) for _ in range(3000)]
    rows.append((3, "none", None))
    df = spark.createDataFrame(rows, "day int, k string, n bigint")
    parts = mergeable.distinct_bitmaps(df, ["day", "k"], "n").repartition(5)
    for keys in (["k"], ["day", "k"], []):
        want = df.groupBy(*keys).agg(F.countDistinct("n").alias("c")).filter("c > 0")
        assert collected(mergeable.distinct_counts(parts, keys), *keys, "distinct_count") == collected(want, *keys, "c")


def test_merged_sketches_keep_their_rank_error(spark):
    rng = random.Random(8)
    values = [rng.expovariate(0.1) for _ in range(60_000)] + [7.0] * 5_000
    df = spark.createDataFrame([(i % 24, v) for i, v in enumerate(values)] + [(1, None)], "hour int, v double").repartition(6)
    merged = mergeable.merged_sketches(mergeable.quantile_sketches(df, ["hour"], "v"), [])
    row, ordered = mergeable.sketched_quantiles(merged, [], [0.01, 0.5, 0.99]).first(), sorted(values)
    assert row["n"] == len(values)
    for name, q in (("p1", 0.01), ("p50", 0.5), ("p99", 0.99)):
        low, high = bisect.bisect_left(ordered, row[name]) / len(ordered), bisect.bisect_right(ordered, row[name]) / len(ordered)
        assert low - mergeable.rank_error() <= q <= high + mergeable.rank_error()


def test_box_cells_follow_height_and_width(spark):
    """A cell is an eighth to half of the box, so that long thin boxes meet few points outside; places with equal boxes share a shape."""
    extents = [(e,) for e in (1e-6, 0.01, 0.25, 0.5, 1.5, 4.5, 19.5, 360.0)]
    cells = spark.createDataFrame(extents, "e double").select("e", (F.lit(geo.BASE_CELL) * F.pow(F.lit(2.0), geo._level(F.col("e")))).alias("c"))
    assert all(r.e / 8 <= r.c <= r.e / 2 for r in cells.collect())
    boxes = spark.createDataFrame([("a", 0.0, 1.0, 0.0, 9.0), ("a", 5.0, 6.0, 0.0, 9.0), ("b", 5.0, 6.0, 0.0, 9.0), ("b", 0.0, 1.0, 0.0, 9.0),
                                   ("c", 0.0, 1.0, 0.0, 9.0), (None, 0.0, 1.0, 0.0, 9.0), ("d", 1.0, 0.0, 0.0, 9.0)],
                                  "name string, min_lat double, max_lat double, min_lon double, max_lon double")
    shapes, places = geo.shared_boxes(boxes, ["name"])
    assert sorted((r.name or "", r.shape.name or "") for r in places.collect()) == [("", ""), ("a", "a"), ("b", "a"), ("c", "")]
    assert shapes.count() == 3
