"""Change-data-capture queries; events play the change log, their user is the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import changes
from .registry import Lake, query, us, whole

# What each event type plays in the change log.
OP_CASE = "CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END"


def change_log(lake: Lake) -> DataFrame:
    return lake("events").withColumn("op", F.expr(OP_CASE))


def envelopes(lake: Lake) -> DataFrame:
    """Change messages of every shape; the event's value decides which: empty, broken, flat, wrapped, plain."""
    image = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("status"), F.col("value").alias("amount"))
    none = F.lit(None).cast("struct<id:bigint,status:string,amount:double>")
    source = F.struct(F.lit("shop").alias("name"), F.lit("orders").alias("table"), F.col("event_id").alias("lsn"))
    body = F.struct(
        F.when(F.col("op") == "d", image).otherwise(none).alias("before"),
        F.when(F.col("op") == "d", none).otherwise(image).alias("after"),
        F.col("op").alias("op"), source.alias("source"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    flat = F.struct(F.col("user_id").alias("id"), F.col("op").alias("__op"), F.lit("orders").alias("__table"),
                    (F.col("op") == "d").cast("string").alias("__deleted"))
    keep_nulls = {"ignoreNullFields": "false"}
    value = (F.when(F.col("value") < 1, F.lit(None).cast("string"))
             .when(F.col("value") < 2, F.lit("not json"))
             .when(F.col("value") < 5, F.to_json(flat, keep_nulls))
             .when(F.col("value") < 10, F.to_json(F.struct(body.alias("payload")), keep_nulls))
             .otherwise(F.to_json(body, keep_nulls)))
    return change_log(lake).select("event_id", F.col("event_id").alias("offset"), F.lit(0).alias("partition"),
                                   F.col("user_id").cast("string").alias("key"), value.alias("value"))


@query(f"""SELECT user_id, event_id, value FROM (SELECT *, {OP_CASE} AS op, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND op <> 'd'""")
def cdc_replay_current(lake: Lake):
    rows = change_log(lake).withColumn("pos", us("ts"))
    current, _ = changes.replay(rows, ["user_id"], "event_id", "pos")
    return current.select("user_id", "event_id", "value")


@query("SELECT 0 AS duplicates, max(epoch_us(ts)) AS latest_position FROM events")
def cdc_duplicates_and_position(lake: Lake):
    rows = change_log(lake).withColumn("pos", us("ts"))
    flagged = changes.flagged_log(rows, "event_id", "pos")
    duplicates = flagged.agg(F.count_if("is_duplicate").cast("int").alias("duplicates"))
    return duplicates.select("duplicates", changes.latest_position(rows, "pos").scalar().alias("latest_position"))


SQL_KIND = """CASE WHEN value < 1 THEN 'tombstone' WHEN value < 2 THEN 'raw' WHEN value < 5 THEN 'flat' ELSE 'envelope' END"""


@query(f"""SELECT event_id, format, CASE WHEN format IN ('envelope', 'flat') THEN op ELSE '-' END AS op_code,
  CASE WHEN format IN ('envelope', 'flat') THEN CASE op WHEN 'd' THEN 'delete' WHEN 'c' THEN 'create' WHEN 'r' THEN 'read/snapshot'
    ELSE 'update' END ELSE '-' END AS op_meaning,
  CASE WHEN format IN ('envelope', 'flat') THEN 'orders' ELSE '-' END AS "table",
  CASE WHEN format = 'flat' THEN CASE WHEN op = 'd' THEN 'true' ELSE 'false' END ELSE '-' END AS deleted,
  format = 'envelope' AND op = 'd' AS has_before, format = 'envelope' AND op <> 'd' AS has_after
FROM (SELECT event_id, {OP_CASE} AS op, {SQL_KIND} AS format FROM events)""")
def cdc_classify(lake: Lake):
    described = changes.classify_changes(envelopes(lake), "value")
    texts = ["op_code", "op_meaning", "table", "deleted"]
    return described.select("event_id", "format", *[F.coalesce(c, F.lit("-")).alias(c) for c in texts],
                            F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after"))


@query(f"""SELECT 'dbz-' || event_id || '-' || op || '-' || user_id || '-' || event_id AS event_id, op, user_id AS order_id,
  event_type AS status, value AS amount, 'shop' AS source, 'orders' AS "table", event_id AS source_lsn,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS order_second
FROM (SELECT *, {OP_CASE} AS op FROM events WHERE value >= 5)""")
def cdc_normalise(lake: Lake):
    flat_or_envelope = envelopes(lake).drop("event_id")
    rows = changes.order_envelopes(flat_or_envelope).filter(F.col("event_id").startswith("dbz-"))
    return rows.select("event_id", "op", "order_id", "status", "amount", "source", "table", "source_lsn",
                       F.substring("order_ts", 1, 19).alias("order_second"))


@query(f"""SELECT 'dbz-inventory-' || event_id || '-' || op || '-' || user_id || '-' || event_id AS event_id, op,
  user_id AS inventory_id, event_type AS product_name, CAST(floor(value) AS BIGINT) AS quantity, 'bin.1' AS source_file,
  event_id AS source_pos FROM (SELECT *, {OP_CASE} AS op FROM events)""")
def cdc_normalise_inventory(lake: Lake):
    image = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("product_name"),
                     F.floor("value").alias("quantity"), F.lit("2024").alias("last_updated"))
    body = F.struct(F.when(F.col("op") == "d", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), "op",
                    F.struct(F.lit("bin.1").alias("file"), F.col("event_id").alias("pos")).alias("source"))
    messages = change_log(lake).select(F.col("event_id").alias("offset"),
                                       F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))
    return changes.inventory_envelopes(messages).select("event_id", "op", "inventory_id", "product_name", "quantity",
                                                        "source_file", "source_pos")


@query(f"""SELECT event_id AS "offset", op AS envelope_op, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS deleted,
  'orders' AS "table", CAST(event_id AS VARCHAR) AS lsn, op <> 'd' AS has_after
FROM (SELECT *, {OP_CASE} AS op FROM events WHERE value >= 5)""")
def cdc_formats_side_by_side(lake: Lake):
    log = changes.unwrap_payload(envelopes(lake), "value").filter(F.get_json_object("value", "$.op").isNotNull())
    flat = change_log(lake).select(F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.to_json(F.struct(
        F.col("op").alias("__op"), (F.col("op") == "d").cast("string").alias("__deleted"), "value")).alias("value"))
    both = changes.align_formats(log, flat)
    return both.select("offset", "envelope_op", "deleted", "table", "lsn", F.col("after").isNotNull().alias("has_after"))


@query("SELECT event_id, epoch_us(ts) AS ts_ms, value FROM events")
def cdc_flat_time(lake: Lake):
    half = F.when(F.col("user_id") % 2 == 0, us("ts"))
    rows = lake("events").select("event_id", "value", half.alias("ts_ms"), us("ts").alias("__ts_ms"))
    return changes.unify_flat_time(rows)


@query("""SELECT user_id AS driver_id, event_type AS full_name, value AS rating FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def changelog_table(lake: Lake):
    body = F.to_json(F.struct(F.col("user_id").alias("driver_id"), F.col("event_type").alias("full_name"),
                              F.col("value").alias("rating")))
    json_key = F.to_json(F.struct(F.col("user_id").alias("driver_id")))
    messages = lake("events").select(
        F.when(F.col("user_id") % 2 == 0, json_key).otherwise(F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("event_type") != "error", body).alias("value"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"))
    fields = T.StructType.fromDDL("driver_id bigint, full_name string, rating double")
    table = changes.changelog_table(messages, fields, "driver_id")
    return table.withColumn("driver_id", whole("driver_id"))


@query("SELECT event_id, user_id FROM events WHERE epoch_us(ts) >= (SELECT max(epoch_us(ts)) - 86400000000 FROM events)")
def late_filter(lake: Lake):
    rows = lake("events").withColumn("ts_us", us("ts"))
    return changes.drop_late(rows, "ts_us", 86_400_000_000).select("event_id", "user_id")


@query("""WITH f AS (SELECT event_id, epoch_us(ts) AS ts_us, CASE WHEN event_type = 'signup' THEN ['email', 'id', 'name']
    WHEN event_type = 'error' THEN ['id'] ELSE ['id', 'name'] END AS fields FROM events),
  p AS (SELECT *, lag(fields) OVER (ORDER BY ts_us, event_id) AS prev FROM f)
SELECT event_id, ts_us, array_to_string(list_sort([x for x in fields if NOT list_contains(prev, x)]), ',') AS added,
  array_to_string(list_sort([x for x in prev if NOT list_contains(fields, x)]), ',') AS removed
FROM p WHERE prev IS NOT NULL AND prev <> fields""")
def schema_drift(lake: Lake):
    document = F.expr("""CASE WHEN event_type = 'signup' THEN '{"name": 1, "id": 2, "email": null}'
        WHEN event_type = 'error' THEN '{"id": 2}' ELSE '{"id": 2, "name": "x"}' END""")
    rows = lake("events").select("event_id", us("ts").alias("ts_us"), document.alias("after"))
    return changes.field_changes(rows, "after", "ts_us", "event_id")


@query("""SELECT user_id AS fingerprint, event_id AS alert_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'view'""")
def active_alerts(lake: Lake):
    history = lake("events").select(F.col("user_id").alias("fingerprint"), F.col("event_id").alias("alert_id"), "ts",
                                    F.when(F.col("event_type") == "view", "resolved").otherwise("firing").alias("status"))
    return changes.active_alerts(history).select("fingerprint", "alert_id")
