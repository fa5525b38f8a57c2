"""Change-data-capture: message shapes, normalised rows, replay to current state, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import epoch_iso, time_chunk
from ..functions.text import as_column
from .keyed import flag_duplicates, latest_by_key, split_duplicates

# Change operation codes and their meaning.
OPERATIONS = {
    "c": "create",
    "u": "update",
    "d": "delete",
    "r": "read/snapshot",
    "t": "truncate",
    "m": "message",
}
DELETE = "d"
LATE_MS = 24 * 60 * 60 * 1000


def json_field(document: Column | str, *path: str) -> Column:
    steps = "".join(f"['{name}']" for name in path)
    return F.get_json_object(as_column(document), f"${steps}")


def _holds_image(keys: Column) -> Column:
    return F.coalesce(F.arrays_overlap(keys, F.array(F.lit("before"), F.lit("after"))), F.lit(False))


def open_envelopes(df: DataFrame, value: str) -> DataFrame:
    """Add ``__doc``: the change message parsed once, a ``payload`` wrapper around an image removed.

    Fields: ``enveloped``, ``keys``, and as JSON text or plain text ``before, after, op, source,
    ts_ms`` and the body itself.
    """
    body = "before string, after string, op string, source string, ts_ms string"
    parsed = df.withColumns({"__outer": F.from_json(value, f"payload string, {body}"),
                             "__keys": F.json_object_keys(value)})
    parsed = parsed.withColumns({"__inner": F.from_json("__outer.payload", body),
                                 "__inner_keys": F.json_object_keys("__outer.payload")})
    parsed = parsed.withColumn("__wrapped", _holds_image(F.col("__inner_keys")))

    def pick(name: str) -> Column:
        return F.when(F.col("__wrapped"), F.col(f"__inner.{name}")).otherwise(F.col(f"__outer.{name}"))

    doc = F.struct(
        (F.col("__wrapped") | _holds_image(F.col("__keys"))).alias("enveloped"),
        F.when(F.col("__wrapped"), F.col("__inner_keys")).otherwise(F.col("__keys")).alias("keys"),
        F.when(F.col("__wrapped"), F.col("__outer.payload")).otherwise(F.col(value)).alias("body"),
        *[pick(name).alias(name) for name in ("before", "after", "op", "source", "ts_ms")])
    return parsed.withColumn("__doc", doc).drop("__outer", "__inner", "__keys", "__inner_keys", "__wrapped")


def unwrap_payload(df: DataFrame, value: str) -> DataFrame:
    """Replace each message by its inner ``payload`` when that carries a row image."""
    return open_envelopes(df, value).withColumn(value, F.col("__doc.body")).drop("__doc")


def operation_meaning(code: Column) -> Column:
    meaning = F.lit("unknown")
    for short, text in OPERATIONS.items():
        meaning = F.when(code == short, text).otherwise(meaning)
    return meaning


def classify_changes(df: DataFrame, value: str) -> DataFrame:
    """Describe each message: format, op code and meaning, table, row images, deleted flag."""
    opened = (open_envelopes(df, value)
              .withColumn("__flat", F.from_json("__doc.body", "__op string, __table string, __deleted string"))
              .withColumn("__source", F.from_json("__doc.source", "table string")))
    complete = F.array(*map(F.lit, ("before", "after", "op")))
    kind = (F.when(F.col(value).isNull() | (F.trim(value) == "null"), "tombstone")
            .when(F.size(F.array_intersect("__doc.keys", complete)) == 3, "envelope")
            .when(F.col("__doc.keys").isNotNull(), "flat")
            .otherwise("raw"))
    is_envelope, is_flat = F.col("format") == "envelope", F.col("format") == "flat"

    def either(nested: str, flat: str) -> Column:
        return F.when(is_envelope, F.col(nested)).when(is_flat, F.col(flat))

    described = opened.withColumn("format", kind).withColumns({
        "op_code": either("__doc.op", "__flat.__op"),
        "table": either("__source.table", "__flat.__table"),
        "before": F.when(is_envelope, F.col("__doc.before")),
        "after": F.when(is_envelope, F.col("__doc.after")),
        "deleted": F.when(is_flat, F.col("__flat.__deleted")),
    })
    meaning = F.when(is_envelope | is_flat, operation_meaning(F.col("op_code")))
    return described.withColumn("op_meaning", meaning).drop("__doc", "__flat", "__source")


def envelope_rows(df: DataFrame, value: str, offset: str, fields: dict[str, tuple[Sequence[str], str]],
                  key_field: str, position: Sequence[str], id_prefix: str, default_source: str,
                  default_table: str) -> DataFrame:
    """Flatten change envelopes: the before image for deletes, the after image otherwise.

    ``fields`` map output names to (candidate names inside the image, type); ``position`` names the
    candidates inside ``source`` that order the log, the message offset being the last resort.
    Messages without a usable image are dropped; already flat messages pass through with their own
    ``event_id``, ``op``, ``source``, ``table`` and position.
    """
    names = sorted({c for candidates, _ in fields.values() for c in candidates})
    flat_names = ["event_id", "source", "table", "source_lsn", "source_pos"]
    as_text = lambda columns: ", ".join(f"`{c}` string" for c in columns)
    image = (F.when(~F.col("__doc.enveloped"), F.col("__doc.body"))
             .when(F.col("__doc.op") == DELETE, F.col("__doc.before")).otherwise(F.col("__doc.after")))
    # Exploding "no image" to no row, instead of filtering, keeps Spark from pushing the JSON
    # parsing into a predicate and doing it again for every field it mentions.
    opened = open_envelopes(df, value).withColumn("__image", image)
    usable = F.when(F.json_object_keys("__image").isNotNull(), F.array("__image"))
    opened = opened.withColumn("__image", F.explode(usable)).withColumns({
        "__row": F.from_json("__image", as_text(names)),
        "__flat": F.from_json("__image", as_text(flat_names)),
        "__src": F.from_json("__doc.source", as_text(["name", "table", "file", *position]))})
    enveloped, op = F.col("__doc.enveloped"), F.col("__doc.op")

    columns = {name: F.coalesce(*[F.col(f"__row.`{c}`") for c in candidates]).try_cast(kind)
               for name, (candidates, kind) in fields.items()}
    place = F.when(enveloped, F.coalesce(*[F.col(f"__src.{c}") for c in position], F.col(offset).cast("string"))
                   ).otherwise(F.coalesce("__flat.source_lsn", "__flat.source_pos"))
    made_id = F.concat_ws("-", F.lit(id_prefix), place, op, columns[key_field].cast("string"),
                          F.col(offset).cast("string"))

    def described(inside: str, flat: str, default: str) -> Column:
        return F.when(enveloped, F.coalesce(F.col(f"__src.{inside}"), F.lit(default))).otherwise(F.col(f"__flat.{flat}"))

    return opened.select(
        *df.columns, F.when(enveloped, made_id).otherwise(F.col("__flat.event_id")).alias("event_id"),
        op.alias("op"), *[column.alias(name) for name, column in columns.items()],
        described("name", "source", default_source).alias("source"),
        described("table", "table", default_table).alias("table"),
        F.when(enveloped, F.col("__src.file")).alias("source_file"),
        place.try_cast("bigint").alias("source_position"), F.col("__doc.ts_ms").alias("captured_ms"))


def order_envelopes(df: DataFrame, value: str = "value", offset: str = "offset",
                    time_unit: str = "ms") -> DataFrame:
    """Order changes: missing amounts count as 0, numeric times become ISO text in ``time_unit``."""
    rows = envelope_rows(
        df, value, offset, key_field="order_id", position=["lsn"], id_prefix="dbz",
        default_source="orders-db", default_table="orders",
        fields={"order_id": (["order_id", "id"], "bigint"), "customer_id": (["customer_id"], "bigint"),
                "status": (["status"], "string"), "amount": (["amount"], "double"),
                "order_ts": (["order_ts", "order_date"], "string")})
    stamp = F.coalesce("order_ts", "captured_ms")
    numeric = stamp.try_cast("bigint")
    return rows.withColumns({
        "amount": F.coalesce("amount", F.lit(0.0)),
        "order_ts": F.when(numeric.isNotNull(), epoch_iso(numeric, time_unit)).otherwise(stamp),
    }).withColumnRenamed("source_position", "source_lsn").drop("source_file", "captured_ms")


def inventory_envelopes(df: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """Inventory changes, placed in the log by (source file, position)."""
    rows = envelope_rows(
        df, value, offset, key_field="inventory_id", position=["pos"], id_prefix="dbz-inventory",
        default_source="inventory-db", default_table="inventory",
        fields={"inventory_id": (["id", "inventory_id"], "bigint"), "product_name": (["product_name"], "string"),
                "quantity": (["quantity"], "bigint"), "last_updated": (["last_updated"], "string")})
    return rows.withColumnRenamed("source_position", "source_pos").drop("captured_ms")


def unify_flat_time(df: DataFrame, time: str = "ts_ms", marked: str = "__ts_ms") -> DataFrame:
    """Rows of an unwrapped change topic: the marked capture time fills a missing event time."""
    if marked not in df.columns:
        return df
    filled = F.coalesce(F.col(time), F.col(marked)) if time in df.columns else F.col(marked)
    return df.withColumn(time, filled).drop(marked)


def align_formats(envelopes: DataFrame, flat: DataFrame, value: str = "value",
                  keys: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Envelope and flat form of the same messages side by side, matched by position."""
    left = (open_envelopes(envelopes, value)
            .withColumn("__src", F.from_json("__doc.source", "table string, lsn string"))
            .select(*keys, F.col("__doc.op").alias("envelope_op"), "__doc.before", "__doc.after",
                    "__src.table", "__src.lsn"))
    right = (flat.withColumn("__f", F.from_json(value, "__op string, __deleted string"))
             .select(*keys, F.col("__f.__op").alias("flat_op"), F.col("__f.__deleted").alias("deleted"),
                     F.col(value).alias("flat_value")))
    return left.join(right, list(keys), "left")


def current_state(events: DataFrame, keys: Sequence[str], log_order: Sequence[str],
                  is_delete: Column) -> DataFrame:
    """Latest event per key, without keys whose latest event is a delete.

    Equal to replaying the log in order, because ``log_order`` is total.
    """
    return latest_by_key(events, keys, log_order).filter(~F.coalesce(is_delete, F.lit(False)))


def replay(events: DataFrame, keys: Sequence[str], event_id: str, position: str,
           op: str = "op") -> tuple[DataFrame, DataFrame]:
    """(current rows, duplicate events): the first copy of an event id in log order counts."""
    unique, duplicates = split_duplicates(events, [event_id], [position])
    current = current_state(unique, keys, [position, event_id], F.col(op) == DELETE)
    return current, duplicates


def flagged_log(events: DataFrame, event_id: str, position: str) -> DataFrame:
    """The whole log with later copies of an event id flagged."""
    return flag_duplicates(events, [event_id], [position])


def changelog_table(messages: DataFrame, fields: T.StructType, key_field: str, key: str = "key",
                    value: str = "value", position: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Latest value per key of a changelog topic; an empty value deletes the key.

    The key is taken from a JSON key, a raw text key, or the value itself, in that order.
    """
    parsed = F.from_json(value, fields)
    text_key = F.when(F.json_object_keys(key).isNotNull(), json_field(key, key_field)).otherwise(F.col(key))
    valid = F.col(value).isNull() | (F.col(value) == "") | F.json_object_keys(value).isNotNull()
    keyed = (messages.filter(valid)
             .withColumn("__key", F.coalesce(text_key, json_field(value, key_field)))
             .filter(F.col("__key").isNotNull()))
    latest = latest_by_key(keyed, ["__key"], position)
    live = latest.filter(F.json_object_keys(value).isNotNull()).withColumn("__row", parsed)
    names = [name for name in fields.fieldNames() if name != key_field]
    return live.select(F.col("__key").alias(key_field), *[F.col(f"__row.{n}").alias(n) for n in names])


def late_cutoff(df: DataFrame, time: str, horizon: Column | int) -> Column:
    """One-row scalar subquery: greatest time minus the horizon."""
    span = F.lit(horizon) if isinstance(horizon, int) else horizon
    return df.agg((F.max(F.coalesce(F.col(time), F.lit(0))) - span).alias("cutoff")).scalar()


def drop_late(df: DataFrame, time: str = "ts_ms", horizon: int = LATE_MS) -> DataFrame:
    """Keep rows within ``horizon`` of the greatest time, the boundary included; null counts as 0."""
    return df.filter(F.coalesce(F.col(time), F.lit(0)) >= late_cutoff(df, time, horizon))


def latest_position(df: DataFrame, position: str, alias: str = "latest_position") -> DataFrame:
    return df.agg(F.coalesce(F.max(position), F.lit(0)).alias(alias))


def active_alerts(history: DataFrame, fingerprint: str = "fingerprint", status: str = "status",
                  order: Sequence[str] = ("ts", "alert_id")) -> DataFrame:
    """Alerts whose latest message is not a resolution."""
    return current_state(history, [fingerprint], order, F.col(status) == "resolved")


CHUNK_GROUP = 10_000


def field_changes(events: DataFrame, document: str, order_micros: str, tie: str,
                  chunk_us: int = 60_000_000) -> DataFrame:
    """Messages whose field set differs from the previous message, with the fields added and removed.

    The stream has one global order, so it is cut into time chunks: only the first and the last
    field set of each chunk cross its border, the rest is compared inside the chunk.
    """
    names = F.array_sort(F.json_object_keys(document))
    rows = (events.select(F.col(order_micros).alias("__us"), F.col(tie).alias("__tie"), names.alias("__fields"))
            .filter(F.col("__fields").isNotNull())
            .withColumn("__chunk", time_chunk(F.col("__us"), chunk_us)))
    inside = Window.partitionBy("__chunk").orderBy("__us", "__tie")
    compared = rows.withColumn("__before", F.lag("__fields").over(inside))
    last = rows.groupBy("__chunk").agg(F.max(F.struct("__us", "__tie", "__fields")).alias("__last"))
    # chunk ends meet their successors by groups of chunks; only the ends of groups are ordered as a whole
    last = last.withColumn("__group", F.floor(F.col("__chunk") / CHUNK_GROUP))
    ends = last.groupBy("__group").agg(F.max_by("__last", "__chunk").alias("__end"))
    carried = ends.select("__group", F.lag("__end").over(Window.orderBy("__group")).alias("__carried"))
    border = last.join(carried, "__group").select("__chunk", F.coalesce(
        F.lag("__last").over(Window.partitionBy("__group").orderBy("__chunk")), "__carried")["__fields"].alias("__border"))
    joined = compared.join(border, "__chunk", "left")
    before = F.coalesce("__before", "__border")
    return (joined.filter(before.isNotNull() & (before != F.col("__fields")))
            .select(F.col("__tie").alias(tie), F.col("__us").alias(order_micros),
                    F.array_join(F.array_except("__fields", before), ",").alias("added"),
                    F.array_join(F.array_except(before, F.col("__fields")), ",").alias("removed")))


def schema_drift(before: T.StructType, after: T.StructType) -> list[tuple[str, str, str]]:
    """(column, change, detail) between two declared schemas."""
    old = {f.name: f.dataType.simpleString() for f in before.fields}
    new = {f.name: f.dataType.simpleString() for f in after.fields}
    changes = [(name, "added", new[name]) for name in new if name not in old]
    changes += [(name, "removed", old[name]) for name in old if name not in new]
    changes += [(name, "retyped", f"{old[name]} -> {new[name]}")
                for name in old if name in new and old[name] != new[name]]
    return sorted(changes)


def widened_kind(kinds: Sequence[str]) -> str:
    """Column type for values of several kinds: any text wins, then double, bigint, boolean."""
    present = [kind for kind in kinds if kind != "void"]
    if any(kind not in ("double", "bigint", "boolean") for kind in present):
        return "string"
    return next((kind for kind in ("double", "bigint", "boolean") if kind in present), "string")
