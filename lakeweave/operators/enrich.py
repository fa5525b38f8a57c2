"""Dimension lookups, membership, stream-table enrichment and threshold rules.

Equi-joins carry no broadcast hint: Spark broadcasts a dimension when file statistics or AQE's
measured shuffle size allow it, and otherwise sort-merges with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from .keyed import top_per_key

MATCHED = "MATCHED"
BROADCAST_ROWS = 50_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting at most ``max_rows + 1`` rows of ``df``.

    A larger table comes back unhinted and is joined by shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def last_row_wins(dimension: DataFrame, keys: Sequence[str], load_order: Sequence[str]) -> DataFrame:
    """Unique dimension keys: the row loaded last replaces earlier ones."""
    return top_per_key(dimension, keys, [F.col(c).desc_nulls_last() for c in load_order])


def lookup(df: DataFrame, dimension: DataFrame, keys: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Left lookup on unique dimension keys; columns without a match take their default."""
    wanted = dimension.select(*keys, *defaults)
    joined = df.join(wanted, list(keys), "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})


def enrich(df: DataFrame, dimension: DataFrame, keys: Sequence[str], columns: Sequence[str],
           flag: str | None = None, probe: str | None = None, missing: str = "MISSING",
           defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join that can record whether the dimension had the key and fill defaults afterwards.

    ``probe`` names the dimension column whose null means "no match".
    """
    joined = df.join(dimension.select(*keys, *columns), list(keys), "left")
    changes: dict[str, Column] = {}
    if flag:
        absent = F.col(probe or columns[0]).isNull()
        changes[flag] = F.when(absent, F.lit(missing)).otherwise(F.lit(MATCHED))
    for name, value in (defaults or {}).items():
        changes[name] = F.coalesce(F.col(name), F.lit(value))
    return joined.withColumns(changes) if changes else joined


def members(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known.select(*keys), list(keys), "left_semi")


def pending(df: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has not been processed yet."""
    return df.join(processed.select(*keys), list(keys), "left_anti")


def with_membership(df: DataFrame, known: DataFrame, key: str, known_key: str, flag: str) -> DataFrame:
    """Boolean column telling whether ``key`` occurs in ``known``; null keys are not members."""
    keys = known.select(F.col(known_key).alias("__member")).distinct()
    return (df.join(keys, F.col(key) == F.col("__member"), "left")
            .withColumn(flag, F.col("__member").isNotNull()).drop("__member"))


def with_table_row(facts: DataFrame, table: DataFrame, key: str, columns: dict[str, Column], flag: str) -> DataFrame:
    """Facts with the table's columns and a flag that tells whether the table, one row per key, holds their key."""
    lookup_side = table.select(F.col(key).alias("__key"), F.lit(True).alias(flag), *[c.alias(n) for n, c in columns.items()])
    return (facts.join(lookup_side, F.col(key) == F.col("__key"), "left").drop("__key")
            .withColumn(flag, F.coalesce(flag, F.lit(False))))


def stream_table_join(facts: DataFrame, table: DataFrame, key: str,
                      columns: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(facts with the table's columns, facts whose key the table lacks), the two halves of one left join."""
    flagged = with_table_row(facts, table, key, columns, "__hit")
    return flagged.filter("__hit").drop("__hit"), flagged.filter("NOT __hit").select(*facts.columns)


def driver_columns() -> dict[str, Column]:
    """Enrichment of a ride by its driver; absent vehicle parts read ``None``."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("None"))
    return {
        "driver_name": F.col("full_name"),
        "driver_rating": F.col("rating").cast("double"),
        "vehicle": F.concat_ws(" ", part("vehicle_year"), part("vehicle_make"), part("vehicle_model")),
        "license_number": F.col("license_number"),
    }


def harmonise_shipments(df: DataFrame, now: Column | None = None) -> DataFrame:
    """One shipment layout from two feeds that name status and time differently."""
    have = set(df.columns)

    def any_of(*names: str) -> Column:
        found = [blank_to_null(name) for name in names if name in have]
        return F.coalesce(*found, F.lit("")) if found else F.lit("")

    stamp = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    event_ts = any_of("event_ts", "updated_at")
    return df.select(
        *[any_of(name).alias(name) for name in ("shipment_id", "order_id", "carrier")],
        any_of("status", "shipment_status").alias("status"),
        F.when(event_ts == "", stamp).otherwise(event_ts).alias("event_ts"))


def compare_by(op: Column, value: Column, threshold: Column) -> Column:
    """Comparison whose operator is held in a column; unknown operators are false."""
    return (F.when(op == ">=", value >= threshold).when(op == ">", value > threshold)
            .when(op == "<=", value <= threshold).when(op == "<", value < threshold)
            .when(op == "=", value == threshold).when(op == "!=", value != threshold)
            .otherwise(F.lit(False)))


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                    name: str = "metric", value: str = "metric_value") -> DataFrame:
    doubles = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return doubles.unpivot(list(ids), list(metrics), name, value).filter(F.col(value).isNotNull())


def evaluate_thresholds(readings: DataFrame, thresholds: DataFrame, source: str,
                        ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One alert per (reading, active rule) whose comparison holds.

    There are only a few (source, metric) pairs, so a shuffle on them would be skewed: the rules
    are broadcast once counted, and joined with AQE skew splitting if there are too many.
    """
    rules = thresholds.filter((F.col("source") == source) & F.col("is_active")).select(
        F.col("metric").alias("__metric"), "threshold_id", "op", "threshold", "severity")
    long = unpivot_metrics(readings, ids, metrics)
    return (long.join(broadcast_if_small(rules), F.col("metric") == F.col("__metric"))
            .filter(compare_by(F.col("op"), F.col("metric_value"), F.col("threshold")))
            .drop("__metric"))


def default_if_empty(thresholds: DataFrame, condition: Column, value: str, default: float) -> Column:
    """Scalar subquery: least ``value`` under ``condition``, or the default without any row."""
    least = thresholds.filter(condition).agg(F.min(value).alias("least")).scalar()
    return F.coalesce(least, F.lit(default))
