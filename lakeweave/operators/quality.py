"""Row rules, expectations, dataset rules, gates and alerts.

A rule is a ``(name, failing)`` pair: a text and a boolean Column that is true where the rule is
broken. A null outcome is not a failure; use :func:`missing` where null itself is the fault.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import safe_ratio
from ..functions.temporal import minutes_between
from ..functions.text import as_column

Rule = tuple[str, Column]
PASS, FAIL = "PASS", "FAIL"
DEAD_LETTER_COLUMNS = ("_dlq_reason", "_dlq_ts", "_corruption")

# Accepted codes and bounds of the retail orders and of the rides.
ORDER_STATUSES = ("NEW", "PAID", "SHIPPED", "CANCELLED")
CURRENCIES = ("USD", "EUR", "INR")
SHIPMENT_STATUSES = ("CREATED", "IN_TRANSIT", "DELIVERED")
PAYMENT_TYPES = ("credit_card", "cash", "mobile", "corporate")
RIDE_REQUIRED = ("trip_id", "driver_id", "fare_amount", "distance_miles", "pickup_zone")
RIDE_BOUNDS = {
    "fare_amount": (0, 1000),
    "distance_miles": (0.0, 150),
    "passenger_count": (1, 8),
    "pickup_lat": (40.4, 41.0),
    "pickup_lon": (-74.3, -73.5),
}


# --- failing conditions ---------------------------------------------------

def missing(value: Column | str) -> Column:
    return as_column(value).isNull()


def blank(value: Column | str) -> Column:
    text = as_column(value)
    return text.isNull() | (text.cast("string") == "")


def outside(value: Column | str, low: float, high: float) -> Column:
    """Not a number within the closed range; text that does not parse and null are outside."""
    number = as_column(value).cast("string").try_cast("double")
    return ~F.coalesce(number.between(low, high), F.lit(False))


def not_in(value: Column | str, allowed: Sequence[object], null_fails: bool = False) -> Column:
    """Value outside the set; null passes unless ``null_fails``."""
    broken = ~as_column(value).isin(*allowed)
    return F.coalesce(broken, F.lit(True)) if null_fails else broken


# --- row rules ------------------------------------------------------------

def errors_array(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in rule order."""
    none = F.array().cast("array<string>")  # joined lists, as a lambda would leave generated code for every row
    return F.concat(none, *[F.when(failing, F.array(F.lit(name))).otherwise(none) for name, failing in rules])


def with_errors(df: DataFrame, rules: Sequence[Rule], errors: str = "quality_errors",
                flag: str = "is_valid") -> DataFrame:
    return df.withColumn(errors, errors_array(rules)).withColumn(flag, F.size(errors) == 0)


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the predicate holds, all others); a null predicate is a rejection."""
    holds = F.coalesce(valid, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def first_error(rules: Sequence[Rule]) -> Column:
    """Name of the first broken rule, null for a good row."""
    return F.coalesce(*[F.when(failing, F.lit(name)) for name, failing in rules])


def nested_rejects(df: DataFrame, rules: Sequence[Rule], source: str,
                   record: Sequence[str] | None = None) -> DataFrame:
    """Rejected rows as (source, errors, record), the record whole."""
    fields = list(record or df.columns)
    return (df.withColumn("errors", errors_array(rules)).filter(F.size("errors") > 0)
            .select(F.lit(source).alias("source"), "errors", F.struct(*fields).alias("record")))


def contract_rules(required: Sequence[str], allowed: dict[str, Sequence[str]] | None = None,
                   invalid: dict[str, str] | None = None) -> list[Rule]:
    """Rules from a contract: required fields, and code sets for fields that are present."""
    rules: list[Rule] = [(f"missing {name}", blank(name)) for name in required]
    for name, codes in (allowed or {}).items():
        text = (invalid or {}).get(name, f"invalid {name}")
        rules.append((text, ~blank(name) & not_in(name, codes)))
    return rules


# Names and limits of the rules.
def order_rules() -> list[Rule]:
    """The nine rules of the retail order lake; null status or currency is not reported."""
    return [
        ("missing_event_id", missing("event_id")),
        ("missing_order_id", missing("order_id")),
        ("missing_customer_id", missing("customer_id")),
        ("missing_product_id", blank("product_id")),
        ("invalid_event_time", missing("event_time_ts")),
        ("missing_amount", missing("amount")),
        ("non_positive_amount", F.col("amount") <= 0),
        ("invalid_status", not_in("status", ORDER_STATUSES)),
        ("unsupported_currency", not_in("currency", CURRENCIES)),
    ]


def shipment_rules(known_order: str) -> list[Rule]:
    return [
        ("missing shipment_id", blank("shipment_id")),
        ("invalid shipment status", not_in("status", SHIPMENT_STATUSES, null_fails=True)),
        ("unknown order_id", ~F.col(known_order)),
    ]


def shipment_contract() -> list[Rule]:
    return contract_rules(["shipment_id", "order_id", "carrier", "status", "event_ts"],
                          {"status": SHIPMENT_STATUSES}, {"status": "invalid shipment status"})


def ride_reason() -> Column:
    """Reason to reject a ride: its corruption mark, else the first broken rule, else null."""
    distance = F.col("distance_miles").try_cast("double")
    rules = [(f"missing_{name}", blank(name)) for name in RIDE_REQUIRED]
    rules += [("negative_fare", F.col("fare_amount").try_cast("double") < 0),
              ("distance_out_of_range", ~((distance > 0) & (distance < 200)))]
    return F.coalesce(F.col("_corruption"), first_error(rules))


# Names and limits of the rules.
def ride_expectations() -> list[Rule]:
    low_high = RIDE_BOUNDS
    return [
        ("trip_id_not_null", blank("trip_id")),
        ("driver_id_not_null", blank("driver_id")),
        ("fare_amount_in_range", outside("fare_amount", *low_high["fare_amount"])),
        ("distance_in_range", outside("distance_miles", *low_high["distance_miles"])),
        ("passengers_in_range", outside("passenger_count", *low_high["passenger_count"])),
        ("payment_type_in_set", not_in("payment_type", PAYMENT_TYPES, null_fails=True)),
        ("pickup_lat_in_nyc", outside("pickup_lat", *low_high["pickup_lat"])),
        ("pickup_lon_in_nyc", outside("pickup_lon", *low_high["pickup_lon"])),
    ]


def dead_letters(df: DataFrame, rules: Sequence[Rule], reason: str = "_dlq_reason") -> DataFrame:
    """One row per (row, broken rule)."""
    return df.withColumn(reason, F.explode(errors_array(rules)))


def strip_dead_letter(df: DataFrame, columns: Sequence[str] = DEAD_LETTER_COLUMNS) -> DataFrame:
    """Dead letters as fresh source rows, to go through the same validation again."""
    return df.drop(*columns)


# --- batch results --------------------------------------------------------

def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed rows per rule, from one aggregate over one scan."""
    totals = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(failing).alias(f"f{i}") for i, (_, failing) in enumerate(rules)])
    entries = F.array(*[F.struct(F.lit(name).alias("rule"), (F.col("rows") - F.col(f"f{i}")).alias("passed"),
                                 F.col(f"f{i}").alias("failed")) for i, (name, _) in enumerate(rules)])
    return totals.select(F.inline(entries))


def batch_score(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passed and failed, and the percentage of single checks that passed (100 * passed / checks)."""
    errors = F.size(errors_array(rules))
    row = df.select(errors.alias("__e")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__e") == 0).alias("passed_rows"),
        F.coalesce(F.sum("__e"), F.lit(0)).alias("failed_checks"))
    checks = F.col("rows") * len(rules)
    return row.select("rows", "passed_rows", (F.col("rows") - F.col("passed_rows")).alias("failed_rows"),
                      "failed_checks", (F.lit(100.0) * (checks - F.col("failed_checks"))
                                        / F.greatest(checks, F.lit(1))).alias("score"))


def top_failing(counts: DataFrame, n: int = 3) -> DataFrame:
    return counts.orderBy(F.desc("failed"), "rule").limit(n)


# --- dataset rules --------------------------------------------------------

def dataset_rules(df: DataFrame, checks: Sequence[tuple[str, Column, Column]], checked_at: Column) -> DataFrame:
    """Evaluate rules over a whole table with one aggregate.

    A check is (rule name, aggregate Column giving the measure, condition over ``measure``).
    Results are (rule, status, measure, rows_scanned, checked_at); a null outcome fails.
    """
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[measure.cast("double").alias(f"m{i}") for i, (_, measure, _) in enumerate(checks)])
    entries = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"m{i}").alias("measure"))
                        for i, (name, _, _) in enumerate(checks)])
    flat = row.select("rows", F.inline(entries))
    verdict = F.lit(None).cast("boolean")
    for name, _, condition in reversed(list(checks)):
        verdict = F.when(F.col("rule") == name, condition).otherwise(verdict)
    return flat.select(
        "rule", F.when(F.coalesce(verdict, F.lit(False)), PASS).otherwise(FAIL).alias("status"),
        "measure", F.col("rows").alias("rows_scanned"), checked_at.alias("checked_at"))


def share_of(failing: Column) -> Column:
    """Aggregate: percentage of rows that meet the condition, 0 for an empty table."""
    return safe_ratio(F.lit(100.0) * F.count_if(failing), F.count(F.lit(1)))


def count_of(failing: Column) -> Column:
    return F.count_if(failing)


def age_seconds(stamp_ms: str, now_ms: Column) -> Column:
    """Aggregate: seconds since the freshest record, null for an empty table."""
    return (now_ms - F.max(F.coalesce(F.col(stamp_ms), F.lit(0)))) / 1000


# Names and limits of the rules.
def rule_table(kind: str, now_ms: Column | None = None, late_cutoff_ms: Column | None = None
               ) -> list[tuple[str, Column, Column]]:
    """Standing checks per silver table: quakes, observations, positions, regions."""
    measure = F.col("measure")
    falsy = lambda name: F.col(name).isNull() | (F.col(name) == "")
    if kind == "seismic_events":
        return [("seismic.has_magnitude", count_of(F.col("magnitude").isNull() | (F.col("magnitude") == 0)), measure == 0),
                ("seismic.freshness", age_seconds("ingested_ms", now_ms), measure <= 600)]
    if kind == "noaa_observations":
        return [("noaa.obs_coords_present", share_of(F.col("lat").isNull() | F.col("lon").isNull()), measure < 5.0),
                ("noaa.freshness", age_seconds("ingested_ms", now_ms), measure <= 1800)]
    if kind == "ogn_positions":
        late = F.coalesce(F.col("ts_ms"), F.lit(0)) < late_cutoff_ms
        return [("ogn.positions_have_pk", share_of(falsy("address") & falsy("callsign")), measure < 10.0),
                ("ogn.late_events_lt_1pct", share_of(late), measure < 1.0)]
    if kind == "regions":
        return [("config.regions_active_min", count_of(F.coalesce(F.col("is_active"), F.lit(False))), measure >= 50)]
    raise ValueError(f"no standing checks for {kind}")


def violation_counts(layers: dict[str, tuple[DataFrame | None, Column]]) -> list[tuple[str, DataFrame | None]]:
    """Violations per layer; a layer whose table is missing has none to count."""
    return [(layer, None if df is None else df.agg(F.count_if(broken).alias("violations")))
            for layer, (df, broken) in layers.items()]


def layer_checks(layers: dict[str, tuple[DataFrame | None, Column]]) -> DataFrame:
    """(layer, violations, passed) rows; -1 violations and passed for a missing table."""
    frames = [df.select(F.lit(layer).alias("layer"), "violations", (F.col("violations") == 0).alias("passed"))
              for layer, df in violation_counts(layers) if df is not None]
    absent = [(layer, -1, True) for layer, (df, _) in layers.items() if df is None]
    if absent or not frames:
        frames.append(SparkSession.active().createDataFrame(absent, "layer string, violations bigint, passed boolean"))
    return reduce(DataFrame.unionByName, frames)


def bronze_gate(orders: DataFrame, customers: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Checks a raw load must pass: both tables filled, no null ids, no negative amounts."""
    measure = F.col("measure")
    now = F.current_timestamp()
    first = dataset_rules(orders, [
        ("bronze_orders_not_empty", F.count(F.lit(1)), measure > 0),
        ("no_null_order_ids", count_of(F.col("order_id").isNull()), measure == 0),
        ("no_negative_amounts", count_of(F.col(amount) < 0), measure == 0)], now)
    second = dataset_rules(customers, [("customers_loaded", F.count(F.lit(1)), measure > 0)], now)
    return first.unionByName(second)


def freshness(df: DataFrame, loaded_at: str, as_of: Column) -> DataFrame:
    """Row count, latest load and its age in minutes (-1 for an empty table)."""
    row = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(loaded_at).alias("latest"))
    return row.withColumn("age_minutes", F.coalesce(minutes_between(as_of, F.col("latest")), F.lit(-1.0)))


# Names and limits of the rules.
def sla_issues(metrics: DataFrame, stale_minutes: float = 60, least_pass_rate: float = 0.95) -> DataFrame:
    """Texts for every broken service level of a one-row metrics table."""
    rules = [(f"Bronze data is stale (>{stale_minutes:g} min old)", F.col("bronze_freshness_minutes") > stale_minutes),
             (f"Quality pass rate below {least_pass_rate:g}", F.col("quality_pass_rate") < least_pass_rate),
             ("Silver layer is empty", F.col("silver_orders_count") == 0)]
    return metrics.select(F.explode(errors_array(rules)).alias("issue"))


def decide_proposals(proposals: DataFrame, policy: str = "recommended_policy") -> DataFrame:
    """Schema proposals whose policy is ``reject`` are refused, all others accepted."""
    refused = F.coalesce(F.col(policy) == "reject", F.lit(False))
    return proposals.withColumn("decision", F.when(refused, "REJECT").otherwise("ACCEPT"))


def assert_metrics(actual: dict[str, int], expected: dict[str, int]) -> None:
    """Stop a run whose layer contract does not hold."""
    wrong = {name: (actual.get(name), value) for name, value in expected.items() if actual.get(name) != value}
    if wrong:
        raise AssertionError(f"layer contract broken (actual, expected): {wrong}")


def alert_rows(metrics: DataFrame, rules: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """Alert rows (all metric columns, alert, severity) for every rule a metrics row meets."""
    found = F.array(*[F.when(condition, F.struct(F.lit(name).alias("alert"), F.lit(severity).alias("severity")))
                      for name, condition, severity in rules])
    hits = F.filter(found, lambda hit: hit.isNotNull())
    return metrics.withColumn("__hit", F.explode(hits)).select(*metrics.columns, "__hit.alert", "__hit.severity")


def standing_alerts() -> list[tuple[str, Column, str]]:
    """Alert conditions on windowed pipeline metrics."""
    return [("HighErrorRate", F.col("invalid_per_second") > 5, "warning"),
            ("SurgeActive", F.col("surge_multiplier") > 1.5, "info"),
            ("DeadLetterBacklog", F.col("dlq_size") > 100, "warning")]


def result_alerts(results: DataFrame, as_of: Column, checked_at: str = "checked_at", fail_minutes: float = 10,
                  silent_minutes: float = 15) -> DataFrame:
    """Alerts on stored rule results: rules failing within ``fail_minutes``, freshness rules failing within
    ``silent_minutes``, and one row when no result at all arrived within ``silent_minutes``."""
    failed = F.col("status") == FAIL
    age = minutes_between(as_of, F.col(checked_at))
    recent = results.withColumn("__age", age).filter(F.col("__age").between(0, silent_minutes))
    per_rule = recent.groupBy("rule").agg(F.count_if(failed & (F.col("__age") <= fail_minutes)).alias("failing"),
                                          F.count_if(failed).alias("stale"))
    named = alert_rows(per_rule, [
        ("QualityRuleFailing", F.col("failing") > 0, "warning"),
        ("IngestorStale", F.col("rule").endswith(".freshness") & (F.col("stale") > 0), "critical")])
    silent = recent.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0)
    return named.select("rule", "alert", "severity").unionByName(silent.select(
        F.lit("*").alias("rule"), F.lit("NoQualityResults").alias("alert"), F.lit("warning").alias("severity")))
