"""Money, distance and step functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column

# Earth radius in miles, metered fare tariff, surge and segment steps,
# magnitude buckets.
EARTH_RADIUS_MILES = 3958.8
FARE_BASE = 2.55
FARE_PER_MILE = 1.75
FARE_PER_MINUTE = 0.35
SURGE_STEPS = ((0.5, 1.0), (1.0, 1.2), (2.0, 1.6), (3.0, 2.0))
SURGE_TOP = 2.5
SURGE_NO_SUPPLY = 3.0
SEGMENT_FLOORS = ((200, "Premium"), (50, "Regular"))
SEGMENT_REST = "New"
MAGNITUDE_STEPS = ((3.0, "<3"), (4.5, "3-4.5"), (5.5, "4.5-5.5"), (6.5, "5.5-6.5"))
MAGNITUDE_TOP = "6.5+"


def step_below(value: Column | str, steps: Sequence[tuple[float, object]], rest: object) -> Column:
    """Label of the first step the value lies below; null and larger values give ``rest``."""
    amount = as_column(value)
    label = F.lit(rest)
    for limit, name in reversed(steps):
        label = F.when(amount < limit, F.lit(name)).otherwise(label)
    return label


def step_from(value: Column | str, floors: Sequence[tuple[float, object]], rest: object) -> Column:
    """Label of the first floor the value reaches; null and smaller values give ``rest``."""
    amount = as_column(value)
    label = F.lit(rest)
    for floor, name in reversed(floors):
        label = F.when(amount >= floor, F.lit(name)).otherwise(label)
    return label


def magnitude_bucket(magnitude: Column | str) -> Column:
    return step_below(magnitude, MAGNITUDE_STEPS, MAGNITUDE_TOP)


def customer_segment(revenue: Column | str) -> Column:
    return step_from(revenue, SEGMENT_FLOORS, SEGMENT_REST)


def surge_multiplier(demand: Column | str, supply: Column | str) -> Column:
    """Price step for demand per idle unit; demand without any supply has its own price."""
    wanted, idle = as_column(demand), as_column(supply)
    by_ratio = step_below(wanted / F.greatest(idle, F.lit(1)), SURGE_STEPS, SURGE_TOP)
    return F.when((idle == 0) & (wanted > 0), F.lit(SURGE_NO_SUPPLY)).otherwise(by_ratio)


def safe_ratio(part: Column | str, whole: Column | str, empty: float = 0.0) -> Column:
    """``part / whole``, or ``empty`` where the whole is zero or null."""
    denominator = as_column(whole)
    return F.when(denominator > 0, as_column(part) / denominator).otherwise(F.lit(empty))


def haversine_miles(lat1: Column | str, lon1: Column | str,
                    lat2: Column | str, lon2: Column | str) -> Column:
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    d_phi = phi2 - phi1
    d_lambda = F.radians(as_column(lon2)) - F.radians(as_column(lon1))
    half = F.pow(F.sin(d_phi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(d_lambda / 2), 2)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(half))


def squared_distance(lat1: Column | str, lon1: Column | str,
                     lat2: Column | str, lon2: Column | str) -> Column:
    d_lat = as_column(lat1) - as_column(lat2)
    d_lon = as_column(lon1) - as_column(lon2)
    return d_lat * d_lat + d_lon * d_lon


def metered_fare(miles: Column | str, minutes: Column | str, surge: Column | float = 1.0) -> Column:
    """Struct of the deterministic fare parts for one trip."""
    distance = F.lit(FARE_PER_MILE) * as_column(miles)
    duration = F.lit(FARE_PER_MINUTE) * as_column(minutes)
    factor = F.lit(surge) if isinstance(surge, (int, float)) else surge
    return F.struct(
        F.lit(FARE_BASE).alias("base_fare"),
        F.round(distance, 2).alias("distance_charge"),
        F.round(duration, 2).alias("time_charge"),
        factor.alias("surge_multiplier"),
        F.round((F.lit(FARE_BASE) + distance + duration) * factor, 2).alias("fare_amount"),
    )


def order_charges(amount: Column | str, tax: float = 0.10, discount: float = 0.05,
                  discount_from: float = 100) -> dict[str, Column]:
    """Taxed amount, volume discount and net amount of an order."""
    value = as_column(amount)
    taxed = value * F.lit(1 + tax)
    off = F.when(value >= discount_from, value * F.lit(discount)).otherwise(F.lit(0.0))
    return {"amount_with_tax": taxed, "discount_amount": off, "net_amount": taxed - off}


def converted(amount: Column | str, rate: Column | str, digits: int = 2) -> Column:
    return F.round(as_column(amount) * as_column(rate), digits)


def money(value: Column | str, scale: int = 2) -> Column:
    """Exact decimal of a double amount, so that sums do not depend on row order."""
    return as_column(value).cast(f"decimal(18,{scale})")
