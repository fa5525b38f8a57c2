"""Time parsing and epoch arithmetic that never fails on dirty text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import as_column

MICROS = {"s": 1_000_000, "ms": 1_000, "us": 1}


def parse_instant(value: Column | str) -> Column:
    """ISO-8601 text to timestamp; anything else becomes null."""
    return F.try_to_timestamp(as_column(value))


def strict_date(value: Column | str, mask: str = "yyyy-MM-dd") -> Column:
    """Date from text that follows ``mask`` exactly; other text becomes null."""
    return F.try_to_timestamp(as_column(value), F.lit(mask)).cast("date")


def with_event_time(df: DataFrame, source: str, timestamp: str, date: str) -> DataFrame:
    """Parse ``source`` into a timestamp column and derive its date."""
    parsed = parse_instant(source)
    return df.withColumns({timestamp: parsed, date: parsed.cast("date")})


def from_epoch(value: Column | str, unit: str = "ms") -> Column:
    """Epoch number in ``unit`` (s, ms, us) to timestamp."""
    return F.timestamp_micros(as_column(value).cast("bigint") * F.lit(MICROS[unit]))


def epoch_iso(value: Column | str, unit: str = "ms") -> Column:
    """Epoch number to ``yyyy-MM-ddTHH:mm:ssZ`` text, with micros only when there are any."""
    instant = from_epoch(value, unit)
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    fine = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    has_fraction = F.pmod(F.unix_micros(instant), F.lit(1_000_000)) != 0
    return F.concat(F.when(has_fraction, fine).otherwise(whole), F.lit("Z"))


def micros(value: Column | str) -> Column:
    """Microseconds since the epoch for timestamp and timestamp_ntz alike (session time zone UTC)."""
    return F.unix_micros(as_column(value).cast("timestamp"))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)


def time_chunk(value_us: Column, width_us: int) -> Column:
    """Number of the ``width_us`` wide slot a microsecond value lies in, in exact integers."""
    return ((value_us - F.pmod(value_us, F.lit(width_us))) / F.lit(width_us)).cast("bigint")


def partition_parts(value: Column | str, hour: bool = False) -> dict[str, Column]:
    """Zero-padded ``year``/``month``/``day``(/``hour``) texts for path partitions."""
    stamp = as_column(value)
    masks = {"year": "yyyy", "month": "MM", "day": "dd"} | ({"hour": "HH"} if hour else {})
    return {name: F.date_format(stamp, mask) for name, mask in masks.items()}
