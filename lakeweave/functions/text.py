"""String cleaning and key derivation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str, case: str | None = None) -> Column:
    """Trim both sides; ``case`` is None, ``upper``, ``lower`` or ``title``."""
    text = F.trim(as_column(value))
    if case is None:
        return text
    return {"upper": F.upper, "lower": F.lower, "title": F.initcap}[case](text)


def blank_to_null(value: Column | str) -> Column:
    text = F.trim(as_column(value))
    return F.when(text != "", text)


def first_non_blank(*values: Column | str) -> Column:
    """First argument that is neither null nor blank, trimmed."""
    return F.coalesce(*[blank_to_null(value) for value in values])


def international_phone(value: Column | str) -> Column:
    """A leading ``00`` becomes ``+``; null becomes the empty string."""
    text = F.trim(F.coalesce(as_column(value), F.lit("")))
    return F.regexp_replace(text, "^00", "+")


def distinct_prefixes(codes: Column | str, length: int = 2, separator: str = ",") -> Column:
    """Sorted distinct prefixes of a code array as one text, null when there are none."""
    prefixes = F.transform(F.coalesce(as_column(codes), F.array().cast("array<string>")),
                           lambda code: F.substring(code, 1, length))
    present = F.filter(F.array_sort(F.array_distinct(prefixes)), lambda code: code.isNotNull())
    return F.when(F.size(present) > 0, F.array_join(present, separator))


def file_name(path: Column | str) -> Column:
    """Last component of a path written with either separator."""
    return F.regexp_extract(as_column(path), r"[^/\\]+$", 0)


def clean_columns(df: DataFrame, upper: Sequence[str] = (), lower: Sequence[str] = (),
                  title: Sequence[str] = (), plain: Sequence[str] = (),
                  casts: dict[str, str] | None = None) -> DataFrame:
    """Trim and case-fold code columns and cast the rest, in one projection.

    Casts never fail: text that does not parse becomes null, for a quality rule to report.
    """
    changes = {name: trimmed(name, "upper") for name in upper}
    changes |= {name: trimmed(name, "lower") for name in lower}
    changes |= {name: trimmed(name, "title") for name in title}
    changes |= {name: trimmed(name) for name in plain}
    changes |= {name: F.col(name).try_cast(kind) for name, kind in (casts or {}).items()}
    return df.withColumns(changes)


def lower_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])


def prefix_number(prefix: str, number: Column | str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(as_column(number).cast("string"), width, "0"))
