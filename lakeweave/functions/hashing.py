"""Content hashes over a canonical JSON rendering."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _canonical(column: Column, kind: T.DataType) -> Column:
    """Rebuild structs (also inside arrays) with their fields in name order."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda field: field.name)
        rebuilt = F.struct(*[_canonical(column[field.name], field.dataType).alias(field.name)
                             for field in fields])
        return F.when(column.isNotNull(), rebuilt)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(column, lambda item: _canonical(item, kind.elementType))
    return column


def canonical_json(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Compact JSON of the named columns: keys sorted at every level, nulls kept."""
    wanted = set(columns or df.columns)
    fields = sorted((f for f in df.schema.fields if f.name in wanted), key=lambda f: f.name)
    body = F.struct(*[_canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    return F.to_json(body, {"ignoreNullFields": "false"})


def record_hash(df: DataFrame, columns: Iterable[str] | None = None, length: int = 16) -> Column:
    """First ``length`` hex digits of the SHA-256 of the canonical JSON."""
    return F.substring(F.sha2(canonical_json(df, columns), 256), 1, length)
