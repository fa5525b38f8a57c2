"""Bounded samples of labelled rows for fitting models on the driver, and hold-out flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """True where crc32 of the id as text leaves ``rest``; a null id is never held out."""
    key = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(key, F.lit(mod)) == rest, F.lit(False))


def bounded(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """All rows, or about ``bound`` of them taken by a hash of the id if there are more. One extra count."""
    count = rows.count()
    if count <= bound:
        return rows
    share = int((bound / count) * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("fit")), F.lit(1 << 30)) < share)


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, usable: Column,
             bound: int) -> DataFrame:
    """(id, text, label 0/1) of at most about ``bound`` labelled documents for which ``usable`` (over the label table) holds.

    A document that is labelled twice gets its larger label; null labels and unlabelled documents are left out. The
    label sample has a proven bound, so it is broadcast and the documents are scanned without a shuffle.
    """
    chosen = (labels.where(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label")))
    chosen = bounded(chosen, "id", bound)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "id")
