"""Per-key selection and de-duplication.

A rank filter ``<= n`` lets Spark cut every map partition to n rows per key before the
shuffle, so a key that holds a third of the table still sends only n rows per task.
Where all copies of a key must survive (quarantine, ties) the work is split by salt first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_column

DUPLICATE_FLAG = "is_duplicate"


def _share(salts: int | None) -> Column:
    """The share of a row's key: its map partition, so that a share never outgrows one task's input."""
    own = F.spark_partition_id()
    return own if salts is None else F.pmod(own, F.lit(salts))


def newest(*columns: str) -> list[Column]:
    """Descending order with nulls last on each column."""
    return [F.col(name).desc_nulls_last() for name in columns]


def oldest(*columns: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in columns]


def top_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column],
                n: int = 1, rank_column: str | None = None) -> DataFrame:
    """First ``n`` rows of each key in ``order``; make the order total, it decides ties."""
    rank = rank_column or "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return ranked if rank_column else ranked.drop(rank)


def latest_by_key(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order_columns`` per key."""
    return top_per_key(df, keys, newest(*order_columns))


def first_by_key(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order_columns`` per key."""
    return top_per_key(df, keys, oldest(*order_columns))


def latest_known(df: DataFrame, key: str, time: str, arrival: Sequence[str]) -> DataFrame:
    """Latest row per non-null key; a null time counts as 0 and the later arrival wins a tie."""
    order = [F.coalesce(F.col(time), F.lit(0)).desc(), *newest(*arrival)]
    return top_per_key(df.filter(F.col(key).isNotNull()), [key], order)


def latest_with_ties(df: DataFrame, keys: Sequence[str], time: str, salts: int | None = None) -> DataFrame:
    """Every row that carries its key's greatest ``time``.

    A salted rank first drops, before any shuffle, what cannot win inside its share of the
    key; the real maximum per key is then joined back, a join AQE can split on a hot key.
    """
    share = _share(salts)
    window = Window.partitionBy(*keys, "__share").orderBy(F.col(time).desc_nulls_last())
    candidates = (df.filter(F.col(time).isNotNull()).withColumn("__share", share)
                  .withColumn("__rank", F.rank().over(window))
                  .filter(F.col("__rank") == 1).drop("__rank", "__share"))
    best = (df.groupBy(*[F.col(key).alias(f"__k{i}") for i, key in enumerate(keys)])
            .agg(F.max(time).alias("__best")))
    match = F.col(time) == F.col("__best")
    for i, key in enumerate(keys):
        match = match & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    return candidates.join(best, match).select(*df.columns)


def last_n_per_key(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str], n: int) -> DataFrame:
    return top_per_key(df, keys, newest(*order_columns), n)


def trail_per_key(df: DataFrame, keys: Sequence[str], time: str, tie: str,
                  payload: Sequence[str], n: int = 40, trail: str = "trail") -> DataFrame:
    """Latest values per key plus its last ``n`` points, oldest first."""
    points = last_n_per_key(df, keys, [time, tie], n)
    fields = [time, tie, *[name for name in payload if name not in (time, tie)]]
    return (points.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(trail))
            .withColumns({name: F.element_at(trail, -1)[name] for name in fields}))


def unique_with_count(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str],
                      count_column: str = "copies") -> DataFrame:
    """First row per key and how many rows had that key.

    One aggregate whose map side already folds each key, instead of a window over whole groups.
    """
    rest = [name for name in df.columns if name not in keys and name not in order_columns]
    # a null order value comes last, as in first_by_key
    flags = [F.col(name).isNull().alias(f"__null_{i}") for i, name in enumerate(order_columns)]
    order = [column for pair in zip(flags, map(F.col, order_columns)) for column in pair]
    row = F.min_by(F.struct(*order_columns, *rest), F.struct(*order, F.xxhash64(*rest) if rest else F.lit(0))).alias("__first")
    folded = df.groupBy(*keys).agg(row, F.count(F.lit(1)).alias(count_column))
    columns = [F.col(name) if name in keys else F.col(f"__first.{name}").alias(name)
               for name in df.columns]
    return folded.select(*columns, count_column)


def flag_duplicates(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str],
                    salts: int | None = None, flag: str = DUPLICATE_FLAG) -> DataFrame:
    """Mark every row after the first of its key, in the given order.

    Ties are broken by content, so only exact copies are interchangeable. Each key is first
    ranked inside its salted shares, one per map partition (or ``salts`` of them); only the share winners
    meet in the second ranking. The salt is the map partition, which a re-run task keeps.
    """
    content = F.xxhash64(*[name for name in df.columns if name not in order_columns])
    order = [*oldest(*order_columns), F.col("__content").asc()]
    salted = df.withColumns({"__content": content,
                             "__salt": _share(salts)})
    inner = Window.partitionBy(*keys, "__salt").orderBy(*order)
    shared = salted.withColumn("__head", F.row_number().over(inner) == 1)
    outer = Window.partitionBy(*keys, F.when(F.col("__head"), F.lit(-1)).otherwise(F.col("__salt"))).orderBy(*order)
    first = F.col("__head") & (F.row_number().over(outer) == 1)
    return shared.withColumn(flag, ~first).select(*df.columns, flag)


def split_duplicates(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str],
                     salts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(first row per key, all later copies). The first branch alone needs no full shuffle.

    ``order_columns`` plus content decide which row is first in both branches alike.
    """
    content = F.xxhash64(*[name for name in df.columns if name not in order_columns])
    kept = top_per_key(df.withColumn("__content", content), keys,
                       [*oldest(*order_columns), F.col("__content").asc()]).drop("__content")
    flagged = flag_duplicates(df, keys, order_columns, salts)
    return kept, flagged.filter(F.col(DUPLICATE_FLAG)).drop(DUPLICATE_FLAG)


def business_key_dedup(df: DataFrame, candidate_keys: Sequence[str], survivor: str) -> DataFrame:
    """One row per business key (those of ``candidate_keys`` present), the least ``survivor`` stays."""
    keys = [name for name in candidate_keys if name in df.columns]
    return first_by_key(df, keys, [survivor])


def newest_n(df: DataFrame, time: str, tie: str, n: int) -> DataFrame:
    """The ``n`` most recently seen rows of the whole table."""
    return df.orderBy(*newest(time, tie)).limit(n)


def top_k_in_group(df: DataFrame, group: Sequence[str], measure: str, ties: Sequence[str], k: int,
                   rank_column: str = "rank") -> DataFrame:
    """The ``k`` largest measures of each group, numbered."""
    order = [F.col(measure).desc_nulls_last(), *oldest(*ties)]
    return top_per_key(df, group, order, k, rank_column)


def top_n(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """Ordered report of at most ``n`` rows, all for None; end the order with the group key."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def modal_value(df: DataFrame, keys: Sequence[str], value: Column | str, alias: str) -> DataFrame:
    """Most frequent non-null ``value`` per key, the lowest on a tie.

    Counted as ordinary group rows, so no task ever holds the value map of a whole key.
    """
    counts = df.groupBy(*keys, as_column(value).alias("__value")).agg(F.count(as_column(value)).alias("__n"))
    return counts.groupBy(*keys).agg(mode_of_counts("__value", "__n").alias(alias))


def mode_of_counts(value: str, count: str) -> Column:
    """Aggregate over (value, count) rows: the value counted most, lowest on a tie, nulls ignored."""
    present = F.col(value).isNotNull()
    best = F.min(F.when(present, F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))))
    return best["v"]
