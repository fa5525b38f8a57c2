"""Running totals, trailing ranges and event-time windows that split hot keys by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import micros, time_chunk


def running_totals(df: DataFrame, key: str, time: str, tie: str, sums: dict[str, Column],
                   count: str = "running_count", chunk_seconds: int = 3_600,
                   chunk: Column | None = None) -> DataFrame:
    """Running sums and count per key in (time, tie) order, the current row included.

    A key is cut into time chunks. Chunk totals are folded map-side, and each chunk gets one more
    row at its start that carries the totals of the chunks before it; rows are then accumulated
    inside their chunk only, in a single shuffle and without a join.
    Where very many rows of a key share an instant, pass ``chunk``: any expression that never
    decreases along (time, tie), such as a struct of the time and a range number of the tie.
    """
    chunk = time_chunk(micros(time), chunk_seconds * 1_000_000) if chunk is None else chunk
    values = [f"__v_{name}" for name in sums]
    rows = df.withColumns({"__chunk": chunk, "__n": F.lit(1).cast("bigint"), "__row": F.lit(1)}
                          | {f"__v_{name}": column for name, column in sums.items()})
    totals = rows.groupBy(key, "__chunk").agg(F.sum("__n").alias("__n"), *[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, "__chunk", F.lit(0).alias("__row"),
                            *[F.sum(v).over(earlier).alias(v) for v in ("__n", *values)])
    inside = Window.partitionBy(key, "__chunk").orderBy("__row", time, tie).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = lambda v: F.coalesce(F.sum(v).over(inside), F.lit(0))
    return (rows.unionByName(carried, allowMissingColumns=True)
            .select("__row", *df.columns, total("__n").alias(count),
                    *[total(f"__v_{name}").alias(name) for name in sums])
            .filter(F.col("__row") == 1).drop("__row"))


def trailing_range(df: DataFrame, keys: Sequence[str], time: str, seconds: float,
                   measures: dict[str, Column], chunk_seconds: int = 3_600) -> DataFrame:
    """Aggregates over ``[time - seconds, time]`` for every row, both ends included.

    ``measures`` map output names to aggregate columns such as ``F.sum("fare")``. Keys are cut
    into time chunks; rows near the end of a chunk are also sent to the chunks that look back
    on them, so each task sees one chunk of one key plus its halo. Any aggregate will do, but each row is summed up anew from its
    frame: ``trailing_sums`` and ``trailing_extremes`` take time in proportion to the rows instead.
    """
    span, width = int(seconds * 1_000_000), chunk_seconds * 1_000_000
    home = time_chunk(F.col("__us"), width)
    last = time_chunk(F.col("__us") + F.lit(span), width)
    # rows without a time form a chunk of their own
    chunks = F.coalesce(F.sequence("__home", last), F.array(F.lit(None).cast("bigint")))
    spread = (df.withColumn("__us", micros(time)).withColumn("__home", home)
              .withColumn("__chunk", F.explode(chunks)))
    window = Window.partitionBy(*keys, "__chunk").orderBy("__us").rangeBetween(-span, Window.currentRow)
    return (spread.select("*", *[column.over(window).alias(name) for name, column in measures.items()])
            .filter(F.col("__chunk").eqNullSafe(F.col("__home")))
            .select(*df.columns, *measures))


def trailing_sums(df: DataFrame, keys: Sequence[str], time: str, seconds: float, sums: dict[str, Column],
                  count: str = "trailing_count", chunk_seconds: int = 3_600) -> DataFrame:
    """Sums and row count over ``[time - seconds, time]`` for every row, both ends included, rows of the same instant too.

    Every row enters at its time and leaves just after time + seconds, so that one running sum per key holds what is inside.
    It is cut into time chunks as running totals are: chunk totals are folded map-side, and each chunk begins with what the
    chunks before it left over. Work follows the number of rows, however many lie in a range, and chunks need not be as
    long as the range.

    ``sums`` are whole numbers or decimals: what leaves must cancel what entered to the last digit, which doubles don't (cast
    them). A sum without a value is null; rows without a time see only each other.
    """
    types = {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in sums.items()]).schema}
    if inexact := [n for n, t in types.items() if isinstance(t, (T.DoubleType, T.FloatType))]:
        raise TypeError(f"cast to decimal before summing over a trailing range: {', '.join(inexact)}")
    span, width = int(seconds * 1_000_000), chunk_seconds * 1_000_000
    rows = df.select(*df.columns, micros(time).alias("__us"), F.lit(1).cast("bigint").alias("__n"),
                     *[c.alias(f"__v_{n}") for n, c in sums.items()],
                     *[c.isNotNull().cast("bigint").alias(f"__k_{n}") for n, c in sums.items()])
    totals = ["__n", *[f"__{kind}_{n}" for n in sums for kind in "vk"]]
    moves = F.array(F.struct(F.col("__us").alias("at"), F.lit(1).alias("sign")), F.struct((F.col("__us") + span + 1).alias("at"), F.lit(-1).alias("sign")))
    moves = F.when(F.col("__us").isNull(), F.slice(moves, 1, 1)).otherwise(moves)
    signed = rows.select("*", F.inline(moves)).select(*df.columns, "at", "sign", time_chunk(F.col("at"), width).alias("__chunk"),
                                                      *[(F.col(c) * F.col("sign")).alias(c) for c in totals])
    folded = signed.filter(F.col("__chunk").isNotNull()).groupBy(*keys, "__chunk").agg(*[F.sum(c).alias(c) for c in totals])
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = folded.select(*keys, "__chunk", (F.col("__chunk") * width).alias("at"), F.lit(0).alias("sign"),
                            *[F.sum(c).over(earlier).alias(c) for c in totals])
    inside = Window.partitionBy(*keys, "__chunk").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    upto = lambda c: F.sum(c).over(inside)
    found = signed.unionByName(carried, allowMissingColumns=True).select(
        "sign", *df.columns, upto("__n").alias(count),
        *[F.when(upto(f"__k_{n}") > 0, upto(f"__v_{n}")).alias(n) for n in sums])
    return found.filter("sign = 1").drop("sign")


def trailing_extremes(df: DataFrame, keys: Sequence[str], time: str, seconds: float, least: dict[str, Column] | None = None,
                      greatest: dict[str, Column] | None = None) -> DataFrame:
    """Least and greatest values over ``[time - seconds, time]`` for every row, both ends included.

    Time is cut into blocks as long as the range, which then is the end of one block and the start of the next: the
    extreme is that of a suffix and of a prefix, both running in their block. Each row goes to its block and, as a
    predecessor, to the next one; both directions are windows over one shuffle, in time proportional to the rows.
    Rows without a time see only each other.
    """
    span = max(1, int(seconds * 1_000_000))
    kinds = [(n, c, F.min, F.least) for n, c in (least or {}).items()] + [(n, c, F.max, F.greatest) for n, c in (greatest or {}).items()]
    rows = df.select(*df.columns, micros(time).alias("__us"), *[c.alias(f"__v_{n}") for n, c, _, _ in kinds])
    block = time_chunk(F.col("__us"), span)
    places = F.array(F.struct(block.alias("__block"), F.lit(True).alias("__own")), F.struct((block + 1).alias("__block"), F.lit(False).alias("__own")))
    places = F.when(F.col("__us").isNull(), F.slice(places, 1, 1)).otherwise(places)
    spread = rows.select("*", F.inline(places)).withColumn(
        "__at", F.when(F.col("__own"), F.col("__us")).otherwise(F.col("__us") + span))
    forward = Window.partitionBy(*keys, "__block").orderBy("__at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    backward = Window.partitionBy(*keys, "__block").orderBy(F.desc("__at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own, earlier = (lambda n: F.when(F.col("__own"), F.col(f"__v_{n}"))), (lambda n: F.when(~F.col("__own"), F.col(f"__v_{n}")))
    found = spread.select("__own", *df.columns, *[both(fold(own(n)).over(forward), fold(earlier(n)).over(backward)).alias(n)
                                                  for n, _, fold, both in kinds])
    return found.filter("__own").drop("__own")


def windowed(df: DataFrame, keys: Sequence[str], time: str, size: str, aggregates: dict[str, Column],
             slide: str | None = None) -> DataFrame:
    """Tumbling windows, or hopping ones when ``slide`` is given; batch and streaming alike."""
    frame = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = df.groupBy(frame.alias("__w"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return grouped.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                          *keys, *aggregates)


def session_totals(df: DataFrame, key: str, time: str, gap_seconds: int,
                   sums: dict[str, Column], count: str = "events") -> DataFrame:
    """Sessions per key: start, last event, event count and sums; a pause of exactly the gap joins.
    Rows without key or time belong to no session.

    Events of one gap-wide slot always share a session, so each (key, slot) is folded map-side
    first and only slot rows are ordered per key: hot keys cost slots, not events.
    """
    gap = gap_seconds * 1_000_000
    slots = (df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
             .withColumn("__us", micros(time))
             .groupBy(key, time_chunk(F.col("__us"), gap).alias("__slot"))
             .agg(F.min("__us").alias("__from"), F.max("__us").alias("__to"),
                  F.count(F.lit(1)).alias(count), *[F.sum(c).alias(n) for n, c in sums.items()]))
    order = Window.partitionBy(key).orderBy("__slot")
    opens = F.col("__from") - F.lag("__to").over(order) > F.lit(gap)
    numbered = (slots.withColumn("__opens", F.coalesce(opens, F.lit(True)).cast("int"))
                .withColumn("__session", F.sum("__opens").over(order)))
    sessions = numbered.groupBy(key, "__session").agg(
        F.min("__from").alias("__from"), F.max("__to").alias("__to"), F.sum(count).alias(count),
        *[F.sum(n).alias(n) for n in sums])
    return sessions.select(key, F.timestamp_micros("__from").alias("session_start"),
                           F.timestamp_micros("__to").alias("session_end"), count, *sums)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float], ranges: int = 64) -> DataFrame:
    """``p50``-like columns per key: the value of rank ceil(q x n), nulls left out; exact for groups of any size.

    A sketch cuts each group into value ranges of like size. Counts per range tell in which one each rank lies, and only the
    rows of those ranges are counted by value and ordered, a small part of the group and range by range. The sketch
    decides how work is dealt out, not the result.
    """
    names = {q: f"p{round(q * 100)}" for q in quantiles}
    rows = df.select(*keys, F.col(value).alias("__v")).filter(F.col("__v").isNotNull())
    cuts = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    edges = rows.groupBy(*keys).agg(F.percentile_approx("__v", cuts, F.lit(1_000)).alias("__edges"))
    renamed = edges.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__edges")
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    placed = rows.join(renamed, same).select(*keys, "__v", F.size(F.filter("__edges", lambda e: e < F.col("__v"))).alias("__range"))
    counts = placed.groupBy(*keys, "__range", "__v").agg(F.count(F.lit(1)).alias("__n"))
    per_range = counts.groupBy(*keys, "__range").agg(F.sum("__n").alias("__n"))
    order, group = Window.partitionBy(*keys).orderBy("__range"), Window.partitionBy(*keys)
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.greatest(F.lit(1), F.ceil(F.lit(q) * F.sum("__n").over(group))).alias("rank"))
                      for q, name in names.items()])
    before = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = per_range.withColumns({"__before": before, "__rank": ranks}).withColumn("__rank", F.expr(
        "filter(__rank, r -> r.rank > __before and r.rank <= __before + __n)")).filter(F.size("__rank") > 0)
    wanted = wanted.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__r"), "__before", "__rank")
    inside = Window.partitionBy(*keys, "__range").orderBy("__v")
    reached = counts.join(wanted, same & (F.col("__range") == F.col("__r"))).withColumn(
        "__upto", F.col("__before") + F.sum("__n").over(inside))
    hits = reached.select(*keys, "__v", "__upto", "__n", F.explode("__rank").alias("__x")).filter(
        (F.col("__x.rank") <= F.col("__upto")) & (F.col("__x.rank") > F.col("__upto") - F.col("__n")))
    return hits.groupBy(*keys).agg(*[F.max(F.when(F.col("__x.name") == name, F.col("__v"))).alias(name) for name in names.values()])


def rates_and_latency(df: DataFrame, keys: Sequence[str], time: str, size: str, window_seconds: int,
                      latency: str | None = None, quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Events per second per window and, for a latency column, exact quantiles."""
    aggregates = {"events": F.count(F.lit(1)), "per_second": F.count(F.lit(1)) / F.lit(float(window_seconds))}
    rates = windowed(df, keys, time, size, aggregates)
    if not latency:
        return rates
    spans = df.withColumn("window_start", F.window(time, size)["start"])
    found = exact_quantiles(spans, ["window_start", *keys], latency, quantiles)
    renamed = found.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(["window_start", *keys])],
                           *found.columns[len(keys) + 1:])
    same = F.lit(True)
    for i, key in enumerate(["window_start", *keys]):
        same = same & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    return rates.join(renamed, same, "left").select(*rates.columns, *found.columns[len(keys) + 1:])
