"""KPI aggregates. Each keyed one folds map-side and shuffles group rows only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import customer_segment, safe_ratio
from ..functions.text import as_column
from .keyed import mode_of_counts

CANCELLED = "CANCELLED"
RECOGNISED = ("PAID", "SHIPPED", "DELIVERED")


def rounded(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)


def count_by(df: DataFrame, keys: Sequence[str], alias: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def most_common(df: DataFrame, key: Column | str, alias: str = "row_count", missing: str = "unknown") -> DataFrame:
    """Histogram of a reason column, the most frequent first."""
    name = key if isinstance(key, str) else "reason"
    reason = F.coalesce(as_column(key), F.lit(missing)).alias(name)
    return df.groupBy(reason).agg(F.count(F.lit(1)).alias(alias)).orderBy(F.desc(alias), name)


def signed_totals(df: DataFrame, keys: Sequence[str], value: Column, is_cancelled: Column) -> DataFrame:
    """Counts per class and a net value in which cancelled rows subtract."""
    cancelled = F.coalesce(is_cancelled, F.lit(False))
    return df.groupBy(*keys).agg(
        F.count_if(~cancelled).alias("submitted_orders"),
        F.count_if(cancelled).alias("cancelled_orders"),
        F.sum(F.when(cancelled, -value).otherwise(value)).alias("net_value"))


def product_kpis(df: DataFrame, keys: Sequence[str], value: Column, is_cancelled: Column) -> DataFrame:
    """Order count and sales without cancelled orders."""
    return df.filter(~F.coalesce(is_cancelled, F.lit(False))).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(value).alias("net_sales"))


def daily_kpis(df: DataFrame, day: str, amount: Column, recognised: Column) -> DataFrame:
    """All orders of a day, and count and revenue of those whose status is recognised."""
    counted = F.coalesce(recognised, F.lit(False))
    return df.groupBy(day).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(counted).alias("paid_or_shipped_count"),
        F.coalesce(F.sum(F.when(counted, amount)), F.lit(0).cast("double")).alias("recognized_revenue"))


def gross_by(df: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_count"),
                                 F.sum(amount).alias("gross_order_amount"))


def revenue_by(df: DataFrame, keys: Sequence[str], sums: dict[str, Column],
               distincts: dict[str, Column] | None = None, means: dict[str, Column] | None = None,
               digits: int | None = 2) -> DataFrame:
    """Distinct counts, rounded sums and rounded means per group."""
    columns = [F.countDistinct(c).alias(n) for n, c in (distincts or {}).items()]
    columns += [rounded(F.sum(c), digits).alias(n) for n, c in sums.items()]
    columns += [rounded(F.sum(c).cast("double") / F.count(c), digits).alias(n) for n, c in (means or {}).items()]
    return df.groupBy(*keys).agg(*columns)


def customer_360(customers: DataFrame, orders: DataFrame, key: str, attributes: Sequence[str],
                 order_id: str, amount: Column, order_date: str, category: str) -> DataFrame:
    """Order statistics, favourite category and segment of every customer, with or without orders.

    Orders are first folded per (customer, category): the same pass yields the sums and the mode,
    and the join then meets one row per customer.
    """
    per_category = orders.groupBy(key, F.col(category).alias("__cat")).agg(
        F.count(order_id).alias("__n"), F.sum(amount).alias("__sum"), F.count(amount).alias("__amounts"),
        F.count(category).alias("__cats"), F.min(order_date).alias("__first"), F.max(order_date).alias("__last"))
    per_customer = per_category.groupBy(key).agg(
        F.sum("__n").alias("__n"), F.sum("__sum").alias("__sum"), F.sum("__amounts").alias("__amounts"),
        F.min("__first").alias("first_order_date"), F.max("__last").alias("last_order_date"),
        mode_of_counts("__cat", "__cats").alias("top_category"))
    total = F.col("__sum").cast("double")
    return customers.select(key, *attributes).join(per_customer, [key], "left").select(
        key, *attributes,
        F.coalesce("__n", F.lit(0)).alias("total_orders"),
        F.coalesce(total, F.lit(0.0)).alias("total_revenue"),
        F.coalesce(total / F.col("__amounts"), F.lit(0.0)).alias("avg_order_value"),
        "first_order_date", "last_order_date", "top_category",
        customer_segment("__sum").alias("customer_segment"))


def daily_sales(orders: DataFrame, day: str, customer: str, product: str, amount: Column) -> DataFrame:
    """Orders, revenue, distinct customers and best-selling product per day.

    One scan feeds two groupings, (day, customer) and (day, product), which are folded map-side and
    then combined per day; nothing keeps a day's customers or products in one buffer.
    """
    staged = orders.select(F.col(day).alias("__day"), F.col(customer).alias("__customer"),
                           F.col(product).alias("__product"), amount.alias("__amount"))
    grouped = staged.groupingSets([["__day", "__customer"], ["__day", "__product"]],
                                  "__day", "__customer", "__product").agg(
        F.grouping("__product").alias("__by_customer"), F.count(F.lit(1)).alias("__n"),
        F.count("__amount").alias("__amounts"), F.sum("__amount").alias("__sum"))
    by_customer = F.col("__by_customer") == 1
    counted = grouped.withColumn("__mode_value", F.when(~by_customer, F.col("__product")))
    total = F.sum(F.when(by_customer, F.col("__sum"))).cast("double")
    return counted.groupBy(F.col("__day").alias(day)).agg(
        F.sum(F.when(by_customer, F.col("__n"))).alias("total_orders"),
        total.alias("total_revenue"),
        F.count_if(by_customer & F.col("__customer").isNotNull()).alias("unique_customers"),
        (total / F.sum(F.when(by_customer, F.col("__amounts")))).alias("avg_order_value"),
        mode_of_counts("__mode_value", "__n").alias("top_product"))


def product_performance(orders: DataFrame, keys: Sequence[str], quantity: Column, amount: Column,
                        price: Column) -> DataFrame:
    return orders.groupBy(*keys).agg(
        F.sum(quantity).alias("total_sold"), F.sum(amount).alias("total_revenue"),
        (F.sum(price).cast("double") / F.count(price)).alias("avg_unit_price"),
        F.count(F.lit(1)).alias("order_count"))


def rollup_by(df: DataFrame, keys: Sequence[str], amount: Column, distinct: str | None = None) -> DataFrame:
    """Count, sum and average per key, optionally with a distinct count."""
    columns = [F.count(amount).alias("order_count"), F.sum(amount).alias("total_amount"),
               (F.sum(amount).cast("double") / F.count(amount)).alias("average_amount")]
    if distinct:
        columns.append(F.countDistinct(distinct).alias("distinct_count"))
    return df.groupBy(*keys).agg(*columns)


def global_kpis(orders: DataFrame, customer: str, amount: Column) -> DataFrame:
    """One row: orders, customers, revenue, mean, and revenue per customer (0 without customers).

    Customers are made distinct by a grouped fold first, so the last step only adds up counts.
    """
    per_customer = orders.groupBy(customer).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("s"), F.count(amount).alias("a"))
    total = F.coalesce(F.sum("s").cast("double"), F.lit(0.0))
    row = per_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"), F.count(customer).alias("unique_customers"),
        total.alias("total_revenue"), F.coalesce(F.sum("a"), F.lit(0)).alias("__amounts"))
    return row.select("total_orders", "unique_customers", "total_revenue",
                      safe_ratio("total_revenue", "__amounts").alias("avg_order_value"),
                      safe_ratio("total_revenue", "unique_customers").alias("revenue_per_customer"))


def segment_distribution(customers: DataFrame, segment: str = "customer_segment") -> DataFrame:
    return count_by(customers, [segment], "customers").orderBy(F.desc("customers"), segment)


def category_analysis(orders: DataFrame, category: str, amount: Column, total_label: str = "ALL") -> DataFrame:
    """Per category: orders, revenue, mean; plus one grand-total row, largest revenue first."""
    per = (orders.filter(F.col(category).isNotNull()).groupBy(category)
           .agg(F.count(F.lit(1)).alias("order_count"), F.sum(amount).alias("__sum"), F.count(amount).alias("__n")))
    grand = per.agg(F.lit(total_label).alias(category), F.sum("order_count").alias("order_count"),
                    F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    revenue = F.coalesce(F.col("__sum").cast("double"), F.lit(0.0))
    return per.unionByName(grand).select(
        category, "order_count", revenue.alias("revenue"), safe_ratio(revenue, "__n").alias("avg_value")
    ).orderBy(F.desc("revenue"), category)


def column_profile(df: DataFrame) -> DataFrame:
    """Type, non-null and null count per column from one aggregate over one scan."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                                 F.lit(f.dataType.simpleString()).alias("data_type"),
                                 F.col(f"c{i}").alias("non_null_rows"),
                                 (F.col("rows") - F.col(f"c{i}")).alias("null_rows"))
                        for i, f in enumerate(fields)])
    return counts.select(F.inline(entries)).orderBy("column_name")


def layer_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows per named table; a table that does not exist counts 0."""
    present = {name: df for name, df in tables.items() if df is not None}
    frames = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
              for name, df in present.items()]
    absent = [(name, 0) for name in tables if name not in present]
    if absent or not frames:
        frames.append(SparkSession.active().createDataFrame(absent, "table_name string, row_count bigint"))
    return reduce(DataFrame.unionByName, frames)


def metric_rows(row: DataFrame) -> DataFrame:
    """One-row aggregate to (metric, value) rows."""
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).cast("bigint").alias("value"))
                      for name in row.columns])
    return row.select(F.inline(pairs))


def pass_rate(results: DataFrame, passed: Column, since: Column, checked_at: str,
              empty: float = 1.0, digits: int | None = 3) -> DataFrame:
    """Share of passed checks after ``since``; ``empty`` where there was none."""
    row = results.filter(F.col(checked_at) > since).agg(
        F.count_if(passed).alias("passed"), F.count(F.lit(1)).alias("total"))
    return row.withColumn("pass_rate", rounded(safe_ratio("passed", "total", empty), digits))


def pass_percentage(results: DataFrame, keys: Sequence[str], passed: Column) -> DataFrame:
    return results.groupBy(*keys).agg(
        (F.lit(100.0) * F.count_if(passed) / F.count(F.lit(1))).alias("pass_percentage"))
