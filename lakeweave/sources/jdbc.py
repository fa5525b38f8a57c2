"""Warehouse tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", truncate: bool = False,
               columns: dict[str, str] | None = None, batch_size: int = 1000, **properties: str) -> None:
    """Write a table; ``columns`` map DataFrame names to table names.

    ``truncate`` with mode overwrite keeps the table definition and only empties it.
    """
    mapped = df.select(*[df[name].alias(target) for name, target in columns.items()]) if columns else df
    mapped.write.mode(mode).option("truncate", truncate).option("batchsize", batch_size).jdbc(
        url, table, properties=properties)


def read_jdbc(spark: SparkSession, url: str, query: str, **properties: str) -> DataFrame:
    """Result of a query; for a large table give ``dbtable`` bounds to :func:`read_jdbc_table` instead."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for name, value in properties.items():
        reader = reader.option(name, value)
    return reader.load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                    partitions: int, fetch_size: int = 10_000, **properties: str) -> DataFrame:
    """A whole table in ``partitions`` parallel key ranges."""
    return spark.read.option("fetchsize", fetch_size).jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties)
