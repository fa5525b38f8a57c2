"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import micros


@dataclass(frozen=True)
class Lake:
    """The test tables of one scale directory."""

    spark: SparkSession
    root: str

    def __call__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(lake) -> DataFrame`` under its own or the given name."""

    def add(fn: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, root: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Lake(spark, root.rstrip("/")))

        key = name or fn.__name__
        if key in CATALOG:
            raise ValueError(f"query {key} is registered twice")
        CATALOG[key] = Query(run, sql)
        return fn

    return add


def whole(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")


def real(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def day(value: str) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def us(value: str) -> Column:
    return micros(value)
