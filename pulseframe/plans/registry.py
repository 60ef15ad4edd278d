"""Name to query and name to SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; timestamps are handled in UTC."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return fn(spark, sf_dir)

        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__ = name
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def runs(spark: SparkSession) -> int:
    """Pieces for ordered work, so that no key is one task's work, however many rows it has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def steady(value: Column, digits: int = 4) -> Column:
    """Rounded, as sums of floating point numbers depend on their order; only for such results."""
    return F.round(value + F.lit(1e-9), digits)


def steady_sql(value: str, digits: int = 4) -> str:
    return f"round({value} + 1e-9, {digits})"
