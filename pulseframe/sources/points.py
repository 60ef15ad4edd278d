"""Time-series points: one row per reading and field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.schemas import MEASUREMENT

UNKNOWN_DEVICE = "unknown"
PARTITION = "date"


def to_points(readings: DataFrame, default_time: Column) -> DataFrame:
    """Tall points from readings with a ``vitals`` map; a reading without vitals gives none.

    Tags are device and risk level where the frame has them; a NULL device is
    ``unknown``, a NULL time is ``default_time``. Narrow.
    """
    has = readings.columns
    device = F.coalesce(F.col("device_id"), F.lit(UNKNOWN_DEVICE)) if "device_id" in has else F.lit(UNKNOWN_DEVICE)
    level = F.col("risk_level") if "risk_level" in has else F.lit(None).cast("string")
    return readings.select(
        F.lit(MEASUREMENT).alias("measurement"),
        F.col("patient_id").cast("string").alias("patient_id"),
        device.alias("device_id"),
        level.alias("risk_level"),
        F.coalesce(F.col("ts"), default_time).alias("ts"),
        # Not a plain explode, for which Spark adds a filter on the map's size and so computes the map twice.
        F.explode_outer("vitals").alias("field", "value"),
    ).filter(F.col("field").isNotNull()).select("measurement", "patient_id", "device_id", "risk_level", "field", "value", "ts")


def by_day(points: DataFrame) -> DataFrame:
    """Points with their day, laid out for a write into day folders.

    Rebalancing gathers each day's rows into few files and still splits a day
    that holds most of the rows.
    """
    return points.withColumn(PARTITION, F.to_date("ts")).hint("REBALANCE", F.col(PARTITION))


def append_points(points: DataFrame, path: str) -> None:
    """Append, one folder per day, so that time ranges prune folders."""
    by_day(points).write.mode("append").partitionBy(PARTITION).parquet(path)


def points_between(points: DataFrame, start: Column, end: Column) -> DataFrame:
    """Points of a half-open time range; the day filter prunes folders before the scan."""
    return points.filter(
        (F.col(PARTITION) >= F.to_date(start)) & (F.col(PARTITION) <= F.to_date(end))
        & (F.col("ts") >= start) & (F.col("ts") < end)
    )
