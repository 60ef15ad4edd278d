"""Consumer metrics: success rate, throughput, partition lag, message counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def throughput(metrics: DataFrame, uptime_seconds: Column) -> DataFrame:
    """One row: processed, errors, success percent (100 when nothing came), messages per second."""
    processed = F.count_if(~F.col("failed"))
    total = F.count(F.lit(1))
    return metrics.agg(
        processed.alias("messages_processed"),
        F.count_if(F.col("failed")).alias("errors"),
        F.when(total == 0, F.lit(100.0)).otherwise(processed * F.lit(100.0) / total).alias("success_rate"),
        F.when(uptime_seconds > 0, processed / uptime_seconds).otherwise(F.lit(0.0)).alias("messages_per_sec"),
    )


def partition_state(metrics: DataFrame, order: str = "ts") -> DataFrame:
    """Last offset and lag per source partition."""
    return metrics.groupBy("partition").agg(
        F.max_by("offset", order).alias("offset"), F.max_by("lag", order).alias("lag")
    )


def lag_summary(metrics: DataFrame, order: str = "ts") -> DataFrame:
    """Partitions, total and greatest current lag."""
    return partition_state(metrics, order).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"),
        F.coalesce(F.max("lag"), F.lit(0)).alias("max_lag"),
    )


def message_counters(outcomes: DataFrame) -> DataFrame:
    """Received, processed, failed, stored and alerted messages in one pass."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if("processed").alias("processed"),
        F.count_if(~F.col("processed")).alias("failed"),
        F.count_if("stored").alias("stored"),
        F.count_if("alerted").alias("alerted"),
    )
