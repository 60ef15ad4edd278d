"""Relational tables: scans, appended rows, audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.functions.patients import clipped_error


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """Table of a database, read in parallel over a numeric key. Needs the driver on the class path."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", table)
        .option("partitionColumn", key).option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions).options(**options).load()
    )


def find(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in order and type; missing ones are NULL."""
    return df.select(
        *(
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        )
    )


def append(df: DataFrame, schema: T.StructType, path: str) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def event_rows(scored: DataFrame, event_type: Column, description: Column) -> DataFrame:
    """Rows of the events table from scored readings."""
    return scored.select(
        F.col("patient_id").cast("string").alias("patient_id"),
        event_type.alias("event_type"),
        "timestamp",
        F.col("risk_level").alias("severity"),
        description.alias("description"),
        F.to_json("vital_signs").alias("vital_signs"),
    )


def limit_alert_rows(points: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows of the alerts table for points past a limit of their vital, with the limit passed."""
    low_rule, high_rule = F, F
    for name, (low, high) in limits.items():
        mine = F.col("field") == name
        if low is not None:
            low_rule = low_rule.when(mine & (F.col("value") < low), F.lit(float(low)))
        if high is not None:
            high_rule = high_rule.when(mine & (F.col("value") > high), F.lit(float(high)))
    low_hit = low_rule.otherwise(F.lit(None).cast("double"))
    high_hit = high_rule.otherwise(F.lit(None).cast("double"))
    side = F.when(low_hit.isNotNull(), F.lit("low")).otherwise(F.lit("high"))
    return (
        points.withColumn("threshold", F.coalesce(low_hit, high_hit))
        .filter(F.col("threshold").isNotNull())
        .select(
            "patient_id",
            F.concat_ws("_", side, F.col("field")).alias("alert_type"),
            F.col("ts").alias("timestamp"),
            F.lit("HIGH").alias("severity"),
            F.col("field").alias("vital_type"),
            "value",
            "threshold",
            F.concat_ws(" ", F.col("field"), side, F.lit("limit passed")).alias("message"),
            F.lit(False).alias("acknowledged"),
        )
    )


def audit_readings(readings: DataFrame, processing_time_ms: Column | None = None) -> DataFrame:
    """Audit rows of scored readings. ``readings`` have patient_id, timestamp and risk_score."""
    return _audit(readings, "reading", F.col("risk_score"), processing_time_ms)


def audit_alerts(alerts: DataFrame) -> DataFrame:
    return _audit(alerts, "alert", F.col("risk_score"))


def audit_errors(rejected: DataFrame, error: str = "reason", data: str | None = None) -> DataFrame:
    """Audit rows of failed messages; the error text is clipped, absent data is ``{}``."""
    body = F.coalesce(F.col(data).cast("string"), F.lit("{}")) if data else F.lit("{}")
    return rejected.select(
        F.col("patient_id").cast("string").alias("patient_id"),
        "timestamp",
        F.lit("error").alias("event_type"),
        body.alias("event_data"),
        F.lit(None).cast("double").alias("risk_score"),
        F.lit(None).cast("double").alias("processing_time_ms"),
        clipped_error(F.col(error)).alias("error_message"),
    )


def _audit(df: DataFrame, event_type: str, risk: Column, time_ms: Column | None = None) -> DataFrame:
    return df.select(
        F.col("patient_id").cast("string").alias("patient_id"),
        "timestamp",
        F.lit(event_type).alias("event_type"),
        F.to_json(F.struct(*df.columns)).alias("event_data"),
        risk.cast("double").alias("risk_score"),
        (time_ms if time_ms is not None else F.lit(None)).cast("double").alias("processing_time_ms"),
        F.lit(None).cast("string").alias("error_message"),
    )


def audit_trail(*parts: DataFrame) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
