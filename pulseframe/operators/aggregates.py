"""Counts and summaries over admissions and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.filters import open_admissions

LEVELS = ("CRITICAL", "HIGH", "MODERATE", "STABLE")


def risk_distribution(admissions: DataFrame) -> DataFrame:
    """Open admissions per level; NULL is a group."""
    return (
        open_admissions(admissions).groupBy("risk_level")
        .agg(F.count("admission_id").alias("admissions"))
    )


def patient_totals(patients: DataFrame, admissions: DataFrame) -> DataFrame:
    """One row: all patients, open admissions."""
    opened = admissions.agg(F.count_if(F.col("discharge_time").isNull()).alias("active")).scalar()
    return patients.agg(F.count("patient_id").alias("total_patients")).withColumn("active_admissions", opened)


def level_summary(admissions: DataFrame) -> DataFrame:
    """One row of open admissions per level, 0 when none; stable also counts MODERATE."""
    level = F.col("risk_level")
    return open_admissions(admissions).agg(
        F.count_if(level == "CRITICAL").alias("critical"),
        F.count_if(level == "HIGH").alias("high"),
        F.count_if(level.isin("STABLE", "MODERATE")).alias("stable"),
    )


def alert_totals(listed: DataFrame) -> DataFrame:
    """Critical, high and all rows of a critical-patient list."""
    level = F.col("risk_level")
    return listed.agg(
        F.count_if(level == "CRITICAL").alias("critical"),
        F.count_if(level == "HIGH").alias("high"),
        F.count(F.lit(1)).alias("total"),
    )


def level_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_level").agg(F.count(F.lit(1)).alias("readings"))
