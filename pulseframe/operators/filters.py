"""Row filters: open admissions, levels, departments, text search, time ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Levels that raise an alert, and levels listed as critical patients.
ALERT_LEVELS = ("MODERATE", "HIGH", "CRITICAL")
CRITICAL_LEVELS = ("CRITICAL", "HIGH")


def open_admissions(admissions: DataFrame) -> DataFrame:
    return admissions.filter(F.col("discharge_time").isNull())


def with_levels(df: DataFrame, levels: Iterable[str]) -> DataFrame:
    """Rows of the given levels; a NULL level is never one of them."""
    return df.filter(F.col("risk_level").isin(*levels))


def in_departments(df: DataFrame, departments: Sequence[str] | None) -> DataFrame:
    return df.filter(F.col("department").isin(*departments)) if departments else df


def search_text(df: DataFrame, query: str, columns=("full_name", "patient_id", "diagnosis")) -> DataFrame:
    """Rows holding the literal text in any column, ignoring case; a NULL column never matches."""
    hits = [
        F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(query.lower())), F.lit(False))
        for c in columns
    ]
    return df.filter(reduce(or_, hits))


def search_pattern(df: DataFrame, pattern: str, columns=("patient_id", "full_name")) -> DataFrame:
    """Rows matching the regular expression in any column, ignoring case."""
    hits = [F.coalesce(F.col(c).cast("string").rlike(f"(?i){pattern}"), F.lit(False)) for c in columns]
    return df.filter(reduce(or_, hits))


def last_hours(df: DataFrame, ref: Column, hours: float, ts: str = "ts") -> DataFrame:
    """Rows of the last ``hours`` (fractions allowed) up to ``ref``.

    The bound is a foldable timestamp, so it reaches the Parquet scan.
    """
    seconds = F.lit(float(hours) * 3600)
    return df.filter((F.col(ts) >= ref - F.make_dt_interval(secs=seconds)) & (F.col(ts) < ref))


def complete_rows(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Drop rows lacking any required value (all columns if none are named); NaN counts as absent."""
    return df.na.drop("any", subset=list(required) if required else None)


def alert_levels(scored: DataFrame, levels: Iterable[str] = ALERT_LEVELS) -> DataFrame:
    return with_levels(scored, levels)
