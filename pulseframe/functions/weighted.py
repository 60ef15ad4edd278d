"""Weighted-deviation risk (0-1) and its event boost."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseframe.functions.numbers import finite_or_null


@dataclass(frozen=True)
class VitalWeight:
    normal_low: float
    normal_high: float
    critical_low: float
    critical_high: float
    weight: float


# Normal range, critical limits and weight per vital.
VITAL_WEIGHTS = {
    "heart_rate": VitalWeight(60, 100, 40, 120, 0.25),
    "spo2": VitalWeight(95, 100, 90, 100, 0.20),
    "temperature": VitalWeight(36.5, 37.5, 35.0, 38.5, 0.15),
    "respiratory_rate": VitalWeight(12, 20, 8, 25, 0.20),
    "blood_pressure_systolic": VitalWeight(90, 140, 80, 160, 0.15),
    "blood_pressure_diastolic": VitalWeight(60, 90, 50, 100, 0.05),
}

# Multiplier per critical event, others 1.0.
EVENT_MULTIPLIERS = {
    "none": 1.0,
    "cardiac_arrest": 2.0,
    "respiratory_failure": 1.8,
    "shock": 1.8,
    "sepsis": 1.5,
}

# Level thresholds of the 0-1 scale.
WEIGHTED_LEVELS = (("CRITICAL", 0.8), ("HIGH", 0.6), ("MEDIUM", 0.3))


def deviation_risk(value: Column, rule: VitalWeight) -> Column:
    """0 inside the normal range, else relative distance, doubled past a critical limit, at most 1."""
    low, high = F.lit(float(rule.normal_low)), F.lit(float(rule.normal_high))
    distance = F.when(value < low, (low - value) / low).otherwise((value - high) / high)
    critical = (value <= F.lit(float(rule.critical_low))) | (value >= F.lit(float(rule.critical_high)))
    scaled = F.when(critical, distance * F.lit(2.0)).otherwise(distance)
    return F.when(value.between(low, high), F.lit(0.0)).otherwise(F.least(F.lit(1.0), scaled))


def weighted_risk(vitals: dict[str, Column]) -> Column:
    """Mean deviation risk over the vitals present, by weight; 0 when none is."""
    risks, weights = [], []
    for name, rule in VITAL_WEIGHTS.items():
        if name not in vitals:
            continue
        value = finite_or_null(vitals[name])
        present = value.isNotNull()
        weight = F.lit(float(rule.weight))
        risks.append(F.when(present, deviation_risk(value, rule) * weight).otherwise(F.lit(0.0)))
        weights.append(F.when(present, weight).otherwise(F.lit(0.0)))
    total_risk = reduce(add, risks, F.lit(0.0))
    total_weight = reduce(add, weights, F.lit(0.0))
    return F.when(total_weight > 0, F.least(F.lit(1.0), total_risk / total_weight)).otherwise(F.lit(0.0))


def weighted_level(score: Column) -> Column:
    chain = F
    for level, floor in WEIGHTED_LEVELS:
        chain = chain.when(score >= floor, F.lit(level))
    return chain.otherwise(F.lit("LOW"))


def event_multiplier(event: Column) -> Column:
    chain = F
    for name, factor in EVENT_MULTIPLIERS.items():
        chain = chain.when(event == name, F.lit(factor))
    return chain.otherwise(F.lit(1.0))


def boosted_risk(score: Column, event: Column) -> Column:
    """Unrounded boosted score; its level is decided before rounding."""
    return F.least(F.lit(1.0), score * event_multiplier(event))
