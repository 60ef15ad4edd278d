"""Early-warning score, risk score, level, anomalies and warnings."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.numbers import finite_or_null


@dataclass(frozen=True)
class Band:
    """Points for values in a closed interval; ``below`` is an open upper edge."""

    points: int
    at_least: float | None = None
    at_most: float | None = None
    below: float | None = None

    def covers(self, value: Column) -> Column:
        tests = []
        if self.at_least is not None:
            tests.append(value >= F.lit(float(self.at_least)))
        if self.at_most is not None:
            tests.append(value <= F.lit(float(self.at_most)))
        if self.below is not None:
            tests.append(value < F.lit(float(self.below)))
        return reduce(lambda a, b: a & b, tests)


# Score bands per vital. The integer edges leave gaps such as
# 40 < heart rate < 41, which score 0 in "parity" mode.
MEWS_BANDS: dict[str, tuple[Band, ...]] = {
    "heart_rate": (
        Band(2, at_most=40),
        Band(1, at_least=41, at_most=50),
        Band(1, at_least=101, at_most=110),
        Band(2, at_least=111, at_most=129),
        Band(3, at_least=130),
    ),
    "respiratory_rate": (
        Band(2, below=9),
        Band(1, at_least=15, at_most=20),
        Band(2, at_least=21, at_most=29),
        Band(3, at_least=30),
    ),
    "temperature": (Band(2, below=35), Band(2, at_least=38.5)),
    "blood_pressure_systolic": (
        Band(3, at_most=70),
        Band(2, at_least=71, at_most=80),
        Band(1, at_least=81, at_most=100),
        Band(2, at_least=200),
    ),
    "spo2": (
        Band(3, below=85),
        Band(2, at_least=85, at_most=89),
        Band(1, at_least=90, at_most=93),
    ),
}
# Score cap, base weight of the score in the risk, level thresholds.
MEWS_CAP = 14
RISK_BASE = 70.0
RISK_CAP = 100.0
LEVEL_RULES = (("CRITICAL", 75.0, 5), ("HIGH", 50.0, 4), ("MODERATE", 20.0, 2))
HIGH_MEWS = 5

# Vitals measured in whole units; only their bands have gaps.
_WHOLE_UNIT_VITALS = frozenset(MEWS_BANDS) - {"temperature"}


def _band_points(value: Column, bands: tuple[Band, ...]) -> Column:
    chain = F
    for band in bands:
        chain = chain.when(band.covers(value), F.lit(band.points))
    return chain.otherwise(F.lit(0))


def mews_score(vitals: dict[str, Column], mode: str = "parity") -> Column:
    """Early-warning score of one reading; absent, NULL and NaN vitals add nothing.

    ``mode="contiguous"`` scores the whole part of each value, which closes the
    gaps between the integer-edged bands.
    """
    if mode not in ("parity", "contiguous"):
        raise ValueError(f"unknown mode {mode!r}")
    parts = []
    for name, bands in MEWS_BANDS.items():
        if name not in vitals:
            continue
        value = finite_or_null(vitals[name])
        if mode == "contiguous" and name in _WHOLE_UNIT_VITALS:
            value = F.floor(value).cast("double")
        parts.append(_band_points(value, bands))
    return F.least(reduce(add, parts, F.lit(0)), F.lit(MEWS_CAP))


def risk_score(mews: Column, heart_rate: Column, spo2: Column) -> Column:
    """Risk 0-100 from the score plus bonuses; a vital of exactly 0 counts as missing."""
    hr, ox = finite_or_null(heart_rate), finite_or_null(spo2)
    rate_bonus = F.when((hr != 0) & ((hr < 40) | (hr > 140)), 10).otherwise(0)
    oxygen_bonus = F.when((ox != 0) & (ox < 85), 10).when((ox != 0) & (ox < 90), 5).otherwise(0)
    raw = mews / F.lit(float(MEWS_CAP)) * F.lit(RISK_BASE) + rate_bonus + oxygen_bonus
    return F.round(F.least(raw, F.lit(RISK_CAP)), 2)


def risk_level(risk: Column, mews: Column) -> Column:
    chain = F
    for level, min_risk, min_mews in LEVEL_RULES:
        chain = chain.when((risk >= min_risk) | (mews >= min_mews), F.lit(level))
    return chain.otherwise(F.lit("STABLE"))


def anomalies(heart_rate: Column, spo2: Column) -> Column:
    """ARRAY<STRUCT<type, val>>: tachycardia first, then hypoxia."""

    def found(kind: str, value: Column, test: Column) -> Column:
        return F.when(
            (value != 0) & test,
            F.struct(F.lit(kind).alias("type"), value.cast("double").alias("val")),
        )

    hr, ox = finite_or_null(heart_rate), finite_or_null(spo2)
    return F.array_compact(
        F.array(found("tachycardia", hr, hr > 130), found("hypoxia", ox, ox < 90))
    )


def warnings(mews: Column) -> Column:
    text = F.concat(F.lit("High MEWS Score: "), mews.cast("string"))
    return F.when(mews >= HIGH_MEWS, F.array(text)).otherwise(F.array().cast("array<string>"))


def vital_columns(df: DataFrame, fallback: dict[str, str] | None = None) -> dict[str, Column]:
    """The scored vitals a wide frame holds, with short alias columns as fallback."""
    from pulseframe.schemas import VITAL_ALIASES

    aliases = VITAL_ALIASES if fallback is None else fallback
    found = {}
    for name in MEWS_BANDS:
        candidates = [c for c in (name, *(a for a, n in aliases.items() if n == name)) if c in df.columns]
        if candidates:
            found[name] = F.coalesce(*(F.col(c).cast("double") for c in candidates))
    return found


def score_readings(df: DataFrame, mode: str = "parity") -> DataFrame:
    """Add mews_score, risk_score, risk_level, anomalies and warnings to wide readings.

    Narrow: no shuffle, works on batch and streaming frames alike.
    """
    vitals = vital_columns(df)
    missing = F.lit(None).cast("double")
    hr, ox = vitals.get("heart_rate", missing), vitals.get("spo2", missing)
    return (
        df.withColumn("mews_score", mews_score(vitals, mode))
        .withColumn("risk_score", risk_score(F.col("mews_score"), hr, ox))
        .withColumn("risk_level", risk_level(F.col("risk_score"), F.col("mews_score")))
        .withColumns({"anomalies": anomalies(hr, ox), "warnings": warnings(F.col("mews_score"))})
    )


def scored_records(df: DataFrame, mode: str = "parity") -> DataFrame:
    """Scored-reading record: id, time, scores, findings and the vitals as one struct."""
    names = [c for c in df.columns if c in MEWS_BANDS or c == "blood_pressure_diastolic"]
    scored = score_readings(df, mode)
    return scored.select(
        F.coalesce(F.col("patient_id").cast("string"), F.lit("Unknown")).alias("patient_id"),
        "timestamp",
        "risk_score",
        "risk_level",
        "mews_score",
        "anomalies",
        "warnings",
        F.struct(*names).alias("vital_signs"),
    )
