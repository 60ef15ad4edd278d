"""Sensor tracks on a one-second grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.filters import complete_rows

# Candidate tracks per vital, preferred first.
TRACK_CANDIDATES = {
    "heart_rate": ("SNUADC/HR", "Solar8000/HR"),
    "spo2": ("SNUADC/SPO2", "Solar8000/PLETH_SPO2"),
    "blood_pressure_systolic": ("SNUADC/ART_SBP", "Solar8000/ART_SBP"),
    "blood_pressure_diastolic": ("SNUADC/ART_DBP", "Solar8000/ART_DBP"),
    "temperature": ("Solar8000/BT", "Primus/TEMP_BLD"),
    "respiratory_rate": ("Solar8000/RR", "Primus/RR_CO2"),
}
# Vitals a replayed row must have; the five tracks of the short variant.
REQUIRED = ("heart_rate", "spo2")
SHORT_TRACKS = {
    "SNUADC/HR": "heart_rate",
    "SNUADC/SPO2": "spo2",
    "SNUADC/ART_SBP": "bp_systolic",
    "SNUADC/ART_DBP": "bp_diastolic",
    "Primus/CO2": "etco2",
}


def all_tracks() -> list[str]:
    return [t for tracks in TRACK_CANDIDATES.values() for t in tracks]


def to_grid(samples: DataFrame, tracks: Sequence[str]) -> DataFrame:
    """One row per case and second, one column per track, the last sample of the second."""
    picks = [
        F.max_by("value", F.when(F.col("track") == t, F.col("t"))).alias(t) for t in tracks
    ]
    return (
        samples.filter(F.col("track").isin(*tracks))
        .withColumn("second", F.floor("t").cast("bigint")).groupBy("case_id", "second").agg(*picks)
    )


def coalesce_tracks(
    grid: DataFrame, candidates: Mapping[str, Sequence[str]] = TRACK_CANDIDATES, keep: Sequence[str] = ("case_id", "second")
) -> DataFrame:
    """First usable candidate track per vital; NaN counts as absent."""

    def usable(track: str):
        c = F.col(f"`{track}`")
        return F.when(~F.isnan(c), c)

    vitals = [F.coalesce(*(usable(t) for t in ts if t in grid.columns)).alias(v) for v, ts in candidates.items()]
    return grid.select(*keep, *vitals)


def replayable(vitals: DataFrame) -> DataFrame:
    return complete_rows(vitals, REQUIRED)


def rename_tracks(
    grid: DataFrame, names: Mapping[str, str] = SHORT_TRACKS, keep: Sequence[str] = ("case_id", "second")
) -> DataFrame:
    """The short track set under its vital names, complete rows only."""
    return complete_rows(grid.select(*keep, *(F.col(f"`{t}`").alias(v) for t, v in names.items())))
