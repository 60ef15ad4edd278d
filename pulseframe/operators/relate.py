"""Patients with their admissions, and the lists built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.patients import age_years, hours_between, level_rank
from pulseframe.operators.filters import CRITICAL_LEVELS, open_admissions, with_levels

KEY = "patient_id"
# Shown for a patient without any admission.
UNMATCHED = {
    "department": "N/A",
    "risk_level": "STABLE",
    "risk_score": 0.0,
    "diagnosis": "N/A",
    "physician": "N/A",
    "admission_type": "N/A",
}


def _admission_view(admissions: DataFrame) -> DataFrame:
    return admissions.select(
        KEY,
        "admission_id",
        "admission_time",
        "department",
        "admission_type",
        "risk_level",
        F.col("current_risk_score").alias("risk_score"),
        F.col("initial_diagnosis").alias("diagnosis"),
        F.col("attending_physician").alias("physician"),
    )


def active_patients(patients: DataFrame, admissions: DataFrame, ref: Column) -> DataFrame:
    """Inner join with open admissions, age as of ``ref``.

    The discharge test runs in the admissions scan. No broadcast hint: AQE picks
    the strategy from measured sizes and splits a patient with very many admissions.
    """
    view = _admission_view(open_admissions(admissions))
    return patients.withColumn("age", age_years(F.col("date_of_birth"), ref)).join(view, KEY)


def patients_with_status(patients: DataFrame, admissions: DataFrame, ref: Column) -> DataFrame:
    """Left join, then keep rows without discharge time: open admissions and never-admitted patients.

    A patient with closed admissions only is dropped. Written as inner join plus
    anti join: an outer join could not split a hot patient on its right side, and
    the discharge test could not reach the scan.
    """
    active = active_patients(patients, admissions, ref)
    known = admissions.select(KEY).distinct()
    never = patients.withColumn("age", age_years(F.col("date_of_birth"), ref)).join(known, KEY, "left_anti")
    defaults = {c: F.lit(v) for c, v in UNMATCHED.items()}
    return active.unionByName(never.withColumns(defaults), allowMissingColumns=True)


def critical_patients(patients: DataFrame, admissions: DataFrame, ref: Column) -> DataFrame:
    """Open admissions at HIGH or CRITICAL with hours since admission, riskiest first."""
    severe = with_levels(open_admissions(admissions), CRITICAL_LEVELS)
    listed = active_patients(patients, severe, ref)
    return by_risk(listed.withColumn("hours_admitted", hours_between(F.col("admission_time"), ref)))


def by_risk(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("risk_score").desc_nulls_last(), KEY, "admission_id")


def sort_patients(df: DataFrame, by: str = "risk") -> DataFrame:
    """Order a patient list by ``risk`` level, ``name``, ``id`` or ``admission`` time."""
    keys = {
        "risk": [level_rank(F.col("risk_level"))],
        "name": [F.col("full_name")],
        "id": [F.col(KEY)],
        "admission": [F.col("admission_time").desc_nulls_last()],
    }
    if by not in keys:
        raise ValueError(f"sort by one of {sorted(keys)}, not {by!r}")
    ties = [c for c in (KEY, "admission_id") if c in df.columns]
    return df.orderBy(*keys[by], *ties)


def current_admission(admissions: DataFrame) -> DataFrame:
    """One open admission per patient: the latest, highest id on a tie.

    An aggregate rather than a ranked window, so a patient's rows are reduced
    before the shuffle.
    """
    newest = F.max(F.struct("admission_time", "admission_id", F.struct(*admissions.columns).alias("row")))
    return open_admissions(admissions).groupBy(KEY).agg(newest.alias("top")).select("top.row.*")


def absent_from(new: DataFrame, existing: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of ``new`` whose key does not exist yet."""
    return new.join(existing.select(key), key, "left_anti")


def lookup_case(df: DataFrame, cases: DataFrame, case: str = "case_id") -> DataFrame:
    """Add the clinical case of each row (case ids are unique); rows without one are kept."""
    return df.join(cases, df[case] == cases["caseid"], "left").drop(cases["caseid"])


def alert_list(patients: DataFrame, admissions: DataFrame, ref: Column) -> DataFrame:
    """Name, diagnosis and risk of every open HIGH or CRITICAL admission."""
    severe = with_levels(open_admissions(admissions), CRITICAL_LEVELS)
    return active_patients(patients, severe, ref).select(
        KEY, "full_name", "admission_id", "risk_level", "diagnosis", "risk_score"
    )


def patient_overview(
    patients: DataFrame, admissions: DataFrame, latest: DataFrame, ref: Column
) -> DataFrame:
    """Active patients with their latest reading, in one job for all patients."""
    return active_patients(patients, admissions, ref).join(latest, KEY, "left")
