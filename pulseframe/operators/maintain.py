"""Table maintenance: each operator turns the current tables and a change set into new ones.

Plain tables cannot be updated in place, so the result is a full new snapshot for
the caller to write. Change sets are reduced to one row per key before any join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.patients import birth_date_from_age, case_key, device_for
from pulseframe.operators.filters import open_admissions
from pulseframe.operators.relate import KEY, absent_from, current_admission, lookup_case
from pulseframe.operators.timeseries import latest_per_key

# Defaults of new patients and admissions.
UNKNOWN = "Unknown"
ADMISSION_DEPARTMENT = "ICU"
ADMISSION_DIAGNOSIS = "Observation"
ADMISSION_LEVEL = "STABLE"
AUTO_DEPARTMENT = "ICU-Emergency"
AUTO_DIAGNOSIS = "Auto-admitted from Stream"
AUTO_MARK = "Auto-"
AUTO_BIRTH_DATE = "1970-01-01"
UNKNOWN_DIAGNOSIS = "Unknown Diagnosis"
REGISTER_STATUS = "active"
BLOOD_TYPES = ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")


def _first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    top = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(top.alias("_top")).select(key, "_top.*")


def add_patients(patients: DataFrame, new: DataFrame, order: Sequence[str], ref: Column) -> DataFrame:
    """Patients plus the new ones not yet present; existing rows stay as they are.

    ``new`` holds patient_id, name, age, gender, blood_type (NULL = default); the
    first row per id in ``order`` counts.
    """
    unique = _first_per_key(new, KEY, order)
    built = unique.select(
        KEY,
        F.coalesce(F.col("name"), F.lit(UNKNOWN)).alias("full_name"),
        birth_date_from_age(F.col("age"), ref).alias("date_of_birth"),
        F.coalesce(F.col("gender"), F.lit(UNKNOWN)).alias("gender"),
        device_for(F.col(KEY)).alias("device_id"),
        F.coalesce(F.col("blood_type"), F.lit(UNKNOWN)).alias("blood_type"),
        F.lit(True).alias("active_monitoring"),
    )
    return patients.unionByName(absent_from(built, patients), allowMissingColumns=True)


def admission_id_for(patient_id: Column, admission_time: Column) -> Column:
    """Id from the natural key: no global counter, and the same on a rerun."""
    return F.xxhash64(patient_id, admission_time)


def add_admissions(
    admissions: DataFrame, new: DataFrame, ref: Column, department: str = ADMISSION_DEPARTMENT
) -> DataFrame:
    """Admissions plus one for each patient of ``new`` without an open admission."""
    opened = open_admissions(admissions).select(KEY)
    built = (
        new.select(KEY).distinct().join(opened, KEY, "left_anti")
        .withColumns(
            {
                "admission_id": admission_id_for(F.col(KEY), ref),
                "admission_time": ref,
                "department": F.lit(department),
                "initial_diagnosis": F.lit(ADMISSION_DIAGNOSIS),
                "risk_level": F.lit(ADMISSION_LEVEL),
            }
        )
    )
    return admissions.unionByName(built, allowMissingColumns=True)


def upsert_profiles(patients: DataFrame, changes: DataFrame, order: Sequence[str], ref: Column) -> DataFrame:
    """Set profile and extra data of known patients, add unknown ones; created_at is kept."""
    last = latest_per_key(changes, [KEY], order).select(
        KEY, F.col("profile").alias("_profile"), F.col("extra_data").alias("_extra"), F.lit(True).alias("_hit")
    )
    hit, known = F.col("_hit").isNotNull(), F.col("_known").isNotNull()
    return (
        patients.withColumn("_known", F.lit(True)).join(last, KEY, "full_outer")
        .withColumns(
            {
                "profile": F.when(hit, F.col("_profile")).otherwise(F.col("profile")),
                "extra_data": F.when(hit, F.col("_extra")).otherwise(F.col("extra_data")),
                "created_at": F.when(known, F.col("created_at")).otherwise(ref),
                "updated_at": F.when(hit, ref).otherwise(F.col("updated_at")),
            }
        )
        .select(*patients.columns)
    )


def replace_rows(register: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """Insert or replace whole rows by key: the last new row per key wins, missing columns become NULL."""
    last = latest_per_key(new, [KEY], order)
    columns = [
        F.coalesce(F.col(c), F.lit(REGISTER_STATUS)).alias(c) if c == "status" else F.col(c)
        for c in register.columns
        if c in last.columns
    ]
    if "status" not in last.columns:
        columns.append(F.lit(REGISTER_STATUS).alias("status"))
    kept = register.join(last.select(KEY), KEY, "left_anti")
    return kept.unionByName(last.select(*columns), allowMissingColumns=True).select(*register.columns)


def bulk_append(register: DataFrame, new: DataFrame) -> DataFrame:
    """Append with status ``active``."""
    return register.unionByName(new.withColumn("status", F.lit(REGISTER_STATUS)), allowMissingColumns=True)


def soft_delete(patients: DataFrame, gone: DataFrame, ref: Column) -> DataFrame:
    """Stop monitoring the patients listed in ``gone`` and stamp the time."""
    keys = gone.select(KEY).distinct().withColumn("_gone", F.lit(True))
    hit = F.col("_gone").isNotNull()
    return (
        patients.join(keys, KEY, "left")
        .withColumns(
            {
                "active_monitoring": F.when(hit, F.lit(False)).otherwise(F.col("active_monitoring")),
                "deleted_at": F.when(hit, ref).otherwise(F.col("deleted_at")),
            }
        )
        .select(*patients.columns)
    )


def hard_delete(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Drop the listed patients from every given table, dependants included."""
    keys = gone.select(KEY)
    return {name: table.join(keys, KEY, "left_anti") for name, table in tables.items()}


def latest_risk(scored: DataFrame, order: Sequence[str]) -> DataFrame:
    """Last risk per patient of a batch of scored readings."""
    return latest_per_key(scored.select(KEY, "risk_score", "risk_level", *order), [KEY], order)


def update_risk(
    patients: DataFrame, admissions: DataFrame, latest: DataFrame, ref: Column
) -> tuple[DataFrame, DataFrame]:
    """New (patients, admissions) after the latest risk per patient.

    The current open admission takes the risk. A patient without one is admitted,
    and created first if unknown.
    """
    risk = latest.select(KEY, F.col("risk_score").alias("_score"), F.col("risk_level").alias("_level"))
    current = current_admission(admissions).select(KEY, "admission_id")
    targets = risk.join(current, KEY).select("admission_id", "_score", "_level", F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    updated = (
        admissions.join(targets, "admission_id", "left")
        .withColumns(
            {
                "current_risk_score": F.when(hit, F.col("_score")).otherwise(F.col("current_risk_score")),
                "risk_level": F.when(hit, F.col("_level")).otherwise(F.col("risk_level")),
                "updated_at": F.when(hit, ref).otherwise(F.col("updated_at")),
            }
        )
        .select(*admissions.columns)
    )
    fresh = risk.join(open_admissions(admissions).select(KEY), KEY, "left_anti")
    admitted = fresh.select(
        admission_id_for(F.col(KEY), ref).alias("admission_id"),
        KEY,
        ref.alias("admission_time"),
        F.lit(AUTO_DEPARTMENT).alias("department"),
        F.lit(AUTO_DIAGNOSIS).alias("initial_diagnosis"),
        F.col("_level").alias("risk_level"),
        F.col("_score").alias("current_risk_score"),
    )
    created = absent_from(fresh.select(KEY), patients).select(
        KEY,
        F.concat(F.lit("Patient "), F.col(KEY).cast("string")).alias("full_name"),
        F.lit(AUTO_BIRTH_DATE).cast("date").alias("date_of_birth"),
        F.lit(UNKNOWN).alias("gender"),
        F.lit(True).alias("active_monitoring"),
    )
    return (
        patients.unionByName(created, allowMissingColumns=True),
        updated.unionByName(admitted, allowMissingColumns=True),
    )


def stable_blood_type(case_id: Column) -> Column:
    """A blood type that depends on the case only."""
    pick = F.pmod(F.xxhash64(case_id), F.lit(len(BLOOD_TYPES))) + 1
    return F.element_at(F.array(*(F.lit(b) for b in BLOOD_TYPES)), pick.cast("int"))


def _none_text(value: Column) -> Column:
    return value.isNull() | (value == "None")


def enrich_active(patients: DataFrame, admissions: DataFrame, cases: DataFrame) -> DataFrame:
    """Active ``ICU-`` patients found in the clinical cases, with gaps filled.

    One row per patient (with its current admission) holding the new values and
    ``changed``. A NULL diagnosis is neither default text and stays.
    """
    current = current_admission(admissions).select(
        KEY, "admission_id", "initial_diagnosis", "department"
    )
    people = patients.select(KEY, "full_name", "gender", "blood_type", "device_id")
    clinical = cases.select(
        "caseid", "sex", "dx", "opname", F.col("department").alias("case_department")
    )
    found = lookup_case(
        people.join(current, KEY).withColumn("case_id", case_key(F.col(KEY))), clinical.withColumn("_found", F.lit(True))
    ).filter(F.col("_found"))
    no_gender = F.col("gender").isNull() | (F.col("gender") == UNKNOWN)
    no_diagnosis = F.coalesce(
        F.contains(F.col("initial_diagnosis"), F.lit(AUTO_MARK))
        | (F.col("initial_diagnosis") == ADMISSION_DIAGNOSIS),
        F.lit(False),
    )
    dept = F.col("department")
    loose_dept = dept.isNull() | (dept == "") | F.contains(dept, F.lit("ICU"))
    no_blood, no_device = _none_text(F.col("blood_type")), _none_text(F.col("device_id"))
    return found.select(
        KEY,
        "case_id",
        "admission_id",
        F.when(no_gender, F.when(F.col("sex") == "M", "Male").otherwise("Female"))
        .otherwise(F.col("gender")).alias("gender"),
        F.when(no_diagnosis, F.coalesce("opname", "dx", F.lit(UNKNOWN_DIAGNOSIS)))
        .otherwise(F.col("initial_diagnosis")).alias("initial_diagnosis"),
        F.when(no_diagnosis & loose_dept, F.coalesce("case_department", "department"))
        .otherwise(dept).alias("department"),
        F.when(no_blood, stable_blood_type(F.col("case_id"))).otherwise(F.col("blood_type")).alias("blood_type"),
        F.when(no_device, F.format_string("MON-%04d", F.col("case_id")))
        .otherwise(F.col("device_id")).alias("device_id"),
        (no_gender | no_diagnosis | no_blood | no_device).alias("changed"),
    )


def apply_enrichment(
    patients: DataFrame, admissions: DataFrame, enriched: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New (patients, admissions) with the enriched values in place."""

    def overlay(table: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
        new = enriched.filter("changed").select(
            key, F.struct(*columns).alias("_new")
        )
        hit = F.col("_new").isNotNull()
        return (
            table.join(new, key, "left")
            .withColumns({c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in columns})
            .select(*table.columns)
        )

    return (
        overlay(patients, KEY, ("gender", "blood_type", "device_id")),
        overlay(admissions, "admission_id", ("initial_diagnosis", "department")),
    )
