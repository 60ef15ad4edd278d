"""Patient columns: ids, ages, durations, defaults, ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display order of risk levels; anything else, NULL included, comes last.
LEVEL_RANK = {"CRITICAL": 0, "HIGH": 1, "MODERATE": 2, "STABLE": 3}
LAST_RANK = 4
ERROR_TEXT_LIMIT = 500
DEFAULT_AGE = 30


def patient_key(case_id: Column) -> Column:
    """``ICU-000123`` for case 123."""
    return F.format_string("ICU-%06d", case_id.cast("bigint"))


def case_key(patient_id: Column) -> Column:
    """Case number of an ``ICU-`` id, NULL for other ids."""
    return F.when(
        patient_id.startswith("ICU-"), F.get(F.split(patient_id, "-"), 1).try_cast("bigint")
    )


def name_from_id(patient_id: Column) -> Column:
    """``Patient <second part of the id>``, or the whole id where it has no dash."""
    return F.concat(F.lit("Patient "), F.coalesce(F.get(F.split(patient_id, "-"), 1), patient_id))


def age_years(date_of_birth: Column, on: Column) -> Column:
    """Whole 365-day years, the way the dashboards count age."""
    return F.floor(F.datediff(on, date_of_birth) / F.lit(365)).cast("int")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0)


def birth_date_from_age(age: Column, on: Column) -> Column:
    return F.make_date(F.year(on) - F.coalesce(age, F.lit(DEFAULT_AGE)).cast("int"), F.lit(1), F.lit(1))


def device_for(patient_id: Column) -> Column:
    return F.concat(F.lit("DEV-"), patient_id.cast("string"))


def level_rank(level: Column) -> Column:
    chain = F
    for name, rank in LEVEL_RANK.items():
        chain = chain.when(level == name, F.lit(rank))
    return chain.otherwise(F.lit(LAST_RANK))


def clipped_error(error: Column) -> Column:
    return F.left(error, F.lit(ERROR_TEXT_LIMIT))
