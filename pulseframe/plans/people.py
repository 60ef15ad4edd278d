"""Patient and admission queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.functions.patients import birth_date_from_age, case_key, level_rank, patient_key
from pulseframe.operators import aggregates as agg
from pulseframe.operators import filters, relate
from pulseframe.operators.timeseries import latest_per_key
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query
from pulseframe.schemas import VITALS

_AGE_SQL = f"CAST(floor(date_diff('day', date_of_birth, DATE '{t.ADMISSION_REF[:10]}') / 365.0) AS INTEGER)"
ACTIVE_SQL = f"""
SELECT p.patient_id, full_name, {_AGE_SQL} AS age, gender, admission_id, admission_time, department, admission_type,
       risk_level, current_risk_score AS risk_score, initial_diagnosis AS diagnosis, attending_physician AS physician
FROM ({t.PATIENTS_SQL}) p JOIN ({t.ADMISSIONS_SQL}) a ON p.patient_id = a.patient_id WHERE discharge_time IS NULL"""
_SHOWN = [
    "patient_id", "full_name", "age", "gender", "admission_id", "admission_time", "department",
    "admission_type", "risk_level", "risk_score", "diagnosis", "physician",
]
_SHOWN_SQL = ", ".join(_SHOWN)


def _ref():
    return t.ntz(t.ADMISSION_REF)


def _tables(spark, sf_dir):
    return t.patients(spark, sf_dir), t.admissions(spark, sf_dir)


def _shown(df):
    return df.select(*_SHOWN)


@query("active_patients", f"SELECT {_SHOWN_SQL} FROM ({ACTIVE_SQL})")
def active_patients(spark, sf_dir):
    return _shown(relate.active_patients(*_tables(spark, sf_dir), _ref()))


@query(
    "patient_status_left",
    f"""SELECT p.patient_id, full_name, {_AGE_SQL} AS age, gender, admission_id, admission_time,
  CASE WHEN a.patient_id IS NULL THEN 'N/A' ELSE department END AS department,
  CASE WHEN a.patient_id IS NULL THEN 'N/A' ELSE admission_type END AS admission_type,
  CASE WHEN a.patient_id IS NULL THEN 'STABLE' ELSE risk_level END AS risk_level,
  CASE WHEN a.patient_id IS NULL THEN 0 ELSE current_risk_score END AS risk_score,
  CASE WHEN a.patient_id IS NULL THEN 'N/A' ELSE initial_diagnosis END AS diagnosis,
  CASE WHEN a.patient_id IS NULL THEN 'N/A' ELSE attending_physician END AS physician
FROM ({t.PATIENTS_SQL}) p LEFT JOIN ({t.ADMISSIONS_SQL}) a ON p.patient_id = a.patient_id WHERE discharge_time IS NULL""",
)
def patient_status_left(spark, sf_dir):
    return _shown(relate.patients_with_status(*_tables(spark, sf_dir), _ref()))


@query(
    "critical_patients",
    f"""SELECT patient_id, full_name, admission_id, risk_level, risk_score,
  date_diff('second', admission_time, TIMESTAMP '{t.ADMISSION_REF}') / 3600.0::DOUBLE AS hours_admitted
FROM ({ACTIVE_SQL}) WHERE risk_level IN ('CRITICAL', 'HIGH') ORDER BY risk_score DESC, patient_id, admission_id""",
)
def critical_patients(spark, sf_dir):
    listed = relate.critical_patients(*_tables(spark, sf_dir), _ref())
    return listed.select(
        "patient_id", "full_name", "admission_id", "risk_level",
        "risk_score", "hours_admitted",
    )


@query(
    "patient_search",
    f"""SELECT patient_id, full_name, admission_id, diagnosis FROM ({ACTIVE_SQL})
WHERE contains(lower(full_name), 'observ') OR contains(CAST(patient_id AS VARCHAR), 'observ') OR coalesce(contains(lower(diagnosis), 'observ'), FALSE)""",
)
def patient_search(spark, sf_dir):
    active = relate.active_patients(*_tables(spark, sf_dir), _ref())
    return filters.search_text(active, "Observ").select("patient_id", "full_name", "admission_id", "diagnosis")


@query(
    "patient_search_pattern",
    f"""SELECT patient_id, full_name, admission_id, department, risk_level FROM ({ACTIVE_SQL})
WHERE risk_level IN ('CRITICAL', 'HIGH', 'MODERATE', 'STABLE') AND department IN ('ICU', 'CCU')
  AND (regexp_matches(CAST(patient_id AS VARCHAR), '7$') OR regexp_matches(full_name, 'customer#0+1', 'i'))""",
)
def patient_search_pattern(spark, sf_dir):
    active = relate.active_patients(*_tables(spark, sf_dir), _ref())
    listed = filters.in_departments(filters.with_levels(active, agg.LEVELS), ("ICU", "CCU"))
    found = filters.search_pattern(listed, "7$|customer#0+1")
    return found.select("patient_id", "full_name", "admission_id", "department", "risk_level")


@query("risk_distribution", f"SELECT risk_level, count(admission_id) AS admissions FROM ({t.ADMISSIONS_SQL}) WHERE discharge_time IS NULL GROUP BY 1")
def risk_distribution(spark, sf_dir):
    return agg.risk_distribution(t.admissions(spark, sf_dir))


@query(
    "patient_totals",
    f"""SELECT (SELECT count(patient_id) FROM ({t.PATIENTS_SQL})) AS total_patients,
  (SELECT count(admission_id) FROM ({t.ADMISSIONS_SQL}) WHERE discharge_time IS NULL) AS active_admissions""",
)
def patient_totals(spark, sf_dir):
    return agg.patient_totals(*_tables(spark, sf_dir))


@query(
    "level_summary",
    f"""SELECT count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical, count(*) FILTER (WHERE risk_level = 'HIGH') AS high,
  count(*) FILTER (WHERE risk_level IN ('STABLE', 'MODERATE')) AS stable FROM ({t.ADMISSIONS_SQL}) WHERE discharge_time IS NULL""",
)
def level_summary(spark, sf_dir):
    return agg.level_summary(t.admissions(spark, sf_dir))


@query(
    "alert_counts",
    f"""SELECT count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical, count(*) FILTER (WHERE risk_level = 'HIGH') AS high,
  count(*) AS total FROM ({ACTIVE_SQL}) WHERE risk_level IN ('CRITICAL', 'HIGH')""",
)
def alert_counts(spark, sf_dir):
    return agg.alert_totals(relate.alert_list(*_tables(spark, sf_dir), _ref()))


@query(
    "active_alert_list",
    f"SELECT patient_id, full_name, admission_id, risk_level, diagnosis, risk_score FROM ({ACTIVE_SQL}) WHERE risk_level IN ('CRITICAL', 'HIGH')",
)
def active_alert_list(spark, sf_dir):
    return relate.alert_list(*_tables(spark, sf_dir), _ref())


_RANK_SQL = "CASE risk_level WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MODERATE' THEN 2 WHEN 'STABLE' THEN 3 ELSE 4 END"


@query(
    "patients_by_level",
    f"SELECT patient_id, full_name, admission_id, {_RANK_SQL} AS level_rank FROM ({ACTIVE_SQL}) ORDER BY level_rank, patient_id, admission_id",
)
def patients_by_level(spark, sf_dir):
    active = relate.active_patients(*_tables(spark, sf_dir), _ref())
    return relate.sort_patients(active, "risk").select(
        "patient_id", "full_name", "admission_id", level_rank(F.col("risk_level")).alias("level_rank")
    )


CURRENT_SQL = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY admission_time DESC, admission_id DESC) AS rn
  FROM ({t.ADMISSIONS_SQL}) WHERE discharge_time IS NULL) WHERE rn = 1"""


@query("current_admission", f"SELECT patient_id, admission_id, admission_time, department, risk_level FROM ({CURRENT_SQL})")
def current_admission(spark, sf_dir):
    return relate.current_admission(t.admissions(spark, sf_dir)).select(
        "patient_id", "admission_id", "admission_time", "department", "risk_level"
    )


@query(
    "patient_overview",
    f"""SELECT a.patient_id, a.full_name, a.admission_id, a.risk_level, r.day, {', '.join('r.' + v for v in VITALS)}
FROM ({ACTIVE_SQL}) a LEFT JOIN (SELECT * FROM ({t.READINGS_SQL}) QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY timestamp DESC) = 1) r
  ON a.patient_id = r.patient_id""",
)
def patient_overview(spark, sf_dir):
    latest = latest_per_key(t.readings(spark, sf_dir), ["patient_id"], ["timestamp"])
    overview = relate.patient_overview(*_tables(spark, sf_dir), latest, _ref())
    return overview.select("patient_id", "full_name", "admission_id", "risk_level", "day", *VITALS)


@query(
    "case_keys",
    "SELECT c_custkey, 'ICU-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS patient_id, c_custkey AS case_id FROM customer",
)
def case_keys(spark, sf_dir):
    ids = t.load(spark, sf_dir, "customer").select("c_custkey", patient_key(F.col("c_custkey")).alias("patient_id"))
    return ids.withColumn("case_id", case_key(F.col("patient_id")))


@query(
    "birth_dates",
    "SELECT p_partkey, CAST(make_date(2024 - CASE WHEN p_size > 45 THEN 30 ELSE p_size END, 1, 1) AS VARCHAR) AS date_of_birth FROM part",
)
def birth_dates(spark, sf_dir):
    parts = t.load(spark, sf_dir, "part")
    age = F.when(F.col("p_size") <= 45, F.col("p_size"))
    born = birth_date_from_age(age, F.lit("2024-06-01").cast("date"))
    return parts.select("p_partkey", born.cast("string").alias("date_of_birth"))


def _sorted_row(by: str, order: str) -> None:
    # The first rows of the list tell its order.
    @query(f"patients_by_{by}", f"SELECT {_SHOWN_SQL} FROM ({ACTIVE_SQL}) ORDER BY {order}, patient_id, admission_id LIMIT 40")
    def sorted_patients(spark, sf_dir):
        return _shown(relate.sort_patients(relate.active_patients(*_tables(spark, sf_dir), _ref()), by)).limit(40)


_sorted_row("name", "encode(full_name)")
_sorted_row("id", "patient_id")
_sorted_row("admission", "admission_time DESC NULLS LAST")
