"""Fixed schemas of the records and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The six monitored vitals, in display order.
VITALS = (
    "heart_rate",
    "spo2",
    "temperature",
    "respiratory_rate",
    "blood_pressure_systolic",
    "blood_pressure_diastolic",
)

# Short names some producers use, and the name used here.
VITAL_ALIASES = {
    "bp_systolic": "blood_pressure_systolic",
    "bp_diastolic": "blood_pressure_diastolic",
}

MEASUREMENT = "vital_signs"


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "VARIANT": T.VariantType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name TYPE, ..."; unlike DDL parsing it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind.upper()]) for name, kind in pairs])


READING = _struct(
    "patient_id STRING, timestamp STRING, vital_signs VARIANT, device_id STRING, profile STRING"
).add("producer_metadata", _struct("sent_at STRING, topic STRING"))

POINT = _struct(
    "measurement STRING, patient_id STRING, device_id STRING, risk_level STRING, "
    "field STRING, value DOUBLE, ts TIMESTAMP"
)

TRACK_SAMPLE = _struct("case_id BIGINT, t DOUBLE, track STRING, value DOUBLE")

PATIENTS = _struct(
    "patient_id STRING, full_name STRING, date_of_birth DATE, age INT, gender STRING, "
    "blood_type STRING, admission_date TIMESTAMP, device_id STRING, chronic_conditions STRING, "
    "active_monitoring BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP, "
    "deleted_at TIMESTAMP, profile STRING, extra_data STRING"
)

ADMISSIONS = _struct(
    "admission_id BIGINT, patient_id STRING, admission_time TIMESTAMP, discharge_time TIMESTAMP, "
    "admission_type STRING, department STRING, initial_diagnosis STRING, "
    "attending_physician STRING, risk_level STRING, current_risk_score DOUBLE, notes STRING, "
    "status STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)

VITAL_SIGNS = _struct(
    "id BIGINT, patient_id STRING, timestamp TIMESTAMP, heart_rate DOUBLE, "
    "blood_pressure_systolic DOUBLE, blood_pressure_diastolic DOUBLE, temperature DOUBLE, "
    "respiratory_rate DOUBLE, spo2 DOUBLE, created_at TIMESTAMP"
)

PATIENT_REGISTER = _struct(
    "patient_id STRING, age INT, gender STRING, admission_type STRING, diagnosis STRING, "
    "apache_score DOUBLE, heart_rate DOUBLE, blood_pressure_systolic DOUBLE, "
    "blood_pressure_diastolic DOUBLE, temperature DOUBLE, respiratory_rate DOUBLE, spo2 DOUBLE, "
    "icu_stay_days INT, status STRING"
)

EVENTS = _struct(
    "id BIGINT, patient_id STRING, event_type STRING, timestamp TIMESTAMP, severity STRING, "
    "description STRING, vital_signs STRING, extra_data STRING, created_at TIMESTAMP"
)

ALERTS = _struct(
    "id BIGINT, patient_id STRING, alert_type STRING, timestamp TIMESTAMP, severity STRING, "
    "vital_type STRING, value DOUBLE, threshold DOUBLE, message STRING, acknowledged BOOLEAN, "
    "acknowledged_at TIMESTAMP, acknowledged_by STRING, created_at TIMESTAMP"
)

CONSUMER_METRICS = _struct(
    "id BIGINT, timestamp TIMESTAMP, messages_processed BIGINT, messages_failed BIGINT, "
    "processing_time_ms DOUBLE, lag BIGINT, partition INT, offset BIGINT"
)

AUDIT_LOGS = _struct(
    "id BIGINT, timestamp TIMESTAMP, patient_id STRING, event_type STRING, event_data STRING, "
    "risk_score DOUBLE, processing_time_ms DOUBLE, error_message STRING"
)

# The 74 columns of a clinical case file. Column types follow the sample file, case numbers are longs;
# `age` stays text because the files sort it as text.
_CLINICAL_COLUMNS = """
caseid:bigint subjectid:int casestart:int caseend:int anestart:int aneend:double opstart:int
opend:int adm:int dis:int icu_days:int death_inhosp:int age:string sex:string height:double
weight:double bmi:double asa:double emop:int department:string optype:string dx:string
opname:string approach:string position:string ane_type:string preop_htn:int preop_dm:int
preop_ecg:string preop_pft:string preop_hb:double preop_plt:double preop_pt:double
preop_aptt:double preop_na:double preop_k:double preop_gluc:double preop_alb:double
preop_ast:double preop_alt:double preop_bun:double preop_cr:double preop_ph:double
preop_hco3:double preop_be:double preop_pao2:double preop_paco2:double preop_sao2:double
cormack:string airway:string tubesize:double dltubesize:string lmasize:double iv1:string
iv2:string aline1:string aline2:string cline1:string cline2:string intraop_ebl:double
intraop_uo:double intraop_rbc:int intraop_ffp:int intraop_crystalloid:double
intraop_colloid:int intraop_ppf:int intraop_mdz:double intraop_ftn:int intraop_rocu:int
intraop_vecu:int intraop_eph:int intraop_phe:int intraop_epi:int intraop_ca:int
"""

CLINICAL_CASE = _struct(
    ", ".join(f"{name} {kind}" for name, kind in (c.split(":") for c in _CLINICAL_COLUMNS.split()))
)
