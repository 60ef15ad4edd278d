"""Table maintenance queries: the new state of a table after a change set."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.functions.patients import patient_key
from pulseframe.functions.scoring import score_readings
from pulseframe.operators import maintain as m
from pulseframe.operators.relate import lookup_case
from pulseframe.plans import tables as t
from pulseframe.plans.people import CURRENT_SQL
from pulseframe.plans.registry import query
from pulseframe.plans.vitals import SCORED_SQL

NOW = "2024-02-01 08:00:00"

# Monitored users beyond the known customers are the new patients. Readings carry a
# shifted id so that known patients, patients without an open admission and unknown
# patients all occur.
_SHIFT = 1000
SHIFTED_SQL = f"SELECT * REPLACE (patient_id * 13 - {_SHIFT} AS patient_id) FROM ({SCORED_SQL})"
LATEST_SQL = f"SELECT * FROM ({SHIFTED_SQL}) QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY timestamp DESC) = 1"


def _now():
    return t.ntz(NOW)


def _latest(spark, sf_dir):
    scored = score_readings(t.readings(spark, sf_dir)).withColumn("patient_id", F.col("patient_id") * 13 - _SHIFT)
    return m.latest_risk(scored, ["timestamp"])


_CURRENT_IDS = f"SELECT patient_id, admission_id FROM ({CURRENT_SQL})"


@query(
    "risk_upsert_admissions",
    f"""WITH latest AS ({LATEST_SQL}), current_adm AS ({_CURRENT_IDS}), adm AS ({t.ADMISSIONS_SQL})
SELECT a.patient_id, a.department, a.initial_diagnosis,
  CASE WHEN l.patient_id IS NULL THEN a.risk_level ELSE l.risk_level END AS risk_level,
  CASE WHEN l.patient_id IS NULL THEN a.current_risk_score ELSE l.risk_score END AS current_risk_score,
  CASE WHEN l.patient_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE a.updated_at END AS updated_at, a.admission_time
FROM adm a LEFT JOIN current_adm c ON a.admission_id = c.admission_id LEFT JOIN latest l ON c.patient_id = l.patient_id
UNION ALL
SELECT patient_id, 'ICU-Emergency', 'Auto-admitted from Stream', risk_level, risk_score, NULL, TIMESTAMP '{NOW}'
FROM latest WHERE patient_id NOT IN (SELECT patient_id FROM current_adm)""",
)
def risk_upsert_admissions(spark, sf_dir):
    _, admissions = m.update_risk(
        t.patients(spark, sf_dir), t.admissions(spark, sf_dir), _latest(spark, sf_dir), _now()
    )
    return admissions.select(
        "patient_id", "department", "initial_diagnosis", "risk_level",
        "current_risk_score", "updated_at", "admission_time",
    )


@query(
    "risk_upsert_patients",
    f"""WITH latest AS ({LATEST_SQL}), current_adm AS ({_CURRENT_IDS}), pat AS ({t.PATIENTS_SQL})
SELECT patient_id, full_name, CAST(date_of_birth AS VARCHAR) AS date_of_birth, gender, active_monitoring FROM pat
UNION ALL
SELECT patient_id, 'Patient ' || patient_id, '1970-01-01', 'Unknown', TRUE FROM latest
WHERE patient_id NOT IN (SELECT patient_id FROM current_adm) AND patient_id NOT IN (SELECT patient_id FROM pat)""",
)
def risk_upsert_patients(spark, sf_dir):
    patients, _ = m.update_risk(
        t.patients(spark, sf_dir), t.admissions(spark, sf_dir), _latest(spark, sf_dir), _now()
    )
    return patients.select(
        "patient_id", "full_name", F.col("date_of_birth").cast("string").alias("date_of_birth"), "gender", "active_monitoring"
    )


# Parts arrive as new patients: ids below the customer count exist already.
def _arrivals(spark, sf_dir):
    return t.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("patient_id"),
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("name"),
        F.when(F.col("p_size") <= 45, F.col("p_size")).alias("age"),
        F.when(F.col("p_type") == "LARGE", "Male").alias("gender"),
        F.when(F.col("p_type") == "SMALL", "B+").alias("blood_type"),
    )


@query(
    "insert_patients",
    f"""WITH pat AS ({t.PATIENTS_SQL})
SELECT patient_id, full_name, CAST(date_of_birth AS VARCHAR) AS date_of_birth, gender, device_id, blood_type, active_monitoring FROM pat
UNION ALL
SELECT p_partkey, CASE WHEN p_size > 5 THEN p_name ELSE 'Unknown' END,
  CAST(make_date(2024 - CASE WHEN p_size <= 45 THEN p_size ELSE 30 END, 1, 1) AS VARCHAR),
  CASE WHEN p_type = 'LARGE' THEN 'Male' ELSE 'Unknown' END, 'DEV-' || p_partkey,
  CASE WHEN p_type = 'SMALL' THEN 'B+' ELSE 'Unknown' END, TRUE
FROM part WHERE p_partkey NOT IN (SELECT patient_id FROM pat)""",
)
def insert_patients(spark, sf_dir):
    new = m.add_patients(t.patients(spark, sf_dir), _arrivals(spark, sf_dir), ["name", "age"], _now())
    return new.select(
        "patient_id", "full_name", F.col("date_of_birth").cast("string").alias("date_of_birth"),
        "gender", "device_id", "blood_type", "active_monitoring",
    )


@query(
    "insert_admissions",
    f"""WITH adm AS ({t.ADMISSIONS_SQL})
SELECT patient_id, department, initial_diagnosis, risk_level, admission_time FROM adm
UNION ALL
SELECT p_partkey, 'ICU', 'Observation', 'STABLE', TIMESTAMP '{NOW}' FROM part
WHERE p_partkey NOT IN (SELECT patient_id FROM adm WHERE discharge_time IS NULL)""",
)
def insert_admissions(spark, sf_dir):
    new = m.add_admissions(t.admissions(spark, sf_dir), _arrivals(spark, sf_dir), _now())
    return new.select("patient_id", "department", "initial_diagnosis", "risk_level", "admission_time")


_LAST_EVENT_SQL = "SELECT * FROM (SELECT user_id * 11 AS patient_id, event_type AS profile, props AS extra_data, ts, event_id FROM events) QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, event_id DESC) = 1"


upsert_profiles_sql = f"""SELECT coalesce(p.patient_id, c.patient_id) AS patient_id, p.full_name,
  CASE WHEN c.patient_id IS NOT NULL THEN c.profile ELSE p.profile END AS profile,
  CASE WHEN c.patient_id IS NOT NULL THEN c.extra_data ELSE p.extra_data END AS extra_data,
  CASE WHEN p.patient_id IS NOT NULL THEN p.created_at ELSE TIMESTAMP '{NOW}' END AS created_at,
  CASE WHEN c.patient_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE p.updated_at END AS updated_at
FROM ({t.PATIENTS_SQL}) p FULL JOIN ({_LAST_EVENT_SQL}) c ON p.patient_id = c.patient_id"""


def _profile_changes(spark, sf_dir):
    return t.load(spark, sf_dir, "events").select(
        (F.col("user_id") * 11).alias("patient_id"), F.col("event_type").alias("profile"),
        F.col("props").alias("extra_data"), "ts", "event_id",
    )


@query("upsert_profiles", upsert_profiles_sql)
def upsert_profiles(spark, sf_dir):
    new = m.upsert_profiles(t.patients(spark, sf_dir), _profile_changes(spark, sf_dir), ["ts", "event_id"], _now())
    return new.select("patient_id", "full_name", "profile", "extra_data", "created_at", "updated_at")


def _register(spark, sf_dir):
    return t.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_nationkey").alias("age"),
        F.col("c_mktsegment").alias("diagnosis"), F.col("c_acctbal").alias("apache_score"), F.lit("active").alias("status"),
    )


_REGISTER_SQL = "SELECT c_custkey AS patient_id, c_nationkey AS age, c_mktsegment AS diagnosis, c_acctbal AS apache_score, 'active' AS status FROM customer"


@query(
    "replace_patients",
    f"""WITH last_row AS (SELECT o_custkey * 2 AS patient_id, o_totalprice AS apache_score, CASE WHEN o_orderstatus = 'F' THEN 'discharged' END AS status
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT * FROM ({_REGISTER_SQL}) WHERE patient_id NOT IN (SELECT patient_id FROM last_row)
UNION ALL SELECT patient_id, NULL, NULL, apache_score, coalesce(status, 'active') FROM last_row""",
)
def replace_patients(spark, sf_dir):
    new = t.load(spark, sf_dir, "orders").select(
        (F.col("o_custkey") * 2).alias("patient_id"), F.col("o_totalprice").alias("apache_score"),
        F.when(F.col("o_orderstatus") == "F", "discharged").alias("status"), "o_orderdate", "o_orderkey",
    )
    return m.replace_rows(_register(spark, sf_dir), new, ["o_orderdate", "o_orderkey"])


@query(
    "bulk_append",
    f"{_REGISTER_SQL} UNION ALL SELECT -1 - s_suppkey, s_nationkey, NULL, s_acctbal, 'active' FROM supplier",
)
def bulk_append(spark, sf_dir):
    new = t.load(spark, sf_dir, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("patient_id"), F.col("s_nationkey").alias("age"), F.col("s_acctbal").alias("apache_score")
    )
    return m.bulk_append(_register(spark, sf_dir), new)


# Patients with an order of a finished status and a low price leave.
def _gone(spark, sf_dir):
    return t.load(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 20000)
    ).select(F.col("o_custkey").alias("patient_id"))


_GONE_SQL = "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 20000"


@query(
    "soft_delete",
    f"""SELECT patient_id, full_name, patient_id NOT IN ({_GONE_SQL}) AS active_monitoring,
  CASE WHEN patient_id IN ({_GONE_SQL}) THEN TIMESTAMP '{NOW}' ELSE deleted_at END AS deleted_at FROM ({t.PATIENTS_SQL})""",
)
def soft_delete(spark, sf_dir):
    new = m.soft_delete(t.patients(spark, sf_dir), _gone(spark, sf_dir), _now())
    return new.select("patient_id", "full_name", "active_monitoring", "deleted_at")


@query(
    "hard_delete",
    f"""SELECT 'patients' AS source, patient_id, NULL AS admission_id FROM ({t.PATIENTS_SQL}) WHERE patient_id NOT IN ({_GONE_SQL})
UNION ALL SELECT 'admissions', patient_id, admission_id FROM ({t.ADMISSIONS_SQL}) WHERE patient_id NOT IN ({_GONE_SQL})""",
)
def hard_delete(spark, sf_dir):
    left = m.hard_delete(
        {"patients": t.patients(spark, sf_dir), "admissions": t.admissions(spark, sf_dir)}, _gone(spark, sf_dir)
    )
    people = left["patients"].select(F.lit("patients").alias("source"), "patient_id", F.lit(None).cast("bigint").alias("admission_id"))
    return people.unionByName(left["admissions"].select(F.lit("admissions").alias("source"), "patient_id", "admission_id"))


def _with_text_ids(df):
    key = F.col("patient_id")
    return df.withColumn("patient_id", F.when(key >= 0, patient_key(key)).otherwise(F.concat(F.lit("SUP"), key.cast("string"))))


def _clinical(spark, sf_dir):
    return t.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("caseid"), F.when(F.col("p_size") <= 25, "M").otherwise("F").alias("sex"),
        F.col("p_type").alias("dx"), F.when(F.col("p_retailprice") >= 1000, F.col("p_name")).alias("opname"),
        F.col("p_brand").alias("department"),
    )


_TEXT_ID = "CASE WHEN patient_id >= 0 THEN 'ICU-' || lpad(CAST(patient_id AS VARCHAR), 6, '0') ELSE 'SUP' || patient_id END"


@query(
    "enrich_patients",
    f"""WITH cur AS ({CURRENT_SQL}), pat AS ({t.PATIENTS_SQL}), joined AS (
  SELECT p.patient_id, p.gender, p.blood_type, p.device_id, c.admission_id, c.initial_diagnosis, c.department,
    CASE WHEN k.p_size <= 25 THEN 'Male' ELSE 'Female' END AS case_gender, k.p_type AS dx,
    CASE WHEN k.p_retailprice >= 1000 THEN k.p_name END AS opname, k.p_brand AS case_department,
    coalesce(p.gender IS NULL OR p.gender = 'Unknown', FALSE) AS no_gender,
    coalesce(contains(c.initial_diagnosis, 'Auto-') OR c.initial_diagnosis = 'Observation', FALSE) AS no_diagnosis,
    p.blood_type IS NULL OR p.blood_type = 'None' AS no_blood, p.device_id IS NULL OR p.device_id = 'None' AS no_device
  FROM pat p JOIN cur c ON p.patient_id = c.patient_id JOIN part k ON p.patient_id = k.p_partkey)
SELECT {_TEXT_ID} AS patient_id, patient_id AS case_id, admission_id,
  CASE WHEN no_gender THEN case_gender ELSE gender END AS gender,
  CASE WHEN no_diagnosis THEN coalesce(opname, dx) ELSE initial_diagnosis END AS initial_diagnosis,
  CASE WHEN no_diagnosis AND (department IS NULL OR department = '' OR contains(department, 'ICU')) THEN case_department ELSE department END AS department,
  CASE WHEN no_blood THEN 'set' ELSE blood_type END AS blood_type,
  CASE WHEN no_device THEN 'MON-' || lpad(CAST(patient_id AS VARCHAR), CAST(greatest(4, length(CAST(patient_id AS VARCHAR))) AS INTEGER), '0') ELSE device_id END AS device_id,
  no_gender OR no_diagnosis OR no_blood OR no_device AS changed
FROM joined""",
)
def enrich_patients(spark, sf_dir):
    patients, admissions = _with_text_ids(t.patients(spark, sf_dir)), _with_text_ids(t.admissions(spark, sf_dir))
    rich = m.enrich_active(patients, admissions, _clinical(spark, sf_dir))
    old = patients.select("patient_id", F.col("blood_type").alias("_old"))
    # Which blood type is filled in depends on Spark's hash, so only the fact is compared.
    filled = F.col("_old").isNull() | (F.col("_old") == "None")
    known = F.when(F.col("blood_type").isin(*m.BLOOD_TYPES), "set")
    return (
        rich.join(old, "patient_id")
        .withColumn("blood_type", F.when(filled, known).otherwise(F.col("blood_type"))).drop("_old")
    )


@query(
    "enriched_admissions",
    f"""WITH cur AS ({CURRENT_SQL}), adm AS ({t.ADMISSIONS_SQL}), fix AS (
  SELECT c.admission_id, coalesce(CASE WHEN k.p_retailprice >= 1000 THEN k.p_name END, k.p_type) AS new_dx,
    CASE WHEN c.department IS NULL OR c.department = '' OR contains(c.department, 'ICU') THEN k.p_brand ELSE c.department END AS new_dept
  FROM cur c JOIN ({t.PATIENTS_SQL}) p ON p.patient_id = c.patient_id JOIN part k ON c.patient_id = k.p_partkey
  WHERE contains(c.initial_diagnosis, 'Auto-') OR c.initial_diagnosis = 'Observation')
SELECT a.admission_id, coalesce(f.new_dx, a.initial_diagnosis) AS initial_diagnosis, coalesce(f.new_dept, a.department) AS department
FROM adm a LEFT JOIN fix f ON a.admission_id = f.admission_id""",
)
def enriched_admissions(spark, sf_dir):
    patients, admissions = _with_text_ids(t.patients(spark, sf_dir)), _with_text_ids(t.admissions(spark, sf_dir))
    rich = m.enrich_active(patients, admissions, _clinical(spark, sf_dir))
    _, after = m.apply_enrichment(patients, admissions, rich)
    return after.select("admission_id", "initial_diagnosis", "department")


@query(
    "case_lookup",
    f"""SELECT p.patient_id, p.full_name, k.p_partkey IS NOT NULL AS found, k.p_type AS dx, k.p_brand AS department
FROM ({t.PATIENTS_SQL}) p LEFT JOIN part k ON p.patient_id = k.p_partkey""",
)
def case_lookup(spark, sf_dir):
    people = t.patients(spark, sf_dir).select("patient_id", "full_name", F.col("patient_id").alias("case_id"))
    clinical = _clinical(spark, sf_dir).withColumn("found", F.lit(True))
    return lookup_case(people, clinical).select(
        "patient_id", "full_name", F.coalesce("found", F.lit(False)).alias("found"), "dx", "department"
    )
