"""The given tables read as this domain, and the same mapping as SQL text.

Events stand for vital-sign points, customers and suppliers for patients (no
supplier is ever admitted), orders for admissions, order lines with their part
for clinical cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# event type -> (vital, scale, offset): value * scale + offset
EVENT_VITALS = {
    "click": ("heart_rate", 1.0, 30.0),
    "view": ("spo2", -0.2, 100.0),
    "purchase": ("temperature", 0.05, 34.0),
    "signup": ("respiratory_rate", 0.25, 4.0),
    "error": ("blood_pressure_systolic", 1.0, 60.0),
}
REF_TIME = "2024-01-31 00:00:00"
ADMISSION_REF = "2001-09-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, patient_id, ts, field, value."""
    field, value = F, F
    for kind, (vital, scale, offset) in EVENT_VITALS.items():
        mine = F.col("event_type") == kind
        field = field.when(mine, F.lit(vital))
        value = value.when(mine, F.col("value") * F.lit(scale) + F.lit(offset))
    return load(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("patient_id"), "ts", field.alias("field"), value.alias("value")
    )


POINTS_SQL = """
SELECT event_id, user_id AS patient_id, ts,
       CASE event_type WHEN 'click' THEN 'heart_rate' WHEN 'view' THEN 'spo2' WHEN 'purchase' THEN 'temperature'
                       WHEN 'signup' THEN 'respiratory_rate' WHEN 'error' THEN 'blood_pressure_systolic' END AS field,
       CASE event_type WHEN 'click' THEN value * 1.0::DOUBLE + 30.0::DOUBLE WHEN 'view' THEN value * -0.2::DOUBLE + 100.0::DOUBLE
                       WHEN 'purchase' THEN value * 0.05::DOUBLE + 34.0::DOUBLE WHEN 'signup' THEN value * 0.25::DOUBLE + 4.0::DOUBLE
                       WHEN 'error' THEN value * 1.0::DOUBLE + 60.0::DOUBLE END AS value
FROM events"""


def carried(df: DataFrame, fields: list[str]) -> DataFrame:
    """Each point of a patient with the last value of every vital up to it, one column per vital."""
    so_far = Window.partitionBy("patient_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {v: F.last(F.when(F.col("field") == v, F.col("value")), ignorenulls=True).over(so_far) for v in fields}
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide reading per point: the patient's vitals as they stand then, the day and the time."""
    vitals = [v[0] for v in EVENT_VITALS.values()]
    wide = carried(points(spark, sf_dir), vitals)
    return wide.select(
        "patient_id", F.to_date("ts").cast("string").alias("day"), F.col("ts").alias("timestamp"), *vitals,
        (F.col("blood_pressure_systolic") / 2 + 15).alias("blood_pressure_diastolic"),
    )


def carried_sql(fields: list[str]) -> str:
    return ", ".join(
        f"last_value(CASE WHEN field = '{v}' THEN value END IGNORE NULLS) OVER so_far AS {v}" for v in fields
    )


SO_FAR_SQL = "WINDOW so_far AS (PARTITION BY patient_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
READINGS_SQL = f"""
SELECT *, blood_pressure_systolic / 2 + 15 AS blood_pressure_diastolic FROM (
  SELECT patient_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, ts AS timestamp,
         {carried_sql(["heart_rate", "spo2", "temperature", "respiratory_rate", "blood_pressure_systolic"])}
  FROM ({POINTS_SQL}) {SO_FAR_SQL})"""


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_name").alias("full_name"),
        F.when(
            F.col("c_acctbal") >= 0,
            F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") * 37 % 25000).cast("int")),
        ).alias("date_of_birth"),
        F.when(segment == "BUILDING", "Male").when(segment == "FURNITURE", "Female")
        .when(segment == "MACHINERY", "Unknown").alias("gender"),
        F.when(segment == "HOUSEHOLD", "None").when(segment != "AUTOMOBILE", "O+").alias("blood_type"),
        F.when(segment != "MACHINERY", F.concat(F.lit("DEV-"), F.col("c_custkey").cast("string"))).alias("device_id"),
        F.lit(True).alias("active_monitoring"),
        segment.alias("profile"),
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("patient_id"),
        F.col("s_name").alias("full_name"),
        F.lit("1970-06-15").cast("date").alias("date_of_birth"),
        F.lit("Female").alias("gender"),
        F.lit("A-").alias("blood_type"),
        F.lit("DEV-S").alias("device_id"),
        F.lit(True).alias("active_monitoring"),
        F.lit("SUPPLIER").alias("profile"),
    )
    created = ntz("2020-01-01 00:00:00")
    return customers.unionByName(suppliers).withColumns(
        {
            "extra_data": F.lit(None).cast("string"),
            "created_at": created,
            "updated_at": created,
            "deleted_at": F.lit(None).cast("timestamp_ntz"),
        }
    )


PATIENTS_SQL = """
SELECT *, CAST(NULL AS VARCHAR) AS extra_data, TIMESTAMP '2020-01-01' AS created_at,
       TIMESTAMP '2020-01-01' AS updated_at, CAST(NULL AS TIMESTAMP) AS deleted_at FROM (
SELECT c_custkey AS patient_id, c_name AS full_name,
       CASE WHEN c_acctbal >= 0 THEN DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) END AS date_of_birth,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Male' WHEN 'FURNITURE' THEN 'Female' WHEN 'MACHINERY' THEN 'Unknown' END AS gender,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'None' WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'O+' END AS blood_type,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'DEV-' || c_custkey END AS device_id,
       TRUE AS active_monitoring, c_mktsegment AS profile
FROM customer
UNION ALL
SELECT -1 - s_suppkey, s_name, DATE '1970-06-15', 'Female', 'A-', 'DEV-S', TRUE, 'SUPPLIER' FROM supplier)"""


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("admission_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").alias("admission_time"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 5 DAYS")).alias("discharge_time"),
        F.when(F.col("o_orderstatus") == "F", "Elective").otherwise("Emergency").alias("admission_type"),
        F.when(price < 100000, "ICU").when(price < 200000, "CCU").when(price < 300000, "Emergency")
        .when(price < 400000, "Surgery").otherwise("ICU-Emergency").alias("department"),
        F.when(priority == "1-URGENT", "Auto-admitted from Stream").when(priority == "2-HIGH", "Observation")
        .when(priority == "3-MEDIUM", "Sepsis follow-up").when(priority == "5-LOW", "Post-operative care")
        .alias("initial_diagnosis"),
        F.concat(F.lit("Team "), F.left(priority, F.lit(1))).alias("attending_physician"),
        F.when(priority == "1-URGENT", "CRITICAL").when(priority == "2-HIGH", "HIGH")
        .when(priority == "3-MEDIUM", "MODERATE").when(priority == "5-LOW", "STABLE").alias("risk_level"),
        (price / 5000).alias("current_risk_score"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


ADMISSIONS_SQL = """
SELECT o_orderkey AS admission_id, o_custkey AS patient_id, o_orderdate AS admission_time,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 5 DAYS END AS discharge_time,
       CASE WHEN o_orderstatus = 'F' THEN 'Elective' ELSE 'Emergency' END AS admission_type,
       CASE WHEN o_totalprice < 100000 THEN 'ICU' WHEN o_totalprice < 200000 THEN 'CCU'
            WHEN o_totalprice < 300000 THEN 'Emergency' WHEN o_totalprice < 400000 THEN 'Surgery'
            ELSE 'ICU-Emergency' END AS department,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Auto-admitted from Stream' WHEN '2-HIGH' THEN 'Observation'
            WHEN '3-MEDIUM' THEN 'Sepsis follow-up' WHEN '5-LOW' THEN 'Post-operative care' END AS initial_diagnosis,
       'Team ' || left(o_orderpriority, 1) AS attending_physician,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH'
            WHEN '3-MEDIUM' THEN 'MODERATE' WHEN '5-LOW' THEN 'STABLE' END AS risk_level,
       o_totalprice / 5000 AS current_risk_score, CAST(NULL AS TIMESTAMP) AS updated_at
FROM orders"""


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clinical cases; age is text, as in the case files."""
    lines = load(spark, sf_dir, "lineitem")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    seconds = F.col("l_quantity") * 600
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("caseid"),
        F.lit(0.0).alias("casestart"),
        seconds.alias("caseend"),
        F.lit(-600.0).alias("anestart"),
        (seconds + 300).alias("aneend"),
        F.greatest(F.round(F.col("l_discount") * 100).cast("int") - 8, F.lit(0)).alias("icu_days"),
        (F.col("l_tax") >= 0.08).cast("int").alias("death_inhosp"),
        (F.col("p_size") + 40).cast("string").alias("age"),
        (F.col("l_linenumber") % 6 + 1).alias("asa"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).cast("int").alias("emop"),
        F.col("p_name").alias("opname"),
        F.col("p_type").alias("department"),
    )


CASES_SQL = """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS caseid,
       0.0::DOUBLE AS casestart, l_quantity * 600 AS caseend, -600.0::DOUBLE AS anestart,
       l_quantity * 600 + 300 AS aneend,
       greatest(CAST(round(l_discount * 100) AS INTEGER) - 8, 0) AS icu_days,
       CAST(l_tax >= 0.08::DOUBLE AS INTEGER) AS death_inhosp, CAST(p_size + 40 AS VARCHAR) AS age,
       l_linenumber % 6 + 1 AS asa,
       CAST(l_returnflag = 'R' AND l_linestatus = 'O' AS INTEGER) AS emop,
       p_name AS opname, p_type AS department
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def consumer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one processed message of the consumer of its type."""
    return load(spark, sf_dir, "events").select(
        F.col("event_type").alias("consumer"),
        "ts",
        "event_id",
        F.col("value").alias("processing_time_ms"),
        (F.col("value") > 150).alias("failed"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.get_json_object("props", "$.k").cast("bigint").alias("lag"),
    )


METRICS_SQL = """
SELECT event_type AS consumer, ts, event_id, value AS processing_time_ms, value > 150 AS failed,
       CAST(user_id % 8 AS INTEGER) AS partition, event_id AS "offset",
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS lag
FROM events"""


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but sign-ups as alerts."""
    value = F.col("value")
    return load(spark, sf_dir, "events").filter(F.col("event_type") != "signup").select(
        F.col("user_id").alias("patient_id"),
        "ts",
        F.col("event_id").alias("alert_id"),
        F.col("event_type").alias("alert_type"),
        F.when(value >= 100, "CRITICAL").when(value >= 50, "HIGH").otherwise("MODERATE").alias("severity"),
    )


def ack_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as acknowledgements."""
    return load(spark, sf_dir, "events").filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("patient_id"),
        "ts",
        F.concat(F.lit("nurse-"), F.get_json_object("props", "$.k")).alias("acknowledged_by"),
    )


ALERTS_SQL = """
SELECT user_id AS patient_id, ts, event_id AS alert_id, event_type AS alert_type,
       CASE WHEN value >= 100 THEN 'CRITICAL' WHEN value >= 50 THEN 'HIGH' ELSE 'MODERATE' END AS severity
FROM events WHERE event_type <> 'signup'"""
ACKS_SQL = """
SELECT user_id AS patient_id, ts, 'nurse-' || json_extract_string(props, '$.k') AS acknowledged_by
FROM events WHERE event_type = 'signup'"""
