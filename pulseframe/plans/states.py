"""Stateful queries: cleanup and cooldown, in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.functions.scoring import score_readings
from pulseframe.operators.folds import clean_points, cool_down, plausible
from pulseframe.operators.rolling import rolling_times
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query, runs
from pulseframe.plans.vitals import _mews_sql
from pulseframe.schemas import VITALS

TWO_DAYS = 2 * 86_400

_IN_RANGE = """(CASE s.field WHEN 'heart_rate' THEN s.value BETWEEN 30 AND 200 WHEN 'spo2' THEN s.value BETWEEN 50 AND 100
  WHEN 'temperature' THEN s.value BETWEEN 30 AND 45 WHEN 'respiratory_rate' THEN s.value BETWEEN 4 AND 60
  WHEN 'blood_pressure_systolic' THEN s.value BETWEEN 50 AND 250 WHEN 'blood_pressure_diastolic' THEN s.value BETWEEN 20 AND 150
  ELSE TRUE END)"""
_NEXT = f"""CASE WHEN NOT {_IN_RANGE} THEN {{prev}}
  WHEN {{prev}} IS NOT NULL AND abs(s.value - {{prev}}) > CASE WHEN s.field = 'heart_rate' THEN 20 ELSE 5 END
    THEN {{prev}} * 0.7::DOUBLE + s.value * 0.3::DOUBLE ELSE s.value END"""
CLEANED_SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (PARTITION BY patient_id, field ORDER BY ts, event_id) AS rn FROM ({t.POINTS_SQL})),
walked AS (
  SELECT s.*, {_NEXT.format(prev='CAST(NULL AS DOUBLE)')} AS cleaned FROM numbered s WHERE rn = 1
  UNION ALL
  SELECT s.*, {_NEXT.format(prev='w.cleaned')} AS cleaned
  FROM walked w JOIN numbered s ON s.patient_id = w.patient_id AND s.field = w.field AND s.rn = w.rn + 1)
SELECT patient_id, field, ts, event_id, value, cleaned FROM walked WHERE cleaned IS NOT NULL"""

COOLDOWN_SQL = f"""
WITH RECURSIVE numbered AS (
  SELECT event_id, user_id AS patient_id, event_type AS alert_type, ts,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events),
walked AS (
  SELECT *, TRUE AS passed, ts AS sent FROM numbered WHERE rn = 1
  UNION ALL
  SELECT s.*, s.ts >= w.sent + INTERVAL {TWO_DAYS} SECONDS AS passed,
         CASE WHEN s.ts >= w.sent + INTERVAL {TWO_DAYS} SECONDS THEN s.ts ELSE w.sent END AS sent
  FROM walked w JOIN numbered s ON s.patient_id = w.patient_id AND s.alert_type = w.alert_type AND s.rn = w.rn + 1)
SELECT patient_id, alert_type, ts, event_id, passed FROM walked"""


def _alerts(spark, sf_dir):
    return t.load(spark, sf_dir, "events").select(
        F.col("user_id").alias("patient_id"), F.col("event_type").alias("alert_type"), "ts", "event_id"
    )


@query("cleaned_vitals", CLEANED_SQL)
def cleaned_vitals(spark, sf_dir):
    return clean_points(t.points(spark, sf_dir), runs=runs(spark)).select("patient_id", "field", "ts", "event_id", "value", "cleaned")


@query("alert_cooldown", COOLDOWN_SQL)
def alert_cooldown(spark, sf_dir):
    return cool_down(_alerts(spark, sf_dir), seconds=TWO_DAYS, runs=runs(spark)).select(
        "patient_id", "alert_type", "ts", "event_id", "passed"
    )


@query(
    "plausible_points",
    f"SELECT field, count(*) AS points, count(*) FILTER (WHERE {_IN_RANGE}) AS plausible FROM ({t.POINTS_SQL}) s GROUP BY 1",
)
def plausible_points(spark, sf_dir):
    return t.points(spark, sf_dir).groupBy("field").agg(
        F.count(F.lit(1)).alias("points"), F.count_if(plausible(F.col("field"), F.col("value"))).alias("plausible")
    )


_FIVE = [v for v in VITALS if v != "blood_pressure_diastolic"]


@query(
    "cleaned_and_scored",
    f"""SELECT patient_id, event_id, {_mews_sql()} AS mews_score FROM (
  SELECT patient_id, event_id, {t.carried_sql(_FIVE)} FROM (SELECT * REPLACE (cleaned AS value) FROM ({CLEANED_SQL})) {t.SO_FAR_SQL})""",
)
def cleaned_and_scored(spark, sf_dir):
    cleaned = clean_points(t.points(spark, sf_dir), runs=runs(spark)).withColumn("value", F.col("cleaned"))
    return score_readings(t.carried(cleaned, _FIVE)).select("patient_id", "event_id", "mews_score")


# One patient has all events: no task may need the whole key.
HOT_POINTS_SQL = f"SELECT event_id, 0::BIGINT AS patient_id, ts, field, value FROM ({t.POINTS_SQL})"
RUNS = 16


def _hot_points(spark, sf_dir):
    return t.points(spark, sf_dir).withColumn("patient_id", F.lit(0).cast("bigint"))


@query("cleaned_hot_key", CLEANED_SQL.replace(t.POINTS_SQL, HOT_POINTS_SQL))
def cleaned_hot_key(spark, sf_dir):
    cleaned = clean_points(_hot_points(spark, sf_dir), runs=RUNS)
    return cleaned.select("patient_id", "field", "ts", "event_id", "value", "cleaned")


@query("cooldown_hot_key", COOLDOWN_SQL.replace("user_id AS patient_id", "0::BIGINT AS patient_id").replace("PARTITION BY user_id", "PARTITION BY 0"))
def cooldown_hot_key(spark, sf_dir):
    alerts = _alerts(spark, sf_dir).withColumn("patient_id", F.lit(0).cast("bigint"))
    return cool_down(alerts, seconds=TWO_DAYS, runs=RUNS).select("patient_id", "alert_type", "ts", "event_id", "passed")


@query(
    "rolling_hot_key",
    f"SELECT event_id, min(value) OVER w AS least, max(value) OVER w AS most FROM ({HOT_POINTS_SQL}) WINDOW w AS (PARTITION BY patient_id ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)",
)
def rolling_hot_key(spark, sf_dir):
    rolled = rolling_times(_hot_points(spark, sf_dir), "value", ["patient_id"], runs=RUNS)
    return rolled.select("event_id", F.col("min_ms").alias("least"), F.col("max_ms").alias("most"))
