"""Alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.functions.scoring import score_readings
from pulseframe.operators import alerts as a
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query, runs
from pulseframe.plans.vitals import SCORED_SQL

AT = "2024-01-20 12:00:00"
WEEK = 7 * 86_400

_KIND_SQL = "CASE WHEN heart_rate > 130 THEN 'tachycardia' WHEN spo2 <> 0 AND spo2 < 90 THEN 'hypoxia' END"
BUILT_SQL = f"""
SELECT patient_id, 'Patient ' || patient_id AS patient_name, coalesce({_KIND_SQL}, 'risk_threshold') AS alert_type,
       coalesce({_KIND_SQL}, 'Risk threshold exceeded') AS alert_reason, risk_level, risk_score, timestamp,
       heart_rate IS NOT NULL AS has_rate, CASE WHEN mews_score >= 5 THEN 1 ELSE 0 END AS n_warnings
FROM ({SCORED_SQL}) WHERE risk_level IN ('MODERATE', 'HIGH', 'CRITICAL')"""


def _built(spark, sf_dir):
    return a.build_alerts(score_readings(t.readings(spark, sf_dir)))


@query("alerts_built", f"SELECT patient_id, patient_name, alert_type, alert_reason, risk_level AS severity, risk_score, timestamp, has_rate, n_warnings FROM ({BUILT_SQL})")
def alerts_built(spark, sf_dir):
    return _built(spark, sf_dir).select(
        "patient_id", "patient_name", "alert_type", "alert_reason", "severity",
        "risk_score", "timestamp",
        F.col("vital_signs.heart_rate").isNotNull().alias("has_rate"), F.size("warnings").alias("n_warnings"),
    )


@query(
    "alerts_routed",
    f"""SELECT patient_id, timestamp, risk_level, channel FROM ({BUILT_SQL}) JOIN
  (VALUES ('dashboard', 'MODERATE'), ('dashboard', 'HIGH'), ('dashboard', 'CRITICAL'), ('slack', 'HIGH'), ('slack', 'CRITICAL'), ('email', 'CRITICAL')) c(channel, level)
  ON risk_level = level""",
)
def alerts_routed(spark, sf_dir):
    return a.route_alerts(_built(spark, sf_dir)).select("patient_id", "timestamp", "risk_level", "channel")


ACKED_SQL = f"""
SELECT a.patient_id, a.ts, a.alert_id, a.alert_type, a.severity, k.ts IS NOT NULL AS acknowledged, k.ts AS acknowledged_at, k.acknowledged_by
FROM ({t.ALERTS_SQL}) a ASOF LEFT JOIN ({t.ACKS_SQL}) k ON a.patient_id = k.patient_id AND a.ts <= k.ts"""


def _acked(spark, sf_dir):
    return a.acknowledge(t.alert_events(spark, sf_dir), t.ack_events(spark, sf_dir), runs=runs(spark))


@query("alerts_acked", ACKED_SQL)
def alerts_acked(spark, sf_dir):
    return _acked(spark, sf_dir)


@query(
    "active_alerts",
    f"""SELECT patient_id, alert_id, severity, ts FROM ({ACKED_SQL})
WHERE ts <= TIMESTAMP '{AT}' AND NOT coalesce(acknowledged_at <= TIMESTAMP '{AT}', FALSE)
  AND (severity = 'CRITICAL' OR ts > TIMESTAMP '{AT}' - INTERVAL {WEEK} SECONDS)""",
)
def active_alerts(spark, sf_dir):
    # The events are sparse, so alerts stay on screen for a week here.
    shown = a.active_at(_acked(spark, sf_dir), t.ntz(AT), display_seconds=WEEK)
    return shown.select("patient_id", "alert_id", "severity", "ts")


@query("alert_history", f"SELECT * FROM ({t.ALERTS_SQL}) ORDER BY ts DESC, alert_id DESC LIMIT 100")
def alert_history(spark, sf_dir):
    return a.history(t.alert_events(spark, sf_dir))


@query(
    "alert_history_stats",
    f"""SELECT (SELECT least(count(*), 100) FROM ({t.ALERTS_SQL})) AS total_alerts, string_agg(CAST(alert_id AS VARCHAR), ',' ORDER BY ts DESC, alert_id DESC) AS recent
FROM (SELECT * FROM ({t.ALERTS_SQL}) ORDER BY ts DESC, alert_id DESC LIMIT 5)""",
)
def alert_history_stats(spark, sf_dir):
    stats = a.history_stats(t.alert_events(spark, sf_dir))
    ids = F.transform("recent_alerts.alert_id", lambda i: i.cast("string"))
    return stats.select("total_alerts", F.array_join(ids, ",").alias("recent"))


@query("alert_short_history", f"SELECT * FROM ({t.ALERTS_SQL}) ORDER BY ts DESC, alert_id DESC LIMIT 50")
def alert_short_history(spark, sf_dir):
    return a.history(t.alert_events(spark, sf_dir), a.SHORT_HISTORY_LENGTH)


@query("alerts_on_connect", f"SELECT * FROM ({t.ALERTS_SQL}) ORDER BY ts DESC, alert_id DESC LIMIT 10")
def alerts_on_connect(spark, sf_dir):
    return a.history(t.alert_events(spark, sf_dir), a.HISTORY_ON_CONNECT)


@query(
    "simple_alerts",
    f"""SELECT patient_id, timestamp, 'CRITICAL_VITALS' AS alert_type, 'HIGH' AS severity FROM ({t.READINGS_SQL})
WHERE coalesce(heart_rate, 0) > 120 OR coalesce(heart_rate, 0) < 50 OR coalesce(spo2, 100) < 90""",
)
def simple_alerts(spark, sf_dir):
    return a.simple_alerts(t.readings(spark, sf_dir)).select("patient_id", "timestamp", "alert_type", "severity")
