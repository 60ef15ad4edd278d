"""Alerts: build, route, acknowledge, list."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.model import threshold_alert
from pulseframe.functions.patients import name_from_id
from pulseframe.operators.filters import ALERT_LEVELS, alert_levels
from pulseframe.operators.ordered import following_min

# Texts, channels, display time and history lengths.
DEFAULT_REASON = "Risk threshold exceeded"
DEFAULT_TYPE = "risk_threshold"
SIMPLE_ALERT_TYPE = "CRITICAL_VITALS"
SIMPLE_SEVERITY = "HIGH"
SLACK_LEVELS = ("HIGH", "CRITICAL")
EMAIL_LEVELS = ("CRITICAL",)
DISPLAY_SECONDS = 60
HISTORY_LENGTH = 100
SHORT_HISTORY_LENGTH = 50
HISTORY_ON_CONNECT = 10
RECENT_IN_STATS = 5


def _pressure(systolic: Column, diastolic: Column) -> Column:
    missing = F.lit("--")
    return F.concat_ws(
        "/", F.coalesce(systolic.cast("string"), missing), F.coalesce(diastolic.cast("string"), missing)
    )


def build_alerts(
    scored: DataFrame, levels: Iterable[str] = ALERT_LEVELS, keep: Sequence[str] = ()
) -> DataFrame:
    """One alert per scored reading at an alerting level, with the ``keep`` columns. Narrow."""
    first = F.get(F.col("anomalies"), 0)["type"]
    return alert_levels(scored, levels).select(
        "patient_id",
        name_from_id(F.col("patient_id").cast("string")).alias("patient_name"),
        F.coalesce(first, F.lit(DEFAULT_TYPE)).alias("alert_type"),
        F.coalesce(first, F.lit(DEFAULT_REASON)).alias("alert_reason"),
        F.col("risk_level").alias("severity"),
        "risk_level",
        "risk_score",
        "timestamp",
        F.struct(
            "heart_rate",
            "spo2",
            "temperature",
            _pressure(F.col("blood_pressure_systolic"), F.col("blood_pressure_diastolic")).alias("blood_pressure"),
        ).alias("vital_signs"),
        "warnings",
        *keep,
    )


def simple_alerts(readings: DataFrame) -> DataFrame:
    """Alerts by plain thresholds, without scoring."""
    return readings.filter(threshold_alert(F.col("heart_rate"), F.col("spo2"))).withColumns(
        {"alert_type": F.lit(SIMPLE_ALERT_TYPE), "severity": F.lit(SIMPLE_SEVERITY)}
    )


def channels(level: Column) -> Column:
    """ARRAY of channels an alert goes to; the dashboard gets every alert."""
    return F.array_compact(
        F.array(
            F.lit("dashboard"),
            F.when(level.isin(*SLACK_LEVELS), F.lit("slack")),
            F.when(level.isin(*EMAIL_LEVELS), F.lit("email")),
        )
    )


def route_alerts(alerts: DataFrame) -> DataFrame:
    """One row per alert and channel."""
    return alerts.withColumn("channel", F.explode(channels(F.col("risk_level"))))


def acknowledge(
    alerts: DataFrame,
    acks: DataFrame,
    keys: Sequence[str] = ("patient_id",),
    runs: int | None = None,
) -> DataFrame:
    """Alerts with the first acknowledgement of their patient at or after the alert.

    ``alerts`` hold (patient_id, ts, alert_id, ...), ``acks`` (patient_id, ts, acknowledged_by).
    Both go into one time-ordered walk per patient, so no alert meets every
    acknowledgement of its patient.
    """
    keys = list(keys)
    extra = [c for c in alerts.columns if c not in (*keys, "ts", "alert_id")]
    mark = F.struct(F.col("ts").alias("at"), F.col("acknowledged_by").alias("by"))
    # At equal times the acknowledgement sorts after the alert and so counts for it.
    left = alerts.select(
        *keys, "ts", F.lit(0).alias("_side"), "alert_id", F.struct(*extra).alias("_rest") if extra else F.lit(None).alias("_rest")
    )
    right = acks.select(*keys, "ts", F.lit(1).alias("_side"), mark.alias("_ack"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn(
        "_order", F.coalesce(F.col("alert_id"), F.lit(-1))
    )
    marked = following_min(both, keys, ("ts", "_side", "_order"), "_ack", "_next", runs)
    return marked.filter(F.col("_side") == 0).select(
        *keys,
        "ts",
        "alert_id",
        *((F.col("_rest")[c].alias(c)) for c in extra),
        F.col("_next").isNotNull().alias("acknowledged"),
        F.col("_next")["at"].alias("acknowledged_at"),
        F.col("_next")["by"].alias("acknowledged_by"),
    )


def active_at(alerts: DataFrame, at: Column, display_seconds: int = DISPLAY_SECONDS) -> DataFrame:
    """Alerts on screen at ``at``: shown, not acknowledged, and if not critical not older than the display time."""
    shown = F.col("ts") <= at
    acked = F.coalesce(F.col("acknowledged_at") <= at, F.lit(False))
    fresh = F.col("ts") > at - F.make_dt_interval(secs=F.lit(float(display_seconds)))
    return alerts.filter(shown & ~acked & ((F.col("severity") == "CRITICAL") | fresh))


def history(alerts: DataFrame, n: int = HISTORY_LENGTH, order: Sequence[str] = ("ts", "alert_id")) -> DataFrame:
    """The last ``n`` alerts, newest first; a query on the table, independent of who listens."""
    return alerts.orderBy(*(F.col(c).desc() for c in order)).limit(n)


def history_stats(
    alerts: DataFrame, kept: int = HISTORY_LENGTH, recent: int = RECENT_IN_STATS, order: Sequence[str] = ("ts", "alert_id")
) -> DataFrame:
    """Number of alerts in the kept history, and the last few of them, newest first."""
    last = F.struct(*order, *(c for c in alerts.columns if c not in order))
    newest = F.slice(F.sort_array(F.collect_list(last), asc=False), 1, recent)
    return history(alerts, kept, order).agg(F.count(F.lit(1)).alias("total_alerts"), newest.alias("recent_alerts"))
