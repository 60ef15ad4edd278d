"""Scoring queries over the readings, one per point."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.functions import display, model, weighted
from pulseframe.functions.scoring import score_readings, scored_records
from pulseframe.operators.aggregates import level_counts
from pulseframe.operators.inference import score_model
from pulseframe.operators.rolling import rolling_features
from pulseframe.operators.timeseries import to_tall, to_wide
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query, runs, steady, steady_sql
from pulseframe.schemas import VITALS

KEYS = ["patient_id", "day"]


# The SQL states bands, weights and limits anew as literals, so that a wrong one in the code shows.
_BANDS_SQL = {
    "heart_rate": """CASE WHEN {v} <= 40 THEN 2 WHEN {v} BETWEEN 41 AND 50 THEN 1 WHEN {v} BETWEEN 101 AND 110 THEN 1
        WHEN {v} BETWEEN 111 AND 129 THEN 2 WHEN {v} >= 130 THEN 3 ELSE 0 END""",
    "respiratory_rate": "CASE WHEN {v} < 9 THEN 2 WHEN {v} BETWEEN 15 AND 20 THEN 1 WHEN {v} BETWEEN 21 AND 29 THEN 2 WHEN {v} >= 30 THEN 3 ELSE 0 END",
    "temperature": "CASE WHEN {v} < 35 THEN 2 WHEN {v} >= 38.5 THEN 2 ELSE 0 END",
    "blood_pressure_systolic": "CASE WHEN {v} <= 70 THEN 3 WHEN {v} BETWEEN 71 AND 80 THEN 2 WHEN {v} BETWEEN 81 AND 100 THEN 1 WHEN {v} >= 200 THEN 2 ELSE 0 END",
    "spo2": "CASE WHEN {v} < 85 THEN 3 WHEN {v} BETWEEN 85 AND 89 THEN 2 WHEN {v} BETWEEN 90 AND 93 THEN 1 ELSE 0 END",
}


def _bands_sql(name: str, value: str) -> str:
    return _BANDS_SQL[name].replace("{v}", value)


def _mews_sql(contiguous: bool = False) -> str:
    parts = [
        _bands_sql(n, f"floor({n})" if contiguous and n != "temperature" else n) for n in _BANDS_SQL
    ]
    return f"CAST(least({' + '.join(parts)}, 14) AS INTEGER)"


SCORED_SQL = f"""
SELECT *, CASE WHEN risk_score >= 75 OR mews_score >= 5 THEN 'CRITICAL'
               WHEN risk_score >= 50 OR mews_score >= 4 THEN 'HIGH'
               WHEN risk_score >= 20 OR mews_score >= 2 THEN 'MODERATE' ELSE 'STABLE' END AS risk_level
FROM (SELECT *, round(least(mews_score / 14.0::DOUBLE * 70
        + CASE WHEN heart_rate <> 0 AND (heart_rate < 40 OR heart_rate > 140) THEN 10 ELSE 0 END
        + CASE WHEN spo2 <> 0 AND spo2 < 85 THEN 10 WHEN spo2 <> 0 AND spo2 < 90 THEN 5 ELSE 0 END, 100), 2) AS risk_score
      FROM (SELECT *, {_mews_sql()} AS mews_score FROM ({t.READINGS_SQL})))"""

_VITAL_LIST = ", ".join(VITALS)


@query("wide_vitals", f"SELECT patient_id, day, {_VITAL_LIST} FROM ({t.READINGS_SQL})")
def wide_vitals(spark, sf_dir):
    return t.readings(spark, sf_dir).select(*KEYS, *VITALS)


@query(
    "wide_by_time",
    "SELECT patient_id, ts, "
    + ", ".join(f"max(CASE WHEN field = '{v}' THEN value END) AS {v}" for v in VITALS)
    + f" FROM ({t.POINTS_SQL}) GROUP BY 1, 2",
)
def wide_by_time(spark, sf_dir):
    return to_wide(t.points(spark, sf_dir))


@query(
    "tall_points",
    " UNION ALL ".join(
        f"SELECT patient_id, day, '{v}' AS field, {v} AS value FROM ({t.READINGS_SQL}) WHERE {v} IS NOT NULL"
        for v in VITALS
    ),
)
def tall_points(spark, sf_dir):
    return to_tall(t.readings(spark, sf_dir), KEYS)


@query("mews_scored", f"SELECT patient_id, day, mews_score, risk_score, risk_level FROM ({SCORED_SQL})")
def mews_scored(spark, sf_dir):
    return score_readings(t.readings(spark, sf_dir)).select(*KEYS, "mews_score", "risk_score", "risk_level")


@query("mews_contiguous", f"SELECT patient_id, day, {_mews_sql(True)} AS mews_score FROM ({t.READINGS_SQL})")
def mews_contiguous(spark, sf_dir):
    return score_readings(t.readings(spark, sf_dir), mode="contiguous").select(*KEYS, "mews_score")


@query("risk_by_level", f"SELECT risk_level, count(*) AS readings FROM ({SCORED_SQL}) GROUP BY 1")
def risk_by_level(spark, sf_dir):
    return level_counts(score_readings(t.readings(spark, sf_dir)))


@query(
    "anomaly_rows",
    f"""SELECT patient_id, day, 'tachycardia' AS type, heart_rate AS val FROM ({t.READINGS_SQL}) WHERE heart_rate > 130
UNION ALL SELECT patient_id, day, 'hypoxia', spo2 FROM ({t.READINGS_SQL}) WHERE spo2 <> 0 AND spo2 < 90""",
)
def anomaly_rows(spark, sf_dir):
    scored = score_readings(t.readings(spark, sf_dir))
    return scored.select(*KEYS, F.inline("anomalies"))


@query(
    "scored_records",
    f"""SELECT CAST(patient_id AS VARCHAR) AS patient_id, timestamp, risk_score, risk_level, mews_score,
  concat_ws(',', CASE WHEN heart_rate > 130 THEN 'tachycardia' END, CASE WHEN spo2 <> 0 AND spo2 < 90 THEN 'hypoxia' END) AS findings,
  CASE WHEN mews_score >= 5 THEN 'High MEWS Score: ' || mews_score ELSE '' END AS warning
FROM ({SCORED_SQL})""",
)
def scored_record_rows(spark, sf_dir):
    records = scored_records(t.readings(spark, sf_dir))
    return records.select(
        "patient_id", "timestamp", "risk_score", "risk_level", "mews_score",
        F.array_join(F.col("anomalies.type"), ",").alias("findings"),
        F.array_join("warnings", ",").alias("warning"),
    )


# vital: normal low and high, critical low and high, weight
_WEIGHTS_SQL = {
    "heart_rate": ("60.0", "100.0", "40", "120", "0.25"),
    "spo2": ("95.0", "100.0", "90", "100", "0.2"),
    "temperature": ("36.5", "37.5", "35", "38.5", "0.15"),
    "respiratory_rate": ("12.0", "20.0", "8", "25", "0.2"),
    "blood_pressure_systolic": ("90.0", "140.0", "80", "160", "0.15"),
    "blood_pressure_diastolic": ("60.0", "90.0", "50", "100", "0.05"),
}


def _weighted_sql() -> str:
    risks, weights = [], []
    for name, (low, high, least, most, weight) in _WEIGHTS_SQL.items():
        d = f"(CASE WHEN {name} < {low} THEN ({low} - {name}) / {low} ELSE ({name} - {high}) / {high} END)"
        scaled = f"CASE WHEN {name} <= {least} OR {name} >= {most} THEN {d} * 2 ELSE {d} END"
        risk = f"CASE WHEN {name} BETWEEN {low} AND {high} THEN 0 ELSE least(1.0, {scaled}) END"
        risks.append(f"CASE WHEN {name} IS NULL THEN 0.0::DOUBLE ELSE ({risk}) * {weight}::DOUBLE END")
        weights.append(f"CASE WHEN {name} IS NULL THEN 0.0::DOUBLE ELSE {weight}::DOUBLE END")
    total = " + ".join(weights)
    return f"CASE WHEN {total} > 0 THEN least(1.0::DOUBLE, ({' + '.join(risks)}) / ({total})) ELSE 0.0::DOUBLE END"


def _weighted_level_sql(score: str) -> str:
    return f"CASE WHEN {score} >= 0.8 THEN 'CRITICAL' WHEN {score} >= 0.6 THEN 'HIGH' WHEN {score} >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END"


WEIGHTED_SQL = f"SELECT *, {_weighted_sql()} AS score FROM ({t.READINGS_SQL})"


@query(
    "weighted_risk",
    f"SELECT patient_id, day, score AS weighted_score, {_weighted_level_sql('score')} AS weighted_level FROM ({WEIGHTED_SQL})",
)
def weighted_risk(spark, sf_dir):
    df = t.readings(spark, sf_dir)
    scored = df.withColumn("score", weighted.weighted_risk({v: F.col(v) for v in VITALS}))
    return scored.select(
        *KEYS, F.col("score").alias("weighted_score"),
        weighted.weighted_level(F.col("score")).alias("weighted_level"),
    )


# The reading's most unusual vital decides which critical event it stands for.
_EVENT_RULES = (
    ("cardiac_arrest", "heart_rate", ">", 150.0),
    ("respiratory_failure", "respiratory_rate", ">", 30.0),
    ("shock", "blood_pressure_systolic", "<", 70.0),
    ("sepsis", "temperature", ">", 38.0),
)


@query(
    "event_boosted_risk",
    f"""SELECT patient_id, day, critical_event, boosted AS risk_score, {_weighted_level_sql('boosted')} AS risk_level
FROM (SELECT *, least(1.0::DOUBLE, score * CASE critical_event WHEN 'cardiac_arrest' THEN 2.0::DOUBLE WHEN 'respiratory_failure' THEN 1.8::DOUBLE
                         WHEN 'shock' THEN 1.8::DOUBLE WHEN 'sepsis' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END) AS boosted
  FROM (SELECT *, CASE {' '.join(f"WHEN {c} {op} {x} THEN '{e}'" for e, c, op, x in _EVENT_RULES)} ELSE 'none' END AS critical_event FROM ({WEIGHTED_SQL})))""",
)
def event_boosted_risk(spark, sf_dir):
    event = F
    for name, column, op, edge in _EVENT_RULES:
        event = event.when(F.col(column) > edge if op == ">" else F.col(column) < edge, F.lit(name))
    df = t.readings(spark, sf_dir).withColumn("critical_event", event.otherwise(F.lit("none")))
    boosted = weighted.boosted_risk(
        weighted.weighted_risk({v: F.col(v) for v in VITALS}), F.col("critical_event")
    )
    return df.withColumn("boosted", boosted).select(
        *KEYS, "critical_event", F.col("boosted").alias("risk_score"),
        weighted.weighted_level(F.col("boosted")).alias("risk_level"),
    )


_FLAGS_SQL = """CASE WHEN heart_rate BETWEEN 60 AND 100 THEN 'green' ELSE 'red' END AS heart_rate_flag,
  CASE WHEN spo2 >= 95 THEN 'green' WHEN spo2 < 90 THEN 'red' ELSE 'yellow' END AS spo2_flag,
  CASE WHEN temperature BETWEEN 36.5 AND 37.5 THEN 'green' ELSE 'red' END AS temperature_flag,
  CASE WHEN respiratory_rate BETWEEN 12 AND 20 THEN 'green' ELSE 'red' END AS respiratory_rate_flag,
  CASE WHEN blood_pressure_systolic BETWEEN 90 AND 140 THEN 'green' ELSE 'red' END AS blood_pressure_systolic_flag"""
_FLAGGED = ("heart_rate", "spo2", "temperature", "respiratory_rate", "blood_pressure_systolic")


@query(
    "vital_flags",
    f"SELECT patient_id, day, {_FLAGS_SQL} FROM ({t.READINGS_SQL})",
)
def vital_flags(spark, sf_dir):
    return t.readings(spark, sf_dir).select(
        *KEYS, *(display.status_flag(v, F.col(v)).alias(f"{v}_flag") for v in _FLAGGED)
    )


@query("danger_flags", f"""SELECT patient_id, day, CASE WHEN heart_rate <> 0 THEN heart_rate < 50 OR heart_rate > 120 END AS heart_rate_danger,
  CASE WHEN spo2 <> 0 THEN spo2 < 90 END AS spo2_danger,
  CASE WHEN temperature <> 0 THEN temperature < 36 OR temperature > 38 END AS temperature_danger,
  CASE WHEN blood_pressure_systolic <> 0 THEN blood_pressure_systolic < 90 OR blood_pressure_systolic > 180 END AS blood_pressure_systolic_danger
FROM ({t.READINGS_SQL})""")
def danger_flags(spark, sf_dir):
    return t.readings(spark, sf_dir).select(
        *KEYS, *(display.danger_flag(v, F.col(v)).alias(f"{v}_danger") for v in display.DANGER_LIMITS)
    )


@query(
    "reading_texts",
    f"""SELECT patient_id, day, coalesce(printf('%.0f', heart_rate), '--') AS heart_rate_text,
  coalesce(printf('%.0f', spo2) || '%', '--') AS spo2_text, coalesce(printf('%.1f', temperature) || '°C', '--') AS temperature_text,
  coalesce(printf('%.0f', blood_pressure_systolic) || '/' || printf('%.0f', blood_pressure_diastolic), '--') AS pressure_text
FROM ({t.READINGS_SQL})""",
)
def reading_texts(spark, sf_dir):
    return t.readings(spark, sf_dir).select(
        *KEYS,
        display.rounded_text(F.col("heart_rate")).alias("heart_rate_text"),
        display.rounded_text(F.col("spo2"), unit="%").alias("spo2_text"),
        display.rounded_text(F.col("temperature"), 1, "°C").alias("temperature_text"),
        display.pressure_text(F.col("blood_pressure_systolic"), F.col("blood_pressure_diastolic")).alias("pressure_text"),
    )


@query(
    "threshold_alerts",
    f"""SELECT patient_id, day FROM ({t.READINGS_SQL})
WHERE coalesce(heart_rate, 0) > 120 OR coalesce(heart_rate, 0) < 50 OR coalesce(spo2, 100) < 90""",
)
def threshold_alerts(spark, sf_dir):
    df = t.readings(spark, sf_dir)
    return df.filter(model.threshold_alert(F.col("heart_rate"), F.col("spo2"))).select(*KEYS)


_ROLL_SQL = f"""SELECT *, {", ".join(f"CASE WHEN NOT isnan({v}_slope) THEN {v}_slope END AS {v}_trend" for v in ("heart_rate", "spo2"))} FROM (SELECT *, {", ".join(
    f"avg({v}) OVER w AS {v}_mean, stddev_samp({v}) OVER w AS {v}_std, regr_slope({v}, epoch_us(timestamp) / 3.6e9) OVER w AS {v}_slope"
    for v in ("heart_rate", "spo2"))}
FROM ({t.READINGS_SQL}) WINDOW w AS (PARTITION BY patient_id ORDER BY timestamp ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""


def _rolled(spark, sf_dir):
    return rolling_features(t.readings(spark, sf_dir), order=("timestamp",), runs=runs(spark))


@query(
    "rolling_features",
    "SELECT patient_id, day, "
    + ", ".join(f"{steady_sql(f'{v}_{s}', 4)} AS {v}_{s}" for v in ("heart_rate", "spo2") for s in ("mean", "std", "trend"))
    + f" FROM ({_ROLL_SQL})",
)
def rolling(spark, sf_dir):
    return _rolled(spark, sf_dir).select(
        *KEYS, *(steady(F.col(f"{v}_{s}")).alias(f"{v}_{s}") for v in ("heart_rate", "spo2") for s in ("mean", "std", "trend"))
    )


# A stand-in model: a linear score of the features, cut to 0..1.
_LINEAR = {
    "heart_rate": 0.004, "spo2": -0.003, "temperature": 0.008, "respiratory_rate": 0.006,
    "heart_rate_mean": 0.001, "spo2_mean": 0.0005,
}


def _linear_model():
    import numpy as np

    weights = np.array([_LINEAR.get(f, 0.0) for f in model.FEATURE_ORDER], dtype="float64")
    return lambda rows: np.clip(rows.astype("float64") @ weights, 0.0, 1.0)


_LINEAR_SQL = (
    "least(1.0::DOUBLE, greatest(0.0::DOUBLE, "
    + " + ".join(f"CAST(CAST(coalesce({f}, 0) AS FLOAT) AS DOUBLE) * {w}::DOUBLE" for f, w in _LINEAR.items())
    + "))"
)


@query(
    "feature_vector_scored",
    f"""SELECT patient_id, day, {steady_sql('score')} AS risk_score,
  CASE WHEN score >= 0.8 THEN 'CRITICAL' WHEN score >= 0.6 THEN 'HIGH' WHEN score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM (SELECT *, {_LINEAR_SQL} AS score FROM ({_ROLL_SQL}))""",
)
def feature_vector_scored(spark, sf_dir):
    scored = score_model(_rolled(spark, sf_dir), _linear_model)
    return scored.select(*KEYS, steady(F.col("risk_score")).alias("risk_score"), "risk_level")
