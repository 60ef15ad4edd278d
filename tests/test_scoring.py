"""Scores against hand-computed values and their invariants."""

import itertools

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import display, model, weighted
from pulseframe.functions.scoring import MEWS_BANDS, score_readings
from pulseframe.schemas import VITALS

COLUMNS = "name STRING, heart_rate DOUBLE, spo2 DOUBLE, temperature DOUBLE, blood_pressure_systolic DOUBLE, blood_pressure_diastolic DOUBLE, respiratory_rate DOUBLE"
SCENARIOS = [
    ("severe", 145.0, 82.0, 38.8, 185.0, 115.0, 28.0),
    ("hypotension", 125.0, 88.0, 38.2, 85.0, 55.0, 24.0),
    ("elevated", 115.0, 91.0, 37.8, 140.0, 90.0, 20.0),
    ("healthy", 72.0, 98.5, 36.8, None, None, None),
]
EXPECTED = {
    "severe": (10, 70.0, "CRITICAL", ["tachycardia", "hypoxia"], ["High MEWS Score: 10"], 0.574, 0.862),
    "hypotension": (7, 40.0, "CRITICAL", ["hypoxia"], ["High MEWS Score: 7"], 0.210, 0.315),
    "elevated": (4, 20.0, "HIGH", [], [], 0.047, 0.071),
    "healthy": (0, 0.0, "STABLE", [], [], 0.0, 0.0),
}


def test_scenarios(spark):
    df = score_readings(spark.createDataFrame(SCENARIOS, COLUMNS))
    risk = weighted.weighted_risk({v: F.col(v) for v in VITALS})
    rows = df.withColumns({"w": risk, "s": weighted.boosted_risk(risk, F.lit("sepsis"))}).collect()
    for r in rows:
        mews, score, level, kinds, warnings, w, s = EXPECTED[r["name"]]
        assert (r["mews_score"], r["risk_score"], r["risk_level"]) == (mews, score, level)
        assert [a["type"] for a in r["anomalies"]] == kinds
        assert r["warnings"] == warnings
        assert r["w"] == pytest.approx(w, abs=5e-4) and r["s"] == pytest.approx(s, abs=5e-4)


def one(spark, vital, value, mode="parity"):
    df = spark.createDataFrame([(value,)], f"{vital} DOUBLE")
    return score_readings(df, mode).first()


@pytest.mark.parametrize(
    "vital,value,closed",
    [("heart_rate", 40.5, 2), ("heart_rate", 110.5, 1), ("heart_rate", 129.5, 2), ("respiratory_rate", 20.5, 1),
     ("respiratory_rate", 29.5, 2), ("blood_pressure_systolic", 70.5, 3), ("blood_pressure_systolic", 80.5, 2), ("spo2", 89.5, 2)],
)
def test_gaps_between_bands(spark, vital, value, closed):
    assert one(spark, vital, value)["mews_score"] == 0
    assert one(spark, vital, value, "contiguous")["mews_score"] == closed


def test_zero_nan_and_missing(spark):
    zero = one(spark, "heart_rate", 0.0)
    assert (zero["mews_score"], zero["risk_score"], zero["anomalies"]) == (2, 10.0, [])
    nan = one(spark, "heart_rate", float("nan"))
    assert (nan["mews_score"], nan["risk_score"], nan["anomalies"]) == (0, 0.0, [])
    assert one(spark, "spo2", 0.0)["risk_score"] == 15.0
    alias = spark.createDataFrame([(None, 65.0), (120.0, 65.0)], "blood_pressure_systolic DOUBLE, bp_systolic DOUBLE")
    assert [r["mews_score"] for r in score_readings(alias).collect()] == [3, 0]
    with pytest.raises(ValueError):
        score_readings(alias, "other")


def test_level_depends_on_score_only(spark):
    """A risk of 75 needs a score of 11 or more, 50 needs 5, and 20 needs 2."""
    grid = {
        "heart_rate": [None, 35.0, 45.0, 75.0, 105.0, 120.0, 135.0, 150.0],
        "spo2": [None, 80.0, 87.0, 91.0, 97.0],
        "temperature": [None, 34.0, 37.0, 39.0],
        "respiratory_rate": [None, 8.0, 12.0, 18.0, 25.0, 35.0],
        "blood_pressure_systolic": [None, 65.0, 75.0, 95.0, 120.0, 210.0],
    }
    rows = list(itertools.product(*grid.values()))
    df = score_readings(spark.createDataFrame(rows, ", ".join(f"{v} DOUBLE" for v in grid)))
    m = F.col("mews_score")
    by_score = F.when(m >= 5, "CRITICAL").when(m >= 4, "HIGH").when(m >= 2, "MODERATE").otherwise("STABLE")
    wrong = df.filter(by_score != F.col("risk_level")).count()
    top = df.agg(F.max("risk_score"), F.max("mews_score")).first()
    assert wrong == 0
    assert top[0] <= 90.0 and top[1] <= 14


def test_weighted_levels_and_unknown_event(spark):
    df = spark.createDataFrame([(0.8, "x"), (0.6, "none"), (0.3, "shock"), (0.29, None)], "s DOUBLE, e STRING")
    rows = df.select(weighted.weighted_level(F.col("s")).alias("l"), weighted.boosted_risk(F.col("s"), F.col("e")).alias("b")).collect()
    assert [r["l"] for r in rows] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert [r["b"] for r in rows] == pytest.approx([0.8, 0.6, 0.54, 0.29])


def test_model_levels(spark):
    df = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.39,), (None,)], "s DOUBLE")
    rows = df.select(model.model_level(F.col("s")).alias("l"), model.model_score(F.col("s")).alias("v")).collect()
    assert [r["l"] for r in rows] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "UNKNOWN"]
    assert rows[-1]["v"] == 0.5


def test_model_failures_stay_on_their_rows(spark):
    from pulseframe.operators.inference import score_model

    def fragile():
        def run(rows):
            if (rows[:, 0] > 200).any():
                raise ValueError("bad input")
            return rows[:, 0] / 100

        return run

    df = spark.createDataFrame([(float(v),) for v in (50, 90, 250)], "heart_rate DOUBLE").coalesce(1)
    rows = {r["heart_rate"]: r for r in score_model(df, fragile).collect()}
    assert rows[50.0]["risk_level"] == "MEDIUM" and rows[90.0]["risk_level"] == "CRITICAL"
    assert (rows[250.0]["risk_score"], rows[250.0]["risk_level"]) == (0.5, "UNKNOWN")
    assert len(rows[50.0]["features"]) == len(model.FEATURE_ORDER)


def test_threshold_alert_defaults(spark):
    df = spark.createDataFrame([(None, None), (80.0, None), (80.0, 89.0), (121.0, 99.0), (49.0, 99.0)], "h DOUBLE, o DOUBLE")
    assert [r[0] for r in df.select(model.threshold_alert(F.col("h"), F.col("o"))).collect()] == [True, False, True, True, True]


def test_texts_round_like_correct_printing(spark):
    values = [30.5, 31.5, 36.45, 36.55, 36.65, 98.25, 120.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v DOUBLE")
    rows = df.select(display.rounded_text(F.col("v")).alias("a"), display.rounded_text(F.col("v"), 1, "°C").alias("b")).collect()
    assert [r["a"] for r in rows] == [f"{v:.0f}" for v in values] + ["--"]
    assert [r["b"] for r in rows] == [f"{v:.1f}°C" for v in values] + ["--"]


def test_texts_of_any_number(spark):
    """Ordinary numbers go without a format; both ways print alike."""
    values = [0.0, -0.0, -0.3, 0.4, 0.96, 1.0, 1.5, 9.96, 99.95, 99.5, 100.25, -1.5, -37.25, 999_999_999.5, 999_999_998.96, 1e9, 1e12 + 0.5]
    values += [1 + i * 0.37 for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    rows = df.select(display.rounded_text(F.col("v"), unit="%").alias("a"), display.rounded_text(F.col("v"), 1).alias("b"),
                     F.format_string("%.0f%%", display.half_even(F.col("v"))).alias("c"), F.format_string("%.1f", display.half_even(F.col("v"), 1)).alias("d")).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(r["c"], r["d"]) for r in rows]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e300,)], "v DOUBLE")
    assert [r[0] for r in odd.select(display.rounded_text(F.col("v"))).collect()][:2] == ["NaN", "Infinity"]


def test_flags(spark):
    df = spark.createDataFrame([(97.0, 0.0), (92.0, 49.0), (80.0, 60.0), (None, None)], "o DOUBLE, h DOUBLE")
    rows = df.select(display.status_flag("spo2", F.col("o")), display.danger_flag("heart_rate", F.col("h")), display.status_flag("heart_rate", F.col("h"))).collect()
    assert [tuple(r) for r in rows] == [("green", None, "red"), ("yellow", True, "red"), ("red", False, "green"), ("yellow", None, "red")]


def test_bands_cover_the_scored_vitals():
    assert set(MEWS_BANDS) == set(VITALS) - {"blood_pressure_diastolic"}
