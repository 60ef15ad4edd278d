"""Model features, model levels and the simple threshold rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Feature order the model expects.
FEATURE_ORDER = (
    "heart_rate",
    "spo2",
    "temperature",
    "respiratory_rate",
    "heart_rate_mean",
    "heart_rate_std",
    "heart_rate_trend",
    "spo2_mean",
    "spo2_std",
    "spo2_trend",
)

# Level thresholds of the model scale, and the result of a failed inference.
MODEL_LEVELS = (("CRITICAL", 0.8), ("HIGH", 0.6), ("MEDIUM", 0.4))
FAILED_SCORE = 0.5
FAILED_LEVEL = "UNKNOWN"
# Reasons of messages that the threshold rule cannot judge.
MALFORMED = "malformed message"
NO_NUMBER = "vital is no number"


def feature_vector(df: DataFrame) -> Column:
    """ARRAY<FLOAT> in the fixed order; absent columns and NULLs become 0."""
    return F.array(
        *(
            (F.coalesce(F.col(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)).cast("float")
            for c in FEATURE_ORDER
        )
    )


def model_level(score: Column) -> Column:
    """Level of a model score; a NULL score means the inference failed."""
    chain = F.when(score.isNull(), F.lit(FAILED_LEVEL))
    for level, floor in MODEL_LEVELS:
        chain = chain.when(score >= floor, F.lit(level))
    return chain.otherwise(F.lit("LOW"))


def model_score(score: Column) -> Column:
    return F.coalesce(score, F.lit(FAILED_SCORE))


def threshold_alert(heart_rate: Column, spo2: Column) -> Column:
    """Heart rate above 120 or below 50, or SpO2 below 90.

    An absent heart rate counts as 0 and so fires; an absent SpO2 counts as 100.
    """
    hr, ox = F.coalesce(heart_rate, F.lit(0.0)), F.coalesce(spo2, F.lit(100.0))
    return (hr > 120) | (hr < 50) | (ox < 90)


def threshold_outcome(body: Column) -> Column:
    """``alert``, ``ok`` or the reason why the threshold rule cannot be applied to a message's VARIANT.

    Only an absent vital has a default. JSON null, text or an object in its place cannot be
    compared, so such a message goes to quarantine unless the heart rate, looked at first,
    fires already. Booleans are 0 and 1.
    """
    kind = lambda path: F.schema_of_variant(F.try_variant_get(body, path, "variant"))

    def odd(path: str) -> Column:
        return F.coalesce(~kind(path).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"), F.lit(False))

    def number(path: str) -> Column:
        return F.coalesce(
            F.when(kind(path) == "BOOLEAN", F.try_variant_get(body, path, "boolean").cast("double")),
            F.try_variant_get(body, path, "double"))

    rate, oxygen = "$.vital_signs.heart_rate", "$.vital_signs.spo2"
    hr, ox = F.coalesce(number(rate), F.lit(0.0)), F.coalesce(number(oxygen), F.lit(100.0))
    return (
        F.when(body.isNull(), MALFORMED)
        .when(F.coalesce(~F.startswith(kind("$.vital_signs"), F.lit("OBJECT")), F.lit(False)) | odd(rate), NO_NUMBER)
        .when((hr > 120) | (hr < 50), "alert").when(odd(oxygen), NO_NUMBER).when(ox < 90, "alert").otherwise("ok")
    )
