"""Cohorts of clinical cases and their summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns coerced to numbers, columns whose NULLs become 0.
NUMERIC_COLUMNS = (
    "age", "asa", "icu_days", "emop", "death_inhosp",
    "casestart", "caseend", "anestart", "aneend",
)
ZERO_FILLED = ("icu_days", "emop", "death_inhosp", "age", "asa")

# Criteria of the ICU-like cohort and of the named cohorts.
HIGH_RISK_SURGERY = "cardiac|thoracic|aortic|vascular|esophagectomy|pneumonectomy"
TRANSPLANT_SURGERY = "transplantation|transplant"
THORACIC_DEPARTMENT = "Thoracic"
LONG_CASE_SECONDS = 14400
LONG_SURGERY_HOURS = 6
ELDERLY_AGE = 70
SEVERE_ASA = (4, 5)
CRITICAL_ASA = 4
HEAD_COLUMNS = ("caseid", "age", "asa", "opname", "icu_days", "icu_risk_score")


def coerce_cases(cases: DataFrame) -> DataFrame:
    """Numeric columns as DOUBLE (unreadable text becomes NULL), then zero-fill five of them."""
    present = [c for c in NUMERIC_COLUMNS if c in cases.columns]
    numeric = cases.withColumns({c: F.col(c).try_cast("double") for c in present})
    return numeric.fillna(0.0, subset=[c for c in ZERO_FILLED if c in present])


def _matches(column: str, pattern: str) -> Column:
    return F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False))


def icu_like(high_risk_surgery: str = HIGH_RISK_SURGERY) -> Column:
    """Seven-way OR over coerced cases; an unknown duration does not match."""
    return (
        (F.col("icu_days") > 0)
        | (F.col("caseend") - F.col("casestart") > LONG_CASE_SECONDS)
        | _matches("opname", high_risk_surgery)
        | (F.col("emop") == 1)
        | (F.col("death_inhosp") == 1)
        | F.col("asa").isin(*SEVERE_ASA)
        | (F.col("age") > ELDERLY_AGE)
    )


def add_case_measures(cases: DataFrame) -> DataFrame:
    return cases.withColumns(
        {
            "case_duration_hours": (F.col("caseend") - F.col("casestart")) / 3600,
            "anesthesia_duration_hours": (F.col("aneend") - F.col("anestart")) / 3600,
            "icu_risk_score": F.col("asa") * 2
            + F.col("age") / 10
            + F.col("icu_days") * 5
            + F.col("emop") * 3
            + F.col("death_inhosp") * 10,
        }
    )


def icu_like_cases(cases: DataFrame, high_risk_surgery: str = HIGH_RISK_SURGERY) -> DataFrame:
    """Coerced ICU-like cases with durations and risk score. Narrow: scan, filter, project."""
    return add_case_measures(coerce_cases(cases).filter(icu_like(high_risk_surgery)))


def by_case_risk(cases: DataFrame, tie_break: tuple[str, ...] = ("caseid",)) -> DataFrame:
    return cases.orderBy(F.col("icu_risk_score").desc_nulls_last(), *tie_break)


def cohort_rules(
    transplant: str = TRANSPLANT_SURGERY, thoracic: str = THORACIC_DEPARTMENT
) -> dict[str, Column]:
    """Name to predicate of the four named cohorts."""
    return {
        "critical": F.col("asa") >= CRITICAL_ASA,
        "transplant": _matches("opname", transplant),
        "cardio": _matches("department", thoracic),
        "long_surgery": (F.col("caseend") - F.col("casestart")) / 3600 >= LONG_SURGERY_HOURS,
    }


def tag_cohorts(cases: DataFrame, rules: Mapping[str, Column], name: str = "cohort") -> DataFrame:
    """One row per case and matching rule, from a single scan."""
    tags = F.array_compact(F.array(*(F.when(rule, F.lit(tag)) for tag, rule in rules.items())))
    return cases.withColumn(name, F.explode(tags))


def by_severity(cases: DataFrame, tie_break: tuple[str, ...] = ("caseid",)) -> DataFrame:
    """ASA, then age in text order, both descending. The tie-break keeps range cuts possible."""
    return cases.orderBy(
        F.col("asa").desc_nulls_last(), F.col("age").cast("string").desc_nulls_last(), *tie_break
    )


def cohort_counts(cases: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(cohort, n) for every rule, those without cases included."""
    counts = cases.agg(*(F.count_if(rule).alias(name) for name, rule in rules.items()))
    return counts.unpivot([], list(rules), "cohort", "n")


def cohort_share(cases: DataFrame, rule: Column) -> DataFrame:
    kept = F.count_if(rule)
    total = F.count(F.lit(1))
    return cases.agg(
        kept.alias("kept"), total.alias("total"), (kept * F.lit(100.0) / total).alias("percent")
    )


def cohort_means(cases: DataFrame) -> DataFrame:
    """Means over a cohort; each skips NULLs."""
    return cases.agg(
        F.count(F.lit(1)).alias("cases"),
        F.avg("case_duration_hours").alias("mean_case_hours"),
        F.avg("anesthesia_duration_hours").alias("mean_anesthesia_hours"),
        F.avg("icu_days").alias("mean_icu_days"),
        F.avg("age").alias("mean_age"),
        (F.avg("death_inhosp") * 100).alias("mortality_percent"),
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values, NULL not counted, ties by value."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), column).limit(n)
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share of all rows per value, ordered by value; NULL is not listed but counts in the total."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # Summed from the counts, so that the grouped shuffle is shared.
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return (
        counts.filter(F.col(column).isNotNull())
        .withColumn("percent", F.col("n") * F.lit(100.0) / total)
        .orderBy(column)
    )


def head_cases(cases: DataFrame, n: int = 10, columns: tuple[str, ...] = HEAD_COLUMNS) -> DataFrame:
    return by_case_risk(cases, tuple(c for c in columns if c == "caseid")).select(*columns).limit(n)
