"""Cohort queries over clinical cases."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulseframe.operators import cohorts as c
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query, steady, steady_sql
from pulseframe.schemas import CLINICAL_CASE
from pulseframe.session import scratch_path
from pulseframe.sources import clinical

# The criteria are parameters; these fit the names and types of the given parts.
SURGERY = "anvil|gear"
TRANSPLANT = "widget|gizmo"
THORACIC = "promo"

COERCED_SQL = f"""
SELECT caseid, casestart, caseend, anestart, aneend, coalesce(CAST(icu_days AS DOUBLE), 0) AS icu_days,
       coalesce(CAST(death_inhosp AS DOUBLE), 0) AS death_inhosp, coalesce(TRY_CAST(age AS DOUBLE), 0) AS age,
       coalesce(CAST(asa AS DOUBLE), 0) AS asa, coalesce(CAST(emop AS DOUBLE), 0) AS emop, opname, department
FROM ({t.CASES_SQL})"""
_ICU_TEST = f"""(icu_days > 0 OR caseend - casestart > 14400 OR regexp_matches(opname, '{SURGERY}', 'i')
  OR emop = 1 OR death_inhosp = 1 OR asa IN (4, 5) OR age > 70)"""
ICU_SQL = f"""
SELECT *, (caseend - casestart) / 3600 AS case_duration_hours, (aneend - anestart) / 3600 AS anesthesia_duration_hours,
       asa * 2 + age / 10 + icu_days * 5 + emop * 3 + death_inhosp * 10 AS icu_risk_score
FROM ({COERCED_SQL}) WHERE {_ICU_TEST}"""
_RULES_SQL = {
    "critical": "asa >= 4",
    "transplant": f"regexp_matches(opname, '{TRANSPLANT}', 'i')",
    "cardio": f"regexp_matches(department, '{THORACIC}', 'i')",
    "long_surgery": "(caseend - casestart) / 3600 >= 6",
}


def _icu(spark, sf_dir):
    return c.icu_like_cases(t.cases(spark, sf_dir), SURGERY)


@query(
    "icu_like_cohort",
    f"""SELECT caseid, asa, age, icu_days, opname, case_duration_hours,
  anesthesia_duration_hours, icu_risk_score FROM ({ICU_SQL})""",
)
def icu_like_cohort(spark, sf_dir):
    return _icu(spark, sf_dir).select(
        "caseid", "asa", "age", "icu_days", "opname",
        "case_duration_hours",
        "anesthesia_duration_hours",
        "icu_risk_score",
    )


@query(
    "cohort_groups",
    " UNION ALL ".join(f"SELECT '{k}' AS cohort, caseid, asa, age FROM ({t.CASES_SQL}) WHERE {r}" for k, r in _RULES_SQL.items()),
)
def cohort_groups(spark, sf_dir):
    return c.tag_cohorts(t.cases(spark, sf_dir), c.cohort_rules(TRANSPLANT, THORACIC)).select(
        "cohort", "caseid", "asa", "age"
    )


@query(
    "cohort_counts",
    " UNION ALL ".join(f"SELECT '{k}' AS cohort, count(*) FILTER (WHERE {r}) AS n FROM ({t.CASES_SQL})" for k, r in _RULES_SQL.items()),
)
def cohort_counts(spark, sf_dir):
    return c.cohort_counts(t.cases(spark, sf_dir), c.cohort_rules(TRANSPLANT, THORACIC))


@query(
    "cohort_share",
    f"SELECT kept, total, kept * 100.0::DOUBLE / total AS percent FROM (SELECT count(*) FILTER (WHERE {_ICU_TEST}) AS kept, count(*) AS total FROM ({COERCED_SQL}))",
)
def cohort_share(spark, sf_dir):
    share = c.cohort_share(c.coerce_cases(t.cases(spark, sf_dir)), c.icu_like(SURGERY))
    return share


@query(
    "cohort_summary",
    f"""SELECT count(*) AS cases, {steady_sql('avg(case_duration_hours)')} AS mean_case_hours,
  {steady_sql('avg(anesthesia_duration_hours)')} AS mean_anesthesia_hours, {steady_sql('avg(icu_days)')} AS mean_icu_days,
  {steady_sql('avg(age)')} AS mean_age, {steady_sql('avg(death_inhosp) * 100')} AS mortality_percent FROM ({ICU_SQL})""",
)
def cohort_summary(spark, sf_dir):
    means = c.cohort_means(_icu(spark, sf_dir))
    return means.select("cases", *(steady(F.col(m)).alias(m) for m in means.columns if m != "cases"))


@query("cohort_top_ops", f"SELECT opname, count(*) AS n FROM ({ICU_SQL}) GROUP BY 1 ORDER BY n DESC, opname LIMIT 10")
def cohort_top_ops(spark, sf_dir):
    return c.top_values(_icu(spark, sf_dir), "opname")


@query(
    "asa_distribution",
    f"SELECT asa, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM ({ICU_SQL}) GROUP BY asa",
)
def asa_distribution(spark, sf_dir):
    shares = c.distribution(_icu(spark, sf_dir), "asa")
    return shares


@query(
    "cohort_head",
    f"""SELECT caseid, age, asa, opname, icu_days, icu_risk_score
FROM ({ICU_SQL}) ORDER BY icu_risk_score DESC, caseid LIMIT 10""",
)
def cohort_head(spark, sf_dir):
    cases = _icu(spark, sf_dir)
    return c.head_cases(cases)


@query(
    "cases_by_severity",
    f"SELECT caseid, asa, age, opname FROM ({t.CASES_SQL}) WHERE asa >= 4 ORDER BY asa DESC, age DESC, caseid",
)
def cases_by_severity(spark, sf_dir):
    critical = t.cases(spark, sf_dir).filter(c.cohort_rules()["critical"])
    return c.by_severity(critical).select("caseid", "asa", "age", "opname")


@query(
    "cases_by_risk",
    f"SELECT caseid, asa, icu_risk_score FROM ({ICU_SQL}) ORDER BY icu_risk_score DESC, caseid",
)
def cases_by_risk(spark, sf_dir):
    return c.by_case_risk(_icu(spark, sf_dir)).select(
        "caseid", "asa", "icu_risk_score"
    )


_FILED_SQL = """
SELECT CAST(l_orderkey * 100 + l_linenumber * 10 + l_suppkey % 10 AS INTEGER) AS caseid, CAST(l_quantity * 600 AS INTEGER) AS caseend,
  CAST(l_linenumber % 6 + 1 AS DOUBLE) AS asa, CAST(CAST(l_quantity AS INTEGER) + 40 AS VARCHAR) AS age, 'biopsy, ' || l_linestatus AS opname,
  'say "' || l_returnflag || '", twice' AS department, l_extendedprice AS preop_hb FROM lineitem"""


def _case_files(spark, sf_dir) -> str:
    """The order lines as a clinical file with all its columns; what the tables lack is empty."""
    number = F.col("l_orderkey") * 100 + F.col("l_linenumber") * 10 + F.col("l_suppkey") % 10
    given = {
        "caseid": number, "casestart": F.lit(0), "caseend": F.col("l_quantity") * 600, "asa": F.col("l_linenumber") % 6 + 1,
        "age": F.col("l_quantity").cast("int") + 40, "opname": F.concat(F.lit("biopsy, "), "l_linestatus"),
        "department": F.concat(F.lit('say "'), "l_returnflag", F.lit('", twice')), "preop_hb": F.col("l_extendedprice"),
    }
    path = scratch_path(spark, "cases")
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CLINICAL_CASE.fields]
    clinical.write_cases(t.load(spark, sf_dir, "lineitem").select(*columns), path, "gzip")
    return path


_FILED_COLUMNS = ("caseid", "caseend", "asa", "age", "opname", "department", "preop_hb")


@query("clinical_files", f"SELECT *, CAST(NULL AS VARCHAR) AS sex, 74 AS columns FROM ({_FILED_SQL})")
def clinical_files(spark, sf_dir):
    """Written as CSV with a header, and read back."""
    cases = clinical.read_cases(spark, _case_files(spark, sf_dir))
    return cases.select(*_FILED_COLUMNS, "sex", F.lit(len(cases.columns)).alias("columns"))


@query(
    "cohort_files",
    f"""SELECT 'critical' AS cohort, caseid, asa, age FROM ({_FILED_SQL}) WHERE asa >= 4
UNION ALL SELECT 'transplant', caseid, asa, age FROM ({_FILED_SQL}) WHERE opname = 'biopsy, F'
UNION ALL SELECT 'cardio', caseid, asa, age FROM ({_FILED_SQL}) WHERE department = 'say "R", twice'
UNION ALL SELECT 'long_surgery', caseid, asa, age FROM ({_FILED_SQL}) WHERE caseend >= 21600""",
)
def cohort_files(spark, sf_dir):
    """One folder of files per cohort, read back."""
    path = scratch_path(spark, "cohorts")
    rules = c.cohort_rules("biopsy, f", 'say "r')
    clinical.write_cohorts(clinical.read_cases(spark, _case_files(spark, sf_dir)), rules, path, "gzip")
    schema = StructType([*CLINICAL_CASE.fields, StructField("cohort", StringType())])
    return spark.read.schema(schema).option("header", True).csv(path).select("cohort", "caseid", "asa", "age")
