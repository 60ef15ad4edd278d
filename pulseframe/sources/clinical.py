"""Clinical case files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.cohorts import tag_cohorts
from pulseframe.schemas import CLINICAL_CASE

#: Cases in a compressed file, at most.
MOST_PACKED = 500_000


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; columns follow the fixed schema, so no inference pass."""
    return spark.read.schema(CLINICAL_CASE).option("header", True).csv(path)


def write_cases(cases: DataFrame, path: str, compression: str | None = None) -> None:
    """Compressed files cannot be split by readers, so they have at most ``MOST_PACKED`` cases."""
    cases.write.mode("overwrite").options(**_packed(compression)).option("header", True).csv(path)


def _packed(compression: str | None) -> dict:
    # Most of what packing saves comes at the lowest level, for a fifth less of the time to write.
    return {"compression": compression, "maxRecordsPerFile": MOST_PACKED, "zlib.compress.level": "BEST_SPEED"} if compression else {}


def write_cohorts(cases: DataFrame, rules: Mapping[str, Column], path: str, compression: str | None = None) -> None:
    """Every cohort in its own folder, from one scan.

    Range-partitioning by the sort order inside each cohort cuts large cohorts over many files
    and leaves every file, and the sequence of files, in order. ``compression`` as in ``write_cases``;
    the files have a column for each of many measures, mostly empty, and pack well.
    """
    order = [F.col("cohort"), F.col("asa").desc_nulls_last(), F.col("age").cast("string").desc_nulls_last(), F.col("caseid")]
    (
        tag_cohorts(cases, rules)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite").partitionBy("cohort").options(**_packed(compression)).option("header", True).csv(path)
    )
