"""Tall and wide vital signs, latest and recent readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.operators.filters import last_hours
from pulseframe.schemas import VITALS

# Fixed value: rows of a "recent readings" query.
RECENT_LIMIT = 1000


def to_wide(
    points: DataFrame,
    keys: Sequence[str] = ("patient_id", "ts"),
    fields: Sequence[str] = VITALS,
    latest_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, one column per field (NULL where absent).

    Several points of a field within a key resolve to the greatest ``latest_by``.
    The field list is fixed, so no extra job looks for pivot values.
    """

    def pick(name: str) -> Column:
        mine = F.when(F.col("field") == name, F.col("value"))
        if not latest_by:
            return F.max(mine).alias(name)
        order = F.col(latest_by[0]) if len(latest_by) == 1 else F.struct(*latest_by)
        return F.max_by(F.col("value"), F.when(F.col("field") == name, order)).alias(name)

    return points.filter(F.col("field").isin(*fields)).groupBy(*keys).agg(*(pick(f) for f in fields))


def to_tall(wide: DataFrame, keys: Sequence[str], fields: Sequence[str] = VITALS) -> DataFrame:
    """One row per key and field with a value. Narrow."""
    present = [f for f in fields if f in wide.columns]
    return wide.unpivot(list(keys), present, "field", "value").filter(F.col("value").isNotNull())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ranked = [c for c in order if c in rest]
    payload = [c for c in rest if c not in ranked]
    top = F.max_by(F.struct(*payload, *ranked), F.struct(*order))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*keys, "_top.*")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 50) -> DataFrame:
    """The ``n`` newest rows per key with their rank, 1 = newest.

    Spark keeps at most ``n`` rows per key and task before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def recent(df: DataFrame, order: Sequence[str] = ("ts", "event_id"), n: int = RECENT_LIMIT) -> DataFrame:
    """The ``n`` newest rows overall (each task keeps n, no full sort)."""
    return df.orderBy(*(F.col(c).desc() for c in order)).limit(n)


def newest_first(df: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    return df.orderBy(*(F.col(c).desc() for c in order))


def first_messages(df: DataFrame, n: int, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The first ``n`` messages in arrival order."""
    return df.orderBy(*order).limit(n)


def patient_vitals(
    points: DataFrame, ref: Column, hours: float, patient_id=None, fields: Sequence[str] = VITALS
) -> DataFrame:
    """Wide vitals of the last hours, of one patient or of all in one job."""
    wanted = last_hours(points, ref, hours)
    if patient_id is not None:
        wanted = wanted.filter(F.col("patient_id") == patient_id)
    return to_wide(wanted, fields=fields)
