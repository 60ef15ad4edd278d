"""Rolling statistics of vitals and of processing times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.ordered import trailing_window

# Fixed value: measurements kept for rolling processing times.
METRIC_WINDOW = 100
TREND_WINDOW = 10


def rolling_features(
    readings: DataFrame,
    vitals: Sequence[str] = ("heart_rate", "spo2"),
    keys: Sequence[str] = ("patient_id",),
    order: Sequence[str] = ("ts",),
    rows: int = TREND_WINDOW,
    runs: int | None = None,
) -> DataFrame:
    """Mean, sample deviation and slope per hour of each vital over the last rows.

    NULL vitals are skipped; a deviation or slope of fewer than two values is NULL.
    ``runs`` cuts keys that are too large for a task.
    """
    hours = F.unix_micros(F.col(order[0]).cast("timestamp")) / F.lit(3.6e9)

    def columns(window):
        out = {}
        for v in vitals:
            out[f"{v}_mean"] = F.avg(v).over(window)
            out[f"{v}_std"] = F.stddev_samp(v).over(window)
            out[f"{v}_trend"] = F.regr_slope(F.col(v), hours).over(window)
        return out

    return trailing_window(readings, keys, order, rows, columns, runs)


def rolling_times(
    metrics: DataFrame,
    value: str = "processing_time_ms",
    keys: Sequence[str] = ("consumer",),
    order: Sequence[str] = ("ts", "event_id"),
    rows: int = METRIC_WINDOW,
    runs: int | None = None,
) -> DataFrame:
    """Average, least and greatest processing time over the last ``rows`` messages of a consumer.

    A consumer's messages may be a large share of all; ``runs`` cuts them.
    """
    return trailing_window(
        metrics,
        keys,
        order,
        rows,
        lambda w: {
            "avg_ms": F.avg(value).over(w),
            "min_ms": F.min(value).over(w),
            "max_ms": F.max(value).over(w),
        },
        runs,
    )
