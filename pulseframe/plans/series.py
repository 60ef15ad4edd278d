"""Time-series and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import metrics as m
from pulseframe.operators import timeseries as ts
from pulseframe.operators.rolling import rolling_times
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query, runs, steady, steady_sql
from pulseframe.schemas import VITALS

SERIES = ["patient_id", "field"]


@query(
    "latest_vitals",
    f"SELECT patient_id, field, ts, event_id, value FROM ({t.POINTS_SQL}) QUALIFY row_number() OVER (PARTITION BY patient_id, field ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_vitals(spark, sf_dir):
    return ts.latest_per_key(t.points(spark, sf_dir), SERIES, ["ts", "event_id"])


@query(
    "last_n_vitals",
    f"""SELECT patient_id, field, ts, event_id, value, CAST(row_number() OVER (PARTITION BY patient_id, field ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank
FROM ({t.POINTS_SQL}) QUALIFY row_number() OVER (PARTITION BY patient_id, field ORDER BY ts DESC, event_id DESC) <= 2""",
)
def last_n_vitals(spark, sf_dir):
    return ts.last_per_key(t.points(spark, sf_dir), SERIES, ["ts", "event_id"], 2)


@query("recent_points", f"SELECT * FROM ({t.POINTS_SQL}) ORDER BY ts DESC, event_id DESC LIMIT 1000")
def recent_points(spark, sf_dir):
    return ts.recent(t.points(spark, sf_dir))


@query(
    "recent_points_by_series",
    f"""SELECT *, CAST(row_number() OVER (PARTITION BY patient_id, field ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank FROM ({t.POINTS_SQL})
WHERE ts >= TIMESTAMP '{t.REF_TIME}' - INTERVAL 240 HOURS AND ts < TIMESTAMP '{t.REF_TIME}'
QUALIFY row_number() OVER (PARTITION BY patient_id, field ORDER BY ts DESC, event_id DESC) <= 2""",
)
def recent_points_by_series(spark, sf_dir):
    from pulseframe.operators.filters import last_hours

    recent = last_hours(t.points(spark, sf_dir), t.ntz(t.REF_TIME), 240)
    return ts.last_per_key(recent, SERIES, ["ts", "event_id"], 2)


@query(
    "recent_range_wide",
    f"""SELECT patient_id, ts, {', '.join(f"max(CASE WHEN field = '{v}' THEN value END) AS {v}" for v in VITALS)} FROM ({t.POINTS_SQL})
WHERE ts >= TIMESTAMP '{t.REF_TIME}' - INTERVAL 150 MINUTES AND ts < TIMESTAMP '{t.REF_TIME}' GROUP BY 1, 2""",
)
def recent_range_wide(spark, sf_dir):
    return ts.patient_vitals(t.points(spark, sf_dir), t.ntz(t.REF_TIME), 2.5)


@query("raw_history", f"SELECT patient_id, ts, event_id, field, value FROM ({t.POINTS_SQL}) ORDER BY ts DESC, event_id DESC")
def raw_history(spark, sf_dir):
    return ts.newest_first(t.points(spark, sf_dir).select("patient_id", "ts", "event_id", "field", "value"))


@query("first_messages", f"SELECT * FROM ({t.POINTS_SQL}) ORDER BY ts, event_id LIMIT 250")
def first_messages(spark, sf_dir):
    return ts.first_messages(t.points(spark, sf_dir), 250)


@query(
    "rolling_metrics",
    f"""SELECT consumer, event_id, {steady_sql('avg(processing_time_ms) OVER w')} AS avg_ms, min(processing_time_ms) OVER w AS min_ms, max(processing_time_ms) OVER w AS max_ms
FROM ({t.METRICS_SQL}) WINDOW w AS (PARTITION BY consumer ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
)
def rolling_metrics(spark, sf_dir):
    times = t.consumer_metrics(spark, sf_dir).select("consumer", "ts", "event_id", "processing_time_ms")
    rolled = rolling_times(times, runs=runs(spark))
    return rolled.select("consumer", "event_id", steady(F.col("avg_ms")).alias("avg_ms"), "min_ms", "max_ms")


@query(
    "partition_state",
    f'SELECT partition, arg_max("offset", ts) AS "offset", arg_max(lag, ts) AS lag FROM ({t.METRICS_SQL}) GROUP BY 1',
)
def partition_state(spark, sf_dir):
    return m.partition_state(t.consumer_metrics(spark, sf_dir))


@query(
    "partition_lag",
    f"SELECT count(*) AS partitions, CAST(sum(lag) AS BIGINT) AS total_lag, max(lag) AS max_lag FROM (SELECT partition, arg_max(lag, ts) AS lag FROM ({t.METRICS_SQL}) GROUP BY 1)",
)
def partition_lag(spark, sf_dir):
    return m.lag_summary(t.consumer_metrics(spark, sf_dir))


@query(
    "success_rate",
    f"""SELECT count(*) FILTER (WHERE NOT failed) AS messages_processed, count(*) FILTER (WHERE failed) AS errors,
  count(*) FILTER (WHERE NOT failed) * 100.0::DOUBLE / count(*) AS success_rate,
  count(*) FILTER (WHERE NOT failed) / 2592000.0::DOUBLE AS messages_per_sec FROM ({t.METRICS_SQL})""",
)
def success_rate(spark, sf_dir):
    return m.throughput(t.consumer_metrics(spark, sf_dir), F.lit(2592000.0))


@query(
    "message_counters",
    f"""SELECT count(*) AS received, count(*) FILTER (WHERE processed) AS processed, count(*) FILTER (WHERE NOT processed) AS failed,
  count(*) FILTER (WHERE stored) AS stored, count(*) FILTER (WHERE alerted) AS alerted
FROM (SELECT NOT failed AS processed, NOT failed AND lag > 10 AS stored, NOT failed AND processing_time_ms > 100 AS alerted FROM ({t.METRICS_SQL}))""",
)
def message_counters(spark, sf_dir):
    done = ~F.col("failed")
    outcomes = t.consumer_metrics(spark, sf_dir).select(
        done.alias("processed"), (done & (F.col("lag") > 10)).alias("stored"),
        (done & (F.col("processing_time_ms") > 100)).alias("alerted"),
    )
    return m.message_counters(outcomes)
