"""Tables that are kept up to date while data streams in: risk, latest readings, profiles, compacted points."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import maintain as m
from pulseframe.plans import tables as t
from pulseframe.plans import upkeep as u
from pulseframe.plans.people import CURRENT_SQL
from pulseframe.plans.registry import query
from pulseframe.plans.series import SERIES
from pulseframe.plans.streams import _SCORED_STREAM_SQL, _arrivals, _arriving, _messages, _monitor, _monitored
from pulseframe.session import scratch_path
from pulseframe.sources.snapshots import Snapshots
from pulseframe.streaming.tables import compact, compacted, drop_compacted, fold_risk, keep_latest

_LAST_SQL = f"SELECT * FROM ({_SCORED_STREAM_SQL}) QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, event_id DESC) = 1"


class _Crash(Exception):
    pass


@query(
    "risk_applied_once",
    f"""WITH latest AS ({_LAST_SQL}), adm AS (SELECT * REPLACE ({u._TEXT_ID} AS patient_id) FROM ({t.ADMISSIONS_SQL})),
  cur AS (SELECT {u._TEXT_ID} AS patient_id, admission_id FROM ({CURRENT_SQL})), folded AS (
SELECT a.patient_id, a.department, a.initial_diagnosis, a.admission_time, a.discharge_time,
  CASE WHEN l.patient_id IS NULL THEN a.risk_level ELSE l.risk_level END AS risk_level,
  CASE WHEN l.patient_id IS NULL THEN a.current_risk_score ELSE l.risk_score END AS current_risk_score
FROM adm a LEFT JOIN cur c ON a.admission_id = c.admission_id LEFT JOIN latest l ON c.patient_id = l.patient_id
UNION ALL
SELECT patient_id, 'ICU-Emergency', 'Auto-admitted from Stream', TIMESTAMP '{u.NOW}', NULL, risk_level, risk_score
FROM latest WHERE patient_id NOT IN (SELECT patient_id FROM cur))
SELECT * REPLACE (CASE WHEN risk_level = 'STABLE' THEN coalesce(discharge_time, TIMESTAMP '{u.NOW}') ELSE discharge_time END AS discharge_time)
FROM folded""",
)
def risk_applied_once(spark, sf_dir):
    """The risk of a stream folded into stored tables: first interrupted before its commit, then repeated, and
    repeated again after all patients without risk were discharged, which must not admit them anew."""
    root = _monitored(spark, _messages(_arriving(t.load(spark, sf_dir, "events"), "risk_events", late=False)))
    store, now = Snapshots(spark, scratch_path(spark, "store")), u._now()
    store.create("patients", u._with_text_ids(t.patients(spark, sf_dir)), "patient_id")
    store.create("admissions", u._with_text_ids(t.admissions(spark, sf_dir)), "patient_id")

    def crash(version):
        raise _Crash

    interrupted = Snapshots(spark, store._root)
    interrupted._publish = crash
    try:
        fold_risk(spark, root, interrupted, now)
    except _Crash:
        pass
    fold_risk(spark, root, store, now)
    calm = store.read("admissions").filter("risk_level = 'STABLE' AND discharge_time IS NULL").select("patient_id", "admission_id")
    leave = lambda rows, gone: rows.join(gone.withColumn("gone", F.lit(True)), ["patient_id", "admission_id"], "left").withColumn(
        "discharge_time", F.when(F.col("gone"), now).otherwise(F.col("discharge_time")))
    store.change("admissions", calm, leave)
    fold_risk(spark, root, store, now)
    return store.read("admissions").select(
        "patient_id", "department", "initial_diagnosis", "admission_time", "discharge_time", "risk_level", "current_risk_score")


@query(
    "latest_vitals_stream",
    f"SELECT patient_id, field, ts, event_id, value FROM ({t.POINTS_SQL}) QUALIFY row_number() OVER (PARTITION BY patient_id, field ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_vitals_stream(spark, sf_dir):
    """The newest point per series, kept in a table while points arrive late and out of order."""
    path, stream = scratch_path(spark, "latest"), _arriving(t.points(spark, sf_dir), "points")
    store = Snapshots(spark, f"{path}/store")
    stream.writeStream.foreachBatch(keep_latest(store, SERIES, ["ts", "event_id"])).option(
        "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return store.read("latest").select(*SERIES, F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value")


@query("upsert_profiles_in_parts", u.upsert_profiles_sql)
def upsert_profiles_in_parts(spark, sf_dir):
    """Profile changes applied week by week to a stored table: each rewrites only the parts it touches."""
    store = Snapshots(spark, scratch_path(spark, "profiles"))
    store.create("patients", t.patients(spark, sf_dir), "patient_id")
    changes = u._profile_changes(spark, sf_dir)
    for week in range(5):
        now = changes.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 7), F.lit(4)) == week)
        store.change("patients", now, lambda old, new: m.upsert_profiles(old, new, ["ts", "event_id"], u._now()))
        store.expire()
    return store.read("patients").select("patient_id", "full_name", "profile", "extra_data", "created_at", "updated_at")


_DAYS = ("2024-01-12", "2024-01-17")


@query(
    "compacted_points",
    f"""WITH s AS (SELECT * FROM ({_SCORED_STREAM_SQL}) WHERE CAST(ts AS DATE) BETWEEN DATE '{_DAYS[0]}' AND DATE '{_DAYS[1]}')
SELECT patient_id, field, ts, cleaned AS value, risk_level FROM s UNION ALL SELECT patient_id, 'risk_score', ts, risk_score, risk_level FROM s""",
)
def compacted_points(spark, sf_dir):
    """Some days of the points of a stream: part of them compacted into day files, their batch folders deleted, part still in batches."""
    root = scratch_path(spark, "monitoring")
    for stream in _arrivals(t.load(spark, sf_dir, "events"), "point_events", late=False):
        _monitor(_messages(stream), root)
    store = Snapshots(spark, f"{root}/store")
    compact(spark, root, store, "points", ["patient_id", "ts"], upto=1)
    drop_compacted(spark, root, store, "points")
    return compacted(spark, root, store, "points", _DAYS).select(
        "patient_id", "field", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "risk_level")
