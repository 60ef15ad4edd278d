"""Ingest queries: decode, flatten, quarantine, tracks, audit, publish."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.functions.model import threshold_outcome
from pulseframe.functions.readings import parse_time, split_pressure
from pulseframe.functions.scoring import score_readings, scored_records
from pulseframe.operators.alerts import build_alerts
from pulseframe.sources import tables as tb
from pulseframe.sources import topics, tracks
from pulseframe.sources.points import to_points
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query
from pulseframe.plans.alerting import BUILT_SQL
from pulseframe.plans.vitals import SCORED_SQL

# Each event becomes a message of one of these shapes, by its id. `{v}` is its value.
_SHAPES = (
    '"vital_signs":{{"heart_rate":{v},"spo2":98.5}}',
    '"vital_signs":{{"heart_rate":"{v}","temperature":37}}',
    '"vital_signs":{{"heart_rate":{{"value":{v}}},"note":"rest"}}',
    '"vital_signs":{{"spo2":97,"blood_pressure":"120/{v}"}}',
    '"vital_signs":{{"blood_pressure":{{"systolic":{v},"diastolic":80}}}}',
    '"vital_signs":{{"heart_rate":null,"spo2":{v}}}',
    '"vital_signs":{{"heart_rate":"-5","spo2":"1e3","temperature":{v}}}',
    '"vital_signs":{{"heart_rate":"12d","bp_systolic":{v}}}',
    '"vital_signs":{{"heart_rate":true,"respiratory_rate":{v}}}',
    '"vital_signs":{{}}',
    '"device_id":"dev-1"',
)
# Expected (heart_rate, spo2, temperature, respiratory_rate, systolic, diastolic) per shape.
_FLAT = (
    ("value", "98.5", None, None, None, None),
    ("value", None, "37", None, None, None),
    ("value", None, None, None, None, None),
    (None, "97", None, None, "120", "value"),
    (None, None, None, None, "value", "80"),
    (None, "value", None, None, None, None),
    (None, None, "value", None, None, None),
    (None, None, None, None, "value", None),
    ("1", None, None, "value", None, None),
    (None,) * 6,
    (None,) * 6,
)
_CLEANING = (*_FLAT[:6], ("-5", "1000", "value", None, None, None), *_FLAT[7:])
_FIELDS = ("heart_rate", "spo2", "temperature", "respiratory_rate", "blood_pressure_systolic", "blood_pressure_diastolic")
_N = len(_SHAPES) + 1  # the last shape is not JSON


def messages(spark, sf_dir):
    events = t.load(spark, sf_dir, "events")
    shape = F.col("event_id") % _N
    body = F
    for i, text in enumerate(_SHAPES):
        before, after = text.replace("{{", "{").replace("}}", "}").split("{v}") if "{v}" in text else (text.replace("{{", "{").replace("}}", "}"), None)
        inner = F.lit(before) if after is None else F.concat(F.lit(before), F.col("value").cast("string"), F.lit(after))
        body = body.when(shape == i, inner)
    patient = F.when(F.col("value") < 10, "").otherwise(
        F.concat(F.lit('"patient_id":"ICU-'), F.lpad(F.col("user_id").cast("string"), 6, "0"), F.lit('",'))
    )
    text = F.concat(
        F.lit("{"), patient, F.lit('"timestamp":"'), F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")),
        F.lit('Z",'), body.otherwise(F.lit("broken")), F.lit("}"),
    )
    return events.select("event_id", text.alias("value"))


def _expected(rows, index):
    arms = " ".join(f"WHEN {i} THEN {row[index]}" for i, row in enumerate(rows) if row[index] is not None)
    return f"CAST(CASE event_id % {_N} {arms} END AS DOUBLE) AS {_FIELDS[index]}" if arms else f"CAST(NULL AS DOUBLE) AS {_FIELDS[index]}"


_DECODED_SQL = "SELECT event_id, CASE WHEN value < 10 THEN 'Unknown' ELSE 'ICU-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS patient_id, ts, "


def _flat_columns(vitals):
    return [F.try_element_at(vitals, F.lit(f)).alias(f) for f in _FIELDS]


@query(
    "flatten_json_vitals",
    _DECODED_SQL + ", ".join(_expected(_FLAT, i) for i in range(6)) + f" FROM events WHERE event_id % {_N} < {_N - 1}",
)
def flatten_json_vitals(spark, sf_dir):
    decoded = topics.only(topics.decode(messages(spark, sf_dir), for_cleaning=False), F.col("body").isNotNull())
    return decoded.select("event_id", "patient_id", F.col("ts").cast("timestamp_ntz").alias("ts"), *_flat_columns(F.col("vitals")))


@query(
    "decode_for_cleaning",
    _DECODED_SQL + ", ".join(_expected(_CLEANING, i) for i in range(6)) + f" FROM events WHERE event_id % {_N} < {_N - 3}",
)
def decode_for_cleaning(spark, sf_dir):
    valid, _ = topics.split_valid(topics.decode(messages(spark, sf_dir)))
    return valid.select("event_id", "patient_id", F.col("ts").cast("timestamp_ntz").alias("ts"), *_flat_columns(F.col("vitals")))


@query(
    "quarantine_split",
    f"""SELECT event_id, CASE WHEN event_id % {_N} = {_N - 1} THEN 'malformed message' ELSE 'no usable vital' END AS reason
FROM events WHERE event_id % {_N} >= {_N - 3}""",
)
def quarantine_split(spark, sf_dir):
    _, rejected = topics.split_valid(topics.decode(messages(spark, sf_dir)))
    return rejected.select("event_id", "reason")


@query(
    "pressure_split",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE value + 60 END AS systolic,
  CASE WHEN event_type IN ('click', 'signup') THEN NULL ELSE value END AS diastolic FROM events""",
)
def pressure_split(spark, sf_dir):
    low, high = F.col("value").cast("string"), (F.col("value") + 60).cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit('"'), high, F.lit('"')))
        .when(kind == "signup", F.concat(F.lit('{"systolic":'), high, F.lit("}")))
        .when(kind == "view", F.concat(F.lit('{"systolic":'), high, F.lit(',"diastolic":'), low, F.lit("}")))
        .otherwise(F.concat(F.lit('"'), high, F.lit("/"), low, F.lit('"')))
    )
    return split_pressure(t.load(spark, sf_dir, "events"), text).select("event_id", "systolic", "diastolic")


@query(
    "iso_times",
    "SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN date_trunc('second', ts) ELSE ts END AS ts FROM events",
)
def iso_times(spark, sf_dir):
    micro, second = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss"
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("yesterday"))
        .when(kind == "signup", F.date_format("ts", second))
        .when(kind == "view", F.concat(F.date_format("ts", micro), F.lit("+00:00")))
        .when(kind == "click", F.date_format("ts", micro))
        .otherwise(F.concat(F.date_format("ts", micro), F.lit("Z")))
    )
    return t.load(spark, sf_dir, "events").select("event_id", parse_time(text).cast("timestamp_ntz").alias("ts"))


# Event types as track pairs; small values come from the preferred track, tiny ones are absent samples.
_KINDS = {
    "click": "heart_rate", "view": "spo2", "purchase": "temperature", "signup": "respiratory_rate",
    "error": "blood_pressure_systolic",
}


def _candidate_track():
    track = F
    for kind, vital in _KINDS.items():
        first, second = tracks.TRACK_CANDIDATES[vital]
        mine = F.col("event_type") == kind
        track = track.when(mine & (F.col("value") < 40), F.lit(first)).when(mine, F.lit(second))
    return track


def samples(spark, sf_dir, track):
    """Samples with days as seconds, so that a grid row holds several tracks."""
    absent = F.lit(float("nan"))
    return t.load(spark, sf_dir, "events").select(
        F.col("user_id").alias("case_id"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(86_400_000_000.0)).alias("t"),
        track.alias("track"),
        F.when(F.col("value") < 4, absent).otherwise(F.col("value")).alias("value"),
    )


# The SQL names tracks, their order and their vitals anew, so that a wrong mapping in the code shows.
_SAMPLES_SQL = """SELECT user_id AS case_id, epoch_us(ts) / 86400000000.0::DOUBLE AS t,
  CASE WHEN event_type = 'click' AND value < 40 THEN 'SNUADC/HR' WHEN event_type = 'click' THEN 'Solar8000/HR'
       WHEN event_type = 'view' AND value < 40 THEN 'SNUADC/SPO2' WHEN event_type = 'view' THEN 'Solar8000/PLETH_SPO2'
       WHEN event_type = 'error' AND value < 40 THEN 'SNUADC/ART_SBP' WHEN event_type = 'error' THEN 'Solar8000/ART_SBP'
       WHEN event_type = 'purchase' AND value < 40 THEN 'Solar8000/BT' WHEN event_type = 'purchase' THEN 'Primus/TEMP_BLD'
       WHEN event_type = 'signup' AND value < 40 THEN 'Solar8000/RR' WHEN event_type = 'signup' THEN 'Primus/RR_CO2' END AS track,
  CASE WHEN value < 4 THEN 'NaN'::DOUBLE ELSE value END AS value FROM events"""
_GRID_TRACKS = (
    "SNUADC/HR", "Solar8000/HR", "SNUADC/SPO2", "Solar8000/PLETH_SPO2", "SNUADC/ART_SBP", "Solar8000/ART_SBP",
    "SNUADC/ART_DBP", "Solar8000/ART_DBP", "Solar8000/BT", "Primus/TEMP_BLD", "Solar8000/RR", "Primus/RR_CO2",
)
_GRID_SQL = f"""SELECT case_id, CAST(floor(t) AS BIGINT) AS second,
  {', '.join(f"nullif(arg_max(value, t) FILTER (WHERE track = '{k}'), 'NaN'::DOUBLE) AS c{i}" for i, k in enumerate(_GRID_TRACKS))}
FROM ({_SAMPLES_SQL}) GROUP BY 1, 2"""
_COALESCED_SQL = f"""SELECT case_id, second, coalesce(c0, c1) AS heart_rate, coalesce(c2, c3) AS spo2,
  coalesce(c4, c5) AS blood_pressure_systolic, coalesce(c6, c7) AS blood_pressure_diastolic,
  coalesce(c8, c9) AS temperature, coalesce(c10, c11) AS respiratory_rate FROM ({_GRID_SQL})"""


@query("track_grid", _GRID_SQL)
def track_grid(spark, sf_dir):
    grid = tracks.to_grid(samples(spark, sf_dir, _candidate_track()), tracks.all_tracks())
    cols = [F.when(~F.isnan(F.col(f"`{k}`")), F.col(f"`{k}`")).alias(f"c{i}") for i, k in enumerate(tracks.all_tracks())]
    return grid.select("case_id", "second", *cols)


@query("coalesced_tracks", f"SELECT * FROM ({_COALESCED_SQL}) WHERE heart_rate IS NOT NULL AND spo2 IS NOT NULL")
def coalesced_tracks(spark, sf_dir):
    grid = tracks.to_grid(samples(spark, sf_dir, _candidate_track()), tracks.all_tracks())
    return tracks.replayable(tracks.coalesce_tracks(grid))


# Samples of all five short tracks: the grid of the given events lacks one, so all fill it in turn.
_SHORT_SQL = """SELECT user_id AS case_id, CAST(floor(epoch_us(ts) / 86400000000.0::DOUBLE / 20) AS BIGINT) AS second,
  epoch_us(ts) / 86400000000.0::DOUBLE / 20 AS t,
  CASE event_type WHEN 'click' THEN 'hr' WHEN 'view' THEN 'spo2' WHEN 'purchase' THEN 'sbp' WHEN 'signup' THEN 'dbp' ELSE 'co2' END AS track,
  CASE WHEN value < 4 THEN 'NaN'::DOUBLE ELSE value END AS value FROM events"""


@query(
    "renamed_tracks",
    f"""SELECT * FROM (SELECT case_id, second, arg_max(value, t) FILTER (WHERE track = 'hr') AS heart_rate, arg_max(value, t) FILTER (WHERE track = 'spo2') AS spo2,
  arg_max(value, t) FILTER (WHERE track = 'sbp') AS bp_systolic, arg_max(value, t) FILTER (WHERE track = 'dbp') AS bp_diastolic,
  arg_max(value, t) FILTER (WHERE track = 'co2') AS etco2 FROM ({_SHORT_SQL}) GROUP BY 1, 2)
WHERE NOT isnan(heart_rate) AND NOT isnan(spo2) AND NOT isnan(bp_systolic) AND NOT isnan(bp_diastolic) AND NOT isnan(etco2)""",
)
def renamed_tracks(spark, sf_dir):
    names = dict(zip(("click", "view", "purchase", "signup", "error"), tracks.SHORT_TRACKS))
    track = F
    for kind, name in names.items():
        track = track.when(F.col("event_type") == kind, F.lit(name))
    made = samples(spark, sf_dir, track).withColumn("t", F.col("t") / 20)
    return tracks.rename_tracks(tracks.to_grid(made, list(tracks.SHORT_TRACKS)))


@query(
    "points_from_messages",
    "SELECT 'vital_signs' AS measurement, patient_id, 'unknown' AS device_id, field, value, ts FROM ("
    + _DECODED_SQL + ", ".join(_expected(_FLAT, i) for i in range(6)) + f" FROM events WHERE event_id % {_N} < {_N - 1})"
    + f" UNPIVOT (value FOR field IN ({', '.join(_FIELDS)}))",
)
def points_from_messages(spark, sf_dir):
    decoded = topics.decode(messages(spark, sf_dir), for_cleaning=False)
    made = to_points(decoded, F.lit("2024-01-01").cast("timestamp"))
    return made.select("measurement", "patient_id", "device_id", "field", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(
    "limit_alert_rows",
    f"""SELECT patient_id, CASE WHEN low IS NOT NULL THEN 'low_' ELSE 'high_' END || field AS alert_type, field AS vital_type, value,
  coalesce(low, high) AS threshold, ts AS timestamp FROM (
  SELECT *, CASE WHEN field = 'heart_rate' AND value < 50 THEN 50.0 WHEN field = 'spo2' AND value < 90 THEN 90.0 WHEN field = 'temperature' AND value < 36 THEN 36.0 WHEN field = 'blood_pressure_systolic' AND value < 90 THEN 90.0 END::DOUBLE AS low,
    CASE WHEN field = 'heart_rate' AND value > 120 THEN 120.0 WHEN field = 'temperature' AND value > 38 THEN 38.0 WHEN field = 'blood_pressure_systolic' AND value > 180 THEN 180.0 END::DOUBLE AS high
  FROM ({t.POINTS_SQL})) WHERE coalesce(low, high) IS NOT NULL""",
)
def limit_alert_rows(spark, sf_dir):
    from pulseframe.functions.display import DANGER_LIMITS

    rows = tb.limit_alert_rows(t.points(spark, sf_dir), DANGER_LIMITS)
    return rows.select("patient_id", "alert_type", "vital_type", "value", "threshold", "timestamp")


@query(
    "event_rows",
    f"SELECT CAST(patient_id AS VARCHAR) AS patient_id, 'reading' AS event_type, timestamp, risk_level AS severity, 'MEWS ' || mews_score AS description, heart_rate FROM ({SCORED_SQL})",
)
def event_rows(spark, sf_dir):
    records = scored_records(t.readings(spark, sf_dir))
    rows = tb.event_rows(records, F.lit("reading"), F.concat(F.lit("MEWS "), F.col("mews_score").cast("string")))
    hr = F.get_json_object("vital_signs", "$.heart_rate").cast("double").alias("heart_rate")
    return rows.select("patient_id", "event_type", "timestamp", "severity", "description", hr)


@query(
    "audit_rows",
    f"""SELECT CAST(patient_id AS VARCHAR) AS patient_id, 'reading' AS event_type, risk_score, NULL AS error_message, risk_level AS logged_level FROM ({SCORED_SQL})
UNION ALL SELECT CAST(patient_id AS VARCHAR), 'alert', risk_score, NULL, risk_level FROM ({BUILT_SQL})
UNION ALL SELECT CASE WHEN value < 10 AND event_id % {_N} <> {_N - 1} THEN 'Unknown' WHEN event_id % {_N} = {_N - 1} THEN 'Unknown' ELSE 'ICU-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END, 'error', NULL,
  CASE WHEN event_id % {_N} = {_N - 1} THEN 'malformed message' ELSE 'no usable vital' END, NULL FROM events WHERE event_id % {_N} >= {_N - 3}""",
)
def audit_rows(spark, sf_dir):
    scored = score_readings(t.readings(spark, sf_dir))
    _, rejected = topics.split_valid(topics.decode(messages(spark, sf_dir)))
    late = rejected.withColumn("timestamp", F.col("ts").cast("timestamp_ntz"))
    trail = tb.audit_trail(
        tb.audit_readings(scored.drop("day")), tb.audit_alerts(build_alerts(scored)), tb.audit_errors(late, data="value")
    )
    return trail.select(
        "patient_id", "event_type", "risk_score", "error_message",
        F.get_json_object("event_data", "$.risk_level").alias("logged_level"),
    )


@query(
    "published_readings",
    f"SELECT CAST(patient_id AS VARCHAR) AS key, heart_rate, spo2, 'patient-vital-signs' AS topic, '2024-02-01T08:00:00.000000Z' AS sent_at FROM ({t.READINGS_SQL})",
)
def published_readings(spark, sf_dir):
    sent = topics.encode(t.readings(spark, sf_dir), "patient-vital-signs", F.lit("2024-02-01 08:00:00").cast("timestamp"))
    get = lambda path: F.get_json_object("value", path)
    return sent.select(
        "key", get("$.heart_rate").cast("double").alias("heart_rate"), get("$.spo2").cast("double").alias("spo2"),
        get("$.producer_metadata.topic").alias("topic"), get("$.producer_metadata.sent_at").alias("sent_at"),
    )


@query(
    "threshold_outcomes",
    f"""SELECT event_id, CASE WHEN event_id % {_N} = 11 THEN 'malformed message' WHEN event_id % {_N} IN (1, 2, 5, 6, 7) THEN 'vital is no number'
  WHEN event_id % {_N} IN (3, 4, 8, 9, 10) THEN 'alert' WHEN value > 120 OR value < 50 THEN 'alert' ELSE 'ok' END AS outcome FROM events""",
)
def threshold_outcomes(spark, sf_dir):
    """The simple alert rule on whole messages: absent vitals take defaults, null ones go to quarantine."""
    bodies = topics.parsed(messages(spark, sf_dir))
    return bodies.select("event_id", threshold_outcome(F.col("body")).alias("outcome"))


@query("patient_by_key", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey = 42")
def patient_by_key(spark, sf_dir):
    """One row of a table by its key: the filter and the three columns reach the scan."""
    return tb.find(tb.read_table(spark, f"{sf_dir}/customer.parquet"), "c_custkey", 42).select("c_custkey", "c_name", "c_mktsegment")
