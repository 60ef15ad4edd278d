"""Streaming queries, run over everything available and returned as a batch result."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.plans import alerting
from pulseframe.plans import tables as t
from pulseframe.plans.registry import query, steady, steady_sql
from pulseframe.plans.states import CLEANED_SQL, COOLDOWN_SQL, TWO_DAYS
from pulseframe.plans.upkeep import _with_text_ids
from pulseframe.plans.vitals import _BANDS_SQL, _bands_sql
from pulseframe.session import scratch_path
from pulseframe.sources.snapshots import Snapshots
from pulseframe.streaming.board import board_alerts, board_changes, on_board
from pulseframe.streaming.monitor import accounting, audit_log, consume_first, start_dispatch, start_monitoring
from pulseframe.streaming.progress import consumer_metrics
from pulseframe.streaming.rolling import rolling_times_stream
from pulseframe.streaming.stateful import clean_readings_stream, cool_down_stream

def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = t.load(spark, sf_dir, "events").schema
    # A file stream takes a folder or a pattern, not a single file.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over all available input into files, and read them."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, label)
    done = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    done.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def _vital_map():
    field, value = F, F
    for kind, (vital, scale, offset) in t.EVENT_VITALS.items():
        mine = F.col("event_type") == kind
        field = field.when(mine, F.lit(vital))
        value = value.when(mine, F.col("value") * F.lit(scale) + F.lit(offset))
    return F.create_map(field, value)


@query("cleaned_vitals_stream", f"SELECT CAST(patient_id AS VARCHAR) AS patient_id, field, ts, event_id, cleaned FROM ({CLEANED_SQL})")
def cleaned_vitals_stream(spark, sf_dir):
    readings = event_stream(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("patient_id"), "ts", F.col("event_id").alias("reading_id"),
        _vital_map().alias("vitals"),
    )
    cleaned = run_available(clean_readings_stream(readings), "cleaned")
    return cleaned.select(
        "patient_id", F.explode("vitals").alias("field", "cleaned"),
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("reading_id").alias("event_id"),
    )


@query("alert_cooldown_stream", f"SELECT CAST(patient_id AS VARCHAR) AS patient_id, alert_type, ts, event_id, passed FROM ({COOLDOWN_SQL})")
def alert_cooldown_stream(spark, sf_dir):
    alerts = event_stream(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("patient_id"), F.col("event_type").alias("alert_type"), "ts",
        F.col("event_id").alias("alert_id"), F.col("props").alias("body"),
    )
    marked = run_available(cool_down_stream(alerts, TWO_DAYS), "cooldown")
    return marked.select(
        "patient_id", "alert_type", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("alert_id").alias("event_id"), "passed",
    )


_POINTS = "(CASE field " + " ".join(
    f"WHEN '{v}' THEN {_bands_sql(v, 'cleaned')}" for v in _BANDS_SQL
) + " ELSE 0 END)"
_BONUS = """CASE WHEN field = 'heart_rate' AND (cleaned < 40 OR cleaned > 140) THEN 10 WHEN field = 'spo2' AND cleaned < 85 THEN 10
  WHEN field = 'spo2' AND cleaned < 90 THEN 5 ELSE 0 END"""


_SCORED_STREAM_SQL = f"""SELECT patient_id, event_id, ts, mews_score, risk_score,
  CASE WHEN risk_score >= 75 OR mews_score >= 5 THEN 'CRITICAL' WHEN risk_score >= 50 OR mews_score >= 4 THEN 'HIGH'
       WHEN risk_score >= 20 OR mews_score >= 2 THEN 'MODERATE' ELSE 'STABLE' END AS risk_level, field, cleaned
FROM (SELECT 'ICU-' || lpad(CAST(patient_id AS VARCHAR), 6, '0') AS patient_id, event_id, ts, field, cleaned, CAST({_POINTS} AS INTEGER) AS mews_score,
        round({_POINTS} / 14.0::DOUBLE * 70 + {_BONUS}, 2) AS risk_score FROM ({CLEANED_SQL}))"""


def _messages(events):
    body = F.struct(
        F.format_string("ICU-%06d", "user_id").alias("patient_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        _vital_map().alias("vital_signs"),
    )
    return events.select("event_id", "ts", F.to_json(body).alias("value"))


def _monitored(spark, messages, **options) -> str:
    """Folder of the sinks after all messages went through decode, cleanup, scoring and the batch sinks."""
    root = scratch_path(spark, "monitoring")
    _monitor(messages, root, **options)
    return root


def _monitor(messages, root: str, **options) -> None:
    """Everything available through decoding on all cores, whatever the input's files and row groups, and scoring."""
    tasks = messages.sparkSession.sparkContext.defaultParallelism
    started = start_monitoring(
        messages, root, F.col("event_id"), F.col("ts"), watch=False, tasks=tasks, availableNow=True, **options)
    for running in started:
        running.awaitTermination()


@query("monitoring_stream", f"SELECT patient_id, event_id, mews_score, risk_score, risk_level FROM ({_SCORED_STREAM_SQL})")
def monitoring_stream(spark, sf_dir):
    root = _monitored(spark, _messages(event_stream(spark, sf_dir)))
    return spark.read.parquet(f"{root}/scored").select(
        "patient_id", F.col("reading_id").alias("event_id"), "mews_score", "risk_score", "risk_level"
    )


@query(
    "monitoring_sinks",
    f"""WITH scored AS ({_SCORED_STREAM_SQL}), alerts AS (SELECT * FROM scored WHERE risk_level IN ('MODERATE', 'HIGH', 'CRITICAL'))
SELECT 'points' AS sink, count(*) * 2 AS n, CAST(round(sum(cleaned + risk_score)) AS BIGINT) AS total FROM scored
UNION ALL SELECT 'risk', count(*), CAST(round(sum(risk_score)) AS BIGINT) FROM (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ts DESC, event_id DESC) = 1)
UNION ALL SELECT 'alerts', count(*), CAST(round(sum(risk_score)) AS BIGINT) FROM alerts
UNION ALL SELECT 'audit', count(*) + (SELECT count(*) FROM alerts) + (SELECT count(*) FROM ({t.POINTS_SQL})) - count(*),
  CAST(round(sum(risk_score) + (SELECT sum(risk_score) FROM alerts)) AS BIGINT) FROM scored
UNION ALL SELECT 'metrics', (SELECT count(*) FROM ({t.POINTS_SQL})), count(*) FROM scored
UNION ALL SELECT 'dispatched', sum(CASE risk_level WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 ELSE 1 END), sum(event_id)::BIGINT FROM alerts""",
)
def monitoring_sinks(spark, sf_dir):
    """Row counts and sums of the other sinks; with no wait at all every alert is dispatched."""
    root = _monitored(spark, _messages(event_stream(spark, sf_dir)))
    start_dispatch(spark, root, seconds=0, availableNow=True).awaitTermination()
    sink = lambda name: spark.read.parquet(f"{root}/{name}")
    made = lambda name, df, n, total: df.agg(n.cast("bigint").alias("n"), F.round(total).cast("bigint").alias("total")).select(F.lit(name).alias("sink"), "n", "total")
    rows, risk = F.count("*"), F.sum("risk_score")
    parts = [
        made("points", sink("points"), rows, F.sum("value")), made("risk", sink("risk"), rows, risk),
        made("alerts", sink("alerts"), rows, risk), made("audit", audit_log(spark, root), rows, risk),
        made("metrics", sink("metrics"), F.sum(F.col("messages_processed") + F.col("messages_failed")), F.sum("messages_processed")),
        made("dispatched", sink("dispatched").dropDuplicates(["alert_id", "channel"]), rows, F.sum(F.when(F.col("channel") == "dashboard", F.col("alert_id")))),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query(
    "monitoring_accounting",
    """SELECT 'received' AS outcome, count(*) + count(*) FILTER (WHERE event_id % 10 = 5) AS messages FROM events
UNION ALL SELECT 'malformed message', count(*) FROM events WHERE event_id % 10 = 0
UNION ALL SELECT 'no usable vital', count(*) FROM events WHERE event_id % 10 = 1
UNION ALL SELECT 'duplicate message', count(*) FROM events WHERE event_id % 10 = 5
UNION ALL SELECT 'no plausible vital', count(*) FROM events WHERE event_id % 10 = 6
UNION ALL SELECT 'scored', count(*) FROM events WHERE event_id % 10 NOT IN (0, 1, 6)""",
)
def monitoring_accounting(spark, sf_dir):
    """Malformed, empty, untimed, badly timed, oddly named, repeated and implausible messages: none is lost."""
    return accounting(spark, _monitored(spark, _odd_messages(event_stream(spark, sf_dir))))


def _odd_messages(events):
    kind = F.col("event_id") % 10
    time = F.when(kind == 2, F.lit("")).when(kind == 3, F.lit(', "timestamp": "yesterday"')).otherwise(
        F.concat(F.lit(', "timestamp": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"')))
    vitals = (
        F.when(kind == 1, "").when(kind == 4, '"heart_rate": 80, "risk_score": 3').when(kind == 6, '"heart_rate": 900')
        .otherwise('"heart_rate": 80'))
    # Everyone's series starts afresh, so that implausible values have nothing to fall back on.
    text = F.concat(F.lit('{"patient_id": "p'), "event_id", F.lit('"'), time, F.lit(', "vital_signs": {'), vitals, F.lit("}}"))
    events = events.withColumn("value", F.when(kind == 0, F.lit("{oops")).otherwise(text))
    again = F.explode(F.when(kind == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return events.select("event_id", "ts", "value", again.alias("copy")).drop("copy")


@query(
    "consumer_metrics_filled",
    """SELECT count(*) AS messages_processed, count(*) FILTER (WHERE event_id % 10 IN (0, 1)) AS messages_failed,
  count(DISTINCT least(3, (day(ts) - 1) // 10)) AS reports FROM events""",
)
def consumer_metrics_filled(spark, sf_dir):
    """The consumer metrics table as the listener wrote it while a stream ran in several micro-batches."""
    root = scratch_path(spark, "watched")
    stream = _arriving(t.load(spark, sf_dir, "events"), "watched_events", late=False)
    decoding, scoring = start_monitoring(
        _odd_messages(stream), root, F.col("event_id"), F.col("ts"),
        tasks=spark.sparkContext.defaultParallelism, availableNow=True)
    scoring.awaitTermination()
    decoding.progress.wait(decoding.runId)
    spark.streams.removeListener(decoding.progress)
    reports = consumer_metrics(spark, f"{root}/consumer_metrics").filter("messages_processed > 0")
    return reports.agg(
        F.sum("messages_processed").alias("messages_processed"), F.sum("messages_failed").alias("messages_failed"),
        F.count("*").alias("reports"))


@query(
    "rolling_metrics_stream",
    f"""SELECT consumer, event_id, {steady_sql('avg(processing_time_ms) OVER w')} AS avg_ms, min(processing_time_ms) OVER w AS min_ms, max(processing_time_ms) OVER w AS max_ms
FROM ({t.METRICS_SQL}) WINDOW w AS (PARTITION BY consumer ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
)
def rolling_metrics_stream(spark, sf_dir):
    """Each consumer's last hundred times, across micro-batches."""
    times = t.consumer_metrics(spark, sf_dir).select("consumer", "ts", "event_id", "processing_time_ms")
    rolled = run_available(rolling_times_stream(_arriving(times, "times", late=False)), "rolled")
    return rolled.select("consumer", "event_id", steady(F.col("avg_ms")).alias("avg_ms"), "min_ms", "max_ms")


_RENAMED = "2024-01-16"


@query(
    "alerts_named_stream",
    f"""SELECT s.patient_id, s.event_id, s.risk_level, CASE WHEN p.full_name IS NULL THEN 'Patient ' || s.patient_id
  WHEN s.ts >= TIMESTAMP '{_RENAMED}' AND p.patient_id % 2 = 0 THEN 'Renamed ' || p.full_name ELSE p.full_name END AS patient_name
FROM ({_SCORED_STREAM_SQL}) s LEFT JOIN ({t.PATIENTS_SQL}) p
  ON p.patient_id >= 0 AND s.patient_id = 'ICU-' || lpad(CAST(p.patient_id AS VARCHAR), 6, '0')
WHERE s.risk_level IN ('MODERATE', 'HIGH', 'CRITICAL')""",
)
def alerts_named_stream(spark, sf_dir):
    """Alerts carry the names of the patient table as it is when their batch runs; half of the names change in between."""
    root, folder = scratch_path(spark, "named"), scratch_path(spark, "named_messages")
    store = Snapshots(spark, scratch_path(spark, "people"))
    people = _with_text_ids(t.patients(spark, sf_dir))
    store.create("patients", people, "patient_id")
    messages = _messages(t.load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    stream = spark.readStream.schema(messages.schema).parquet(f"{folder}/*")
    early = F.col("ts") < F.lit(_RENAMED).cast("timestamp")
    for name, part in (("early", messages.filter(early)), ("later", messages.filter(~early))):
        part.write.parquet(f"{folder}/{name}")
        _monitor(stream, root, people=store)
        even = people.filter("patient_id LIKE 'ICU-%' AND CAST(substr(patient_id, 5) AS BIGINT) % 2 = 0").select("patient_id")
        renamed = lambda old, new: old.join(new.withColumn("hit", F.lit(True)), "patient_id", "left").withColumn(
            "full_name", F.when(F.col("hit"), F.concat(F.lit("Renamed "), "full_name")).otherwise(F.col("full_name"))).drop("hit")
        store.change("patients", even, renamed)
    alerts = spark.read.parquet(f"{root}/alerts")
    return alerts.select("patient_id", F.col("reading_id").alias("event_id"), "risk_level", "patient_name")


_AGAIN = "event_id % 7 < 3"
_ONCE_SQL = f"(SELECT * FROM ({_SCORED_STREAM_SQL}))"


def _delivered(spark, sf_dir):
    """Messages of all events, then a part of them delivered again, in two files of their own and in reverse."""
    root = scratch_path(spark, "delivered")
    messages = _messages(t.load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return root, messages, spark.readStream.schema(messages.schema).parquet(f"{root}/*")


@query(
    "redelivered_accounting",
    f"""SELECT 'received' AS outcome, count(*) + 2 * count(*) FILTER (WHERE {_AGAIN}) AS messages, NULL AS total FROM ({t.POINTS_SQL})
UNION ALL SELECT 'duplicate message', 2 * count(*) FILTER (WHERE {_AGAIN}), NULL FROM ({t.POINTS_SQL})
UNION ALL SELECT 'scored', count(*), CAST(round(sum(risk_score)) AS BIGINT) FROM {_ONCE_SQL}
UNION ALL SELECT 'no plausible vital', (SELECT count(*) FROM ({t.POINTS_SQL})) - (SELECT count(*) FROM {_ONCE_SQL}), NULL""",
)
def redelivered_accounting(spark, sf_dir):
    """A restarted consumer delivers a range of messages again, twice: each is scored once, with the scores of a single delivery."""
    folder, messages, stream = _delivered(spark, sf_dir)
    root = scratch_path(spark, "monitoring")
    for name, part in (("first", messages), ("again", messages.filter(_AGAIN)), ("once_more", messages.filter(_AGAIN).orderBy(F.desc("event_id")))):
        part.write.parquet(f"{folder}/{name}")
        _monitor(stream, root)
    total = spark.read.parquet(f"{root}/scored").agg(F.round(F.sum("risk_score")).cast("bigint").alias("total"))
    counts = accounting(spark, root)
    return counts.join(total.withColumn("outcome", F.lit("scored")), "outcome", "left").select("outcome", "messages", "total")


def _arrivals(rows: DataFrame, label: str, late: bool = True) -> Iterator[DataFrame]:
    """A stream of ``rows``, given each time that ten days of arrivals more are there; a third arrives a day late, a third two days.

    Each ten days are written by all cores, and are a micro-batch.
    """
    spark, root = rows.sparkSession, scratch_path(rows.sparkSession, label)
    late = F.pmod(F.xxhash64(*rows.columns), F.lit(3)).cast("int") if late else F.lit(0)
    timed = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    arrival = F.floor((F.unix_seconds("ts") + late * 86_400 - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))) / (10 * 86_400))
    placed = timed.withColumn("arrival", F.greatest(F.lit(0), F.least(F.lit(3), arrival)))
    files = spark.sparkContext.defaultParallelism
    for part in range(4):
        folder = f"{root}/part={part}"
        placed.filter(F.col("arrival") == part).drop("arrival").repartition(files).write.parquet(folder)
        # A task without rows writes no file, and micro-batches are told apart by their number of files.
        for _ in range(len(spark.read.schema(timed.schema).parquet(folder).inputFiles()), files):
            spark.createDataFrame([], timed.schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/part=*")
        yield stream.drop("part")


def _arriving(rows: DataFrame, label: str, late: bool = True) -> DataFrame:
    """The stream of ``_arrivals`` with all of them there."""
    *_, stream = _arrivals(rows, label, late)
    return stream


def _board(spark, sf_dir):
    """One row per alert after alerts and acknowledgements went through the board, out of order and late."""
    alerts = t.alert_events(spark, sf_dir).withColumnRenamed("alert_type", "body")
    rows = alerts.withColumn("acknowledged_by", F.lit(None).cast("string")).unionByName(
        t.ack_events(spark, sf_dir), allowMissingColumns=True)
    stream = _arriving(rows, "board")
    changes = board_changes(
        stream.filter("alert_id IS NOT NULL"), stream.filter("alert_id IS NULL").select("patient_id", "ts", "acknowledged_by"),
        delay="3 days", display_seconds=alerting.WEEK, tick_seconds=3600)
    return board_alerts(run_available(changes, "board_changes")).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("ts", "acknowledged_at", "expired_at")})


@query("alerts_acked_stream", f"SELECT CAST(patient_id AS VARCHAR) AS patient_id, * EXCLUDE (patient_id) FROM ({alerting.ACKED_SQL})")
def alerts_acked_stream(spark, sf_dir):
    return _board(spark, sf_dir).withColumnRenamed("body", "alert_type").select(
        "patient_id", "ts", "alert_id", "alert_type", "severity", "acknowledged", "acknowledged_at", "acknowledged_by")


@query(
    "active_alerts_stream",
    f"""SELECT CAST(patient_id AS VARCHAR) AS patient_id, alert_id, severity, ts FROM ({alerting.ACKED_SQL})
WHERE ts <= TIMESTAMP '{alerting.AT}' AND NOT coalesce(acknowledged_at <= TIMESTAMP '{alerting.AT}', FALSE)
  AND (severity = 'CRITICAL' OR ts > TIMESTAMP '{alerting.AT}' - INTERVAL {alerting.WEEK} SECONDS)""",
)
def active_alerts_stream(spark, sf_dir):
    """The board at a moment, from its changes alone: nothing is computed from ages afterwards."""
    return on_board(_board(spark, sf_dir), t.ntz(alerting.AT)).select("patient_id", "alert_id", "severity", "ts")


@query("first_messages_stream", f"SELECT * FROM ({t.POINTS_SQL}) ORDER BY ts, event_id LIMIT 250")
def first_messages_stream(spark, sf_dir):
    """The consumer stops after so many messages; most of the stream is never read."""
    stream = _arriving(t.points(spark, sf_dir), "first_points", late=False)
    first = consume_first(stream, scratch_path(spark, "first"), 250, ["ts", "event_id"])
    return first.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "monitoring_hook",
    f"""SELECT patient_id, event_id, risk_score, CASE WHEN risk_score >= 20 THEN 'look' ELSE 'leave' END AS advice
FROM ({_SCORED_STREAM_SQL}) WHERE patient_id NOT LIKE '%7'""",
)
def monitoring_hook(spark, sf_dir):
    """A caller's function on every scored micro-batch: it adds a column and leaves patients out, in all sinks."""
    advise = lambda scored: scored.filter("patient_id NOT LIKE '%7'").withColumn(
        "advice", F.when(F.col("risk_score") >= 20, "look").otherwise("leave"))
    root = _monitored(spark, _messages(event_stream(spark, sf_dir)), hook=advise)
    return spark.read.parquet(f"{root}/scored").select("patient_id", F.col("reading_id").alias("event_id"), "risk_score", "advice")
