"""The monitoring query: messages in; points, scores, risk updates, alerts, audit and metrics out.

A first query decodes every message once into a staged table, with the reason if it
cannot be scored; that table is also the quarantine. A second one reads it, cleans
(keyed state), scores and writes every micro-batch to one folder per sink and batch, so
that a repeated batch replaces its own output. A third one follows the alert folder and
applies the cooldown. Every message is accounted for: it is scored or has a reason.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.scoring import score_readings
from pulseframe.operators.alerts import build_alerts, route_alerts
from pulseframe.operators.folds import COOLDOWN_SECONDS
from pulseframe.operators.maintain import latest_risk
from pulseframe.schemas import VITALS
from pulseframe.sources.points import PARTITION, to_points
from pulseframe.sources.snapshots import Snapshots
from pulseframe.sources.tables import audit_alerts, audit_errors, audit_readings, audit_trail
from pulseframe.sources.topics import decode, rejection
from pulseframe.streaming.progress import FAILED, ProgressTable
from pulseframe.streaming.stateful import clean_readings_stream, cool_down_stream

# Fixed value: reason of a reading whose vitals are all implausible.
IMPLAUSIBLE = "no plausible vital"
_STAGED = (
    "patient_id STRING, timestamp STRING, ts TIMESTAMP, reading_id BIGINT, device_id STRING, "
    "vitals MAP<STRING, DOUBLE>, value STRING, reason STRING, accepted BOOLEAN"
)
_ALERTS = (
    "patient_id STRING, patient_name STRING, alert_type STRING, alert_reason STRING, risk_level STRING, "
    "risk_score DOUBLE, reading_id BIGINT, ts TIMESTAMP, batch_id BIGINT"
)


def staged_messages(messages: DataFrame, reading_id: Column, received: Column | None = None) -> DataFrame:
    """Every message decoded, with ``reason`` and ``accepted``.

    A message without a readable time takes the time of its arrival, ``received``
    (default: now). Only rejected messages keep their text.
    """
    received = F.current_timestamp() if received is None else received
    decoded = decode(messages.withColumns({"reading_id": reading_id.cast("bigint"), "received": received}))
    told = decoded.withColumn("reason", rejection(decoded))
    return told.observe("decoded", F.count_if(F.col("reason").isNotNull()).alias(FAILED)).select(
        "patient_id", "timestamp", F.coalesce("ts", "received").alias("ts"), "reading_id", "device_id", "vitals",
        F.when(F.col("reason").isNotNull(), F.col("value").cast("string")).alias("value"), "reason",
        F.col("reason").isNull().alias("accepted"),
    )


def score_batch(cleaned: DataFrame, mode: str = "parity") -> DataFrame:
    """Scored wide readings of a cleaned batch."""
    wide = cleaned.withColumns({v: F.try_element_at("vitals", F.lit(v)) for v in VITALS})
    return score_readings(wide.withColumn("timestamp", F.col("ts")), mode)


def _replace(df: DataFrame, root: str, sink: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{sink}/batch_id={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def with_names(alerts: DataFrame, people: Snapshots) -> DataFrame:
    """Alerts with the names that patients have now; unknown ones keep theirs. Reads only the parts with such patients."""
    known = people.read("patients", people.touched("patients", alerts))
    names = known.select(F.col("patient_id").cast("string").alias("patient_id"), F.col("full_name").alias("_name"))
    named = alerts.join(names, "patient_id", "left").withColumn("patient_name", F.coalesce("_name", "patient_name"))
    return named.select(*alerts.columns)


def write_batch(
    root: str, mode: str = "parity", hook: Callable[[DataFrame], DataFrame] | None = None, people: Snapshots | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function; ``hook`` may transform the scored readings before they are written.

    Alerts take the names that the table ``patients`` of ``people`` has when the batch runs.
    """

    def run(cleaned: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        spark = cleaned.sparkSession
        scored = score_batch(cleaned, mode)
        if hook is not None:
            scored = scored.transform(hook)
        scored = scored.persist()
        try:
            usable = F.size("vitals") > 0
            counts = scored.agg(
                F.max("ts").alias("timestamp"),
                F.count_if(usable).alias("messages_processed"),
                F.count_if(~usable).alias("messages_failed"),
            )
            summary = counts.first()
            if not summary["messages_processed"] + summary["messages_failed"]:
                return
            kept = scored.filter(usable).drop("reason")
            record = kept.drop("vitals")
            _replace(record, root, "scored", batch_id)
            unusable = scored.filter(~usable).select(
                "patient_id", "timestamp", "ts", "reading_id", F.coalesce("reason", F.lit(IMPLAUSIBLE)).alias("reason"))
            _replace(unusable, root, "unusable", batch_id)
            # A vital that is called like the score must not meet it in the map.
            others = F.map_filter("vitals", lambda k, _: k != "risk_score")
            with_risk = kept.withColumn("vitals", F.map_concat(others, F.create_map(F.lit("risk_score"), F.col("risk_score"))))
            points = to_points(with_risk, F.current_timestamp()).withColumns(
                {PARTITION: F.to_date("ts"), "batch_id": F.lit(batch_id).cast("bigint")})
            # Days first, so that a time range prunes folders; a day's batch has one file.
            points.repartition(PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy(PARTITION, "batch_id").parquet(f"{root}/points")
            _replace(latest_risk(kept, ["ts", "reading_id"]), root, "risk", batch_id)
            alerts = build_alerts(kept, keep=("reading_id", "ts"))
            if people is not None:
                alerts = with_names(alerts, people)
            # A stream follows this folder, so what is written once stays as it is.
            if not _exists(spark, f"{root}/alerts/batch_id={batch_id}/_SUCCESS"):
                _replace(alerts, root, "alerts", batch_id)
            trail = audit_trail(audit_readings(record), audit_alerts(alerts), audit_errors(unusable))
            _replace(trail, root, "audit", batch_id)
            elapsed = F.lit((time.monotonic() - started) * 1000.0)
            _replace(counts.withColumn("processing_time_ms", elapsed), root, "metrics", batch_id)
        finally:
            scored.unpersist()

    return run


def start_monitoring(
    messages: DataFrame,
    root: str,
    reading_id: Column,
    received: Column | None = None,
    idle_days: float | None = None,
    remember_days: float | None = None,
    hook: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
    watch: bool = True,
    people: Snapshots | None = None,
    tasks: int | None = None,
    **trigger,
):
    """Start decoding and scoring; returns both queries, decoding first.

    ``trigger`` goes to the writers, e.g. ``processingTime="10 seconds"``. With
    ``availableNow=True`` decoding ends before scoring starts. The source's rate limit
    bounds the first query's batches, ``files_per_batch`` the second one's. ``watch``
    writes the first query's progress reports to the consumer metrics table; the listener
    is the attribute ``progress`` of that query. ``people`` hold the patients' names.
    ``tasks`` deals the messages of a source with few partitions out before they are decoded,
    which is most of the first query's work.
    Messages delivered again
    within ``remember_days`` (None: ever) are known by their ``reading_id``.
    """
    spark, trigger = messages.sparkSession, trigger or {"processingTime": "10 seconds"}
    name, progress = f"decoding {uuid.uuid4().hex}", None
    if watch:
        progress = ProgressTable(spark, f"{root}/consumer_metrics", [name])
        spark.streams.addListener(progress)
    if tasks:
        messages = messages.repartition(tasks)
    decoding = (
        staged_messages(messages, reading_id, received).writeStream.queryName(name).format("parquet").outputMode("append")
        .partitionBy("accepted").option("path", f"{root}/staged")
        .option("checkpointLocation", f"{root}/_checkpoints/decoding").trigger(**trigger).start()
    )
    decoding.progress = progress
    if trigger.get("availableNow"):
        decoding.awaitTermination()
    staged = spark.readStream.schema(_STAGED).option("maxFilesPerTrigger", files_per_batch).parquet(f"{root}/staged")
    scoring = (
        clean_readings_stream(staged.filter("accepted"), idle_days, remember_days).writeStream.outputMode("append")
        .foreachBatch(write_batch(root, hook=hook, people=people))
        .option("checkpointLocation", f"{root}/_checkpoints/scoring").trigger(**trigger).start()
    )
    return decoding, scoring


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Messages that were not scored, with their reason."""
    rejected = spark.read.schema(_STAGED).parquet(f"{root}/staged").filter("NOT accepted")
    unusable = spark.read.parquet(f"{root}/unusable")
    return rejected.select("patient_id", "ts", "reading_id", "value", "reason").unionByName(
        unusable.select("patient_id", "ts", "reading_id", F.lit(None).cast("string").alias("value"), "reason"))


def accounting(spark: SparkSession, root: str) -> DataFrame:
    """(outcome, messages): ``received``, ``scored``, and each reason for not scoring."""
    received = spark.read.schema(_STAGED).parquet(f"{root}/staged").select(F.lit("received").alias("outcome"))
    scored = spark.read.parquet(f"{root}/scored").select(F.lit("scored").alias("outcome"))
    reasons = quarantine(spark, root).select(F.col("reason").alias("outcome"))
    return received.union(scored).union(reasons).groupBy("outcome").agg(F.count("*").alias("messages"))


def audit_log(spark: SparkSession, root: str) -> DataFrame:
    """The whole audit trail: readings, alerts and unusable readings of all batches, and rejected messages."""
    rejected = spark.read.schema(_STAGED).parquet(f"{root}/staged").filter("NOT accepted")
    errors = audit_errors(rejected.withColumn("timestamp", F.col("ts")), data="value")
    return spark.read.parquet(f"{root}/audit").drop("batch_id").unionByName(errors)


def alert_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the alert folder."""
    alerts = spark.readStream.schema(_ALERTS).option("maxFilesPerTrigger", files_per_batch).parquet(f"{root}/alerts")
    return alerts.select(
        "patient_id", "alert_type", "ts", F.col("reading_id").alias("alert_id"),
        F.to_json(F.struct("patient_name", "alert_reason", "risk_level", "risk_score")).alias("body"),
    )


def dispatched(marked: DataFrame) -> DataFrame:
    """Channel rows of the alerts that passed the cooldown."""
    sent = marked.filter("passed").withColumn("risk_level", F.get_json_object("body", "$.risk_level"))
    return route_alerts(sent)


def start_dispatch(spark: SparkSession, root: str, seconds: float = COOLDOWN_SECONDS, **trigger):
    """Cool the alert folder down and append the channel rows."""
    trigger = trigger or {"processingTime": "10 seconds"}
    rows = dispatched(cool_down_stream(alert_stream(spark, root), seconds))
    return (
        rows.writeStream.format("parquet").outputMode("append").option("path", f"{root}/dispatched")
        .option("checkpointLocation", f"{root}/_checkpoints/dispatch").trigger(**trigger).start()
    )



def first_messages_sink(path: str, n: int, order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that keeps the first ``n`` messages of a stream, each batch's by ``order``.

    How many came before is read from the earlier batches' folders, so a batch that is
    repeated after a restart gives the same again. When ``full`` is set the query may stop.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = 0
        if _exists(spark, path):
            # The batch itself, if it is repeated, does not count.
            before = spark.read.parquet(path).filter(F.col("batch_id") < batch_id).count()
        if before < n:
            batch.orderBy(*order).limit(n - before).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            before += spark.read.parquet(f"{path}/batch_id={batch_id}").count()
        run.full = before >= n

    run.full = False
    return run


def consume_first(messages: DataFrame, path: str, n: int, order: Sequence[str], **trigger) -> DataFrame:
    """The first ``n`` messages of a stream; the query is stopped as soon as they are there, whatever else there is.

    The source's rate limit bounds what a batch reads beyond them. ``n`` is meant to be small.
    """
    sink = first_messages_sink(f"{path}/first", n, order)
    query = (
        messages.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**(trigger or {"processingTime": "1 second"})).start()
    )
    while query.isActive and not sink.full:
        query.awaitTermination(0.2)
    query.stop()
    if query.exception() is not None and not sink.full:
        raise query.exception()
    return messages.sparkSession.read.parquet(f"{path}/first").select(*messages.columns)
