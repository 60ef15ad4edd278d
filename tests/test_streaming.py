"""Streams give what the batch operators give, across batches and restarts."""

import json
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseframe.operators.folds import clean_points, clean_readings, cool_down
from pulseframe.operators.rolling import rolling_times
from pulseframe.plans.streams import _arriving
from pulseframe.sources.topics import decode
from pulseframe.streaming.monitor import (
    accounting, audit_log, quarantine, score_batch, start_dispatch, start_monitoring, write_batch)
from pulseframe.streaming.progress import consumer_metrics
from pulseframe.streaming.rolling import rolling_times_stream
from pulseframe.streaming.stateful import Seen, clean_readings_stream, cool_down_stream


def reading_rows(n=300, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vitals = {"heart_rate": rng.choice([70.0, 90.0, 130.0, 250.0]), "spo2": rng.uniform(45, 100)}
        if rng.random() < 0.3:
            vitals.pop("spo2")
        rows.append((f"p{rng.randrange(5)}", 1000 + i // 3, i, vitals))
    return rows


SCHEMA = "patient_id STRING, sec BIGINT, reading_id BIGINT, vitals MAP<STRING, DOUBLE>"


def write_files(spark, path, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, **options):
    stream = spark.readStream.schema(SCHEMA).options(**options).parquet(path)
    return stream.withColumn("ts", F.timestamp_seconds("sec"))


def run(stream, path):
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def batch_cleaned(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).select(
        "patient_id", F.timestamp_seconds("sec").alias("ts"), F.col("reading_id").alias("event_id"), F.explode("vitals").alias("field", "value")
    )
    return {(r["event_id"], r["field"]): r["cleaned"] for r in clean_points(df).collect()}


def test_cleanup_over_restarts_equals_batch(spark, tmp_path):
    rows = reading_rows()
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    write_files(spark, source, [rows[:100]])
    run(clean_readings_stream(stream_of(spark, source)), sink)
    # Shuffled inside the file: the order of rows within a batch must not matter.
    rest = rows[100:]
    random.Random(1).shuffle(rest)
    write_files(spark, source, [rest])
    run(clean_readings_stream(stream_of(spark, source)), sink)
    out = spark.read.parquet(f"{sink}/out").collect()
    assert sorted(r["reading_id"] for r in out) == list(range(len(rows)))
    got = {(r["reading_id"], f): v for r in out for f, v in r["vitals"].items()}
    assert got == batch_cleaned(spark, rows)


def test_late_and_repeated_rows_in_order_of_arrival(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    one = ("p", 2000, 1, {"heart_rate": 75.0})
    write_files(spark, source, [[("p", 1000, 0, {"heart_rate": 70.0}), one, one]])
    run(clean_readings_stream(stream_of(spark, source)), sink)
    write_files(spark, source, [[one]])
    run(clean_readings_stream(stream_of(spark, source)), sink)
    write_files(spark, source, [[("p", 500, 2, {"heart_rate": 190.0}), ("p", 3000, 3, {"heart_rate": 80.0})]])
    run(clean_readings_stream(stream_of(spark, source)), sink)
    out = spark.read.parquet(f"{sink}/out").collect()
    got = {r["reading_id"]: r["vitals"]["heart_rate"] for r in out if r["reason"] is None}
    assert got == pytest.approx({0: 70.0, 1: 75.0, 2: 75 * 0.7 + 190 * 0.3, 3: 109.5 * 0.7 + 80 * 0.3})
    assert [(r["reading_id"], r["vitals"], r["reason"]) for r in out if r["reason"]] == [(1, {}, "duplicate message")] * 2


def test_ranges_delivered_again_change_nothing(spark, tmp_path):
    """After restarts, in any order, with ids far apart and a patient's ids not in order of time: stream = batch."""
    rows = [(p, sec, i * 977 if i % 2 else 500_000 - i, vitals) for p, sec, i, vitals in reading_rows(240, 5)]
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    for part in (rows[:150], rows[40:160][::-1], rows[160:] + rows[:5], rows):
        write_files(spark, source, [part])
        run(clean_readings_stream(stream_of(spark, source), buckets=3), sink)
    out = spark.read.parquet(f"{sink}/out").collect()
    assert len([r for r in out if r["reason"] == "duplicate message"]) == len(out) - len(rows) == 110 + 5 + 240
    batch = spark.createDataFrame(rows + rows[40:160] + rows, SCHEMA).withColumn("ts", F.timestamp_seconds("sec"))
    want = {(r["patient_id"], r["reading_id"]): r["vitals"] for r in clean_readings(batch).collect()}
    assert {(r["patient_id"], r["reading_id"]): r["vitals"] for r in out if r["vitals"]} == want


def test_ids_are_forgotten_and_missing_ones_never_repeat(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for _ in range(2):
            write_files(spark, source, [[("p", 0, 3, {"heart_rate": 70.0}), ("p", 1, None, {"spo2": 90.0})]])
            run(clean_readings_stream(stream_of(spark, source), remember_days=1e-6), sink)
            time.sleep(0.5)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    out = spark.read.parquet(f"{sink}/out").collect()
    assert sorted(str(r["reading_id"]) for r in out if r["reason"] is None) == ["3", "3", "None", "None"]


def test_idle_patients_lose_their_state(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for step in ([("p", 0, 0, {"heart_rate": 70.0})], [("p", 7, 3, {"heart_rate": 170.0})]):
            write_files(spark, source, [step])
            run(clean_readings_stream(stream_of(spark, source), idle_days=1e-6), sink)
            time.sleep(0.5)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    out = {r["reading_id"]: r["vitals"]["heart_rate"] for r in spark.read.parquet(f"{sink}/out").collect()}
    assert out[3] == 170.0


def test_cooldown_equals_batch(spark, tmp_path):
    rng = random.Random(8)
    rows = [(f"p{rng.randrange(3)}", rng.choice(["a", "b"]), rng.randrange(5000), i, "x") for i in range(400)]
    rows.sort(key=lambda r: (r[2], r[3]))
    schema = "patient_id STRING, alert_type STRING, sec BIGINT, alert_id BIGINT, body STRING"
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    for part in (rows[:200], rows[200:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.timestamp_seconds("sec"))
        run(cool_down_stream(stream), sink)
    got = {r["alert_id"]: r["passed"] for r in spark.read.parquet(f"{sink}/out").collect()}
    frame = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("sec")).withColumnRenamed("alert_id", "event_id")
    assert got == {r["event_id"]: r["passed"] for r in cool_down(frame).collect()}


def test_rolling_times_over_restarts_equal_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"c{min(rng.randrange(9), 3)}", i // 3, i, rng.choice([None, 1.0, rng.uniform(0, 50)])) for i in range(300)]
    schema = "consumer STRING, sec BIGINT, event_id BIGINT, processing_time_ms DOUBLE"
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    for part in (rows[:7], rows[7:200], rows[200:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.timestamp_seconds("sec"))
        run(rolling_times_stream(stream, rows=20, buckets=2), sink)
    got = {r["event_id"]: (r["avg_ms"], r["min_ms"], r["max_ms"]) for r in spark.read.parquet(f"{sink}/out").collect()}
    frame = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("sec")).filter("processing_time_ms IS NOT NULL")
    want = {r["event_id"]: (r["avg_ms"], r["min_ms"], r["max_ms"]) for r in rolling_times(frame, rows=20).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.fixture(scope="module")
def monitored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("monitor")
    rng = random.Random(6)
    messages = []
    for i in range(120):
        vitals = {"heart_rate": rng.choice([45, 80, 150]), "spo2": rng.choice(["97", 84, 91]), "blood_pressure": "110/70"}
        at = f"2024-03-01T{10 + i // 60}:{i % 60:02d}:00Z"
        messages.append(json.dumps({"patient_id": f"ICU-00000{i % 4}", "timestamp": at, "vital_signs": vitals}))
    messages += ["{oops", json.dumps({"patient_id": "ICU-000001", "timestamp": "2024-03-01T10:00:00Z", "vital_signs": {}})]
    # Without a time, with a vital called like the score, with nothing plausible, and one message twice.
    messages.append(json.dumps({"patient_id": "late-1", "vital_signs": {"heart_rate": 80, "risk_score": 2}}))
    messages.append(json.dumps({"patient_id": "late-2", "timestamp": "yesterday", "vital_signs": {"heart_rate": 999}}))
    rows = [*enumerate(messages), (5, messages[5])]
    spark.createDataFrame(rows, "offset BIGINT, value STRING").write.parquet(str(root / "in"))
    stream = spark.readStream.schema("offset BIGINT, value STRING").parquet(str(root / "in"))
    arrived = F.lit("2024-03-02 00:00:00").cast("timestamp")
    started = start_monitoring(stream, str(root / "out"), F.col("offset"), arrived, availableNow=True)
    for q in started:
        q.awaitTermination()
    return str(root / "out"), rows, started[0].progress, started[0].runId


def test_monitoring_sinks_agree(spark, monitored):
    root, rows, *_ = monitored
    scored = spark.read.parquet(f"{root}/scored")
    assert sorted(r["reading_id"] for r in scored.collect()) == [*range(120), 122]
    points = spark.read.parquet(f"{root}/points")
    by_field = {r["field"]: r["count"] for r in points.groupBy("field").count().collect()}
    assert by_field["risk_score"] == by_field["heart_rate"] == by_field["blood_pressure_systolic"] + 1 == 121
    assert points.filter("risk_level IS NULL").count() == 0
    assert {str(r["ts"]) for r in points.filter("patient_id = 'late-1'").collect()} == {"2024-03-02 00:00:00"}
    alerts = spark.read.parquet(f"{root}/alerts")
    assert alerts.count() == scored.filter("risk_level IN ('MODERATE', 'HIGH', 'CRITICAL')").count()
    reasons = {r["reason"]: r["count"] for r in quarantine(spark, root).groupBy("reason").count().collect()}
    assert reasons == {"malformed message": 1, "no usable vital": 1, "no plausible vital": 1, "duplicate message": 1}
    counts = {r["outcome"]: r["messages"] for r in accounting(spark, root).collect()}
    assert counts == {"received": len(rows), "scored": 121, **reasons}
    audit = {r["event_type"]: r["count"] for r in audit_log(spark, root).groupBy("event_type").count().collect()}
    assert audit == {"reading": 121, "alert": alerts.count(), "error": 4}
    metrics = spark.read.parquet(f"{root}/metrics").agg(F.sum("messages_processed"), F.sum("messages_failed")).first()
    assert tuple(metrics) == (121, 2)


def test_progress_reaches_the_metrics_table(spark, monitored):
    root, rows, progress, run_id = monitored
    assert progress.wait(run_id)
    table = consumer_metrics(spark, f"{root}/consumer_metrics").agg(F.sum("messages_processed"), F.sum("messages_failed")).first()
    assert tuple(table) == (len(rows), 2)


def test_monitoring_matches_batch(spark, monitored):
    root, rows, *_ = monitored
    decoded = decode(spark.createDataFrame(rows, "event_id BIGINT, value STRING")).filter("event_id < 120")
    assert decoded.count() == 121  # one came twice
    cleaned = clean_readings(decoded.withColumnRenamed("event_id", "reading_id"))
    expected = {r["reading_id"]: (r["mews_score"], r["risk_score"], r["risk_level"]) for r in score_batch(cleaned).collect()}
    got = {r["reading_id"]: (r["mews_score"], r["risk_score"], r["risk_level"]) for r in spark.read.parquet(f"{root}/scored").filter("reading_id < 120").collect()}
    assert got == expected


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    df = spark.createDataFrame([("p", 10, 1, {"heart_rate": 150.0}), ("p", 20, 2, {})], SCHEMA).withColumn("ts", F.timestamp_seconds("sec")).drop("sec")
    df = df.withColumn("reason", F.lit(None).cast("string"))
    write = write_batch(str(tmp_path), hook=lambda scored: scored.withColumn("ward", F.lit("A")))
    for _ in range(2):
        write(df, 7)
    assert spark.read.parquet(f"{tmp_path}/scored").select("reading_id", "ward", "batch_id").collect() == [(1, "A", 7)]
    assert spark.read.parquet(f"{tmp_path}/risk").count() == 1


def test_dispatch(spark, monitored):
    root = monitored[0]
    query = start_dispatch(spark, root, seconds=600, availableNow=True)
    query.awaitTermination()
    sent = spark.read.parquet(f"{root}/dispatched")
    per_alert = {r["alert_id"]: {x["channel"] for x in sent.filter(F.col("alert_id") == r["alert_id"]).collect()} for r in sent.select("alert_id").distinct().limit(3).collect()}
    assert per_alert and all("dashboard" in v for v in per_alert.values())


def test_progress_rows():
    from pulseframe.streaming.progress import consumer_rows

    progress = {
        "timestamp": "2024-03-01T10:00:00.000Z", "numInputRows": 30, "durationMs": {"triggerExecution": 1500},
        "sources": [{"endOffset": '{"vitals": {"0": 100, "1": 40}}', "latestOffset": '{"vitals": {"0": 110, "1": 40}}'}],
        "observedMetrics": {"decoded": {"messages_failed": 4}},
    }
    assert {r["messages_failed"] for r in consumer_rows(progress)} == {4}
    rows = {r["partition"]: r for r in consumer_rows(progress)}
    assert rows[0]["offset"] == 100 and rows[0]["lag"] == 10 and rows[1]["lag"] == 0
    assert rows[0]["messages_processed"] == 30 and rows[0]["processing_time_ms"] == 1500.0
    files = dict(progress, sources=[{"endOffset": {"logOffset": 3}, "latestOffset": None}])
    assert [(r["partition"], r["offset"]) for r in consumer_rows(files)] == [(None, None)]


class Counted:
    """A map state that counts the calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def exists(self):
        return bool(self.held)

    def containsKey(self, key):
        self.calls += 1
        return key in self.held

    def getValue(self, key):
        self.calls += 1
        return self.held[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


def test_ids_of_many_patients_share_entries():
    state = Counted()
    for repeated in (False, True):
        seen = Seen(state)
        assert [seen.add(f"p{i % 500}", i) for i in range(2_000)] == [not repeated] * 2_000
        seen.store()
    assert state.calls <= 4
    seen = Seen(state)
    assert seen.add("p1", 0) and not seen.add("p0", 0) and seen.add(None, 0) and not seen.add(None, 0)
    seen.store()
    seen = Seen(state)
    assert not any(seen.add(p, i) for p, i in (("p1", 0), (None, 0), ("p499", 1_999)))


def test_messages_of_one_file_are_decoded_by_several_tasks(spark, tmp_path):
    text = '{"patient_id": "p%d", "timestamp": "2024-01-01T00:00:00Z", "vital_signs": {"heart_rate": 80}}'
    rows = [(i, text % i) for i in range(200)]
    spark.createDataFrame(rows, "id BIGINT, value STRING").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id BIGINT, value STRING").parquet(str(tmp_path / "in"))
    for running in start_monitoring(stream, str(tmp_path / "out"), F.col("id"), watch=False, tasks=4, availableNow=True):
        running.awaitTermination()
    assert len(spark.read.parquet(str(tmp_path / "out/staged")).inputFiles()) == 4
    assert {r["outcome"]: r["messages"] for r in accounting(spark, str(tmp_path / "out")).collect()} == {"received": 200, "scored": 200}


def test_arrivals_are_written_by_all_tasks_and_stay_micro_batches(spark, tmp_path):
    """Also where ten days have one row or none: each is a batch of its own."""
    rows = [(i, f"2024-01-0{1 + i % 9} 00:00:00") for i in range(400)] + [(500, "2024-01-25 00:00:00"), (501, None)]
    table = spark.createDataFrame(rows, "id BIGINT, ts STRING").withColumn("ts", F.col("ts").cast("timestamp"))
    batches = []
    _arriving(table, "few", late=False).writeStream.foreachBatch(
        lambda batch, _: batches.append((sorted(r["id"] for r in batch.collect()), batch.select(F.input_file_name()).distinct().count()))
    ).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [b for b, _ in batches] == [list(range(400)), [], [500], [501]]
    assert batches[0][1] > 1


def test_rolling_times_are_handed_on_in_pieces():
    from pulseframe.streaming import rolling

    n = 2 * rolling.CHUNK + 5
    processor = rolling.RollingProcessor(3)
    processor.ring = Counted()
    frame = pd.DataFrame({"consumer": "c", "ts_us": range(n), "event_id": range(n), "processing_time_ms": np.arange(n, dtype=float)})
    made = list(processor.handleInputRows((0,), iter([frame[::-1]]), None))
    assert max(map(len, made)) <= rolling.CHUNK
    whole = pd.concat(made)
    assert whole["event_id"].tolist() == list(range(n))
    assert whole["avg_ms"].tolist() == [0.0, 0.5] + [float(i - 1) for i in range(2, n)]
    assert whole["min_ms"].tolist() == [0.0, 0.0] + [float(i - 2) for i in range(2, n)] and processor.ring.held[("c",)] == ([n - 3.0, n - 2.0, n - 1.0],)
