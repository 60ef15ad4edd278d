"""The alert board: order of arrival, timers, late rows, restarts."""

import random

from pyspark.sql import functions as F

from pulseframe.operators.alerts import acknowledge, active_at
from pulseframe.streaming.board import BoardProcessor, board_alerts, board_changes, on_board

SCHEMA = "patient_id STRING, sec BIGINT, alert_id BIGINT, severity STRING, acknowledged_by STRING"


def changes(spark, path, parts, **options):
    """Each part is a micro-batch of a restarted query."""
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in").withColumn("ts", F.timestamp_seconds("sec"))
        alerts = stream.filter("alert_id IS NOT NULL").withColumn("body", F.lit("b"))
        made = board_changes(alerts, stream.filter("alert_id IS NULL"), buckets=4, **options)
        made.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out").option(
            "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


def listed(df):
    rows = df.select("alert_id", "what", F.unix_seconds("at").alias("at"), "acknowledged_by").collect()
    return sorted(map(tuple, rows), key=str)


def test_expiry_acknowledgement_and_late_rows(spark, tmp_path):
    parts = [
        [("p", 100, 1, "HIGH", None), ("p", 110, 2, "CRITICAL", None), ("q", 100, 3, "HIGH", None), ("q", 100, 3, "HIGH", None)],
        [("p", 150, None, None, "late"), ("z", 200, 9, "CRITICAL", None)],
        # An earlier acknowledgement arrives later, and so does an alert that the later one already ended.
        [("p", 120, None, None, "early"), ("p", 130, 4, "HIGH", None)],
        [("z", 900, 10, "CRITICAL", None)],
        # Beyond the delay: the watermark drops it.
        [("p", 90, 5, "HIGH", None)],
    ]
    got = changes(spark, str(tmp_path), parts, delay="100 seconds", display_seconds=60)
    assert listed(got) == sorted([
        (1, "shown", 100, None), (2, "shown", 110, None), (3, "shown", 100, None), (9, "shown", 200, None), (4, "shown", 130, None),
        (1, "acknowledged", 150, "late"), (2, "acknowledged", 150, "late"), (1, "acknowledged", 120, "early"),
        (2, "acknowledged", 120, "early"), (4, "acknowledged", 150, "late"), (3, "expired", 160, None), (10, "shown", 900, None),
    ], key=str)
    board = on_board(board_alerts(got), F.timestamp_seconds(F.lit(155)))
    assert sorted(r["alert_id"] for r in board.collect()) == [3]


def test_stream_equals_batch_in_any_order_within_the_delay(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"p{rng.randrange(6)}", rng.randrange(4000), i, rng.choice(["CRITICAL", "HIGH"]), None) for i in range(300)]
    rows += [(f"p{rng.randrange(6)}", rng.randrange(4000), None, None, f"n{i}") for i in range(60)]
    # Some rows of the end of each part come with the next one, within the delay.
    late = {i for i, r in enumerate(rows) if r[1] % 1000 > 700 and r[1] < 3000 and rng.random() < 0.5}
    parts = [[r for i, r in enumerate(rows) if r[1] // 1000 + (i in late) == p] for p in range(4)]
    assert late and sum(map(len, parts)) == len(rows)
    got = board_alerts(changes(spark, str(tmp_path), [*parts, [("x", 9000, 999, "CRITICAL", None)]], delay="400 seconds", display_seconds=60))
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("sec")).drop("sec")
    batch = acknowledge(frame.filter("alert_id IS NOT NULL").drop("acknowledged_by"),
                        frame.filter("alert_id IS NULL").select("patient_id", "ts", "acknowledged_by"))
    key = lambda df: {r["alert_id"]: (r["patient_id"], r["ts"], r["acknowledged_at"]) for r in df.collect() if r["alert_id"] != 999}
    assert key(got) == key(batch)
    for at in (700, 1500, 3900):
        at = F.timestamp_seconds(F.lit(at))
        want = {r["alert_id"] for r in active_at(batch, at, 60).collect()}
        assert {r["alert_id"] for r in on_board(got, at).collect()} == want


def test_old_alerts_leave_the_state(spark, tmp_path):
    parts = [[("p", 100, 1, "HIGH", None)], [("z", 5000, 9, "CRITICAL", None)], [("p", 5001, None, None, "n")], [("z", 9000, 8, "CRITICAL", None)]]
    got = changes(spark, str(tmp_path), parts, delay="100 seconds", display_seconds=60, keep_seconds=1000)
    assert (1, "expired", 160, None) in listed(got) and not [r for r in listed(got) if r[1] == "acknowledged"]


class Held(dict):
    """A map state."""

    def exists(self):
        return bool(self)

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)

    def iterator(self):
        return iter(list(self.items()))


class Timers:
    """Timers of a bucket, a watermark, or a timer that fires, in milliseconds."""

    def __init__(self, ms=0):
        self.ms, self.set = ms, []

    def registerTimer(self, ms):
        self.set.append(ms)

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_timers_of_a_batch_are_handled_together():
    """Two buckets in turn, timer by timer: the first timer of each hands on all changes up to the watermark."""
    makers = {}
    for key in ((0,), (1,)):
        made = BoardProcessor(60, None, 1.0)
        made.handle, made.wards, made.due = Timers(), Held(), Held()
        n = 50
        made.walk({"patient_id": [f"p{i % 5}" for i in range(n)], "ts_us": [i * 1_000_000 for i in range(n)], "side": [0] * n,
                   "alert_id": list(range(n)), "acknowledged_by": [None] * n, "severity": ["HIGH"] * n, "body": ["b"] * n}, Timers(0))
        makers[key] = made
    processor = BoardProcessor(60, None, 1.0)
    out, frames, watermark = {(0,): [], (1,): []}, 0, Timers(80_000)
    for at in (ms for ms in makers[(0,)].handle.set if ms <= 80_000):
        for key, made in makers.items():
            processor.wards, processor.due = made.wards, made.due
            if not hasattr(processor, "handled"):
                processor.init(type("Handle", (), {"getMapState": lambda *_: None})())
                processor.wards, processor.due = made.wards, made.due
            for frame in processor.handleExpiredTimer(key, watermark, Timers(at)):
                out[key] += list(zip(frame["alert_id"], frame["at_us"]))
                frames += 1
    # Alert i expires at second i + 60; the timer of the watermark itself comes by itself.
    assert {k: sorted(v) for k, v in out.items()} == {k: [(i, (i + 60) * 1_000_000) for i in range(21)] for k in out}
    assert frames == 4
    assert all(sorted(t for t, in made.due) == list(range(81, 110)) for made in makers.values())
