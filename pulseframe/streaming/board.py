"""The live alert board: alerts that are shown, acknowledged and taken off while they stream in.

One stateful operator turns alerts and acknowledgements into changes. An acknowledgement
ends all alerts of its patient up to its time; an alert that is not critical also leaves
the board when it has been on display long enough, by an event-time timer. What arrives
late, within the delay of the watermark, has the effect that it would have had in time: a
late alert takes the earliest acknowledgement after it, a late acknowledgement moves the
end of an alert forward. Later rows are dropped by the watermark.
"""

from __future__ import annotations

from bisect import insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.alerts import DISPLAY_SECONDS
from pulseframe.streaming.stateful import BUCKETS, BucketProcessor, Entries, bucket_of, require_rocksdb

# Fixed value: the level that stays on the board until someone acknowledges it.
STAYS = "CRITICAL"
SHOWN, ACKNOWLEDGED, EXPIRED = "shown", "acknowledged", "expired"
#: Changes by timers that are handed on at once.
CHANGES = 10_000


class _Ward:
    """A patient's alerts that can still change, and the acknowledgements that late alerts can still meet."""

    schema = (
        "ids ARRAY<BIGINT>, shown ARRAY<BIGINT>, ends ARRAY<BIGINT>, expiries ARRAY<BIGINT>, "
        "ack_us ARRAY<BIGINT>, ack_by ARRAY<STRING>"
    )

    def __init__(self, stored=None) -> None:
        ids, shown, ends, expiries, ack_us, ack_by = stored or ([],) * 6
        #: id -> [shown, acknowledged or None, time of the expiry still to come or None]
        self.alerts = {i: [s, None if e < 0 else e, None if x < 0 else x] for i, s, e, x in zip(ids, shown, ends, expiries)}
        self.acks = list(zip(ack_us, ack_by))

    def stored(self):
        rows = list(self.alerts.values())
        return (list(self.alerts), [r[0] for r in rows], [-1 if r[1] is None else r[1] for r in rows],
                [-1 if r[2] is None else r[2] for r in rows], [a for a, _ in self.acks], [b for _, b in self.acks])

    def forget(self, watermark: int, keep_us: int | None) -> None:
        """Drop what no row can change any more."""
        self.acks = [a for a in self.acks if a[0] > watermark]
        for i, (shown, end, expiry) in list(self.alerts.items()):
            done = end is not None and end <= watermark and (expiry is None or end <= expiry)
            if done or (keep_us is not None and expiry is None and shown + keep_us <= watermark):
                del self.alerts[i]


class BoardProcessor(BucketProcessor):
    """Changes (what, at) of the alerts of a bucket of patients.

    State is an entry per patient, and an entry per tick of the timers with the alerts that
    may expire in it, so that a timer finds its alerts without a search.
    """

    output_schema = (
        "patient_id STRING, alert_id BIGINT, shown_us BIGINT, what STRING, at_us BIGINT, acknowledged_by STRING, "
        "severity STRING, body STRING"
    )
    order = ["ts_us", "side", "alert_id"]

    def __init__(self, display_seconds: int, keep_seconds: float | None, tick_seconds: float):
        self.display_us, self.tick_us = int(display_seconds * 1_000_000), max(1000, int(tick_seconds * 1_000_000))
        self.keep_us = None if keep_seconds is None else int(keep_seconds * 1_000_000)

    def init(self, handle) -> None:
        self.handle = handle
        self.wards = handle.getMapState("wards", "patient_id STRING", _Ward.schema)
        self.due = handle.getMapState("due", "tick BIGINT", "patients ARRAY<STRING>, ids ARRAY<BIGINT>")
        #: The watermark whose timers are being handled, and the (bucket, time) of those that are done.
        self.handled = None, set()

    def _store(self, wards: dict[str, _Ward], watermark: int) -> None:
        for patient, ward in wards.items():
            ward.forget(watermark, self.keep_us)
            if ward.alerts or ward.acks:
                self.wards.updateValue((patient,), ward.stored())
            else:
                self.wards.removeKey((patient,))

    def _made(self, out: list[tuple]) -> pd.DataFrame:
        columns = ["patient_id", "alert_id", "shown_us", "what", "at_us", "acknowledged_by", "severity", "body"]
        return pd.DataFrame(out, columns=columns)

    def walk(self, rows, timerValues):
        wards: dict[str, _Ward] = {}
        due: dict[int, list[tuple[str, int]]] = {}
        out: list[tuple] = []
        stored, ticks = Entries(self.wards), Entries(self.due)
        columns = ("patient_id", "ts_us", "side", "alert_id", "acknowledged_by", "severity", "body")
        for patient, ts, side, alert_id, by, severity, body in zip(*(rows[c] for c in columns)):
            if patient not in wards:
                wards[patient] = _Ward(stored.get((patient,)))
            ward = wards[patient]
            if side:
                insort(ward.acks, (ts, by), key=lambda a: a[0])
                for i, alert in ward.alerts.items():
                    if alert[0] <= ts and (alert[1] is None or ts < alert[1]):
                        alert[1] = ts
                        out.append((patient, i, alert[0], ACKNOWLEDGED, ts, by, None, None))
                continue
            alert_id = int(alert_id)
            if alert_id in ward.alerts:
                continue  # delivered again
            out.append((patient, alert_id, ts, SHOWN, ts, None, severity, body))
            end = next((a for a in ward.acks if a[0] >= ts), None)
            if end is not None:
                out.append((patient, alert_id, ts, ACKNOWLEDGED, *end, None, None))
            expiry = None if severity == STAYS else ts + self.display_us
            ward.alerts[alert_id] = [ts, None if end is None else end[0], expiry]
            if expiry is not None:
                due.setdefault(-(-expiry // self.tick_us), []).append((patient, alert_id))
        for tick, more in due.items():
            known = ticks.get((tick,))
            patients, ids = ([], []) if known is None else map(list, known)
            if known is None:
                self.handle.registerTimer(tick * self.tick_us // 1000)
            self.due.updateValue((tick,), (patients + [p for p, _ in more], ids + [i for _, i in more]))
        self._store(wards, timerValues.getCurrentWatermarkInMs() * 1000)
        return self._made(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        if self.handled[0] != watermark:
            self.handled = watermark, set()
        handled = self.handled[1]
        if (key, at) in handled:
            return
        # All timers before the watermark fire in this batch, so the first of them handles the others' alerts too:
        # a patient is read and written once, and changes do not come out timer by timer.
        fires = lambda us: -(-us // self.tick_us) * self.tick_us // 1000
        ticks = [(tick, patients) for (tick,), (patients, _) in self.due.iterator()
                 if tick * self.tick_us // 1000 == at or at < watermark and tick * self.tick_us // 1000 < watermark]
        stored, out = Entries(self.wards), []
        for patient in dict.fromkeys(p for _, patients in ticks for p in patients):
            ward = _Ward(stored.get((patient,)))
            for alert_id, alert in ward.alerts.items():
                shown, end, expiry = alert
                if expiry is None or not (fires(expiry) == at or at < watermark and fires(expiry) < watermark):
                    continue
                alert[2] = None
                if end is None or end > expiry:
                    out.append((patient, alert_id, shown, EXPIRED, expiry, None, None, None))
            self._store({patient: ward}, watermark * 1000)
            if len(out) >= CHANGES:
                yield self._made(out)
                out = []
        for tick, _ in ticks:
            self.due.removeKey((tick,))
            handled.add((key, tick * self.tick_us // 1000))
        if out:
            yield self._made(out)


def board_changes(
    alerts: DataFrame,
    acks: DataFrame,
    delay: str = "10 minutes",
    display_seconds: int = DISPLAY_SECONDS,
    keep_seconds: float | None = None,
    tick_seconds: float = 1.0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Stream of changes (patient_id, alert_id, ts, what, at, acknowledged_by, severity, body).

    ``alerts`` hold patient_id, alert_id, ts, severity and body STRING, ``acks`` patient_id,
    ts and acknowledged_by. ``what`` is shown, acknowledged or expired; when an earlier
    acknowledgement arrives late, a second change with the earlier time follows. Timers
    fire once the watermark passes, in steps of ``tick_seconds``. Alerts nobody
    acknowledges stay in state for ``keep_seconds`` after they were shown (None: for good).
    """
    require_rocksdb(alerts.sparkSession)
    none = F.lit(None).cast("string")
    rows = alerts.select(
        F.col("patient_id").cast("string").alias("patient_id"), "ts", F.lit(0).alias("side"),
        F.col("alert_id").cast("bigint").alias("alert_id"), none.alias("acknowledged_by"), "severity",
        F.col("body").cast("string").alias("body"),
    ).union(acks.select(
        F.col("patient_id").cast("string"), "ts", F.lit(1), F.lit(-1).cast("bigint"), "acknowledged_by", none, none))
    timed = rows.withWatermark("ts", delay).withColumns(
        {"ts_us": F.unix_micros("ts"), "bucket": bucket_of("patient_id", buckets=buckets)})
    changes = timed.groupBy("bucket").transformWithStateInPandas(
        BoardProcessor(display_seconds, keep_seconds, tick_seconds), BoardProcessor.output_schema, "Append", "EventTime")
    return changes.select(
        "patient_id", "alert_id", F.timestamp_micros("shown_us").alias("ts"), "what",
        F.timestamp_micros("at_us").alias("at"), "acknowledged_by", "severity", "body")


def board_alerts(changes: DataFrame) -> DataFrame:
    """One row per alert of a table of changes: its columns, its first acknowledgement, and when it expired."""
    of = lambda what, value: F.when(F.col("what") == what, value)
    first = F.min(of(ACKNOWLEDGED, F.struct("at", "acknowledged_by")))
    made = changes.groupBy("patient_id", "alert_id").agg(
        F.min("ts").alias("ts"), F.max("severity").alias("severity"), F.max("body").alias("body"),
        first.alias("_first"), F.min(of(EXPIRED, F.col("at"))).alias("expired_at"))
    return made.select(
        "patient_id", "alert_id", "ts", "severity", "body", F.col("_first").isNotNull().alias("acknowledged"),
        F.col("_first.at").alias("acknowledged_at"), F.col("_first.acknowledged_by").alias("acknowledged_by"), "expired_at")


def on_board(alerts: DataFrame, at: Column) -> DataFrame:
    """Alerts of ``board_alerts`` that were on the board at ``at``, a time that the watermark has passed."""
    ended = F.least("acknowledged_at", "expired_at")
    return alerts.filter((F.col("ts") <= at) & (ended.isNull() | (ended > at)))
