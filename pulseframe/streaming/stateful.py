"""Cleanup and cooldown as stateful streaming operators.

Rows are handled in the order of their arrival: those of one micro-batch by (time, id),
and micro-batches one after another, with the same step functions as the batch folds.
So nothing is buffered, nothing waits for a watermark, and late rows are not lost: they
are compared with the state as it is when they come.

Patients are dealt to buckets by hash, and a bucket is the key of the state operator: one
call handles all patients of a bucket in a micro-batch, each patient's state being an
entry of a map state. So many patients with few rows each do not cost a call each, and
only the entries of patients that appear are read and written. A task holds the rows of
one bucket and one micro-batch, which the source's rate limit bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from pulseframe.operators.folds import COOLDOWN_SECONDS, Cleanup, Cooldown
from pulseframe.session import ROCKSDB_PROVIDER, STATE_PROVIDER_KEY

# Fixed value: reason of a reading that came twice.
DUPLICATE = "duplicate message"
#: Buckets of keys; a running query must keep the number it was started with.
BUCKETS = 256
#: Consecutive reading ids of a bucket that share one entry of the ids seen.
SEEN_BLOCK = 16_384


def require_rocksdb(spark: SparkSession) -> None:
    """Keyed-state queries need the RocksDB provider; it is a per-session setting."""
    if spark.conf.get(STATE_PROVIDER_KEY, "") != ROCKSDB_PROVIDER:
        spark.conf.set(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)


def bucket_of(*keys: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def in_ms(days: float | None) -> int | None:
    return None if days is None else max(1, int(days * 86_400_000))


class BucketProcessor(StatefulProcessor):
    """Hands the rows of a bucket and micro-batch, in order, to ``walk``, as one list per column."""

    order: list[str]

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable", ignore_index=True)
        if len(frame):
            yield self.walk({c: frame[c].tolist() for c in frame.columns}, timerValues)


class Entries:
    """Entries of a map state; one that holds nothing yet is asked only once."""

    def __init__(self, state) -> None:
        self._state, self._any = state, state.exists()

    def get(self, key: tuple):
        return self._state.getValue(key) if self._any and self._state.containsKey(key) else None


class Seen:
    """Ids that a bucket's messages had, in blocks: sorted 16-bit offsets by patient, read when first asked for.

    Ids that follow one another belong to many patients, so a block has one entry for all of a bucket's.
    """

    def __init__(self, state) -> None:
        self._state, self._stored, self._blocks, self._new = state, Entries(state), {}, {}

    def add(self, patient: str, message: int) -> bool:
        """Whether the id is new; it is remembered."""
        block, offset = divmod(message, SEEN_BLOCK)
        if block not in self._blocks:
            self._blocks[block] = dict(zip(*(self._stored.get((block,)) or ((), ()))))
            self._new[block] = {}
        known, new = self._blocks[block], self._new[block]
        if patient not in new:
            new[patient] = set(), set(np.frombuffer(bytes(known.get(patient, b"")), "<u2").tolist())
        added, before = new[patient]
        if offset in before or offset in added:
            return False
        added.add(offset)
        return True

    def store(self) -> None:
        for block, new in self._new.items():
            changed = {p: np.array(sorted(before | added), "<u2").tobytes() for p, (added, before) in new.items() if added}
            if changed:
                offsets = self._blocks[block] | changed
                self._state.updateValue((block,), (list(offsets), list(offsets.values())))


class CleanupProcessor(BucketProcessor):
    """Cleans whole readings; a patient's state is the last value per vital, and the ids seen."""

    output_schema = (
        "patient_id STRING, ts_us BIGINT, reading_id BIGINT, names ARRAY<STRING>, vals ARRAY<DOUBLE>, reason STRING"
    )
    order = ["ts_us", "reading_id"]

    def __init__(self, idle_days: float | None = None, remember_days: float | None = None):
        self.idle_ms, self.remember_ms = in_ms(idle_days), in_ms(remember_days)

    def init(self, handle) -> None:
        self.last = handle.getMapState(
            "last", "patient_id STRING", "names ARRAY<STRING>, vals ARRAY<DOUBLE>", self.idle_ms)
        self.seen = handle.getMapState(
            "seen", "block BIGINT", "patients ARRAY<STRING>, offsets ARRAY<BINARY>", self.remember_ms)

    def walk(self, rows, timerValues):
        fold, seen, entries, states, changed, out = Cleanup(), Seen(self.seen), Entries(self.last), {}, set(), []
        for patient, ts, reading_id, names, vals in zip(*(rows[c] for c in ("patient_id", "ts_us", "reading_id", "names", "vals"))):
            # A message without an id cannot be told from another one.
            known = not pd.isna(reading_id)
            reading_id = int(reading_id) if known else None
            if known and not seen.add(patient, reading_id):
                out.append((patient, ts, reading_id, [], [], DUPLICATE))
                continue
            if patient not in states:
                stored = entries.get((patient,))
                states[patient] = {} if stored is None else dict(zip(*stored))
            last, kept_names, kept_vals = states[patient], [], []
            for name, value in zip(names, vals):
                result, state = fold.step(last.get(name), name, float(value))
                if state is not None and state != last.get(name):
                    last[name] = state
                    changed.add(patient)
                if result is not None:
                    kept_names.append(name)
                    kept_vals.append(result)
            if self.idle_ms is not None:
                changed.add(patient)  # being heard of keeps a state alive
            out.append((patient, ts, reading_id, kept_names, kept_vals, None))
        for patient in changed:
            self.last.updateValue((patient,), (list(states[patient]), list(states[patient].values())))
        seen.store()
        made = pd.DataFrame(out, columns=["patient_id", "ts_us", "reading_id", "names", "vals", "reason"])
        return made.astype({"reading_id": "Int64"})


class CooldownProcessor(BucketProcessor):
    """Marks each alert as sent or muted; the state of a patient and kind is when one was sent."""

    output_schema = (
        "patient_id STRING, alert_type STRING, ts_us BIGINT, alert_id BIGINT, body STRING, passed BOOLEAN"
    )
    order = ["ts_us", "alert_id"]

    def __init__(self, seconds: float = COOLDOWN_SECONDS, idle_days: float | None = None):
        self.fold, self.idle_ms = Cooldown(seconds=seconds), in_ms(idle_days)

    def init(self, handle) -> None:
        self.sent = handle.getMapState("sent", "patient_id STRING, alert_type STRING", "sent_us BIGINT", self.idle_ms)

    def walk(self, rows, timerValues):
        places: dict[tuple, list[int]] = {}
        entries = Entries(self.sent)
        for i, key in enumerate(zip(rows["patient_id"], rows["alert_type"])):
            places.setdefault(key, []).append(i)
        passed = [False] * len(rows["ts_us"])
        for key, own in places.items():
            sent = (entries.get(key) or (None,))[0]
            times = [rows["ts_us"][i] for i in own]
            marks, sent = self.fold.walk(sent, (times,), 0, len(times))
            self.sent.updateValue(key, (sent,))
            for i, mark in zip(own, marks):
                passed[i] = mark
        columns = ("patient_id", "alert_type", "ts_us", "alert_id", "body")
        return pd.DataFrame({**{c: rows[c] for c in columns}, "passed": passed})


def time_mode(*days: float | None) -> str:
    """State that expires needs processing time, with which a query also runs batches without data.

    So a query with expiring state and ``availableNow`` ends only if
    spark.sql.streaming.noDataMicroBatches.enabled is false.
    """
    return "None" if all(d is None for d in days) else "ProcessingTime"


def clean_readings_stream(
    readings: DataFrame, idle_days: float | None = None, remember_days: float | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Cleaned readings (patient_id, ts, reading_id, vitals, reason) of a reading stream.

    ``readings`` hold patient_id, ts TIMESTAMP, reading_id BIGINT and the vitals map.
    A reading whose vitals all drop comes out with an empty map. Delivery may repeat any
    range of messages at any later time: a reading whose id its patient had before comes
    out empty with a reason and changes nothing, as in the batch operator. Ids are
    remembered for ``remember_days`` of processing time (None: for good), about two bytes
    each. Patients silent for ``idle_days`` lose their last values.
    """
    require_rocksdb(readings.sparkSession)
    prepared = readings.select(
        bucket_of("patient_id", buckets=buckets),
        F.col("patient_id").cast("string").alias("patient_id"),
        F.unix_micros("ts").alias("ts_us"),
        "reading_id",
        F.map_keys("vitals").alias("names"),
        F.map_values("vitals").alias("vals"),
    )
    cleaned = prepared.groupBy("bucket").transformWithStateInPandas(
        CleanupProcessor(idle_days, remember_days), CleanupProcessor.output_schema, "Append",
        time_mode(idle_days, remember_days))
    return cleaned.select(
        "patient_id",
        F.timestamp_micros("ts_us").alias("ts"),
        "reading_id",
        F.map_from_arrays("names", "vals").alias("vitals"),
        "reason",
    )


def cool_down_stream(
    alerts: DataFrame, seconds: float = COOLDOWN_SECONDS, idle_days: float | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Alerts (patient_id, alert_type, ts, alert_id, body) with ``passed``."""
    require_rocksdb(alerts.sparkSession)
    prepared = alerts.select(
        bucket_of("patient_id", "alert_type", buckets=buckets),
        F.col("patient_id").cast("string").alias("patient_id"),
        "alert_type",
        F.unix_micros("ts").alias("ts_us"),
        "alert_id",
        "body",
    )
    marked = prepared.groupBy("bucket").transformWithStateInPandas(
        CooldownProcessor(seconds, idle_days), CooldownProcessor.output_schema, "Append", time_mode(idle_days))
    return marked.withColumn("ts", F.timestamp_micros("ts_us")).drop("ts_us")
