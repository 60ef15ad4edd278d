"""Rolling processing times while messages stream in."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.rolling import METRIC_WINDOW
from pulseframe.streaming.stateful import BUCKETS, BucketProcessor, Entries, bucket_of, require_rocksdb

#: Messages whose windows are held at once.
CHUNK = 10_000


class RollingProcessor(BucketProcessor):
    """Average, least and greatest of each consumer's last times; the state is a ring of those times."""

    output_schema = "consumer STRING, ts_us BIGINT, event_id BIGINT, avg_ms DOUBLE, min_ms DOUBLE, max_ms DOUBLE"
    order = ["ts_us", "event_id"]

    def __init__(self, rows: int) -> None:
        self.rows = rows

    def init(self, handle) -> None:
        self.ring = handle.getMapState("ring", "consumer STRING", "times ARRAY<DOUBLE>")

    def handleInputRows(self, key, rows, timerValues):
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable", ignore_index=True)
        rings = Entries(self.ring)
        for consumer, own in frame.groupby("consumer", sort=False):
            before = np.array((rings.get((consumer,)) or ([],))[0], float)
            times = np.concatenate([before, own["processing_time_ms"].to_numpy(float)])
            self.ring.updateValue((consumer,), (times[-self.rows:].tolist(),))
            # Windows that are not full yet are filled up with values that do not count.
            padded = np.concatenate([np.full(self.rows - 1, np.nan), times])
            windows = np.lib.stride_tricks.sliding_window_view(padded, self.rows)[len(before):]
            for i in range(0, len(own), CHUNK):
                part, some = own.iloc[i:i + CHUNK], windows[i:i + CHUNK]
                yield pd.DataFrame({
                    "consumer": consumer, "ts_us": part["ts_us"], "event_id": part["event_id"],
                    "avg_ms": np.nanmean(some, axis=1), "min_ms": np.nanmin(some, axis=1), "max_ms": np.nanmax(some, axis=1)})


def rolling_times_stream(metrics: DataFrame, rows: int = METRIC_WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """Each message (consumer, ts, event_id, processing_time_ms) with avg_ms, min_ms and max_ms over the consumer's last ``rows``.

    As ``rolling_times``, in order of arrival. Messages without a time have no part in it.
    """
    require_rocksdb(metrics.sparkSession)
    timed = metrics.filter("processing_time_ms IS NOT NULL").select(
        bucket_of("consumer", buckets=buckets), "consumer", F.unix_micros("ts").alias("ts_us"), "event_id", "processing_time_ms")
    rolled = timed.groupBy("bucket").transformWithStateInPandas(
        RollingProcessor(rows), RollingProcessor.output_schema, "Append", "None")
    return rolled.withColumn("ts", F.timestamp_micros("ts_us")).drop("ts_us")
