"""Consumer metrics from the progress of streaming queries."""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from pulseframe.schemas import CONSUMER_METRICS


# Name of the observed count of messages that cannot be scored.
FAILED = "messages_failed"


def _topic_offsets(value) -> dict[int, int]:
    """Offsets by partition of a topic source; other sources have none."""
    value = json.loads(value) if isinstance(value, str) else value
    if not isinstance(value, dict):
        return {}
    return {
        int(p): int(o) for parts in value.values() if isinstance(parts, dict) for p, o in parts.items()
    }


def consumer_rows(progress: dict) -> list[dict]:
    """Rows of the consumer metrics table for one progress report: one per source partition."""
    ends, latest = {}, {}
    for source in progress["sources"]:
        ends.update(_topic_offsets(source.get("endOffset")))
        latest.update(_topic_offsets(source.get("latestOffset")))
    base = {
        "id": None,
        "timestamp": dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")),
        "messages_processed": progress["numInputRows"],
        "messages_failed": sum(m.get(FAILED) or 0 for m in progress.get("observedMetrics", {}).values()),
        "processing_time_ms": float(progress["durationMs"].get("triggerExecution", 0)),
    }
    if not ends:
        return [{**base, "lag": None, "partition": None, "offset": None}]
    return [
        {**base, "lag": latest.get(p, o) - o, "partition": p, "offset": o} for p, o in sorted(ends.items())
    ]


class ProgressTable(StreamingQueryListener):
    """Writes the progress reports of some queries, by name, to the consumer metrics table.

    A report is a small file of JSON lines named after its run and batch: no Spark job is
    started for it, and a report that comes twice replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, names: Collection[str]):
        self._spark, self._path, self._names = spark, path.rstrip("/"), set(names)
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name not in self._names:
            return
        report = json.loads(event.progress.json)
        rows = [dict(r, timestamp=r["timestamp"].isoformat()) for r in consumer_rows(report)]
        context = self._spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{report['runId']}-{report['batchId']:012d}.json")
        stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
        stream.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        stream.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, run_id: str, seconds: float = 60) -> bool:
        """Whether all reports of an ended run are written; they come after the run's end, in order."""
        return self._end(str(run_id)).wait(seconds)


def consumer_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONSUMER_METRICS).json(path)
