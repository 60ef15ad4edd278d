"""Sinks of the monitoring query folded into versioned tables: risk, latest readings, compacted history.

Every fold reads only batches after the mark that is stored with the tables, and writes
tables and mark in one step. So a fold that is repeated after a crash, or a batch that
comes twice, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.operators.maintain import update_risk
from pulseframe.operators.timeseries import latest_per_key
from pulseframe.sources.snapshots import Snapshots

RISK_MARK = "risk"
LATEST = "latest"


def fold_risk(spark: SparkSession, root: str, store: Snapshots, ref: Column) -> int:
    """Bring the risk of all batches since the last fold into the tables ``patients`` and ``admissions``.

    Both are cut by patient_id into the same parts. A patient discharged after their last
    reading is not admitted again, since each reading acts once. Returns the number of
    the version that holds the result.
    """
    updates = spark.read.parquet(f"{root}/risk").filter(F.col("batch_id") > store.mark(RISK_MARK))
    last = updates.agg(F.max("batch_id")).first()[0]
    if last is None:
        return max(store.versions(), default=0)
    latest = latest_per_key(updates.filter(F.col("batch_id") <= last), ["patient_id"], ["ts", "reading_id"])
    parts = store.touched("patients", latest)
    people, stays = update_risk(store.read("patients", parts), store.read("admissions", parts), latest, ref)
    return store.commit({"patients": people, "admissions": stays}, {"patients": parts, "admissions": parts}, {RISK_MARK: last})


def keep_latest(
    store: Snapshots, keys: Sequence[str], order: Sequence[str], name: str = LATEST, parts: int = 64
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that keeps the newest row per key in a table, by ``order``, whatever the order of arrival.

    A batch is first reduced to one row per key, and touches only the parts of its keys.
    """
    keys, order = list(keys), list(order)

    def newest(old: DataFrame, new: DataFrame) -> DataFrame:
        return latest_per_key(old.unionByName(new), keys, order).select(*old.columns)

    def run(batch: DataFrame, batch_id: int) -> None:
        if store.mark(name) >= batch_id:
            return
        reduced = latest_per_key(batch, keys, order).select(*batch.columns).persist()
        try:
            if name not in store.tables():
                store.create(name, reduced.limit(0), keys[0], parts)
            store.change(name, reduced, newest, {name: batch_id})
        finally:
            reduced.unpersist()

    return run


def _batches(spark: SparkSession, root: str, store: Snapshots, sink: str) -> DataFrame:
    """The batch folders of a sink that are not in its table yet."""
    reader = spark.read
    if sink in store.tables():
        # All folders may be in the table and deleted by now.
        reader = reader.schema(store.read(sink).schema.add("batch_id", T.LongType()))
    return reader.parquet(f"{root}/{sink}").filter(F.col("batch_id") > store.mark(sink))


def compact(
    spark: SparkSession, root: str, store: Snapshots, sink: str, order: Sequence[str], day: str = "ts", upto: int | None = None
) -> int:
    """Move a sink's batches since the last time, or those up to one, into its table, cut by day and sorted within files.

    Days that get no rows keep their files; a day that does is written anew, so the number
    of files depends on the days and their volume, not on the number of batches.
    """
    batches = _batches(spark, root, store, sink)
    if upto is not None:
        batches = batches.filter(F.col("batch_id") <= upto)
    last = batches.agg(F.max("batch_id")).first()[0]
    if last is None:
        return max(store.versions(), default=0)
    rows = batches.filter(F.col("batch_id") <= last).drop("batch_id")
    if sink not in store.tables():
        store.create(sink, rows.limit(0), day, None)
    parts = store.touched(sink, rows)
    old = store.read(sink, parts)
    return store.commit({sink: old.unionByName(rows.select(*old.columns))}, {sink: parts}, {sink: last}, {sink: list(order)})


def compacted(spark: SparkSession, root: str, store: Snapshots, sink: str, days: tuple[str, str] | None = None) -> DataFrame:
    """All rows of a sink: those in its table, of some days only if given, and the batches that are not in it yet."""
    if sink not in store.tables():
        return _batches(spark, root, store, sink).drop("batch_id")
    table = store.read(sink) if days is None else store.read_days(sink, *days)
    fresh = _batches(spark, root, store, sink)
    if days is not None:
        fresh = fresh.filter(F.to_date("ts").between(*(F.lit(d).cast("date") for d in days)))
    return table.unionByName(fresh.select(*table.columns))


def drop_compacted(spark: SparkSession, root: str, store: Snapshots, sink: str) -> list[int]:
    """Delete the batch folders that are in the sink's table; readers of the folder itself have to be done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = path(f"{root}/{sink}")
    fs, mark, gone = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), store.mark(sink), []
    folders = [s.getPath() for s in fs.listStatus(place) if s.isDirectory()]
    while folders:
        folder = folders.pop()
        name, _, value = folder.getName().partition("=")
        if name != "batch_id":
            folders += [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
        elif int(value) <= mark:
            fs.delete(folder, True)
            gone.append(int(value))
    return sorted(set(gone))
