"""Ordered keyed folds: reading cleanup and alert cooldown.

Both carry a state from row to row that no window function can express: the
next state depends on whether the previous one let the row through. Rows are
shuffled and sorted by Spark; a task walks them once, in Arrow batches, with one
small state at a time.

A key that is too large for a task can be cut into runs by range partitioning. A run
that starts inside a key does not know the state it starts from, so it is walked
for every start at once until the start no longer matters:

* cleanup keeps the outcome for the lowest and the highest possible state. The
  step never changes the order of two states, so once both meet, every start
  gives that same state.
* cooldown keeps the time of the last passed alert for every start that still
  makes a difference; an alert lets through all groups that have waited long
  enough, and these merge into one.

Rows walked before that point are set aside, and finished in a second, equally
parallel pass, in which a run that never settled is continued by the next one's rows.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.session import scratch_path

# Plausible range per vital, jump limits, smoothing weights.
PLAUSIBLE_RANGES = {
    "heart_rate": (30.0, 200.0),
    "spo2": (50.0, 100.0),
    "temperature": (30.0, 45.0),
    "respiratory_rate": (4.0, 60.0),
    "blood_pressure_systolic": (50.0, 250.0),
    "blood_pressure_diastolic": (20.0, 150.0),
}
JUMP_LIMITS = {"heart_rate": 20.0}
DEFAULT_JUMP_LIMIT = 5.0
OLD_WEIGHT, NEW_WEIGHT = 0.7, 0.3
# Fixed value: seconds during which a passed alert mutes its kind.
COOLDOWN_SECONDS = 300

_WIDEST = float(np.finfo(np.float64).max)


class Cleanup:
    """Range check, imputation and smoothing of one (patient, vital) series.

    The state is the last kept value, or None before there is one. The vital's name
    must be part of the fold's key.
    """

    output = (("cleaned", pa.float64(), T.DoubleType()),)

    def __init__(self, field: str = "field", value: str = "value"):
        self.inputs = (field, value)

    def prepare(self, batch: pa.RecordBatch) -> list:
        field, value = (batch.column(batch.schema.get_field_index(c)) for c in self.inputs)
        values = value.to_numpy(zero_copy_only=False)
        return [field, values.tolist(), values]

    def rules(self, field: str) -> tuple[float, float, float]:
        """(low, high, jump limit); an unlisted vital has no range, only infinities are useless."""
        low, high = PLAUSIBLE_RANGES.get(field, (None, None))
        return low, high, JUMP_LIMITS.get(field, DEFAULT_JUMP_LIMIT)

    def fold(self, state, values, low, high, jump):
        """(outputs, None where the value is dropped; state after the last value)."""
        out = []
        for value in values:
            if low is None:
                if math.isinf(value):
                    out.append(None)
                    continue
            elif not low <= value <= high:
                out.append(state)
                continue
            if state is not None and abs(value - state) > jump:
                value = state * OLD_WEIGHT + value * NEW_WEIGHT
            out.append(value)
            state = value
        return out, state

    def step(self, state, field, value):
        """(output or None to drop, next state) for a single value."""
        out, state = self.fold(state, (value,), *self.rules(field))
        return out[0], state

    def walk(self, state, columns, start, stop):
        """Outputs of rows start..stop of one series and the state after them.

        Once the state is the value just seen, calm values, which are plausible and no jump
        from their plausible neighbour, come out as they are; only the others are stepped.
        """
        fields, values, array = columns
        low, high, jump = self.rules(fields[start].as_py())
        here = array[start:stop]
        usable = np.isfinite(here) if low is None else (here >= low) & (here <= high)
        calm = usable[1:] & usable[:-1] & (np.abs(np.diff(here)) <= jump)
        out, at = [], 0
        for rough in [*(np.flatnonzero(~calm) + 1).tolist(), len(here)]:
            while at < rough:
                (made,), state = self.fold(state, (values[start + at],), low, high, jump)
                out.append(made)
                at += 1
                if state == values[start + at - 1]:
                    out.extend(values[start + at : start + rough])
                    at, state = rough, values[start + rough - 1]
        return out, state

    def unknown(self, columns, start):
        field = columns[0][start].as_py()
        low, high = PLAUSIBLE_RANGES.get(field, (-_WIDEST, _WIDEST))
        return {"rules": self.rules(field), "low": low, "high": high}

    def walk_unknown(self, open_state, columns, start, stop):
        """Rows set aside, and the state if it became certain (else None)."""
        values, rules = columns[1], open_state["rules"]
        low, high = open_state["low"], open_state["high"]
        for i in range(start, stop):
            _, low = self.fold(low, values[i : i + 1], *rules)
            _, high = self.fold(high, values[i : i + 1], *rules)
            if low == high or (math.isnan(low) and math.isnan(high)):
                return i + 1 - start, low
        open_state["low"], open_state["high"] = low, high
        return stop - start, None


class Cooldown:
    """Lets an alert pass if none of its kind passed within the cooldown.

    The state is the time (microseconds) of the last passed alert. Muted alerts
    do not extend it.
    """

    output = (("passed", pa.bool_(), T.BooleanType()),)

    def __init__(self, ts: str = "ts", seconds: float = COOLDOWN_SECONDS):
        self.inputs = (ts,)
        self.wait = int(seconds * 1_000_000)

    def prepare(self, batch: pa.RecordBatch) -> list[list]:
        ts = batch.column(batch.schema.get_field_index(self.inputs[0]))
        micros = ts.cast(pa.timestamp("us", tz=ts.type.tz)).cast(pa.int64())
        return [micros.to_numpy(zero_copy_only=False).tolist()]

    def walk(self, state, columns, start, stop):
        (times,) = columns
        out = [False] * (stop - start)
        i = start if state is None else bisect_left(times, state + self.wait, start, stop)
        while i < stop:
            out[i - start], state = True, times[i]
            i = bisect_left(times, state + self.wait, i + 1, stop)
        return out, state

    def unknown(self, columns, start):
        # groups: deque of [last passed time, starts], oldest first. A start is an
        # upper bound on the incoming time; `kept` is true while a start can exist
        # that nothing let through yet.
        return {"first": columns[0][start], "groups": deque(), "kept": True, "reach": None}

    def walk_unknown(self, open_state, columns, start, stop):
        (times,) = columns
        groups = open_state["groups"]
        for i in range(start, stop):
            now = times[i]
            released = []
            while groups and now - groups[0][0] >= self.wait:
                released.extend(groups.popleft()[1])
            if open_state["kept"]:
                reach = now - self.wait
                if open_state["reach"] is None or reach > open_state["reach"]:
                    open_state["reach"] = reach
                    released.append(reach)
                if reach >= open_state["first"]:
                    open_state["kept"] = False
            if released:
                # Starts between two bounds behave alike, so only the bounds are kept.
                groups.append([now, released])
            if not open_state["kept"] and len(groups) == 1:
                return i + 1 - start, groups[0][0]
        return stop - start, None


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> list[int]:
    """Row numbers at which the key differs from the row before."""
    n = batch.num_rows
    changed = np.zeros(n, dtype=bool)
    for key in keys:
        column = batch.column(batch.schema.get_field_index(key))
        here, before = column.slice(1), column.slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(here, before), False)
        nulls = pc.xor(pc.is_null(here), pc.is_null(before))
        changed[1:] |= pc.or_(differs, nulls).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed).tolist()


def _key_at(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(batch.schema.get_field_index(k))[row].as_py() for k in keys)


def _with_columns(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *extra.values()], names=[*batch.schema.names, *extra]
    )


def _kept(batch: pa.RecordBatch, results: pa.Array) -> tuple[pa.RecordBatch, pa.Array]:
    """Rows the fold did not drop, with their results."""
    if not results.null_count:
        return batch, results
    mask = pc.is_valid(results)
    return batch.filter(mask), results.filter(mask)


def _emit(batch: pa.RecordBatch, results: list, fold) -> pa.RecordBatch:
    (name, arrow_type, _), = fold.output
    kept, values = _kept(batch, pa.array(results, arrow_type))
    return _with_columns(kept, {name: values})


def _walk_batches(batches: Iterator[pa.RecordBatch], keys, fold, entering=None):
    """Fold sorted batches; a key's state is dropped as soon as its rows end."""
    key, state = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = fold.prepare(batch)
        starts = [0, *_starts(batch, keys)]
        results = []
        for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
            this = _key_at(batch, keys, start)
            if this != key:
                key, state = this, None if entering is None else entering(batch, start)
            out, state = fold.walk(state, columns, start, stop)
            results.extend(out)
        yield _emit(batch, results, fold)


def _output_schema(df: DataFrame, fold) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType([*fields, *(T.StructField(n, t) for n, _, t in fold.output)])


def fold_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fold, runs: int | None = None
) -> DataFrame:
    """Walk each key's rows in ``order`` and add the fold's output column.

    ``order`` must be total within a key. Without ``runs`` a key is one task's stream;
    with ``runs`` all rows are cut into that many pieces, whatever their keys. The result
    depends neither on that nor on the number of partitions.
    """
    keys, order = list(keys), list(order)
    if runs is not None:
        return _fold_in_runs(df, keys, order, fold, runs)
    return (
        df.repartition(*keys)
        .sortWithinPartitions(*keys, *order)
        .mapInArrow(lambda batches: _walk_batches(batches, keys, fold), _output_schema(df, fold))
    )


_RUN_COLUMNS = [
    T.StructField("_part", T.StringType()),
    T.StructField("_run", T.IntegerType()),
    T.StructField("_first_key", T.StringType()),
    T.StructField("_last_key", T.StringType()),
    T.StructField("_end", T.StringType()),
]


def _key_text(key: tuple) -> str:
    return json.dumps([str(k) if k is not None else None for k in key])


def _walk_run(batches: Iterator[pa.RecordBatch], keys, fold):
    """First pass over one run: finished rows, rows set aside, and one closing row."""
    run = TaskContext.get().partitionId()
    (name, arrow_type, _), = fold.output

    def tagged(batch, results, part):
        n = batch.num_rows
        extra = {name: results if results is not None else pa.nulls(n, arrow_type)}
        extra["_part"] = pa.array([part] * n, pa.string())
        extra["_run"] = pa.array([run] * n, pa.int32())
        for c in ("_first_key", "_last_key", "_end"):
            extra[c] = pa.nulls(n, pa.string())
        return _with_columns(batch, extra)

    first = key = state = opened = schema = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        schema = batch.schema
        columns = fold.prepare(batch)
        starts = [0, *_starts(batch, keys)]
        waiting, results = 0, []
        for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
            this = _key_at(batch, keys, start)
            if first is None:
                first = key = this
                opened = fold.unknown(columns, start)
            elif this != key:
                key, state, opened = this, None, None
            if opened is not None:
                # Only the first key of a run can be open, so set-aside rows lead the batch.
                count, certain = fold.walk_unknown(opened, columns, start, stop)
                waiting += count
                start += count
                if certain is None:
                    continue
                state, opened = certain, None
            out, state = fold.walk(state, columns, start, stop)
            results.extend(out)
        if waiting:
            yield tagged(batch.slice(0, waiting), None, "waiting")
        if results:
            yield tagged(*_kept(batch.slice(waiting), pa.array(results, arrow_type)), "done")
    if first is not None:
        closing = {
            "_part": ["closing"],
            "_run": [run],
            "_first_key": [_key_text(first)],
            "_last_key": [_key_text(key)],
            # The state after the run, if it is known; [] keeps a state of None apart.
            "_end": [None if opened is not None else json.dumps([state])],
        }
        arrays = [pa.nulls(1, f.type) for f in schema]
        names = list(schema.names)
        arrays.append(pa.nulls(1, arrow_type))
        names.append(name)
        for c, v in closing.items():
            arrays.append(pa.array(v, pa.int32() if c == "_run" else pa.string()))
            names.append(c)
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _chains(closings: DataFrame) -> DataFrame:
    """(_run, _chain, _entering): which run's set-aside rows come first, and the state before them.

    One row per run. A run that starts inside a key and follows one that never settled
    continues that one's chain.
    """
    by_run = Window.orderBy("_run")
    before = lambda c: F.lag(c).over(by_run)
    inside = F.coalesce(before("_last_key") == F.col("_first_key"), F.lit(False))
    told = closings.withColumns({"_inside": inside, "_before": before("_end")})
    starts = ~F.col("_inside") | F.col("_before").isNotNull()
    chain = F.max(F.when(starts, F.col("_run"))).over(by_run.rowsBetween(Window.unboundedPreceding, 0))
    return told.select(
        "_run", chain.alias("_chain"), F.when(F.col("_inside"), F.col("_before")).alias("_entering")
    )


def _fold_in_runs(df: DataFrame, keys, order, fold, runs: int) -> DataFrame:
    spark = df.sparkSession
    staged_schema = T.StructType(
        [*_output_schema(df, fold).fields, *_RUN_COLUMNS]
    )
    path = scratch_path(spark, "fold")
    (
        df.repartitionByRange(runs, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .mapInArrow(lambda batches: _walk_run(batches, keys, fold), staged_schema)
        .write.partitionBy("_part").parquet(path)
    )
    staged = spark.read.schema(staged_schema).parquet(path)
    columns, inputs = _output_schema(df, fold).names, df.columns
    closings = staged.filter(F.col("_part") == "closing").select("_run", "_first_key", "_last_key", "_end")
    waiting = staged.filter(F.col("_part") == "waiting").select(*inputs, "_run")

    def entering(batch, row):
        text = batch.column(batch.schema.get_field_index("_entering"))[row].as_py()
        return None if text is None else json.loads(text)[0]

    def finish(batches):
        # A chain's rows are of one key and come in its order, the first run's first.
        yield from _walk_batches(batches, ["_chain"], fold, entering)

    known = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    more = [T.StructField("_run", T.IntegerType()), T.StructField("_chain", T.IntegerType()), T.StructField("_entering", T.StringType())]
    finished_schema = T.StructType([*known, *more, *(T.StructField(n, t) for n, _, t in fold.output)])
    finished = (
        waiting.join(F.broadcast(_chains(closings)), "_run")  # ``runs`` rows at most
        .select(*inputs, "_run", "_chain", "_entering")
        .repartition(runs, "_chain")
        .sortWithinPartitions("_chain", "_run", *order)
        .mapInArrow(finish, finished_schema)
    )
    done = staged.filter(F.col("_part") == "done").select(*columns)
    return done.unionByName(finished.select(*columns))


def clean_points(
    points: DataFrame,
    keys: Sequence[str] = ("patient_id", "field"),
    order: Sequence[str] = ("ts", "event_id"),
    field: str = "field",
    value: str = "value",
    runs: int | None = None,
) -> DataFrame:
    """Cleaned value per tall point; points without a number or a usable history are dropped."""
    numeric = points.filter(F.col(value).isNotNull())
    return fold_by_key(numeric, keys, order, Cleanup(field, value), runs)


def clean_readings(readings: DataFrame, runs: int | None = None) -> DataFrame:
    """Readings (patient_id, ts, reading_id, vitals map) with cleaned vitals.

    Delivery may repeat a message: of readings with the same patient, time and id one
    counts. Readings that keep no vital are left out. Each vital is its own series, so the
    fold runs on one row per vital; the vitals of a reading, a handful, are
    gathered again afterwards.
    """
    keys = ["patient_id", "ts", "reading_id"]
    tall = readings.select(*keys, F.explode("vitals").alias("field", "value")).dropDuplicates([*keys, "field"])
    cleaned = clean_points(tall, order=("ts", "reading_id"), runs=runs)
    entries = F.collect_list(F.struct("field", "cleaned"))
    return cleaned.groupBy(*keys).agg(F.map_from_entries(entries).alias("vitals"))


def cool_down(
    alerts: DataFrame,
    keys: Sequence[str] = ("patient_id", "alert_type"),
    order: Sequence[str] = ("ts", "event_id"),
    seconds: float = COOLDOWN_SECONDS,
    runs: int | None = None,
) -> DataFrame:
    """Alerts with ``passed``: whether each is sent or muted."""
    return fold_by_key(alerts, keys, order, Cooldown(order[0], seconds), runs)


def plausible(field: Column, value: Column) -> Column:
    """In range for its vital (unlisted vitals have no range); NaN is not in any range."""
    chain = F
    for name, (low, high) in PLAUSIBLE_RANGES.items():
        chain = chain.when(field == name, value.between(F.lit(low), F.lit(high)))
    return chain.otherwise(F.lit(True))
