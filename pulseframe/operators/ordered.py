"""Work that needs rows of a key in order, without giving a key to one task.

Spark's window and grouped operators send a whole key to one task, which sorts it on
disk and streams it. That is the plan without ``runs``. A caller whose keys are too
large for that names the number of ``runs``: rows are then range-partitioned on (key,
order), which cuts a key wherever the volume asks for it, and the sorted runs are written
to the shared scratch folder so that later steps see the same cuts even if executors
are lost in between. Nothing is counted to choose a plan. What is kept per run is a row of
a table with ``runs`` rows, a number that the caller sets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.session import scratch_path

_RUN_SHIFT = 33  # monotonically_increasing_id: partition number above, row number below


def with_ordinal(df: DataFrame, order: Sequence[str], runs: int, name: str = "ordinal") -> tuple[DataFrame, int]:
    """Dense 0-based position of every row in the total order ``order``, and the number of rows.

    Each sorted run numbers its own rows; the rows in earlier runs are added from
    a table with one row per run, which is why that table may be broadcast.
    """
    path = scratch_path(df.sparkSession, "runs")
    (
        df.repartitionByRange(runs, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    staged = df.sparkSession.read.parquet(path).withColumn("_run", F.shiftright("_slot", _RUN_SHIFT))
    sizes = staged.groupBy("_run").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_run").alias("_start_run"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    position = F.col("_start") + F.col("_slot") - F.shiftleft(F.col("_run"), _RUN_SHIFT)
    placed = (
        staged.join(F.broadcast(starts), F.col("_run") == F.col("_start_run"))
        .withColumn(name, position)
        .drop("_slot", "_run", "_start_run", "_start")
    )
    return placed, staged.count()


def trailing_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    frame_rows: int,
    columns: Callable[[Window], dict[str, Column]],
    runs: int | None = None,
) -> DataFrame:
    """Columns over the last ``frame_rows`` rows (this one included) of the key.

    ``columns`` maps a window to the new columns. With ``runs``, rows are cut into that
    many equal stretches of the total order and each stretch also gets the
    ``frame_rows - 1`` rows before it, so every frame is whole.
    """
    keys, order = list(keys), list(order)
    reach = frame_rows - 1
    if runs is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-reach, 0)
        return df.withColumns(columns(window))
    placed, total = with_ordinal(df, keys + order, runs)
    stretch = max(-(-total // runs), frame_rows)
    own = F.floor(F.col("ordinal") / stretch)
    in_reach = F.col("ordinal") % stretch >= stretch - reach
    copied = placed.withColumn(
        "_stretch", F.explode(F.when(in_reach, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    window = Window.partitionBy("_stretch", *keys).orderBy(*order).rowsBetween(-reach, 0)
    return (
        copied.withColumns(columns(window))
        .filter(F.col("_stretch") == own)
        .drop("_stretch", "ordinal")
    )


def following_min(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    runs: int | None = None,
) -> DataFrame:
    """Smallest ``value`` among this row and all later rows of the key.

    The order is walked backwards, so the frame only grows and the cost is linear.
    With ``runs``, rows are cut into that many stretches, and the minimum of each
    stretch is carried to the earlier ones through a table of one row per stretch and key.
    """
    keys, order = list(keys), list(order)
    backwards = [F.col(c).desc() for c in order]
    if runs is None:
        window = Window.partitionBy(*keys).orderBy(*backwards).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.min(value).over(window))
    placed, total = with_ordinal(df, keys + order, runs)
    placed = placed.withColumn("_stretch", F.floor(F.col("ordinal") / max(1, -(-total // runs))))
    inside = Window.partitionBy("_stretch", *keys).orderBy(*backwards).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(*keys).orderBy(F.col("_stretch").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*keys, "_stretch").agg(F.min(value).alias("_low"))
        .withColumn("_later", F.min("_low").over(later)).drop("_low")
    )
    return (
        placed.withColumn("_inside", F.min(value).over(inside))
        .join(carried, [*keys, "_stretch"])
        .withColumn(name, F.least("_inside", "_later"))
        .drop("_inside", "_later", "_stretch", "ordinal")
    )
