"""Cases kept as files of sensor tracks: read whole, replayed as they arrive, stopped early."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.plans.ingest import _GRID_TRACKS, _SAMPLES_SQL, _candidate_track, samples
from pulseframe.plans.registry import query, runs
from pulseframe.session import scratch_path
from pulseframe.sources import case_files, tracks
from pulseframe.streaming.monitor import consume_first

# Users are put together to this many cases, a file or more each.
_CASES = 64
_CASES_SQL = f"SELECT * REPLACE (case_id % {_CASES} AS case_id) FROM ({_SAMPLES_SQL})"
_HELD_SQL = f"""SELECT case_id, CAST(floor(t) AS BIGINT) AS second,
  {', '.join(f"nullif(arg_max(value, t) FILTER (WHERE track = '{k}'), 'NaN'::DOUBLE) AS c{i}" for i, k in enumerate(_GRID_TRACKS))}
FROM ({_CASES_SQL}) GROUP BY 1, 2"""


def _kept(spark, sf_dir) -> tuple[DataFrame, str]:
    """All samples, and a folder with them as case files."""
    made = samples(spark, sf_dir, _candidate_track()).withColumn("case_id", F.pmod("case_id", F.lit(_CASES)))
    path = scratch_path(spark, "cases")
    case_files.write_cases(made, path, runs(spark))
    return made, path


def _grid(rows: DataFrame) -> DataFrame:
    grid = tracks.to_grid(rows, tracks.all_tracks())
    cols = [F.when(~F.isnan(F.col(f"`{k}`")), F.col(f"`{k}`")).alias(f"c{i}") for i, k in enumerate(tracks.all_tracks())]
    return grid.select("case_id", "second", *cols)


@query("case_grid", _HELD_SQL)
def case_grid(spark, sf_dir):
    """The grid of all cases through the data source, one partition for each case file."""
    return _grid(case_files.load_cases(spark, _kept(spark, sf_dir)[1], tracks.all_tracks()))


@query("case_grid_stream", _HELD_SQL)
def case_grid_stream(spark, sf_dir):
    """The same grid after a replay that takes at most sixteen files at a time."""
    path, work = _kept(spark, sf_dir)[1], scratch_path(spark, "replay")
    stream = case_files.replay_cases(spark, path, f"{work}/progress", most_files=16)
    replay = (
        stream.writeStream.format("parquet").option("path", f"{work}/out")
        .option("checkpointLocation", f"{work}/checkpoint").start()
    )
    try:
        replay.processAllAvailable()
    finally:
        replay.stop()
    return _grid(spark.read.schema(stream.schema).parquet(f"{work}/out"))


@query("case_replay_first", "SELECT least(250, count(*)) AS taken, 0 AS unknown FROM events")
def case_replay_first(spark, sf_dir):
    """The replay stops after so many samples; which come first depends on the order in which files were put there."""
    made, path = _kept(spark, sf_dir)
    work = scratch_path(spark, "replay")
    stream = case_files.replay_cases(spark, path, f"{work}/progress", most_files=4)
    first = consume_first(stream, work, 250, ["case_id", "t", "track"])
    known = made.select("case_id", "t", "track").distinct().withColumn("known", F.lit(True))
    return first.join(known, ["case_id", "t", "track"], "left").agg(
        F.count("*").alias("taken"), F.count_if(F.col("known").isNull()).alias("unknown"))
