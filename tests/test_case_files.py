"""Case files and their data source: batch, stream, restart."""

import os
import time

import pytest
from pyspark.sql import functions as F

from pulseframe.session import ship_package
from pulseframe.sources import case_files as cf
from pulseframe.streaming.monitor import consume_first

SAMPLES = "case_id BIGINT, t DOUBLE, track STRING, value DOUBLE"


@pytest.fixture()
def rows(spark):
    ship_package(spark)
    # Case 7 has most of the samples; one row names no case, one value is null.
    made = [(7, float(i) / 4, "HR" if i % 2 else "SPO2", float(i)) for i in range(200)]
    made += [(c, float(i), "HR", float(c * 10 + i)) for c in (-1, 2, 3) for i in range(5)] + [(2, 9.0, "SPO2", None)]
    return made


def as_set(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_round_trip_tracks_and_cases(spark, rows, tmp_path):
    path = str(tmp_path / "cases")
    cf.write_cases(spark.createDataFrame([*rows, (None, 1.0, "HR", 1.0)], SAMPLES), path, 4, most_rows=40)
    assert as_set(cf.load_cases(spark, path)) == sorted(rows, key=str)
    assert as_set(cf.load_cases(spark, "file://" + path, ["SPO2"])) == sorted((r for r in rows if r[2] == "SPO2"), key=str)
    assert as_set(cf.load_cases(spark, path, cases=[2, -1, 99])) == sorted((r for r in rows if r[0] in (2, -1)), key=str)
    assert cf.load_cases(spark, path, tracks=[]).count() == 0
    # One partition for each file, a long case in several.
    files = cf.case_files(path)
    assert cf.load_cases(spark, path).rdd.getNumPartitions() == len(files)
    assert sum(f.case_id == 7 for f in files) >= 5


def test_empty_and_other_files(spark, rows, tmp_path):
    assert cf.load_cases(spark, str(tmp_path / "nothing")).count() == 0
    path = str(tmp_path / "cases")
    cf.write_cases(spark.createDataFrame(rows, SAMPLES).limit(0), path, 2)
    assert cf.load_cases(spark, path).count() == 0
    os.makedirs(f"{path}/case_id=abc")
    for name in ("case_id=abc/x.parquet", "case_id=abc/notes.txt", "y.parquet"):
        with open(f"{path}/{name}", "w") as file:
            file.write("no case")
    assert cf.load_cases(spark, path).count() == 0


def replayed(spark, path, progress, work, most):
    stream = cf.replay_cases(spark, path, progress, most_files=most)
    return stream.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/check").start()


def until(done, seconds=60):
    end = time.time() + seconds
    while not done() and time.time() < end:
        time.sleep(0.2)
    assert done()


def test_stream_takes_few_files_a_batch_and_goes_on_after_a_restart(spark, rows, tmp_path):
    path, work, progress = (str(tmp_path / n) for n in ("cases", "work", "progress"))
    cf.write_cases(spark.createDataFrame(rows, SAMPLES), path, 4, most_rows=40)
    files = len(cf.case_files(path))
    sizes = []
    got = lambda: spark.read.schema(SAMPLES).parquet(f"{work}/out").count() if os.path.exists(f"{work}/out/_spark_metadata") else 0
    query = replayed(spark, path, progress, work, 3)
    until(lambda: got() == len(rows))
    sizes += [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    assert len(sizes) >= -(-files // 3)
    # Two more cases arrive while the query is down, one while it runs; an old file is gone.
    os.remove(cf.case_files(path)[0].path)
    more = [(c, 1.0, "HR", 1.0) for c in (20, 21)]
    later = tmp_path / "later"
    for n, row in enumerate(more):
        cf.write_cases(spark.createDataFrame([row], SAMPLES), str(later / str(n)), 1)
        os.rename(later / str(n) / f"case_id={row[0]}", f"{path}/case_id={row[0]}")
    query = replayed(spark, path, progress, work, 1)
    until(lambda: got() == len(rows) + 2)
    cf.write_cases(spark.createDataFrame([(22, 1.0, "HR", 1.0)], SAMPLES), str(later / "2"), 1)
    os.rename(later / "2" / "case_id=22", f"{path}/case_id=22")
    until(lambda: got() == len(rows) + 3)
    query.stop()
    assert as_set(spark.read.schema(SAMPLES).parquet(f"{work}/out")) == sorted([*rows, *more, (22, 1.0, "HR", 1.0)], key=str)


def test_offsets_never_go_back(tmp_path, rows, spark):
    path, progress = str(tmp_path / "cases"), str(tmp_path / "progress")
    cf.write_cases(spark.createDataFrame(rows, SAMPLES), path, 4, most_rows=40)
    options = {"path": path, "progress": progress, "maxFilesPerBatch": "2"}
    first = cf._Stream(options)
    offsets = [first.initialOffset(), first.latestOffset(), first.latestOffset()]
    # After a crash the noted offset comes first, even with a smaller limit; a batch is repeated as it was.
    second = cf._Stream({**options, "maxFilesPerBatch": "1"})
    assert second.latestOffset() == offsets[-1]
    step = lambda reader, a, b: [f.path for f in reader.partitions(a, b)]
    assert step(second, *offsets[1:]) == step(first, *offsets[1:])
    assert len(step(second, *offsets[:2])) == len(step(second, *offsets[1:])) == 2
    assert len(step(second, offsets[-1], second.latestOffset())) == 1
    with pytest.raises(ValueError):
        cf._Stream({**options, "maxFilesPerBatch": "0"})


def test_stop_after_n(spark, rows, tmp_path):
    path = str(tmp_path / "cases")
    cf.write_cases(spark.createDataFrame(rows, SAMPLES), path, 4, most_rows=40)
    stream = cf.replay_cases(spark, path, str(tmp_path / "progress"), most_files=1)
    first = consume_first(stream, str(tmp_path / "first"), 30, ["case_id", "t", "track"])
    assert first.count() == 30
    taken = cf.case_files(path)
    assert {r["case_id"] for r in first.select("case_id").distinct().collect()} <= {f.case_id for f in taken}
