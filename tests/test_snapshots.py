"""Versioned tables: copy-on-write by part, crashes, conflicts, compaction."""

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.maintain import replace_rows
from pulseframe.sources.snapshots import Conflict, Snapshots
from pulseframe.streaming.tables import compact, compacted, drop_compacted, fold_risk, keep_latest

SCHEMA = "patient_id STRING, age INT, status STRING"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    store.create("register", spark.createDataFrame([(f"p{i}", i, "active") for i in range(200)], SCHEMA), "patient_id", 16)
    return store


def test_a_change_leaves_other_parts_alone(spark, store):
    before, files = store.parts("register"), store.read("register").inputFiles()
    new = spark.createDataFrame([("p3", 99, None, 1), ("new", 5, None, 2)], SCHEMA + ", ord INT")
    operator = lambda old, changes: replace_rows(old, changes, ["ord"])
    whole = rows(operator(store.read("register"), new))
    old = store.read("register")
    store.change("register", new, operator)
    assert rows(store.read("register")) == whole and len(whole) == 201
    after = store.parts("register")
    changed = {p for p in after if after[p] != before.get(p)}
    assert 1 <= len(changed) <= 2 and set(store.touched("register", new)) == changed
    assert set(files) & set(store.read("register").inputFiles()) and len(rows(old)) == 200
    # Older versions stay readable until they are expired.
    assert store.read("register", version=1).count() == 200
    gone = store.expire(keep=1)
    assert len(gone) == len(changed) and rows(store.read("register")) == whole


def test_a_crash_before_the_version_changes_nothing(spark, store, monkeypatch):
    new = spark.createDataFrame([("p3", 99, None, 1)], SCHEMA + ", ord INT")
    change = lambda: store.change("register", new, lambda old, c: replace_rows(old, c, ["ord"]), {"done": 7})

    def crash(version):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "_publish", crash)
        with pytest.raises(OSError):
            change()
    assert store.mark("done") == -1 and store.read("register").filter("age = 99").isEmpty() is False  # p99
    assert store.read("register").filter("patient_id = 'p3'").first()["age"] == 3
    change()
    assert store.mark("done") == 7 and store.read("register").filter("patient_id = 'p3'").first()["age"] == 99
    store.expire(1)
    assert store.read("register").count() == 200


def test_the_slower_of_two_writers_is_told(spark, store):
    version = store._version()
    version["version"] += 1
    store._publish(dict(version))
    with pytest.raises(Conflict):
        store._publish(version)


def test_empty_parts_and_strays(spark, store):
    gone = spark.createDataFrame([(f"p{i}",) for i in range(200)], "patient_id STRING")
    store.change("register", gone, lambda old, g: old.join(g, "patient_id", "left_anti"))
    assert store.parts("register") == {} and store.read("register").count() == 0
    with pytest.raises(ValueError):
        store.commit({"register": spark.createDataFrame([("a", 1, "x")], SCHEMA)}, {"register": []})


def risk(spark, root, batch, data):
    spark.createDataFrame(data, "patient_id STRING, risk_score DOUBLE, risk_level STRING, ts TIMESTAMP, reading_id BIGINT") \
        .write.parquet(f"{root}/risk/batch_id={batch}")


def test_risk_is_applied_once(spark, tmp_path, monkeypatch):
    import datetime as dt

    root, store = str(tmp_path), Snapshots(spark, str(tmp_path / "store"))
    people = "patient_id STRING, full_name STRING, date_of_birth DATE, gender STRING, active_monitoring BOOLEAN"
    stays = ("admission_id BIGINT, patient_id STRING, admission_time TIMESTAMP, discharge_time TIMESTAMP, department STRING, "
             "initial_diagnosis STRING, risk_level STRING, current_risk_score DOUBLE, updated_at TIMESTAMP")
    store.create("patients", spark.createDataFrame([], people), "patient_id", 8)
    store.create("admissions", spark.createDataFrame([], stays), "patient_id", 8)
    at = dt.datetime(2024, 3, 1)
    risk(spark, root, 0, [("a", 10.0, "STABLE", at, 1), ("b", 50.0, "HIGH", at, 2)])
    fold = lambda: fold_risk(spark, root, store, F.lit("2024-03-02").cast("timestamp"))
    with monkeypatch.context() as patch:
        patch.setattr(store, "_publish", lambda v: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            fold()
    fold()
    assert [(r["patient_id"], r["current_risk_score"]) for r in store.read("admissions").orderBy("patient_id").collect()] == [("a", 10.0), ("b", 50.0)]
    discharged = store.read("admissions", store.touched("admissions", store.read("patients").filter("patient_id = 'a'")))
    parts = store.touched("admissions", discharged)
    store.commit({"admissions": store.read("admissions", parts).withColumn("discharge_time", F.lit(at))}, {"admissions": parts})
    version = fold()
    assert fold() == version and store.read("admissions").count() == 2 and store.read("patients").count() == 2
    risk(spark, root, 1, [("b", 60.0, "HIGH", at, 3)])
    fold()
    again = store.read("admissions").filter("patient_id = 'a'")
    assert again.count() == 1 and store.mark("risk") == 1


def test_latest_in_any_order_and_twice(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    run = keep_latest(store, ["patient_id", "field"], ["sec", "event_id"], parts=4)
    schema = "patient_id STRING, field STRING, sec BIGINT, event_id BIGINT, value DOUBLE"
    data = [(f"p{i % 7}", "f" + str(i % 3), (i * 37) % 100, i, float(i)) for i in range(200)]
    parts = [data[120:], data[:60], data[60:120]]
    for i, part in enumerate(parts):
        run(spark.createDataFrame(part, schema), i)
    run(spark.createDataFrame([("p0", "f0", 10_000, 1, 0.0)], schema), 1)  # a batch that is in the table already
    want = {}
    for row in data:
        want[row[:2]] = max(want.get(row[:2], row), row, key=lambda r: r[2:4])
    assert rows(store.read("latest")) == sorted(want.values(), key=str)


def test_compaction_switches_at_once(spark, tmp_path):
    root, store = str(tmp_path), Snapshots(spark, str(tmp_path / "store"))
    schema = "patient_id STRING, sec BIGINT, value DOUBLE"
    data = [(f"p{i % 5}", (i % 4) * 86_400 + i, float(i)) for i in range(400)]
    for batch in range(20):
        part = spark.createDataFrame(data[batch * 20:batch * 20 + 20], schema).withColumn("ts", F.timestamp_seconds("sec")).drop("sec")
        part.withColumns({"date": F.to_date("ts"), "batch_id": F.lit(batch)}).write.mode("append").partitionBy("date", "batch_id").parquet(f"{root}/points")
    view = lambda days=None: rows(compacted(spark, root, store, "points", days).select("patient_id", "ts", "value"))
    whole = view()
    assert len(whole) == 400
    many = len(spark.read.parquet(f"{root}/points").inputFiles())
    compact(spark, root, store, "points", ["patient_id", "ts"])
    few = store.read("points").inputFiles()
    assert view() == whole and len(few) == 4 < many
    late = spark.createDataFrame([("late", 86_400 * 2, 1.0)], schema).withColumn("ts", F.timestamp_seconds("sec")).drop("sec")
    late.withColumns({"date": F.to_date("ts"), "batch_id": F.lit(20)}).write.mode("append").partitionBy("date", "batch_id").parquet(f"{root}/points")
    assert len(view()) == 401
    compact(spark, root, store, "points", ["patient_id", "ts"])
    assert len(set(few) & set(store.read("points").inputFiles())) == 3 and len(view()) == 401
    days = view(("1970-01-02", "1970-01-03"))
    assert len(days) == 201 and len(store.read_days("points", "1970-01-02", "1970-01-03").inputFiles()) == 2
    assert drop_compacted(spark, root, store, "points") == list(range(21)) and len(view()) == 401
    assert compact(spark, root, store, "points", ["patient_id", "ts"]) == max(store.versions())
