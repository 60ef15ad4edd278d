"""Ordered windows give the same values whether or not a key is cut into stretches."""

import random

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.alerts import acknowledge
from pulseframe.operators.ordered import with_ordinal
from pulseframe.operators.rolling import rolling_features, rolling_times


def hot_frame(spark, n=2000, same_time=False):
    rng = random.Random(9)
    rows = [
        (
            "hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}",
            0 if same_time else rng.randrange(10_000),
            i,
            None if rng.random() < 0.1 else round(rng.uniform(40, 160), 2),
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "consumer STRING, sec BIGINT, event_id BIGINT, processing_time_ms DOUBLE")
    return rows, df.withColumn("ts", F.timestamp_seconds("sec")).repartition(6)


@pytest.mark.parametrize("same_time", [False, True])
def test_ordinal_is_dense_and_ordered(spark, same_time):
    rows, df = hot_frame(spark, same_time=same_time)
    got = {r["event_id"]: r["ordinal"] for r in with_ordinal(df, ["consumer", "ts", "event_id"], 9)[0].collect()}
    expected = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    assert [r[2] for r in expected] == sorted(got, key=got.get)
    assert sorted(got.values()) == list(range(len(rows)))


@pytest.mark.parametrize("frame", [1, 7, 100])
@pytest.mark.parametrize("same_time", [False, True])
def test_rolling_times_in_stretches(spark, frame, same_time):
    rows, df = hot_frame(spark, same_time=same_time)
    expected = {}
    series = {}
    for key, sec, eid, value in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        kept = series.setdefault(key, [])
        kept.append(value)
        window = [v for v in kept[-frame:] if v is not None]
        expected[eid] = (min(window), max(window), sum(window) / len(window)) if window else (None,) * 3
    for runs in (None, 30):
        got = rolling_times(df, rows=frame, runs=runs).collect()
        assert len(got) == len(rows)
        for r in got:
            low, high, mean = expected[r["event_id"]]
            assert (r["min_ms"], r["max_ms"]) == (low, high)
            assert r["avg_ms"] == (None if mean is None else pytest.approx(mean))


def test_rolling_features_trend(spark):
    rows = [("p", i * 3600, 60.0 + 2 * i, 95.0) for i in range(5)]
    df = spark.createDataFrame(rows, "patient_id STRING, sec BIGINT, heart_rate DOUBLE, spo2 DOUBLE").withColumn(
        "ts", F.timestamp_seconds("sec")
    )
    last = rolling_features(df, rows=3).orderBy("ts").collect()[-1]
    assert last["heart_rate_mean"] == pytest.approx(66.0)
    assert last["heart_rate_std"] == pytest.approx(2.0)
    assert last["heart_rate_trend"] == pytest.approx(2.0)
    assert last["spo2_trend"] == pytest.approx(0.0)


def test_acknowledge_in_stretches(spark):
    rng = random.Random(2)
    alerts = [("hot" if rng.random() < 0.6 else f"p{rng.randrange(4)}", rng.randrange(500), i) for i in range(900)]
    acks = [("hot" if rng.random() < 0.6 else f"p{rng.randrange(4)}", rng.randrange(500), f"n{i}") for i in range(60)]
    a = spark.createDataFrame(alerts, "patient_id STRING, sec BIGINT, alert_id BIGINT")
    k = spark.createDataFrame(acks, "patient_id STRING, sec BIGINT, acknowledged_by STRING")
    a, k = (d.withColumn("ts", F.timestamp_seconds("sec")).drop("sec") for d in (a, k))
    expected = {}
    for pid, sec, i in alerts:
        later = [(s, by) for p, s, by in acks if p == pid and s >= sec]
        expected[i] = min(later, default=(None, None))
    for runs in (None, 19):
        got = acknowledge(a, k, runs=runs).withColumn("at", F.unix_seconds("acknowledged_at")).collect()
        assert {r["alert_id"]: (r["at"], r["acknowledged_by"]) for r in got} == expected
        assert all(r["acknowledged"] == (r["at"] is not None) for r in got)
