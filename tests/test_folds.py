"""Cleanup and cooldown: hand goldens, brute force, and independence of the cuts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.folds import clean_points, cool_down

LIMITS = {"heart_rate": (30, 200), "spo2": (50, 100)}


def brute_clean(rows):
    last, out = {}, {}
    for pid, field, ts, eid, value in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        if value is None:
            continue
        key = (pid, field)
        lo_hi = LIMITS.get(field)
        if lo_hi and not (lo_hi[0] <= value <= lo_hi[1]):
            if key in last:
                out[eid] = last[key]
            continue
        if key in last and abs(value - last[key]) > (20 if field == "heart_rate" else 5):
            value = last[key] * 0.7 + value * 0.3
        last[key] = out[eid] = value
    return out


def brute_cooldown(rows, wait):
    sent, out = {}, {}
    for pid, kind, ts, eid in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        ok = (pid, kind) not in sent or ts - sent[pid, kind] >= wait
        if ok:
            sent[pid, kind] = ts
        out[eid] = ok
    return out


def points(spark, rows):
    df = spark.createDataFrame(rows, "patient_id STRING, field STRING, sec BIGINT, event_id BIGINT, value DOUBLE")
    return df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec").repartition(5)


def run_clean(spark, rows, **kw):
    got = clean_points(points(spark, rows), **kw).select("event_id", "cleaned").collect()
    assert len({r["event_id"] for r in got}) == len(got)
    return {r["event_id"]: r["cleaned"] for r in got}


def same(a, b):
    return a.keys() == b.keys() and all(
        a[k] == b[k] or (math.isnan(a[k]) and math.isnan(b[k])) for k in a
    )


def test_golden_sequence(spark):
    rows = [("p", "heart_rate", i, i, float(v)) for i, v in enumerate([70, 100, 250, 85])]
    rows += [("p", "etco2", i, 10 + i, v) for i, v in enumerate([10.0, 20.0])]
    rows += [("q", "spo2", 0, 20, 10.0), ("q", "spo2", 1, 21, None), ("q", "spo2", 2, 22, float("nan"))]
    got = run_clean(spark, rows)
    assert got == {0: 70.0, 1: 79.0, 2: 79.0, 3: 85.0, 10: 10.0, 11: 13.0}


def hot_rows(seed, n, make):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        pid = "hot" if rng.random() < 0.6 else f"p{rng.randrange(8)}"
        field = "heart_rate" if pid == "hot" else rng.choice(["heart_rate", "spo2", "etco2"])
        rows.append((pid, field, i // 2, i, make(rng, field)))
    return rows


VALUES = {
    "calm": lambda rng, f: rng.gauss(80, 6),
    "wild": lambda rng, f: rng.uniform(0, 260),
    "spiky": lambda rng, f: rng.choice([31.0, 199.0]),
    "useless": lambda rng, f: 999.0 if rng.random() < 0.995 else 90.0,
    "holes": lambda rng, f: rng.choice([None, float("nan"), 75.0, 140.0, 5.0]),
}


@pytest.mark.parametrize("kind", VALUES)
def test_cleanup_in_runs_equals_brute_force(spark, kind):
    rows = hot_rows(11, 3000, VALUES[kind])
    expected = brute_clean(rows)
    assert same(run_clean(spark, rows), expected)
    assert same(run_clean(spark, rows, runs=20), expected)


def test_cleanup_of_runs_that_never_settle(spark):
    # An alternating series whose two extreme starts come close but need not meet.
    rows = [("hot", "heart_rate", i, i, 40.0 if i % 2 else 190.0) for i in range(400)]
    rows += [("hot2", "unlisted", i, 1000 + i, 40.0 if i % 2 else 190.0) for i in range(400)]
    expected = brute_clean(rows)
    assert same(run_clean(spark, rows, runs=32), expected)


def test_cleanup_of_a_hot_key_at_one_instant(spark):
    rng = random.Random(3)
    rows = [("hot", "spo2", 7, i, rng.uniform(40, 100)) for i in range(900)]
    assert same(run_clean(spark, rows, runs=9), brute_clean(rows))


def alerts(spark, rows):
    df = spark.createDataFrame(rows, "patient_id STRING, alert_type STRING, sec BIGINT, event_id BIGINT")
    return df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec").repartition(5)


def run_cooldown(spark, rows, **kw):
    got = cool_down(alerts(spark, rows), **kw).select("event_id", "passed").collect()
    assert len({r["event_id"] for r in got}) == len(got)
    return {r["event_id"]: r["passed"] for r in got}


def test_cooldown_golden(spark):
    rows = [("p", "a", t, i) for i, t in enumerate([0, 100, 299, 300, 450, 601])]
    got = run_cooldown(spark, rows)
    assert [got[i] for i in range(6)] == [True, False, False, True, False, True]


def times(kind, rng, i):
    return {"dense": i, "sparse": i * rng.randrange(1, 400), "bursts": (i // 40) * 350 + i % 3, "instant": 5}[kind]


@pytest.mark.parametrize("kind", ["dense", "sparse", "bursts", "instant"])
@pytest.mark.parametrize("runs", [60, 5])
def test_cooldown_in_runs_equals_brute_force(spark, kind, runs):
    rng = random.Random(5)
    rows = [
        ("hot" if rng.random() < 0.7 else f"p{rng.randrange(5)}", "a", times(kind, rng, i), i)
        for i in range(2500)
    ]
    expected = brute_cooldown(rows, 300)
    assert run_cooldown(spark, rows) == expected
    assert run_cooldown(spark, rows, runs=runs) == expected


def test_cooldown_of_runs_that_never_settle(spark, monkeypatch):
    from pulseframe.operators import folds

    monkeypatch.setattr(folds.Cooldown, "walk_unknown", lambda self, opened, columns, start, stop: (stop - start, None))
    rows = [("hot", "a", i, i) for i in range(1200)] + [("hot2", "a", i, 5000 + i) for i in range(700)]
    assert run_cooldown(spark, rows, runs=9) == brute_cooldown(rows, 300)


def test_known_vitals_stay_in_range_and_ignore_the_partition_count(spark):
    rows = hot_rows(21, 1500, VALUES["wild"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(run_clean(spark, rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
    field = {r[3]: r[1] for r in rows}
    for event, value in results[0].items():
        low, high = LIMITS.get(field[event], (-math.inf, math.inf))
        assert low <= value <= high


def test_empty_input(spark):
    assert run_clean(spark, []) == {}
    assert run_cooldown(spark, []) == {}
