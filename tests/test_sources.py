"""Clinical files, messages, points, tracks and audit rows."""

import json

import pytest
from pyspark.sql import functions as F

from pulseframe import schemas
from pulseframe.functions.numbers import general_float, plain_decimal
from pulseframe.functions.patients import case_key, name_from_id, patient_key
from pulseframe.operators import cohorts as c
from pulseframe.plans import queries
from pulseframe.sources import clinical, points, tables, topics, tracks


@pytest.fixture
def cases(spark):
    rows = [
        (1, "73", 6.0, 0, 0, 0, 0, 21600, "Lung wedge resection", "Thoracic surgery"),
        (2, "8", 2.0, 0, 0, 0, 0, 3600, "Appendectomy", "General surgery"),
        (3, ">89", 4.0, 3, 1, 0, 0, 7200, "Liver TRANSPLANTATION", "General surgery"),
        (4, None, None, None, None, None, 0, None, None, None),
        (5, "71", 1.0, 0, 0, 0, 0, 100, "Aortic repair", "General surgery"),
    ]
    names = ["caseid", "age", "asa", "icu_days", "emop", "death_inhosp", "casestart", "caseend", "opname", "department"]
    schema = ", ".join(f"{n} {schemas.CLINICAL_CASE[n].dataType.simpleString()}" for n in names)
    df = spark.createDataFrame(rows, schema)
    missing = [f for f in schemas.CLINICAL_CASE.fields if f.name not in names]
    full = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return full.select(*schemas.CLINICAL_CASE.names)


def test_case_file_round_trip(spark, cases, tmp_path):
    path = str(tmp_path / "cases")
    clinical.write_cases(cases, path)
    back = clinical.read_cases(spark, path)
    assert len(back.columns) == 74 and back.schema["age"].dataType.simpleString() == "string"
    assert sorted(back.collect(), key=lambda r: r["caseid"]) == sorted(cases.collect(), key=lambda r: r["caseid"])


def test_icu_like_and_order(cases):
    kept = c.by_case_risk(c.icu_like_cases(cases)).collect()
    assert {r["caseid"] for r in kept} == {3, 1, 5}
    assert kept[0]["caseid"] == 3 and kept[0]["age"] == 0.0 and kept[0]["icu_risk_score"] == 26.0
    critical = cases.filter(c.cohort_rules()["critical"])
    assert [r["caseid"] for r in c.by_severity(critical).collect()] == [1, 3]
    assert [r["caseid"] for r in c.by_severity(cases.filter("asa < 3").unionByName(cases.filter("caseid = 2").withColumns({"age": F.lit("79"), "caseid": F.lit(9)}))).collect()] == [2, 9, 5]


def test_cohorts_in_one_pass(spark, cases, tmp_path):
    rules = c.cohort_rules()
    counts = {r["cohort"]: r["n"] for r in c.cohort_counts(cases, rules).collect()}
    assert counts == {"critical": 2, "transplant": 1, "cardio": 1, "long_surgery": 1}
    path = str(tmp_path / "cohorts")
    clinical.write_cohorts(cases, rules, path)
    back = spark.read.option("header", True).csv(path)
    assert {(r["cohort"], r["caseid"]) for r in back.collect()} == {
        ("critical", "1"), ("critical", "3"), ("transplant", "3"), ("cardio", "1"), ("long_surgery", "1")
    }


def test_packed_case_files(spark, cases, tmp_path, monkeypatch):
    """Packed files hold the same cases, and only so many each that they can be read in parallel."""
    monkeypatch.setattr(clinical, "MOST_PACKED", 2)
    clinical.write_cases(cases.coalesce(1), str(tmp_path / "cases"), "gzip")
    clinical.write_cohorts(cases, c.cohort_rules(), str(tmp_path / "cohorts"), "gzip")
    files = sorted((tmp_path / "cases").glob("part-*"))
    assert len(files) == -(-cases.count() // 2) and all(f.name.endswith(".csv.gz") for f in files)
    plain = spark.read.option("header", True).csv(str(tmp_path / "cohorts"))
    assert {(r["cohort"], r["caseid"]) for r in plain.collect()} == {
        ("critical", "1"), ("critical", "3"), ("transplant", "3"), ("cardio", "1"), ("long_surgery", "1")}


def test_case_numbers_beyond_int(spark, tmp_path):
    """Case numbers are longs: made, written, read and filed whole on tables with many order keys."""
    rows = [(54_000_000 + i, 7, i % 7 + 1, float(i % 50 + 1), 1.5 * i, "R" if i % 3 else "N", "F" if i % 2 else "O") for i in range(40)]
    spark.createDataFrame(
        rows, "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, l_linestatus STRING"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    cases = {o * 100 + n * 10 + 7: (n % 6 + 1, str(int(q) + 40), q * 600, flag, status) for o, _, n, q, _, flag, status in rows}
    filed = queries()["clinical_files"](spark, str(tmp_path)).collect()
    assert sorted((r["caseid"], r["asa"], r["age"], r["caseend"]) for r in filed) == sorted((k, *v[:3]) for k, v in cases.items())
    wanted = [
        (cohort, k, asa, age)
        for k, (asa, age, end, flag, status) in cases.items()
        for cohort, is_in in {"critical": asa >= 4, "transplant": status == "F", "cardio": flag == "R", "long_surgery": end >= 21600}.items()
        if is_in
    ]
    assert sorted(map(tuple, queries()["cohort_files"](spark, str(tmp_path)).collect())) == sorted(wanted)
    numbers = spark.createDataFrame([(2**31 + 5,)], "caseid BIGINT").select(
        *(F.col("caseid") if f.name == "caseid" else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.CLINICAL_CASE.fields))
    clinical.write_cases(numbers, str(tmp_path / "cases"))
    assert clinical.read_cases(spark, str(tmp_path / "cases")).first()["caseid"] == 2**31 + 5


TEXTS = ["98.5", "-5", "1e3", "12d", "abc", ".5", "5.", "1_000", "", " 7 ", "nan", "-inf", "1__0", "."]


def test_number_texts(spark):
    def python_float(text):
        try:
            return float(text)
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in TEXTS], "t STRING")
    rows = df.select(general_float(F.col("t")).alias("g"), plain_decimal(F.col("t")).alias("p")).collect()
    for text, r in zip(TEXTS, rows):
        assert str(r["g"]) == str(python_float(text)), text
        assert r["p"] == (float(text) if text.replace(".", "", 1).isdigit() else None), text


def decoded(spark, *messages, **kw):
    df = spark.createDataFrame([(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)], "i INT, value STRING")
    return topics.decode(df, **kw)


def test_flatten_shapes(spark):
    cases = [
        ({"heart_rate": 80, "spo2": "98.5"}, {"heart_rate": 80.0, "spo2": 98.5}),
        ({"heart_rate": {"value": 70}, "note": "x"}, {"heart_rate": 70.0}),
        ({"blood_pressure": "120/80"}, {"blood_pressure_systolic": 120.0, "blood_pressure_diastolic": 80.0}),
        ({"blood_pressure": "120"}, {}),
        ({"blood_pressure": {"systolic": 120}}, {"blood_pressure_systolic": 120.0}),
        ({"bp_systolic": 110, "blood_pressure": {"systolic": 120, "diastolic": 70}}, {"blood_pressure_systolic": 110.0, "blood_pressure_diastolic": 70.0}),
        ({"bp_systolic": 110, "blood_pressure_systolic": 111}, {"blood_pressure_systolic": 111.0}),
        ({"heart_rate": None, "spo2": [1], "x": True, "y": False}, {"x": 1.0, "y": 0.0}),
        ({"heart_rate": "-5", "spo2": "1e3", "z": -5, "w": 1e3}, {"z": -5.0, "w": 1000.0}),
        ({"t": "true", "u": "12d"}, {}),
    ]
    rows = decoded(spark, *({"vital_signs": v} for v, _ in cases), for_cleaning=False).orderBy("i").collect()
    for r, (_, wanted) in zip(rows, cases):
        assert r["vitals"] == wanted and r["patient_id"] == "Unknown"
    wide = decoded(spark, {"vital_signs": {"heart_rate": "-5", "spo2": "1e3"}}).first()
    assert wide["vitals"] == {"heart_rate": -5.0, "spo2": 1000.0}


def test_quarantine(spark):
    df = decoded(spark, {"patient_id": "p", "vital_signs": {"heart_rate": 1}}, "{broken", "[1]", {"patient_id": "p"}, {"vital_signs": {}}, {"vital_signs": 3})
    valid, rejected = topics.split_valid(df)
    assert [r["i"] for r in valid.collect()] == [0]
    assert {r["i"]: r["reason"] for r in rejected.collect()} == {
        1: topics.MALFORMED, 2: topics.MALFORMED, 3: topics.NO_VITALS, 4: topics.NO_VITALS, 5: topics.NO_VITALS
    }


def test_publish_round_trip_and_counts(spark):
    df = spark.createDataFrame([("ICU-000007", 80.0), (None, 70.0)], "patient_id STRING, heart_rate DOUBLE").select(
        "patient_id", F.lit("2024-01-01T00:00:00Z").alias("timestamp"), F.struct("heart_rate").alias("vital_signs")
    )
    sent, seen = topics.counted(topics.encode(df, "readings", F.lit("2024-01-01").cast("timestamp")))
    rows = {r["key"]: json.loads(r["value"]) for r in sent.collect()}
    assert seen.get == {"total": 2, "successful": 2, "failed": 0}
    assert set(rows) == {"ICU-000007", "unknown"}
    assert rows["ICU-000007"]["producer_metadata"] == {"sent_at": "2024-01-01T00:00:00.000000Z", "topic": "readings"}
    back = topics.decode(topics.encode(df, "readings", F.current_timestamp())).collect()
    assert sorted(r["vitals"]["heart_rate"] for r in back) == [70.0, 80.0]


def test_points_append_and_prune(spark, tmp_path):
    df = spark.createDataFrame(
        [("p", "2024-01-01 10:00:00", {"heart_rate": 80.0, "spo2": 97.0}), ("p", None, {"spo2": 96.0}), ("q", "2024-01-03 10:00:00", {})],
        "patient_id STRING, at STRING, vitals MAP<STRING, DOUBLE>",
    ).select("patient_id", F.col("at").cast("timestamp").alias("ts"), "vitals")
    made = points.to_points(df, F.lit("2024-01-02").cast("timestamp"))
    path = str(tmp_path / "points")
    points.append_points(made, path)
    points.append_points(made.limit(0), path)
    table = spark.read.parquet(path)
    assert table.count() == 3 and {r["device_id"] for r in table.collect()} == {"unknown"}
    day = points.points_between(table, F.lit("2024-01-02").cast("timestamp"), F.lit("2024-01-02 12:00").cast("timestamp"))
    assert [r["value"] for r in day.collect()] == [96.0]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_track_grid_and_candidates(spark):
    nan = float("nan")
    rows = [(1, 0.2, "SNUADC/HR", nan), (1, 0.3, "Solar8000/HR", 81.0), (1, 0.1, "Solar8000/PLETH_SPO2", 97.0), (1, 0.9, "Solar8000/PLETH_SPO2", 98.0),
            (1, 1.5, "SNUADC/HR", 70.0), (1, 1.6, "Solar8000/HR", 71.0), (2, 0.0, "SNUADC/HR", 60.0)]
    grid = tracks.to_grid(spark.createDataFrame(rows, schemas.TRACK_SAMPLE), tracks.all_tracks())
    vitals = {(r["case_id"], r["second"]): r for r in tracks.coalesce_tracks(grid).collect()}
    assert (vitals[1, 0]["heart_rate"], vitals[1, 0]["spo2"]) == (81.0, 98.0)
    assert (vitals[1, 1]["heart_rate"], vitals[1, 1]["spo2"]) == (70.0, None)
    assert [(r["case_id"], r["second"]) for r in tracks.replayable(tracks.coalesce_tracks(grid)).collect()] == [(1, 0)]


def test_ids(spark):
    df = spark.createDataFrame([("ICU-003962",), ("P001",), ("ICU-x",), (None,)], "p STRING")
    rows = df.select(case_key(F.col("p")).alias("k"), name_from_id(F.col("p")).alias("n")).collect()
    assert [r["k"] for r in rows] == [3962, None, None, None]
    assert [r["n"] for r in rows] == ["Patient 003962", "Patient P001", "Patient x", None]
    assert spark.range(1).select(patient_key(F.lit(3962))).first()[0] == "ICU-003962"


def test_audit_error_is_clipped(spark):
    df = spark.createDataFrame([("p", "e" * 600, None)], "patient_id STRING, reason STRING, body STRING").withColumn("timestamp", F.current_timestamp())
    row = tables.audit_errors(df, data="body").first()
    assert len(row["error_message"]) == 500 and row["event_data"] == "{}"
    kept = tables.conform(tables.audit_errors(df), schemas.AUDIT_LOGS).schema
    assert [(f.name, f.dataType) for f in kept] == [(f.name, f.dataType) for f in schemas.AUDIT_LOGS]
