import pytest
from pyspark.sql import functions as F

from pulseframe.llm import mixing

SCHEMA = "doc_id LONG, source STRING, text STRING"


def wanted(sizes, most=3):
    """Water filling, one stopped source after another."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 50, "c": 1000}, {"a": 3, "b": 2, "c": 1, "d": 1, "e": 400, None: 7},
    {"Z": 10, "a": 1, "é": 5, "": 900}, {"a": 0, "b": 4}, {"only": 12},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source STRING, source_size LONG")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = wanted(sizes)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_plan_and_mixture_agree(spark):
    rows = [(i, f"s{i % 4}" if i % 9 else None, "w " * (i % 23)) for i in range(3000)] + [(7, "s3", None), (7, "s3", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    source_of = {i: source for i, source, _ in rows}
    for source in set(source_of.values()):
        own = [r for r in plan if source_of[r["doc_id"]] == source]
        assert len({r["target"] for r in own}) == 1
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.1)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in plan)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sorted(r[0] for r in mixed.collect()) == sorted(r["doc_id"] for r in plan for _ in range(r["copies"]))
    assert sorted(mixing.mix_plan(docs).collect()) == sorted(plan)


def test_empty_and_clashing(spark):
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, None, None), (1, "a", "x y")], SCHEMA)
    extra = docs.withColumns({c: F.lit("no") for c in ("rate", "copies", "target", "weight", "size", "name", "place")})
    assert mixing.mix(extra).columns == extra.columns
    assert [(r["size"], r["taken"] <= 3 * r["size"]) for r in mixing.mix_plan(extra).orderBy("size").collect()] == [(0, True), (2, True)]
