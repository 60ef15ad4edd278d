import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import vantage
from pulseframe.llm.queries import queries

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>"


def wanted(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    for n, (i, q) in enumerate(ok):
        if i % every == 0:
            far = sorted((float(np.sqrt(((q - p) ** 2).sum())), j) for m, (j, p) in enumerate(ok) if m != n and len(p) == len(q))
            for rank, (d, j) in enumerate(far[:k], 1):
                yield i, rank, j, d


def made(seed, n, dims, centres):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(centres, dims)) * 4
    return [(i, [float(np.float32(c)) for c in middle[r.integers(centres)] + r.normal(size=dims)]) for i in range(n)]


def same(got, want):
    got, want = sorted(got), sorted(want)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
    assert [g[2] for g in got] == [w[2] for w in want]


@pytest.mark.parametrize("seed, dims, centres", [(1, 8, 5), (2, 2, 40), (3, 1, 3), (4, 24, 1)])
def test_factor_one_is_exact(spark, monkeypatch, seed, dims, centres):
    for name, value in (("LEAF", 16), ("TOGETHER", 7), ("SHARD_QUERIES", 5), ("SAMPLE", 64)):
        monkeypatch.setattr(vantage, name, value)
    monkeypatch.setattr(vantage.Tree.__init__, "__defaults__", (16,))
    rows = made(seed, 900, dims, centres)
    # A third of all rows is one vector, and nearly one vector.
    rows += [(2000 + i, [1.0] * dims) for i in range(250)] + [(3000 + i, [1.0] * (dims - 1) + [float(np.float32(1.0 + i / 1e6))]) for i in range(150)]
    rows += [(20, [0.5] * dims), (20, [0.5] * dims), (40, None), (60, []), (61, [None] * dims), (80, [float("nan")] * dims),
             (81, [float("inf")] * dims), (None, [1.0] * dims), (100, [0.0] * dims), (120, [1.0] * (dims + 1)), (121, [2.0] * (dims + 1))]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "v", "query", "region", "reach", "dims", "piece")})
    got = vantage.nearest(vectors.repartition(4), k=10, query_every=20, factor=1.0, shard_rows=100)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    same(map(tuple, got.collect()), wanted(rows, 10, 20))


def test_pruning_and_recall(spark):
    """A larger factor asks fewer shards and still finds most."""
    rows = made(5, 4000, 6, 60)
    asked = {}
    search = vantage._search

    def counted(points, queries, k, factor):
        asked[factor] = asked.get(factor, 0) + queries.count()
        return search(points, queries, k, factor)

    vantage._search = counted
    try:
        found = {f: vantage.nearest(spark.createDataFrame(rows, SCHEMA), 10, 20, f, 200).collect() for f in (1.0, vantage.FACTOR, 50.0)}
    finally:
        vantage._search = search
    want = {(i, j) for i, _, j, _ in wanted(rows, 10, 20)}
    recall = {f: len({(r[0], r[2]) for r in got} & want) / len(want) for f, got in found.items()}
    assert recall[1.0] == 1.0 and recall[vantage.FACTOR] >= 0.9 and recall[50.0] < recall[vantage.FACTOR]
    assert asked[50.0] < asked[vantage.FACTOR] < asked[1.0] < 200 + 200 * 20


def test_few_none_and_large(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (100, [0.25, 0.5])]
    same(map(tuple, vantage.nearest(spark.createDataFrame(rows, SCHEMA)).collect()), wanted(rows, 10, 100))
    assert vantage.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vantage.nearest(spark.createDataFrame([(0, [1.0])], SCHEMA)).count() == 0
    huge = [(0, [1e200, 1.0]), (1, [-1e200, 1.0]), (2, [1e200, 2.0])]
    got = vantage.nearest(spark.createDataFrame(huge, "vec_id LONG, embedding ARRAY<DOUBLE>")).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 1.0), (1, math.inf)]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_on_the_whole_table(spark, sf):
    got = queries()["op11_vantage_neighbours"](spark, f"/root/testdata/{sf}").collect()
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas()
    want = list(wanted([(int(i), v.tolist()) for i, v in zip(table["vec_id"], table["embedding"])], 10, 100))
    assert len(got) == len(want)
    found, there = {(r[0], r[2]): r[3] for r in got}, {(i, j): d for i, _, j, d in want}
    assert len(found.keys() & there.keys()) >= 0.9 * len(there)
    assert all(math.isclose(found[x], there[x], rel_tol=1e-12) for x in found.keys() & there.keys())
