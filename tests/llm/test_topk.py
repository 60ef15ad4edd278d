import math
import random

import pytest
from pyspark.sql import functions as F

from pulseframe.llm import topk

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>"


def wanted(rows, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for n, (i, q) in enumerate(ok):
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, p)), j) for m, (j, p) in enumerate(ok) if m != n and len(p) == len(q))
            for rank, (s, j) in enumerate(scores[:k], 1):
                yield i, rank, j, -s


def made(seed, n, dims, spread):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        length = math.exp(r.gauss(0, spread))
        rows.append((i, [float(round(r.gauss(0, 1) * length * 8) / 8) for _ in range(dims)]))
    return rows


@pytest.mark.parametrize("seed, dims, spread, cosine", [(1, 8, 0.0, 0.5), (2, 3, 1.5, 0.0), (3, 2, 1.0, 0.9), (4, 16, 0.3, 0.2), (5, 1, 0.7, 0.5)])
def test_against_brute_force(spark, monkeypatch, seed, dims, spread, cosine):
    monkeypatch.setattr(topk, "COORDINATE_COSINE", cosine)
    monkeypatch.setattr(topk, "SEED_ROWS", 100)
    rows = made(seed, 600, dims, spread) + [(1000 + i, [1.0] * dims) for i in range(150)]
    rows += [(20, [0.5] * dims), (20, [0.5] * dims), (40, None), (60, []), (61, [None] * dims), (80, [float("nan")] * dims),
             (81, [float("inf")] * dims), (None, [1.0] * dims), (100, [0.0] * dims), (120, [1.0] * (dims + 1)), (121, [2.0] * (dims + 1))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "norm", "v", "query", "bucket")})
    got = [tuple(r) for r in topk.top_k(topk.integer_vectors(docs.repartition(4)), 20, 50, 8).collect()]
    assert sorted(got) == sorted(wanted(rows, 20))


def test_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (20, [0.25, 0.5])]
    got = topk.top_k(topk.integer_vectors(spark.createDataFrame(rows, SCHEMA)), 20)
    assert sorted(map(tuple, got.collect())) == sorted(wanted(rows, 20))
    assert topk.top_k(topk.integer_vectors(spark.createDataFrame([], SCHEMA)), 20).count() == 0
    assert topk.top_k(topk.integer_vectors(spark.createDataFrame([(1, [1.0])], SCHEMA)), 20).count() == 0


def test_cells_that_cannot_win_are_not_formed(spark):
    # Few long vectors hold all results, so the blocks of short ones meet only queries without a bound.
    rows = made(7, 2000, 6, 1.5)
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    asked, candidates = topk.cells(vectors, 5, 100, 10)
    sizes = lambda df: {(r["block"], r["group"]): r["count"] for r in df.groupBy("block", "group").count().collect()}
    blocks, groups = sizes(candidates), sizes(asked)
    all_blocks, all_groups = ({c[i] for c in blocks} for i in (0, 1))
    assert len(all_blocks) >= 20 and len(all_groups) >= 10
    assert set(groups) == set(blocks) and len(blocks) < 0.6 * len(all_blocks) * len(all_groups)
    assert max(blocks.values()) <= 200 and max(groups.values()) <= 40
    got = [tuple(r) for r in topk.top_k(vectors, 5, 100, 10).collect()]
    assert sorted(got) == sorted(wanted(rows, 5))


def test_one_length_and_one_need(spark):
    # Everything ties: one bucket and one level are still dealt to several blocks and groups.
    rows = [(i, [1.0, 1.0]) for i in range(500)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    asked, candidates = topk.cells(vectors, 3, 100, 5)
    assert asked.select("group").distinct().count() > 1 and candidates.select("block").distinct().count() > 1
    got = [tuple(r) for r in topk.top_k(vectors, 3, 100, 5).collect()]
    assert sorted(got) == sorted(wanted(rows, 3))
