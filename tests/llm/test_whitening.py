import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import whitening
from pulseframe.llm.queries import queries

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>"


def wanted(rows, scale=256):
    """n, S, covariance (each distinct vector once, fractions), integer vectors by row."""
    xs = [(i, tuple(math.floor(np.float64(c) * scale) for c in v)) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in xs), default=0)
    xs = [(i, x + (0,) * (width - len(x))) for i, x in xs]
    fit = sorted({x for _, x in xs})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[Fraction(c) - Fraction(t, n) for c, t in zip(x, s)] for x in fit]
    cov = [[sum(r[i] * r[j] for r in centred) / n for j in range(width)] for i in range(width)]
    return n, s, cov, xs, fit


def made(seed, count, dims):
    r = random.Random(seed)
    base = np.random.default_rng(seed).normal(size=(count, dims)) * np.linspace(1, 3, dims)
    rows = [(r.randrange(count), [float(np.float32(c)) for c in v]) for v in base]
    rows += [rows[0]] * 500 + [(3, None), (4, [None] * dims), (5, [float("nan")] + [1.0] * (dims - 1)), (6, [float("inf")] * dims),
                               (None, [0.5] * dims), (7, [0.0] * dims), (7, [-0.0] * dims)]
    return rows


@pytest.mark.parametrize("seed, count, dims", [(1, 300, 6), (2, 40, 3), (3, 900, 4), (4, 100, 1)])
def test_against_fractions(spark, monkeypatch, seed, count, dims):
    monkeypatch.setattr(whitening, "PLANE_ROWS", 70)
    monkeypatch.setattr(whitening, "PLANE_BYTES", 64)
    rows = made(seed, count, dims)
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("x", "n", "component", "i", "p0")})
    got = whitening.whiten(vectors.repartition(3)).collect()
    n, s, cov, xs, fit = wanted(rows)
    values = np.linalg.eigvalsh(np.array(cov, float))[::-1]
    k = min(4, dims)
    assert len(got) == k * len(xs)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in got if r.component == 1) == sorted(
        (-1 if i is None else i, sum((n * c - t) ** 2 for c, t in zip(x, s))) for i, x in xs)
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    for r in got:
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
    # Whitened values of one row: the squared length by component is that of the projection.
    vectors_ = np.linalg.eigh(np.array(cov, float))[1][:, ::-1]
    for c in range(k):
        mine = sorted((r.deviation, abs(r.whitened)) for r in got if r.component == c + 1)
        brute = sorted((sum((n * a - t) ** 2 for a, t in zip(x, s)),
                        abs(sum(float(Fraction(a) - Fraction(t, n)) * e for a, t, e in zip(x, s, vectors_[:, c]))) / math.sqrt(values[c])) for _, x in xs)
        assert np.allclose([w for _, w in mine], [w for _, w in brute], atol=1e-9)


@pytest.mark.parametrize("bits", [1, 9, 40, 62])
def test_cross_products_are_exact(bits):
    r = random.Random(bits)
    x = np.array([[r.randrange(-2**bits, 2**bits) for _ in range(5)] for _ in range(131)], np.int64)
    s, c = whitening.cross_products(x)
    e = x.astype(object)
    assert (s == e.sum(axis=0)).all() and (c == e.T @ e).all()
    total = int(c[0, 0]) * 10**6 * (-1) ** bits
    assert sum(p << (k * whitening.PIECE_BITS) for k, p in enumerate(whitening._in_pieces(total))) == total


def test_large_values(spark):
    rows = [(0, [1e30, 0.0]), (1, [-1e30, 2.0]), (2, [3.0, -5.0]), (3, [1e9, 1e9])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: r.deviation for r in got}[0] is None and all(r.whitened is not None for r in got if r.component == 1)


def test_degenerate(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [
        (i, c, 1, 0, None, 0.0, None) for i in (1, 2) for c in (1, 2)]
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], SCHEMA)).collect()
    assert {(r.component, r.whitened is None, r.explained) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}
    assert max(r.identity_error for r in flat) < 1e-12
    unlike = [(1, [1.0]), (2, [1.0, 0.0]), (3, [2.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(unlike, SCHEMA)).collect()
    assert {r.n for r in got} == {2} and len(got) == 6


def test_query_on_the_whole_table(spark):
    got = queries()["op12_embedding_whitening"](spark, "/root/testdata/sf0.01").toPandas()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    x = np.floor(np.stack(table["embedding"]).astype(float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 4 * len(x) and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    by_row = got.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    want = (x - s / n) @ vectors[:, :4] / np.sqrt(values[:4])
    sign = np.sign((by_row * want).sum(axis=0))
    assert np.allclose(by_row, want * sign, atol=1e-9)
    assert (got.drop_duplicates("vec_id").set_index("vec_id")["deviation"].loc[table["vec_id"]].to_numpy() == ((n * x - s) ** 2).sum(axis=1)).all()
    assert np.allclose(got.groupby("component")["explained"].max(), values[:4] / values.sum())
