"""Embedding whitening: exact cross-products from bit planes, then a principal-component transform."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import pa_schema, saved, table_of, vector_matrix

SCALE = 256
COMPONENTS = 4
#: Rows whose bit planes are multiplied at once, and bytes of the intermediate words, about.
PLANE_ROWS = 8_192
PLANE_BYTES = 1 << 22
#: Exact sums leave a task as so many signed pieces of so many bits, so that Spark can add them up as longs.
PIECES, PIECE_BITS = 5, 40
_SUMS = "i INT, j INT, " + ", ".join(f"p{k} LONG" for k in range(PIECES))
_LONG = 2**63


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) with x = floor(scale * component) as little-endian longs.

    Rows whose vector is null or holds null or non-finite entries are left out. Values
    beyond a long become the nearest long.
    """
    schema = "vec_id LONG, x BINARY"
    arrow = pa_schema(vectors.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in vector_matrix(batch.column(1)):
                with np.errstate(over="ignore"):
                    scaled = np.floor(values * scale)
                x = np.clip(scaled, -_LONG, _LONG - 1024).astype("<i8")
                x[scaled >= _LONG] = _LONG - 1
                yield table_of([batch.column(0).take(pa.array(rows)), pa.array([r.tobytes() for r in x], pa.binary())], arrow)

    return vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    ).mapInArrow(run, schema)


def _exact(x: np.ndarray) -> np.ndarray:
    return x.astype(object)


def bit_planes(y: np.ndarray) -> np.ndarray:
    """[plane, dimension, word]: bit planes of unsigned rows, packed across rows into 64-bit words."""
    rows, dims = y.shape
    planes = int(y.max()).bit_length() if y.size else 0
    words = -(-rows // 64)
    out = np.zeros((planes, dims, words * 8), np.uint8)
    for b in range(planes):
        packed = np.packbits(((y >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        out[b, :, :packed.shape[1]] = packed
    return out.view(np.uint64)


def _common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[i, j]: rows in which both bits are set."""
    dims, words = a.shape
    step = max(1, PLANE_BYTES // max(1, 8 * dims * words))
    return np.concatenate([
        np.bitwise_count(a[i:i + step, None, :] & b[None, :, :]).sum(axis=2, dtype=np.int64)
        for i in range(0, dims, step)
    ])


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products over the rows of ``x`` (longs), as integers of any size.

    Each dimension is shifted by its least value; products of its bit planes are weighted
    AND-popcounts; then the shift is taken back.
    """
    rows, dims = x.shape
    least = x.min(axis=0)
    y = x.astype(np.uint64) - least.astype(np.uint64)
    planes = bit_planes(y)
    products, sums = np.zeros((dims, dims), object), np.zeros(dims, object)
    for a, plane in enumerate(planes):
        sums += _exact(np.bitwise_count(plane).sum(axis=1, dtype=np.int64)) << a
        for b in range(a + 1):
            common = _common_bits(plane, planes[b])
            products += _exact(common if a == b else common + common.T) << (a + b)
    least = _exact(least)
    shift = np.outer(least, sums)
    return sums + rows * least, products + shift + shift.T + rows * np.outer(least, least)


def _in_pieces(value: int) -> list[int]:
    out = []
    for _ in range(PIECES - 1):
        out.append(value & ((1 << PIECE_BITS) - 1))
        value >>= PIECE_BITS
    return [*out, value]


class Moments:
    """n, sums S and cross-products C of the fit list, all exact."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]]) -> None:
        self.n, self.sums, self.products = n, sums, products

    def covariance(self) -> np.ndarray:
        """Centred as integers, n*C - S*S', then divided by n squared, each entry rounded once."""
        n, s, c = self.n, self.sums, self.products
        return np.array([[(n * c[i][j] - s[i] * s[j]) / n**2 for j in range(len(s))] for i in range(len(s))], float).reshape(len(s), len(s))


def moments(fit: DataFrame, dims: int) -> Moments:
    """Moments of the ``x`` of all rows; (dims + 1)**2 numbers at most reach the driver."""
    arrow = pa_schema(fit.sparkSession, _SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, dims)
            for start in range(0, len(x), PLANE_ROWS):
                s, c = cross_products(x[start:start + PLANE_ROWS])
                sums, products = sums + s, products + c
            n += len(x)
        if n:
            rows = [(-1, -1, n), *((-1, i, s) for i, s in enumerate(sums))]
            rows += [(i, j, products[i, j]) for i in range(dims) for j in range(i + 1)]
            columns = list(zip(*((i, j, *_in_pieces(int(v))) for i, j, v in rows)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    pieces = [F.sum(f"p{k}").alias(f"p{k}") for k in range(PIECES)]
    found = fit.select("x").mapInArrow(run, _SUMS).groupBy("i", "j").agg(*pieces).collect()
    total = {(r["i"], r["j"]): sum(r[f"p{k}"] << (k * PIECE_BITS) for k in range(PIECES)) for r in found}
    sums = [total.get((-1, i), 0) for i in range(dims)]
    products = [[total.get((max(i, j), min(i, j)), 0) for j in range(dims)] for i in range(dims)]
    return Moments(total.get((-1, -1), 0), sums, products)


class Whitening:
    """The transform fitted on the moments: the first components by falling eigenvalue."""

    def __init__(self, fitted: Moments, components: int = COMPONENTS) -> None:
        self.n, self.sums = fitted.n, fitted.sums
        covariance = fitted.covariance()
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        values, self.vectors = values[order], vectors[:, order]
        trace, largest = float(np.trace(covariance)), float(values[0]) if len(values) else 0.0
        # A component without variance beyond rounding has no whitened value.
        real = values > largest * len(covariance) * np.finfo(float).eps
        self.scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), np.nan)
        self.explained = np.where(trace > 0, np.maximum(values, 0) / (trace or 1.0), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: longs where all fit, else integers of any size."""
        largest = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        if self.n * largest + max(map(abs, self.sums), default=0) < _LONG:
            return x * self.n - np.array(self.sums, np.int64)
        return _exact(x) * self.n - np.array(self.sums, object)

    def deviation(self, centred: np.ndarray) -> list[int | None]:
        """Sum of the squares, exact; None beyond a long."""
        largest = max(abs(int(centred.min())), abs(int(centred.max()))) if centred.size else 0
        if largest * largest * centred.shape[1] < _LONG:
            return (centred * centred).sum(axis=1).tolist()
        exact = (_exact(centred) ** 2).sum(axis=1)
        return [int(d) if d < _LONG else None for d in exact]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.vectors * self.scale


def _identity_error(fit: DataFrame, white: Whitening, dims: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, by centred co-moments."""
    real = np.nonzero(np.isfinite(white.scale))[0].tolist()
    if not real:
        return None
    schema = ", ".join(f"w{c} DOUBLE" for c in real)
    arrow = pa_schema(fit.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, dims)
            w = white.whitened(white.centred(x))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, c]) for c in real], schema=arrow)

    pairs = [(a, b) for a in real for b in real if b <= a]
    row = fit.select("x").mapInArrow(run, schema).agg(*(F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs)).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(row, pairs))


def whiten(vectors: DataFrame, scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    The transform is fitted on each distinct integer vector once: one pass over the
    deduplicated vectors, and numbers by dimension only on the driver. ``whitened`` is the
    centred vector on the component over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of all variance, ``identity_error`` measured on the whole fit list.

    Vectors that are null or hold null or non-finite entries are left out; a null vec_id
    stays null. Repeated vectors get rows each and count once in the fit; repeated ids are
    rows of their own. Vectors of fewer entries than the longest count as zero beyond
    their end. A component without variance has null as ``whitened`` and 0 as
    ``explained``; there are no more components than dimensions. ``deviation`` is null
    where it exceeds a long. Other columns do not matter. An empty table gives an empty
    result.
    """
    spark = vectors.sparkSession
    schema = ("vec_id LONG, component INT, n LONG, deviation LONG, whitened DOUBLE, explained DOUBLE, "
              "identity_error DOUBLE")
    arrow = pa_schema(spark, schema)
    rows = saved(integer_vectors(vectors, scale), "integers")
    shortest, longest = rows.agg(F.min(F.length("x")), F.max(F.length("x"))).first()
    if not longest:
        return spark.createDataFrame([], schema)
    if shortest != longest:
        rows = rows.withColumn("x", F.expr(f"rpad(x, {longest}, X'00')"))
    dims = longest // 8
    # Equal vectors are reduced in the map tasks first, so a vector that is very common is no one task's work.
    fit = saved(rows.select("x").distinct(), "fit")
    white = Whitening(moments(fit, dims), components)
    error = _identity_error(fit, white, dims)
    count = len(white.scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8").reshape(-1, dims)
            centred = white.centred(x)
            w = white.whitened(centred).ravel()
            each = np.repeat(np.arange(len(x)), count)
            yield table_of([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(w), white.n)), pa.array(white.deviation(centred), pa.int64()).take(pa.array(each)),
                pa.array(w, mask=np.isnan(w)), pa.array(np.tile(white.explained, len(x))),
                pa.array([error] * len(w), pa.float64()),
            ], arrow)

    return rows.mapInArrow(run, schema)
