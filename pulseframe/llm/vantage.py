"""Approximate nearest neighbours: vantage-point trees per shard, pruned by a relaxed triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.common import pa_schema, saved, table_of, vector_matrix

K = 10
#: A branch is skipped if its least possible distance times this exceeds the k-th found; 1 is exact.
FACTOR = 2.0
#: Vectors that the split of the space into regions is fitted on, at most, and its most regions.
SAMPLE = 8_192
REGIONS = 1_024
#: Vectors of a shard, about; queries that meet one copy of a shard; points of a leaf.
SHARD_ROWS = 16_384
SHARD_QUERIES = 65_536
LEAF = 256
#: Queries that walk a tree together.
TOGETHER = 1_024

_VECTORS = "row LONG, vec_id LONG, dims INT, query BOOLEAN, v BINARY"
_FOUND = "row LONG, query_id LONG, vec_id LONG, score DOUBLE"
#: Slack for bounds from rounded distances.
_SLACK = 1e-9


def usable_vectors(vectors: DataFrame, query_every: int) -> DataFrame:
    """Rows of _VECTORS: vectors as little-endian doubles, without those that take no part.

    Null, empty and zero vectors, those with null or non-finite components, and rows
    without a vec_id take no part. Rows whose vec_id is divisible by ``query_every`` are
    queries.
    """
    arrow = pa_schema(vectors.sparkSession, _VECTORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            for rows, values in vector_matrix(batch.column(2)):
                some = values.any(axis=1)
                rows, values = rows[some], values[some].astype("<f8")
                yield table_of([
                    batch.column(0).take(pa.array(rows)), pa.array(ids[rows]),
                    pa.array(np.full(len(rows), values.shape[1])), pa.array(ids[rows] % query_every == 0),
                    pa.array([v.tobytes() for v in values], pa.binary())], arrow)

    return vectors.filter("vec_id IS NOT NULL").select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<double>"),
    ).mapInArrow(run, _VECTORS)


def _matrix(rows, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f8").reshape(-1, dims)


def _distances(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(((points - point) ** 2).sum(axis=1))


def _beyond(bound: np.ndarray, reach: np.ndarray, factor: float) -> np.ndarray:
    """Whether a branch whose points are at least ``bound`` away may be skipped."""
    return factor * bound * (1 - _SLACK) > reach


class Regions:
    """The top of the tree: vantage points and radii that deal all vectors to regions.

    Fitted on a sample; a vector lies inside a node's radius or outside it, so the
    triangle bound holds for all vectors, sampled or not.
    """

    def __init__(self, sample: np.ndarray, regions: int) -> None:
        self.count = 0
        self._root = self._grow(sample, max(1, regions))

    def _grow(self, points: np.ndarray, regions: int):
        if regions > 1 and len(points) > 2:
            point = points[len(points) // 2]
            far = _distances(points, point)
            radius = float(np.median(far))
            inside = far <= radius
            if inside.any() and not inside.all():
                return (point, radius, self._grow(points[inside], (regions + 1) // 2),
                        self._grow(points[~inside], regions // 2))
        self.count += 1
        return self.count - 1

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        stack = [(self._root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not isinstance(node, tuple):
                out[rows] = node
            elif len(rows):
                inside = _distances(points[rows], node[0]) <= node[1]
                stack += [(node[2], rows[inside]), (node[3], rows[~inside])]
        return out

    def reached(self, queries: np.ndarray, reach: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, region): the regions that each query's ball may reach."""
        found = []
        stack = [(self._root, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            if not isinstance(node, tuple):
                found.append((rows, node))
            elif len(rows):
                beside = _distances(queries[rows], node[0]) - node[1]
                stack += [(node[2], rows[~_beyond(beside, reach[rows], factor)]),
                          (node[3], rows[~_beyond(-beside, reach[rows], factor)])]
        return (np.concatenate([r for r, _ in found]).astype(np.int64),
                np.concatenate([np.full(len(r), n, np.int32) for r, n in found]))


class Best:
    """The k nearest found so far of some queries: by distance, then id."""

    def __init__(self, queries: np.ndarray, own_rows: np.ndarray, reach: np.ndarray, k: int) -> None:
        self.queries, self.own_rows, self.reach, self.k = queries, own_rows, reach.copy(), k
        self.squares = (queries * queries).sum(axis=1)
        self.far = np.full((len(queries), k), np.inf)
        self.ids = np.zeros((len(queries), k), np.int64)
        self.filled = np.zeros(len(queries), np.int64)

    def meet(self, rows: np.ndarray, points: np.ndarray, squares: np.ndarray, ids: np.ndarray, point_rows: np.ndarray) -> None:
        """Compare queries with points; products find those in reach, differences give the distances."""
        with np.errstate(over="ignore", invalid="ignore"):
            near = self.squares[rows, None] + squares[None, :] - 2 * (self.queries[rows] @ points.T)
            limit = self.reach[rows, None] ** 2 + _SLACK * (self.squares[rows, None] + squares[None, :])
            q, p = np.nonzero(~(near > limit) & (point_rows[None, :] != self.own_rows[rows, None]))
        if not len(q):
            return
        q = rows[q]
        far = np.concatenate([_distances(self.queries[q[i:i + 8192]], points[p[i:i + 8192]]) for i in range(0, len(q), 8192)])
        keep = far <= self.reach[q]
        q, far, id_ = q[keep], far[keep], ids[p[keep]]
        hit = np.unique(q)
        old, place = np.nonzero(np.arange(self.k)[None, :] < self.filled[hit, None])
        q, far, id_ = (np.concatenate(x) for x in (
            (hit[old], q), (self.far[hit[old], place], far), (self.ids[hit[old], place], id_)))
        order = np.lexsort((id_, far, q))
        q, far, id_ = q[order], far[order], id_[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        keep = place < self.k
        q, far, id_, place = q[keep], far[keep], id_[keep], place[keep]
        self.far[q, place], self.ids[q, place] = far, id_
        self.filled[hit] = np.bincount(np.searchsorted(hit, q), minlength=len(hit))
        full = hit[self.filled[hit] == self.k]
        self.reach[full] = np.minimum(self.reach[full], self.far[full, -1])


class Tree:
    """A vantage-point tree over the points of a shard."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> None:
        order = np.arange(len(points))
        self._leaf, self._points = leaf, points
        self._ids, self._rows = ids, rows
        self._squares = (points * points).sum(axis=1)
        self._root = self._grow(order)

    def _grow(self, own: np.ndarray):
        if len(own) > self._leaf:
            point = self._points[own[len(own) // 2]]
            far = _distances(self._points[own], point)
            inside = far <= np.median(far)
            if inside.all():
                inside = far < far.max()
            if inside.any() and not inside.all():
                # The greatest distance inside and the least outside bound tighter than one radius.
                return (point, float(far[inside].max()), float(far[~inside].min()),
                        self._grow(own[inside]), self._grow(own[~inside]))
        return self._points[own], self._squares[own], self._ids[own], self._rows[own]

    def search(self, best: Best, factor: float) -> None:
        self._walk(self._root, np.arange(len(best.queries)), best, factor)

    def _walk(self, node, rows: np.ndarray, best: Best, factor: float) -> None:
        if not len(rows):
            return
        if len(node) == 4:
            for start in range(0, len(node[0]), 4 * self._leaf):
                best.meet(rows, *(x[start:start + 4 * self._leaf] for x in node))
            return
        point, inner, outer, inside, outside = node
        far = _distances(best.queries[rows], point)
        near_first = far <= (inner + outer) / 2
        # Each query goes to its nearer side first, so that the other one is judged by a tighter reach.
        self._walk(inside, rows[near_first], best, factor)
        self._walk(outside, rows[~near_first], best, factor)
        reach = best.reach[rows]
        self._walk(outside, rows[near_first & ~_beyond(outer - far, reach, factor)], best, factor)
        self._walk(inside, rows[~near_first & ~_beyond(far - inner, reach, factor)], best, factor)


def _searched(rows: Iterator[pa.RecordBatch], k: int, factor: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, vec_id, score, place) of queries against their shards.

    Rows come shard by shard, first the shard's points, then its queries: a task holds one
    shard and a batch of queries at a time.
    """
    now, tree, held = None, None, []
    for batch in rows:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
        asks = batch.column(4).to_numpy(zero_copy_only=False)
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or asks[i] != asks[i - 1]]
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            if keys[start] != now:
                now, tree, held = keys[start], None, []
            own_rows, ids = (batch.column(i)[start:end].to_numpy(zero_copy_only=False) for i in (5, 6))
            values = _matrix(batch.column(7)[start:end].to_pylist(), now[0])
            if not asks[start]:
                held.append((values, ids, own_rows))
                continue
            if tree is None and held:
                tree = Tree(*(np.concatenate(x) for x in zip(*held)))
                held = []
            if tree is None:
                continue
            reach = batch.column(8)[start:end].to_numpy(zero_copy_only=False)
            for i in range(0, end - start, TOGETHER):
                best = Best(values[i:i + TOGETHER], own_rows[i:i + TOGETHER], reach[i:i + TOGETHER], k)
                tree.search(best, factor)
                q, place = np.nonzero(np.arange(k)[None, :] < best.filled[:, None])
                yield own_rows[i:i + TOGETHER][q], ids[i:i + TOGETHER][q], best.ids[q, place], best.far[q, place]


_SHARD = ["dims", "region", "piece"]


def _search(points: DataFrame, asked: DataFrame, k: int, factor: float) -> DataFrame:
    """Rows of _FOUND of queries (_SHARD, row, vec_id, v, reach) against the points of their shards.

    Only shards that are asked are shuffled; a shard with very many queries is copied, so
    that its queries are dealt to several tasks.
    """
    asks = asked.groupBy(*_SHARD).agg(F.ceil(F.count("*") / SHARD_QUERIES).cast("int").alias("copies"))
    part = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part")
    rows = ["row", "vec_id", "v"]
    there = points.join(asks, _SHARD).select(*_SHARD, part, F.lit(False).alias("asks"), *rows, F.lit(0.0).alias("reach"))
    own = asked.join(asks, _SHARD).select(
        *_SHARD, F.pmod(F.xxhash64("row"), F.col("copies")).cast("int").alias("part"), F.lit(True).alias("asks"), *rows, "reach")
    key = [*_SHARD, "part"]
    arrow = pa_schema(points.sparkSession, _FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _searched(batches, k, factor):
            yield table_of([pa.array(x) for x in found], arrow)

    return there.union(own).repartition(*key).sortWithinPartitions(*key, "asks").mapInArrow(run, _FOUND)


def nearest(
    vectors: DataFrame, k: int = K, query_every: int = 100, factor: float = FACTOR, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k nearest found of all other rows.

    Nearness is the Euclidean distance of the original vectors in double precision; ties
    go to the smaller vec_id. ``factor`` relaxes the triangle inequality: a branch is
    skipped if its least possible distance times ``factor`` exceeds the k-th distance
    found, so 1 is exact and more is faster and may miss some.

    Every usable row is indexed: vantage points fitted on a bounded sample deal all rows
    to regions; regions are cut by hash into shards of about ``shard_rows`` rows, so equal
    or very close vectors never make one large shard; each shard grows its own tree. A
    query is first searched in the shard where it lies, which gives it a reach, and then
    only in the shards of those regions that its reach touches.

    Null, empty and zero vectors and those with null or non-finite components take no
    part, nor do rows without a vec_id. Rows that repeat a vec_id are rows of their own,
    and a repeated query is answered each time; vectors are compared with those of as many
    components only. Distances beyond a double are infinite. Other columns do not matter.
    An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    usable = saved(usable_vectors(vectors, query_every), "vectors")
    total = usable.count()
    picked = usable.filter(F.pmod(F.xxhash64("row"), F.lit(max(1, total // SAMPLE))) == 0).limit(2 * SAMPLE).select("dims", "v").toPandas()
    wanted = min(REGIONS, -(-total // shard_rows))
    regions = {int(d): Regions(_matrix(own["v"], int(d)), wanted) for d, own in picked.groupby("dims")}

    placed_schema = f"{_VECTORS}, region INT"
    placed_arrow = pa_schema(spark, placed_schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            region = np.zeros(len(dims), np.int32)
            for d in np.unique(dims):
                if d in regions:
                    own = np.nonzero(dims == d)[0]
                    region[own] = regions[d].home(_matrix(batch.column(4).take(pa.array(own)).to_pylist(), d))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], schema=placed_arrow)

    placed = saved(usable.mapInArrow(place, placed_schema), "placed")
    # One row for each of at most REGIONS regions of a dimension.
    sizes = placed.groupBy("dims", "region").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("pieces"))
    points = placed.join(sizes, ["dims", "region"]).withColumn("piece", F.pmod(F.xxhash64("row"), "pieces").cast("int"))
    queries = points.filter("query")
    first = saved(_search(points, queries.withColumn("reach", F.lit(float("inf"))), k, factor), "at_home")

    # The k-th distance at home, if there are k.
    reach = first.groupBy("row").agg(
        F.when(F.count("*") == k, F.max("score")).otherwise(F.lit(float("inf"))).alias("reach"))
    asked_schema = "dims INT, row LONG, vec_id LONG, v BINARY, reach DOUBLE, home INT, home_piece INT, region INT"
    asked_arrow = pa_schema(spark, asked_schema)

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                own = np.nonzero(dims == d)[0]
                some = batch.take(pa.array(own))
                row, region = np.arange(len(own)), np.zeros(len(own), np.int32)
                if d in regions:
                    row, region = regions[d].reached(
                        _matrix(some.column(3).to_pylist(), d), some.column(4).to_numpy(zero_copy_only=False), factor)
                for i in range(0, len(row), 8192):
                    out = some.take(pa.array(row[i:i + 8192]))
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(region[i:i + 8192])], schema=asked_arrow)

    known = queries.join(reach, "row", "left").select(
        "dims", "row", "vec_id", "v", F.coalesce("reach", F.lit(float("inf"))).alias("reach"),
        F.col("region").alias("home"), F.col("piece").alias("home_piece"))
    touched = known.mapInArrow(touch, asked_schema).join(sizes, ["dims", "region"]).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    ).filter("region <> home OR piece <> home_piece")
    found = first.union(_search(points, touched, k, factor))
    best = Window.partitionBy("row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
