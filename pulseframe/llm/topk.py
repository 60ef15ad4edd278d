"""Exact top-k search by inner product, pruned in buckets of vectors of like length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.common import pa_schema, saved

#: Candidates of a block and queries of a group; a task meets one of each.
BLOCK_ROWS = 16_384
GROUP_ROWS = 2_048
#: Candidates whose scores give each query a first lower bound.
SEED_ROWS = 4_096
#: Local cosine above which coordinates prune better than lengths.
COORDINATE_COSINE = 0.5
#: Coordinates, the largest of the query, whose feasible ranges are looked at.
COORDINATES = 3
#: Queries that are multiplied with a block at once.
QUERIES_AT_ONCE = 256

_VECTORS = "row LONG, vec_id LONG, dims INT, norm DOUBLE, query BOOLEAN, v BINARY"


def integer_vectors(vectors: DataFrame, scale: int = 64, query_every: int = 20) -> DataFrame:
    """Rows of _VECTORS: floor(scale * component), of vectors without null or non-finite components.

    Rows whose vec_id is divisible by ``query_every`` are queries. Vectors without
    components and rows without an id take no part.
    """
    arrow = pa_schema(vectors.sparkSession, _VECTORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, vec_id, values in zip(*(c.to_pylist() for c in batch.columns)):
                if vec_id is None or not values or any(x is None for x in values):
                    continue
                exact = np.floor(np.array(values, np.float64) * scale)
                if np.isfinite(exact).all():
                    v = exact.astype("<i8")
                    norm = float(np.sqrt((exact * exact).sum()))
                    out.append((row, vec_id, len(v), norm, vec_id % query_every == 0, v.tobytes()))
            yield pa.RecordBatch.from_pydict(
                {f.name: [r[i] for r in out] for i, f in enumerate(arrow)}, schema=arrow)

    return vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<double>"),
    ).mapInArrow(run, _VECTORS)


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<i8").reshape(-1, dims)


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through doubles where those are exact."""
    if len(q) and len(p) and float(np.abs(q).max()) * float(np.abs(p).max()) * q.shape[1] < 2**53:
        return np.rint(q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def _best(score: np.ndarray, ids: np.ndarray, k: int, least: float) -> np.ndarray:
    """Positions of the k best scores of at least ``least``, ties to smaller ids."""
    near = np.nonzero(score >= least)[0]
    if len(near) > 4 * k:
        kth = np.partition(score[near], len(near) - k)[len(near) - k]
        near = near[score[near] >= kth]
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def _searched(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> Iterator[tuple]:
    """(query row, query_id, vec_id, score) of a group of queries against a block.

    ``block`` is in descending order of length. A query whose bound exceeds its length
    times the block's greatest is done. With a low local cosine threshold the candidates
    too short for the bound are cut off; with a high one only those are verified whose
    normalised components lie in the feasible ranges of the query's largest coordinates.
    """
    dims = int(queries["dims"].iloc[0])
    q, p = _matrix(queries["v"], dims), _matrix(block["v"], dims)
    ids, rows = block["vec_id"].to_numpy(np.int64), block["row"].to_numpy(np.int64)
    length, q_length = block["norm"].to_numpy(float), queries["norm"].to_numpy(float)
    bound = queries["bound"].to_numpy(float)
    # A little slack: lengths are rounded, and pruning must never drop a candidate.
    reach = np.where(bound > 0, bound / np.maximum(q_length, 1e-300) * (1 - 1e-9), 0.0)
    cosine = reach / max(length[0], 1e-300)
    q_rows, q_ids = queries["row"].to_numpy(np.int64), queries["vec_id"].to_numpy(np.int64)

    def best(i: int, place: np.ndarray, score: np.ndarray) -> Iterator[tuple]:
        other = rows[place] != q_rows[i]
        place, score = place[other], score[other]
        for j in _best(score, ids[place], k, bound[i]):
            yield int(q_rows[i]), int(q_ids[i]), int(ids[place[j]]), int(score[j])

    unit = by_coordinate = None
    by_length = []
    for i in np.nonzero(cosine <= 1)[0]:
        if cosine[i] < COORDINATE_COSINE or length[-1] <= 0:
            by_length.append(i)
            continue
        if unit is None:
            unit = p / length[:, None]
            by_coordinate = {}
        own, t = q[i] / q_length[i], cosine[i]
        chosen = None
        for f in np.argsort(-np.abs(own))[:COORDINATES]:
            if f not in by_coordinate:
                order = np.argsort(unit[:, f], kind="stable")
                by_coordinate[f] = order, unit[order, f]
            order, values = by_coordinate[f]
            swing = np.sqrt(max(0.0, 1 - own[f] ** 2) * max(0.0, 1 - t * t)) + 1e-9
            low, high = own[f] * t - swing, own[f] * t + swing
            # Beyond the query's own direction a component may be larger than at the bound itself.
            if own[f] >= t:
                high = 1.0
            elif own[f] <= -t:
                low = -1.0
            left, right = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if chosen is None or right - left < len(chosen):
                chosen = order[left:right]
        yield from best(i, chosen, _products(q[i:i + 1], p[chosen])[0])
    if by_length:
        # Candidates are sorted by length, so those too short for the bound are a tail.
        ends = np.searchsorted(-length, -reach[by_length], "right")
        order = np.argsort(ends, kind="stable")
        for start in range(0, len(order), QUERIES_AT_ONCE):
            part = order[start:start + QUERIES_AT_ONCE]
            own, end = np.array(by_length)[part], int(ends[part].max())
            for i, score in zip(own, _products(q[own], p[:end])):
                yield from best(i, np.arange(end), score)


def _seeds(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of components: a bounded number of vectors and their rows, half the longest, half any."""
    longest = vectors.orderBy(F.col("norm").desc(), "row").limit(SEED_ROWS // 2).toPandas()
    others = vectors.orderBy(F.xxhash64("row")).limit(SEED_ROWS // 2).toPandas()
    seeds = pd.concat([longest, others]).drop_duplicates("row")
    return {dims: (_matrix(own["v"], dims), own["row"].to_numpy(np.int64)) for dims, own in seeds.groupby("dims")}


def _edges(df: DataFrame, column: str, pieces: int) -> np.ndarray:
    """Ascending values that cut a column into so many pieces of about equal size."""
    return np.array(df.approxQuantile(column, [i / pieces for i in range(1, pieces)], 0.001) if pieces > 1 else [])


def _numbered(classes: list, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of classes (number, rows, edge) in order: number, pieces of about ``most`` rows, edge, and where their pieces begin, and the end."""
    classes = sorted(classes)
    parts = np.array([-(-n // most) for _, n, _ in classes], np.int64)
    ends = np.concatenate([[0], np.cumsum(parts)]).astype(np.int64)
    return np.array([c[0] for c in classes], np.int64), parts, np.array([c[2] for c in classes], np.float64), ends


def cells(vectors: DataFrame, k: int, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(queries, candidates), each row once for every (block, group) in which a query may find a result.

    Candidates lie in buckets of like length, longest first; queries in levels of like
    reach, the length that a candidate must have to beat the query's bound, least first.
    Large buckets and levels are dealt to several blocks and groups. A group meets the
    blocks whose longest vector is within its least reach, and these are the first ones;
    a block meets the first groups. What cannot win is not shuffled.
    """
    spark = vectors.sparkSession
    vectors = saved(vectors, "vectors")
    total, queries = vectors.agg(F.count("*"), F.count_if("query")).first()
    edges = _edges(vectors, "norm", -(-total // block_rows))
    seeds = _seeds(vectors)
    placed = f"{_VECTORS}, bucket INT, bound DOUBLE, reach DOUBLE"
    arrow = pa_schema(spark, placed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, norms = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            query = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
            bounds = np.full(len(rows), -np.inf)
            for d in np.unique(dims[query]):
                if d not in seeds:
                    continue
                p, seed_rows = seeds[d]
                mine = np.nonzero(query & (dims == d))[0]
                for start in range(0, len(mine), QUERIES_AT_ONCE):
                    own = mine[start:start + QUERIES_AT_ONCE]
                    score = _products(_matrix(batch.column(5).take(pa.array(own)).to_pylist(), d), p)
                    for i, found in zip(own, score):
                        found = found[seed_rows != rows[i]]
                        if len(found) >= k:
                            bounds[i] = np.partition(found, len(found) - k)[len(found) - k]
            # A little slack: lengths are rounded, and pruning must never drop a candidate.
            reach = np.where(bounds > 0, bounds / np.maximum(norms, 1e-300) * (1 - 1e-9), 0.0)
            bucket = (len(edges) - np.searchsorted(edges, norms, "left")).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket), pa.array(bounds), pa.array(reach)], schema=arrow)

    vectors = saved(vectors.mapInArrow(place, placed), "bucketed")
    asked = vectors.filter("query")
    levels = _edges(asked, "reach", -(-queries // group_rows))

    @F.pandas_udf("int")
    def level_of(reach: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(levels, reach.to_numpy(), "left").astype(np.int32))

    asked = asked.withColumn("level", level_of("reach"))
    # Numbers of the few buckets and levels: their rows, greatest length and least need.
    buckets = vectors.groupBy("bucket").agg(F.count("*"), F.max("norm")).collect()
    needs = asked.groupBy("level").agg(F.count("*"), F.min("reach")).collect()
    bucket, block_parts, longest, block_ends = _numbered(buckets, block_rows)
    level, group_parts, least, group_ends = _numbered(needs, group_rows)
    # Lengths fall with the bucket and needs rise with the level, so what can meet is a beginning on both sides.
    groups_met = group_ends[np.searchsorted(least, longest, "right")]
    blocks_met = block_ends[np.searchsorted(-longest, -least, "right")]
    to_blocks = np.stack([bucket, block_parts, block_ends[:-1], groups_met], axis=1).tolist()
    to_groups = np.stack([level, group_parts, group_ends[:-1], blocks_met], axis=1).tolist()
    dealt = lambda own, key, numbers: own.join(
        F.broadcast(spark.createDataFrame(numbers, f"{key} INT, parts INT, first INT, met INT")), key).filter("met > 0")
    number = (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("met") - 1))
    candidates = dealt(vectors, "bucket", to_blocks).select(
        "row", "vec_id", "dims", "norm", "v", number.alias("block"), every.alias("group"))
    asked = dealt(asked, "level", to_groups).select(
        "row", "vec_id", "dims", "norm", "v", "bound", number.alias("group"), every.alias("block"))
    return asked, candidates


def top_k(vectors: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query row of ``vectors`` (rows of _VECTORS).

    The k highest integer inner products with every other row, or all if there are fewer;
    ties go to the smaller vec_id. Rows that repeat a vec_id are rows of their own, and a
    repeated query is answered each time; vectors are compared with those of as many
    components only. Products beyond 64 bits wrap. An empty table gives an empty result.

    A bounded number of seed rows gives each query a bound; only blocks of candidates and
    groups of queries that can meet it are brought together (``cells``).
    """
    asked, candidates = cells(vectors, k, block_rows, group_rows)
    asked = asked.select(*(F.col(c).alias(f"q_{c}") for c in asked.columns))

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        queries = queries.rename(columns=lambda c: c.removeprefix("q_"))
        found: list[tuple] = []
        for dims, own in queries.groupby("dims"):
            there = block[block["dims"] == dims].sort_values("norm", ascending=False)
            if len(there):
                found.extend(_searched(own, there, k))
        return pd.DataFrame(found, columns=["row", "query_id", "vec_id", "score"])

    found = asked.groupBy("q_block", "q_group").cogroup(candidates.groupBy("block", "group")).applyInPandas(
        search, "row LONG, query_id LONG, vec_id LONG, score LONG")
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
