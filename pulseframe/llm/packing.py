"""Packing tokenised documents into sequences of fixed length by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.common import pa_schema, saved, whole_text

LENGTH = 2048
#: Pieces of one length that are numbered in one window partition.
NUMBERED_TOGETHER = 50_000

_PIECES = "row LONG, doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"


class Encoder:
    """Token ids as the ``tokenizers`` file gives them.

    The same vocabulary as tiktoken ranks gives equal ids several times faster; it is used
    for texts that hold none of the added tokens.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None) -> None:
        import base64

        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self._fast is None or any(t in text for t in self._added):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._fast.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None, pattern: str | None) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    return Encoder(path, ranks, pattern)


def pieces(
    docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None, length: int = LENGTH
) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of each document's ids and a closing 0.

    Documents of more than ``length`` ids are cut so that every piece but the first is full.
    """
    arrow = pa_schema(docs.sparkSession, _PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, ranks, pattern).ids
        for batch in batches:
            out = []
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.append(ids_of(text), np.uint32(0)).astype("<u4")
                first = len(ids) % length or length
                starts = [0, *range(first, len(ids), length)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out.append((row, doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow) if out else \
                pa.RecordBatch.from_pylist([], schema=arrow)

    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        whole_text().alias("text"))
    return whole.mapInArrow(run, _PIECES)


class OpenBins:
    """A segment tree over remaining capacities that finds the tightest open bin."""

    def __init__(self, length: int) -> None:
        self._leaves = 1 << length.bit_length()
        self._some = [False] * (2 * self._leaves)
        self._bins: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]

    def _mark(self, capacity: int) -> None:
        node = self._leaves + capacity
        self._some[node] = bool(self._bins[capacity])
        while node > 1:
            node //= 2
            self._some[node] = self._some[2 * node] or self._some[2 * node + 1]

    def put(self, capacity: int, first: int, count: int) -> None:
        """``count`` bins, numbered from ``first``, with ``capacity`` left."""
        if count and capacity:
            self._bins[capacity].append((first, count))
            self._mark(capacity)

    def tightest(self, size: int) -> int:
        """The least capacity of an open bin that holds ``size``, or 0."""
        node = self._leaves + size
        if not self._some[node]:
            while node > 1 and not (node % 2 == 0 and self._some[node + 1]):
                node //= 2
            if node <= 1:
                return 0
            node += 1
            while node < self._leaves:
                node = 2 * node if self._some[2 * node] else 2 * node + 1
        return node - self._leaves

    def take(self, capacity: int) -> tuple[int, int]:
        bins = self._bins[capacity].pop()
        if not self._bins[capacity]:
            self._mark(capacity)
        return bins


def best_fit(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts`` (size to number), as runs of equal placements.

    A run (size, first, sequence, each, offset) says: the pieces of that size numbered
    from ``first`` on go, ``each`` to a sequence, into sequences numbered from ``sequence``
    on, the first of each at ``offset``. Bins of equal capacity are alike, so they are
    handled as intervals, and the number of runs depends on the sizes, not on the pieces:
    there are at most ``length`` sizes, and each splits at most one interval.
    """
    open_bins, runs, sequences = OpenBins(length), [], 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            capacity = open_bins.tightest(size)
            each = (capacity or length) // size
            if capacity:
                first, bins = open_bins.take(capacity)
            else:
                capacity, first, bins = length, sequences, -(-left // each)
                sequences += bins
            full = min(bins, left // each)
            runs.append((size, rank, first, each, length - capacity))
            open_bins.put(capacity - each * size, first, full)
            rank, left = rank + full * each, left - full * each
            if full < bins and left:
                # One more bin takes what is left of this size.
                open_bins.put(capacity - left * size, first + full, 1)
                open_bins.put(capacity, first + full + 1, bins - full - 1)
                left = 0
            elif full < bins:
                open_bins.put(capacity, first + full, bins - full)
    return runs


def pack(
    docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None, length: int = LENGTH
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Best-fit decreasing over the whole table: the driver sees the number of pieces of each
    size (at most ``length`` numbers) and places sizes, not pieces; each piece then finds
    its place from its number among those of its size. Numbers are dealt in windows of
    bounded size. Empty and null texts are a single id 0; rows that repeat are packed each;
    an empty table has no sequences.
    """
    cut = saved(pieces(docs, path, ranks, pattern, length), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs = best_fit(counts, length)
    parts = F.ceil(F.count("*") / F.lit(NUMBERED_TOGETHER)).cast("long").alias("parts")
    sizes = cut.groupBy(F.col("length").alias("size")).agg(parts)  # at most ``length`` rows
    dealt = cut.join(F.broadcast(sizes), cut["length"] == sizes["size"]).withColumn(
        "part", F.pmod(F.xxhash64("row", "piece"), F.col("parts"))).drop("size", "parts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "part").orderBy("row", "piece")
    numbered = dealt.withColumn("own", F.row_number().over(own)).join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own") - 1).alias("number"))
    schema = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG, sequence_id LONG, offset LONG"
    arrow = pa_schema(docs.sparkSession, schema)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            size, number = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            run = table[np.searchsorted(keys, size << 44 | number, "right") - 1] if len(size) else table[:0]
            nth = number - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 2] + nth // run[:, 3]), pa.array(run[:, 4] + nth % run[:, 3] * size)],
                schema=arrow)

    return numbered.mapInArrow(place, schema)
