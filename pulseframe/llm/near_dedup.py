"""Near-duplicate documents: SimHash fingerprints linked through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import by_batch, pa_schema, saved, whole_text
from pulseframe.llm.graph import components

SHINGLE = 3
MOST_BITS = 2
#: Fingerprints that the vantage points of the shards are chosen from, at most.
SAMPLE = 16_384
#: Distinct fingerprints that a shard is meant to have.
SHARD_ROWS = 8_192
#: Pairs that are compared at once, without further pruning.
BLOCK = 1 << 17
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, 42)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        hashes = [digest(joined[a:b - 1], 42) for a, b in zip([0, *ends], ends[shingle - 1:])]
    values, ones = np.array(hashes, np.uint64), np.zeros(64, np.int64)
    for start in range(0, len(values), _BITS_AT_ONCE):
        part = values[start:start + _BITS_AT_ONCE].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_key: bool = False) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of whole texts, and a ``text_key`` if asked for; null counts as empty."""
    key = ["text_key"] if text_key else []

    def make():
        def step(doc_id, text, *keys):
            values = np.array([fingerprint(t, shingle) for t in text], np.uint64).view(np.int64)
            return {"doc_id": doc_id, "fingerprint": values.tolist(), **dict(zip(key, keys))}

        return step

    columns = [F.col("doc_id").cast("long"), whole_text().alias("text"), *(F.xxhash64(whole_text()).alias(k) for k in key)]
    return by_batch(docs.select(*columns), make, ", ".join(f"{c} LONG" for c in ("doc_id", "fingerprint", *key)))


def _distance(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point).astype(np.int16)


class Shards:
    """A vantage-point tree whose leaves are the shards.

    A fingerprint lies inside a node's radius or outside it. By the triangle bound, those
    within ``bits`` of it lie on the same side unless its distance is within ``bits`` of
    the radius; then it has to be looked for on both sides.
    """

    def __init__(self, sample: np.ndarray, leaves: int, bits: int) -> None:
        self.bits, self.leaves = bits, 0
        self._root = self._grow(np.unique(sample), max(1, leaves))

    def _grow(self, values: np.ndarray, leaves: int):
        if leaves > 1 and len(values) > 2:
            point = values[len(values) // 2]
            far = _distance(values, point)
            radius = int(np.median(far))
            inside, outside = far <= radius, far > radius
            both = np.mean((far <= radius + self.bits) & (far > radius - self.bits))
            if inside.any() and outside.any() and both < 0.9:
                return (point, radius, self._grow(values[inside], (leaves + 1) // 2),
                        self._grow(values[outside], leaves // 2))
        self.leaves += 1
        return self.leaves - 1

    def place(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, home): each fingerprint's own shard, and later ones that its ball reaches."""
        home = np.zeros(len(values), np.int64)
        found: list[tuple[np.ndarray, int]] = []

        def walk(node, rows, at_home):
            if not len(rows):
                return
            if not isinstance(node, tuple):
                home[rows[at_home]] = node
                found.append((rows, node))
                return
            far = _distance(values[rows], node[0])
            for side, near, own in ((node[2], far <= node[1] + self.bits, far <= node[1]),
                                    (node[3], far > node[1] - self.bits, far > node[1])):
                walk(side, rows[near], (at_home & own)[near])

        walk(self._root, np.arange(len(values)), np.ones(len(values), bool))
        row = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
        shard = np.concatenate([np.full(len(r), s) for r, s in found]) if found else np.zeros(0, np.int64)
        keep = shard >= home[row]
        row, shard = row[keep], shard[keep]
        return row, shard, shard == home[row]


class Links:
    """A spanning forest of the pairs within ``bits``, found by walking two subtrees at once."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self._values, self._bits = values, bits
        self._parent = np.arange(len(values))
        self.edges: list[tuple[int, int]] = []

    def _roots(self, rows: np.ndarray) -> np.ndarray:
        root = self._parent[rows]
        while True:
            upper = self._parent[root]
            if np.array_equal(upper, root):
                self._parent[rows] = root
                return root
            root = upper

    def _root(self, row: int) -> int:
        while self._parent[row] != row:
            self._parent[row] = self._parent[self._parent[row]]
            row = self._parent[row]
        return int(row)

    def _compare(self, a: np.ndarray, b: np.ndarray) -> None:
        """All pairs of two sets, in blocks; only links between unlinked trees are kept."""
        width = max(1, BLOCK // max(1, min(len(b), BLOCK)))
        for i in range(0, len(a), width):
            for j in range(0, len(b), BLOCK):
                rows, others = a[i:i + width], b[j:j + BLOCK]
                near = np.bitwise_count(self._values[rows][:, None] ^ self._values[others][None, :]) <= self._bits
                x, y = np.nonzero(near)
                x, y = rows[x], others[y]
                while len(x):
                    rx, ry = self._roots(x), self._roots(y)
                    open_ = rx != ry
                    x, y = x[open_][:4096], y[open_][:4096]
                    for p, q in zip(x.tolist(), y.tolist()):
                        rp, rq = self._root(p), self._root(q)
                        if rp != rq:
                            self._parent[max(rp, rq)] = min(rp, rq)
                            self.edges.append((p, q))
                    x, y = np.nonzero(near) if open_.sum() > 4096 else (x[:0], y[:0])
                    if len(x):
                        x, y = rows[x], others[y]

    def within(self, a: np.ndarray) -> None:
        if len(a) * len(a) <= BLOCK:
            return self._compare(a, a)
        far = _distance(self._values[a], self._values[a[len(a) // 2]])
        radius = int(np.median(far))
        inside, outside = far <= radius, far > radius
        if not outside.any():
            radius = int(far.max()) - 1
            inside, outside = far <= radius, far > radius
        if not inside.any() or not outside.any():
            return self._compare(a, a)
        self.within(a[inside])
        self.within(a[outside])
        self.between(a[inside & (far > radius - self._bits)], a[outside & (far <= radius + self._bits)])

    def between(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a) * len(b) <= BLOCK:
            return self._compare(a, b)
        more = a if len(a) >= len(b) else b
        point = self._values[more[len(more) // 2]]
        fa, fb = _distance(self._values[a], point), _distance(self._values[b], point)
        radius = int(np.median(np.concatenate([fa, fb])))
        ia, ib, na, nb = fa <= radius, fb <= radius, np.abs(2 * fa - 2 * radius - 1), np.abs(2 * fb - 2 * radius - 1)
        edge = 2 * self._bits - 1
        parts = [(ia, ib), (~ia, ~ib), (ia & (na <= edge), ~ib & (nb <= edge)), (~ia & (na <= edge), ib & (nb <= edge))]
        if sum(int(x.sum()) * int(y.sum()) for x, y in parts) > 0.9 * len(a) * len(b):
            return self._compare(a, b)
        for x, y in parts:
            self.between(a[x], b[y])


def near_links(values: DataFrame, bits: int = MOST_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``values`` as all pairs within ``bits`` do.

    A bounded sample fits the vantage points, so that shards have about ``shard_rows``
    rows; every fingerprint is then placed and queried. Each shard returns a spanning
    forest of its links, never all pairs.
    """
    count = values.count()
    # A sample by hash: near fingerprints are no more likely to be drawn together than others.
    few = values.filter(F.pmod(F.xxhash64("fingerprint"), F.lit(max(1, count // SAMPLE))) == 0).limit(2 * SAMPLE)
    sample = np.array([r[0] for r in few.collect()], np.int64).view(np.uint64)
    shards = Shards(sample, -(-count // shard_rows), bits)
    arrow = pa_schema(values.sparkSession, "shard LONG, fingerprint LONG, home BOOLEAN")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            row, shard, home = shards.place(own.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(own[row]), pa.array(home)], schema=arrow)

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["fingerprint"].to_numpy(np.int64)
        home = rows["home"].to_numpy(bool)
        links = Links(own.view(np.uint64), bits)
        links.within(np.nonzero(home)[0])
        links.between(np.nonzero(home)[0], np.nonzero(~home)[0])
        pairs = np.array(links.edges, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": own[pairs[:, 0]], "b": own[pairs[:, 1]]})

    placed = values.select("fingerprint").mapInArrow(place, "shard LONG, fingerprint LONG, home BOOLEAN")
    return placed.groupBy("shard").applyInPandas(link, "a LONG, b LONG")


def _grouped(rows: DataFrame, first: Column, bits: int) -> DataFrame:
    """(fingerprint, first, group): the least ``first`` of its rows, and the component it is in."""
    nodes = saved(rows.groupBy("fingerprint").agg(F.min(first).alias("first")), "nodes")
    found = components(near_links(nodes, bits)).withColumnRenamed("node", "fingerprint")
    return nodes.join(found, "fingerprint", "left").withColumn("group", F.coalesce("component", "fingerprint"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MOST_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents with at most ``bits`` differing fingerprint bits are linked; component_id is
    the smallest doc_id reachable. Equal fingerprints are one node, whatever the number
    of their documents; texts without words share fingerprint zero. Rows that repeat a
    doc_id count as documents of their own; a null doc_id is never the smallest while
    there is another. An empty table gives an empty result.
    """
    rows = saved(fingerprints(docs, shingle), "fingerprints")
    named = _grouped(rows, F.col("doc_id"), bits)
    first = named.groupBy("group").agg(F.min("first").alias("component_id"))
    named = named.join(first, "group").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MOST_BITS) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest doc_id (null ids last).

    Rows that share a doc_id are documents of their own; of one component's, that whose text
    has the least hash stays, and of rows that agree in doc_id and text just one. Null texts
    count as empty, and texts without words are one component. An empty table gives an
    empty result.
    """
    rows = saved(fingerprints(docs, shingle, text_key=True), "fingerprints")
    nameless, named_id = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    first = F.struct(nameless.alias("nameless"), named_id.alias("id"), "text_key")
    stay = _grouped(rows, first, bits).groupBy("group").agg(F.min("first").alias("first")).select("first.*")
    columns = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*columns)
    doc_id, text = (columns[docs.columns.index(name)] for name in ("doc_id", "text"))
    own = F.col(doc_id).cast("long")
    # Keys without nulls, so that the join's partitions serve the last step too.
    keyed = plain.withColumns(
        {"nameless": own.isNull(), "id": F.coalesce(own, F.lit(0)), "text_key": F.xxhash64(whole_text(text))})
    kept = keyed.hint("merge").join(stay, stay.columns, "left_semi")
    return kept.dropDuplicates(stay.columns).select(*columns).toDF(*docs.columns)
