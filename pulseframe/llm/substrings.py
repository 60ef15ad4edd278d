"""Removal of long byte strings that occur more than once.

A string of ``window`` bytes is repeated if it starts anywhere else too. Not every suffix
has to be sorted to know them all: of each window's k-grams those with the least hash are
its anchors, so equal windows hold equal anchors at equal places. Anchors whose k-gram
occurs once, or whose surroundings agree with no other's over any class of window places,
are done. The others are sorted by the bytes after them, and by those before them, to the
depth at which a window ends; common prefixes on both sides of two anchors that add up to
a window give the repeated bytes around them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import pa_schema, saved, whole_text
from pulseframe.llm.suffixes import common_prefix, deep_shallow_order

WINDOW = 400
GRAM = 32
#: Different surroundings of an anchor that are sorted together; larger groups are split.
GROUP_ROWS = 50_000
#: Parts that a range of window places is cut into, both to split groups and to rule out anchors early.
PARTS = 4
#: Bytes of a text whose anchors are found at once.
CHUNK = 1 << 20
#: Rows with bytes that are handed on together.
ROWS_AT_ONCE = 2048
#: Documents that the most frequent k-grams are looked for in, about; those with a larger
#: share of the anchors than HEAVY_SHARE, less than 1 / HEAVY_SHARE in number, are dealt out further.
SAMPLE_DOCS = 10_000
HEAVY_SHARE = 0.002
LEAST_HEAVY = 100

_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15 | 1
#: kind 0: an anchor (p, and n of equal surroundings in its batch); 1: a repeated span (p to last).
_ENTRY = "part LONG, kind INT, doc_id LONG, h LONG, p INT, last INT, n INT, key LONG, around LONG, c0 INT, c1 INT, c2 INT, c3 INT"
#: kind 1: a repeated span; 2: an anchor whose surroundings have to be sorted, 3: one of a group too large for that.
_FOUND = "kind INT, doc_id LONG, h LONG, p INT, last INT"
_BLOCK = "doc_id LONG, h LONG, p INT, lo INT, hi INT, key LONG, around LONG, back BINARY, core BINARY, ahead BINARY"
_BLOCK_COLUMNS = [column.split()[0] for column in _BLOCK.split(", ")]
_SPAN = "doc_id LONG, h LONG, first INT, last INT"


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, and a number for each byte."""
    size = CHUNK + 4 * WINDOW + 4096
    power = lambda base: np.cumprod(np.array([1] + [base] * size, np.uint64))
    byte = np.random.default_rng(20).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    return power(_BASE), power(pow(_BASE, -1, 2**64)), byte


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick over each ``width`` neighbours: running values from both ends of blocks meet."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, fill, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1:width - 1 + n])


def _ranges(lo: int, hi: int) -> list[tuple[int, int]]:
    """PARTS equal classes of the window places lo to hi."""
    step = max(1, -(-(hi - lo + 1) // PARTS))
    return [(a, min(hi, a + step - 1)) for a in range(lo, hi + 1, step)]


def anchors(text: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(place, hash of the k-gram, hash of all bytes of windows around it, and one short hash
    for each class of window places: of the bytes that all its windows share, 0 if it has
    none) of the anchors of a text.

    Ties all count, so a text that repeats a short period has many anchors, of few kinds.
    """
    raw, n, reach = np.frombuffer(text, np.uint8), len(text), window - gram
    found: list[tuple[np.ndarray, ...]] = []
    power, inverse, byte = _powers()
    for c0 in range(0, max(0, n - window + 1), CHUNK):
        c1 = min(c0 + CHUNK, n - window + 1)
        low, high = max(0, c0 - reach), min(n, c1 + reach + window)
        part = raw[low:high]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte[part] * power[:len(part)], dtype=np.uint64)])
        hashed = lambda a, b: _mixed((sums[b] - sums[a]) * inverse[a])  # noqa: B023,E731
        grams = np.arange(c0 - low, c1 + reach - low)
        order = hashed(grams, grams + gram)
        least = _sliding(order, reach + 1, np.minimum, 2**64 - 1)
        most = _sliding(np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)]), reach + 1, np.maximum, 0)
        p = np.nonzero(most == order)[0]
        at = grams[p]
        first, last = np.maximum(at - reach, -low), np.minimum(at + window, n - low)
        # The surroundings also tell how far they reach, as texts may end before.
        clip = _mixed(((at - first) << 20 | (last - at)).astype(np.uint64))
        classes = []
        for lo, hi in _ranges(0, reach):
            a, b = at - lo, at - hi + window
            held = (a >= 0) & (b <= n - low)
            short = hashed(np.where(held, a, 0), np.where(held, b, 0)) >> np.uint64(33)
            classes.append(np.where(held, short + np.uint64(1), 0).astype(np.int32))
        classes += [np.zeros(len(p), np.int32)] * (PARTS - len(classes))
        found.append((at + low, order[p], hashed(first, last) ^ clip, *classes))
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int32)] * PARTS)
    whole = [np.concatenate(c) for c in zip(*found)]
    place, once = np.unique(whole[0], return_index=True)
    return place, *(c[once] for c in whole[1:])


def covered(blocks: list[tuple[bytes, bytes]], total: int) -> list[tuple[int, int] | None]:
    """How far repeated windows reach back and ahead around each anchor of a group, or None.

    ``blocks`` are different pairs of the bytes before (backwards) and after a string that
    all share; a window needs common prefixes that add up to ``total``. Both sides are
    sorted. Groups with equal bytes before are joined from the longest common prefix to
    shorter ones; in a joined group, an anchor's best partner is next to it in the order
    of the bytes after, so each row of the smaller group is looked up in the larger one.
    """
    if len(blocks) == 2:
        (a, x), (b, y) = blocks
        back, ahead = common_prefix(a, b), common_prefix(x, y)
        return [(back, ahead) if back + ahead >= total else None] * 2
    backs, aheads = [b for b, _ in blocks], [a for _, a in blocks]
    order = deep_shallow_order(backs)
    place = {row: i for i, row in enumerate(deep_shallow_order(aheads))}
    by_place = {i: row for row, i in place.items()}
    best: list[list[int] | None] = [None] * len(blocks)

    def meet(x: int, y: int, back: int) -> None:
        ahead = common_prefix(aheads[x], aheads[y])
        if back + ahead >= total:
            for row in (x, y):
                old = best[row] or [0, 0]
                best[row] = [max(old[0], back), max(old[1], ahead)]

    steps = sorted(((common_prefix(backs[a], backs[b]), i) for i, (a, b) in enumerate(zip(order, order[1:]))), reverse=True)
    first = list(range(len(order)))
    members = {i: [place[order[i]]] for i in range(len(order))}

    def root(i: int) -> int:
        while first[i] != i:
            first[i] = first[first[i]]
            i = first[i]
        return i

    for back, i in steps:
        a, b = root(i), root(i + 1)
        small, large = (a, b) if len(members[a]) <= len(members[b]) else (b, a)
        own, there = members.pop(small), members[large]
        for rank in own:
            at = bisect_left(there, rank)
            for near in (at - 1, at):
                if 0 <= near < len(there):
                    meet(by_place[rank], by_place[there[near]], back)
        for rank in own:
            insort(there, rank)
        first[small] = large
    return [tuple(x) if x else None for x in best]


def _anchor_rows(docs: DataFrame, window: int, gram: int, heavy: frozenset[int]) -> DataFrame:
    """Rows of _ENTRY. Equal surroundings within a batch are repeats for sure: their spans
    are told at once, and one anchor stands for them. ``part`` is where a row goes: anchors
    of a k-gram together, those of heavy ones by their surroundings.
    """
    arrow, reach = pa_schema(docs.sparkSession, _ENTRY), window - gram
    many = np.array(sorted(heavy), np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [anchors(t.encode("utf-8", "surrogatepass"), window, gram) for t in batch.column(2).to_pylist()]
            row = np.repeat(np.arange(len(lists)), [len(x[0]) for x in lists])
            if not len(row):
                continue
            place, key, around, *classes = (np.concatenate(x) for x in zip(*lists))
            _, first, same, count = np.unique(key + _mixed(around), return_index=True, return_inverse=True, return_counts=True)
            part = np.where(np.isin(key, many), _mixed(around), key)[first]
            signed = lambda x: pa.array(x.view(np.int64))
            number = lambda x: pa.array(np.asarray(x, np.int32))
            zero = np.zeros(len(first), np.int32)
            yield pa.RecordBatch.from_arrays([
                signed(part), number(zero), batch.column(0).take(pa.array(row[first])), batch.column(1).take(pa.array(row[first])),
                number(place[first]), number(zero), number(np.minimum(count, 2)), signed(key[first]), signed(around[first]),
                *(number(c[first]) for c in classes)], schema=arrow)
            again = np.nonzero(count[same] > 1)[0]
            if len(again):
                # Spans of one document that touch are one.
                start, end = place[again] - reach, place[again] + window
                new = np.concatenate([[True], (row[again][1:] != row[again][:-1]) | (start[1:] > end[:-1])])
                at = np.nonzero(new)[0]
                end = end[np.append(at[1:], len(again)) - 1]
                owner, zero = pa.array(row[again][at]), np.zeros(len(at), np.int32)
                h = batch.column(1).take(owner)
                yield pa.RecordBatch.from_arrays([
                    h, number(zero + 1), batch.column(0).take(owner), h, number(start[at]), number(end), number(zero),
                    pa.array(zero.astype(np.int64)), pa.array(zero.astype(np.int64)), *[number(zero)] * PARTS], schema=arrow)

    return docs.mapInArrow(run, _ENTRY)


def _heavy_keys(docs: DataFrame, window: int, gram: int) -> frozenset[int]:
    """K-grams with a large share of the anchors of a bounded sample of documents.

    Missing one costs balance, never results.
    """
    share = max(1, docs.count() // SAMPLE_DOCS)
    few = docs.filter(F.pmod("h", F.lit(share)) == 0).limit(2 * SAMPLE_DOCS)
    keys = _anchor_rows(few, window, gram, frozenset()).filter("kind = 0").groupBy("key").agg(F.count("*").alias("n"))
    keys = keys.filter(F.col("n") > LEAST_HEAVY)
    least = HEAVY_SHARE * (keys.agg(F.sum("n")).first()[0] or 0)
    return frozenset(r["key"] for r in keys.filter(F.col("n") > F.lit(least)).orderBy(F.desc("n")).limit(int(1 / HEAVY_SHARE)).collect())


def _sifted(rows: DataFrame, reach: int, window: int, heavy: frozenset[int], group_rows: int) -> DataFrame:
    """Rows of _FOUND: what repeats for sure, and the anchors that have to be sorted.

    Rows stream by in the order of their k-gram and surroundings. Anchors with equal
    surroundings repeat each other throughout, and the first stands for all. Of different
    surroundings of a k-gram only those stay that agree with another in a class.
    """
    arrow = pa_schema(rows.sparkSession, _FOUND)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        key = around = first = None
        repeated, held, large = False, [], False

        def closed():
            if len(held) < 2:
                return []
            seen = [Counter(x[3 + j] for x in held if x[3 + j]) for j in range(PARTS)]
            return [(2, *x[:3], 0) for x in held if any(x[3 + j] and seen[j][x[3 + j]] > 1 for j in range(PARTS))]

        for batch in batches:
            out: list[tuple] = []
            for kind, doc_id, h, p, last, n, k, a, *classes in zip(*(c.to_pylist() for c in batch.columns[1:])):
                if kind == 1:
                    out.append((1, doc_id, h, p, last))
                    continue
                if k != key:
                    out.extend(closed())
                    key, around, held, large = k, None, [], k in heavy
                if a != around:
                    around, first, repeated = a, (doc_id, h, p), n > 1
                    if large:
                        out.append((3, doc_id, h, p, 0))
                    else:
                        held.append((doc_id, h, p, *classes))
                        if len(held) > group_rows:
                            out.extend((3, *x[:3], 0) for x in held)
                            large, held = True, []
                    if repeated:
                        out.append((1, doc_id, h, p - reach, p + window))
                    continue
                if not repeated:
                    repeated = True
                    out.append((1, first[0], first[1], first[2] - reach, first[2] + window))
                out.append((1, doc_id, h, p - reach, p + window))
            yield out
        yield closed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in sift(batches):
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return rows.repartition("part").sortWithinPartitions("kind", "key", "around").mapInArrow(run, _FOUND)


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, packed): texts compressed, as they are shuffled whole."""
    schema = "doc_id LONG, h LONG, packed BINARY"
    arrow = pa_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack(t.encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], schema=arrow)

    return docs.mapInArrow(run, schema)


def _block(text: bytes, p: int, lo: int, hi: int, window: int) -> tuple[bytes, bytes, bytes]:
    """Bytes before (backwards), within and after what all windows at places lo to hi before p share."""
    n, a, b = len(text), p - lo, p - hi + window
    return text[max(0, p - hi):a][::-1], text[a:b], text[b:min(n, a + window)]


def _hashes(lo: int, hi: int, back: bytes, core: bytes, ahead: bytes) -> tuple[int, int]:
    key = xxhash.xxh64(core, seed=lo * 65536 + hi).intdigest()
    around = xxhash.xxh64(b"%d %d " % (len(back), len(ahead)) + back + ahead, seed=7).intdigest()
    return key - (key >> 63 << 64), around - (around >> 63 << 64)


def _blocks(docs: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """The bytes around wanted (doc_id, h, p) anchors."""
    arrow, reach = pa_schema(docs.sparkSession, _BLOCK), window - gram
    by_doc = wanted.groupBy("doc_id", "h").agg(F.collect_list("p").alias("places"))
    joined = _packed(docs).join(
        by_doc.withColumnsRenamed({"doc_id": "d", "h": "g"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for doc_id, h, packed, places in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack(packed)
                # The core is the k-gram alone.
                made = ((p, _block(data, p, 0, reach, window)) for p in places)
                rows = ((doc_id, h, p, 0, reach, *_hashes(0, reach, *parts), *parts) for p, parts in made)
                for part in batched(rows, ROWS_AT_ONCE):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)

    return joined.select("doc_id", "h", "packed", "places").mapInArrow(run, _BLOCK)


def _split(blocks: DataFrame, window: int) -> DataFrame:
    """The same windows in narrower classes, so that their cores, and thus keys, say more."""
    arrow = pa_schema(blocks.sparkSession, _BLOCK)

    def made(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, h, p, lo, hi, _, _, back, core, ahead in rows:
            text = back[::-1] + core + ahead
            at = len(back) + lo  # where p is in this text
            for a, b in _ranges(lo, hi):
                # Without a window at these places within the document there is no block.
                if at >= a and at - b + window <= len(text):
                    parts = _block(text, at, a, b, window)
                    yield doc_id, h, p, a, b, *_hashes(a, b, *parts), *parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batched(made(zip(*(c.to_pylist() for c in batch.columns))), ROWS_AT_ONCE):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)

    return blocks.select(*_BLOCK_COLUMNS).mapInArrow(run, _BLOCK)


def _solved(blocks: DataFrame, window: int) -> DataFrame:
    """Spans (doc_id, h, first, last) of repeated windows, group by group of equal keys."""
    arrow = pa_schema(blocks.sparkSession, _SPAN)

    def spans(rows: list[tuple]) -> Iterator[tuple]:
        cores: dict[bytes, list[tuple]] = {}
        for row in rows:
            cores.setdefault(row[8], []).append(row)
        for core, same in cores.items():
            if len(same) > 1:
                lo, hi = same[0][3], same[0][4]
                for row, reach in zip(same, covered([(r[7], r[9]) for r in same], hi - lo)):
                    if reach:
                        start = row[2] - lo
                        yield row[0], row[1], start - reach[0], start + len(core) + reach[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def flushed(rows):
            return list(spans(rows)) if len(rows) > 1 else []

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][5] != row[5]:
                    out.extend(flushed(group))
                    group = []
                group.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
        out = flushed(group)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return blocks.repartition("key").sortWithinPartitions("key").select(*_BLOCK_COLUMNS).mapInArrow(run, _SPAN)


def repeated_spans(docs: DataFrame, window: int, gram: int, group_rows: int) -> DataFrame:
    """Spans (doc_id, h, first, last) that together cover all repeated windows of docs (doc_id, h, text)."""
    reach = window - gram
    heavy = _heavy_keys(docs, window, gram)
    rows = saved(_sifted(_anchor_rows(docs, window, gram, heavy), reach, window, heavy, group_rows), "sifted")
    spans = rows.filter("kind = 1").select("doc_id", "h", F.col("p").alias("first"), "last")
    spans = spans.union(_solved(_blocks(docs, rows.filter("kind = 2"), window, gram), window))
    large = rows.filter("kind = 3")
    if large.isEmpty():
        return spans
    large = _blocks(docs, large, window, gram)
    while True:
        # Narrower classes of window places have longer cores, so their groups are smaller; in
        # a class of one place all of a group are equal, so this ends.
        narrow = saved(_split(large, window), "narrower")
        kinds = saved(narrow.groupBy("key", "around").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "p")).alias("one")), "kinds")
        spans = spans.union(narrow.join(kinds.filter("n > 1").select("key", "around"), ["key", "around"]).select(
            "doc_id", "h", (F.col("p") - F.col("lo") - F.length("back")).cast("int").alias("first"),
            (F.col("p") - F.col("hi") + F.lit(window) + F.length("ahead")).cast("int").alias("last")))
        sizes = kinds.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        one = kinds.join(sizes, "key").select(
            "key", "around", "size", F.col("one.doc_id").alias("d"), F.col("one.h").alias("g"), F.col("one.p").alias("q"))
        sized = narrow.join(one, ["key", "around"]).filter(
            F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")) & (F.col("p") == F.col("q")))
        spans = spans.union(_solved(sized.filter(F.col("size") <= group_rows), window))
        large = sized.filter(F.col("size") > group_rows)
        if large.isEmpty():
            return spans


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_rows: int = GROUP_ROWS, keep_text: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes left).

    Every byte under a string of ``window`` bytes that also starts elsewhere, in the same
    document or another, is removed; strings are judged on the input. Null texts are empty;
    texts shorter than the window lose nothing; rows that repeat a text repeat each
    other's strings and lose all of them; an empty table gives an empty result.
    """
    text = whole_text()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    spans = repeated_spans(docs, window, gram, group_rows)
    by_doc = spans.groupBy("doc_id", "h").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    by_doc = by_doc.withColumnsRenamed({"doc_id": "d", "h": "g"})
    joined = _packed(docs).join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    schema = "doc_id LONG, n_bytes LONG, n_removed LONG, n_spans LONG, kept_sha256 STRING" + ", kept BINARY" * keep_text
    arrow = pa_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc_id, packed, spans in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack(packed)
                kept, runs, at, removed = [], 0, 0, 0
                for first, last in sorted((max(0, s["first"]), min(len(data), s["last"])) for s in spans or ()):
                    if first > at or not runs:
                        kept.append(data[at:first])
                        runs, at = runs + 1, first
                    if last > at:
                        removed, at = removed + last - at, last
                kept = b"".join([*kept, data[at:]])
                row = (doc_id, len(data), removed, runs, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if keep_text else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow) \
                if out else pa.RecordBatch.from_pylist([], schema=arrow)

    return joined.select("doc_id", "packed", "spans").mapInArrow(run, schema)
