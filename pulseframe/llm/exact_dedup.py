"""Exact deduplication through cuckoo indexes over content digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import SPACE, pa_schema, saved, whole_text
from pulseframe.llm.cuckoo import CuckooIndex

#: Live digests that a map task holds before it hands them on, and that a shard has, at most about.
LIVE_PER_TASK = 200_000
#: Rows for which a shard of its own is worth while, up to the session's number of shuffle partitions.
SHARD_ROWS = 20_000

_INDEX = "digest BINARY, keep_id LONG, keep_row LONG, group_size LONG"


def content_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with each run of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(text, f"{SPACE}+", " "), 256))


def _earlier(a: tuple, b: tuple) -> bool:
    """Whether (doc_id, row) a stays rather than b; null ids come last."""
    return (a[0] is None, a[0] or 0, a[1]) < (b[0] is None, b[0] or 0, b[1])


def _flushed(index: CuckooIndex, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    entries = list(index)
    for start in range(0, len(entries), 20_000):
        part = entries[start:start + 20_000]
        yield pa.RecordBatch.from_pydict(
            {"digest": [e[0] for e in part], "keep_id": [e[1][0] for e in part],
             "keep_row": [e[1][1] for e in part], "group_size": [e[1][2] for e in part]},
            schema=schema,
        )


def _merged(rows: DataFrame, limit: int | None) -> DataFrame:
    """Rows of _INDEX, one for each digest that a task meets (until ``limit`` are live)."""
    arrow = pa_schema(rows.sparkSession, _INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for digest, keep_id, row, size in zip(*(c.to_pylist() for c in batch.columns)):
                entry = index.entry(digest)
                if entry is None:
                    index.add(digest, (keep_id, row, size))
                    continue
                old = entry[1]
                first = (keep_id, row) if _earlier((keep_id, row), old) else old[:2]
                entry[1] = (*first, old[2] + size)
            if limit and len(index) >= limit:
                yield from _flushed(index, arrow)
                index = CuckooIndex()
        yield from _flushed(index, arrow)

    return rows.mapInArrow(run, _INDEX)


def build_index(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, group_size) of (doc_id, row, digest).

    Each map task folds its rows through its own cuckoo index first, so a digest of any
    number of rows reaches its shard with one row for each task. There are so many shards
    that none has more than about LIVE_PER_TASK digests, at any number of rows.
    """
    ones = rows.select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
                       F.lit(1).cast("long").alias("group_size"))
    return _merged(_merged(ones, LIVE_PER_TASK).repartition(_shards(rows), "digest"), None)


def _shards(rows: DataFrame) -> int:
    count, usual = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-count // LIVE_PER_TASK), min(usual, -(-count // SHARD_ROWS)))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after each run of white space became one space; null
    counts as empty. The row with the smallest doc_id stays (null ids last), of rows that
    repeat a doc_id with equal text just one. An empty table gives an empty result.
    """
    rows = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.monotonically_increasing_id().alias("row"),
                    content_digest(whole_text()).alias("digest")),
        "digests",
    )
    return rows.join(build_index(rows), "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of rows with equal text and id, one."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*columns)
    digest = content_digest(whole_text(columns[docs.columns.index("text")]))
    doc_id = columns[docs.columns.index("doc_id")]
    own = F.col(doc_id).cast("long")
    # A digest is never null; where Spark knows, it need not compute it once more to test that.
    digest = F.coalesce(digest, F.lit(b""))
    keyed = plain.withColumns({"digest": digest, "nameless": own.isNull(), "id": F.coalesce(own, F.lit(0))})
    rows = saved(keyed.select(own.alias("doc_id"), F.monotonically_increasing_id().alias("row"), "digest"), "digests")
    # Keys without nulls, so that the join's partitions serve the last step too.
    stay = build_index(rows).select(
        "digest", F.col("keep_id").isNull().alias("nameless"), F.coalesce("keep_id", F.lit(0)).alias("id"))
    kept = keyed.hint("merge").join(stay, stay.columns, "left_semi")
    return kept.dropDuplicates(stay.columns).select(*columns).toDF(*docs.columns)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The index (digest, keep_id, group_size) after removals, then additions, of (doc_id, digest).

    A digest of which no row is left is deleted; one whose kept document left, but which
    has rows still, keeps its keep_id as the name of the group. Removing a digest that is
    not live changes nothing.
    """
    added = added.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    removed = removed.groupBy("digest").agg(F.lit(None).cast("long").alias("keep_id"), (-F.count("*")).alias("n"))
    kind = lambda df, order, size: df.select("digest", "keep_id", F.col(size).cast("long").alias("n"), F.lit(order).alias("turn"))
    schema = "digest BINARY, keep_id LONG, group_size LONG"
    arrow = pa_schema(index.sparkSession, schema)
    changes = saved(kind(index, 0, "group_size").union(kind(removed, 1, "n")).union(kind(added, 2, "n")), "changes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = CuckooIndex()
        for batch in batches:
            for digest, keep_id, n, _ in zip(*(c.to_pylist() for c in batch.columns)):
                entry = live.entry(digest)
                if entry is None:
                    if n > 0:
                        live.add(digest, (keep_id, n))
                elif entry[1][1] + n > 0:
                    first = min((x for x in (entry[1][0], keep_id) if x is not None), default=None)
                    entry[1] = (first, entry[1][1] + n)
                else:
                    live.remove(digest)
        entries = list(live)
        yield pa.RecordBatch.from_pydict(
            {"digest": [e[0] for e in entries], "keep_id": [e[1][0] for e in entries],
             "group_size": [e[1][1] for e in entries]}, schema=arrow)

    return changes.repartition(_shards(changes), "digest").sortWithinPartitions("turn").mapInArrow(run, schema)
