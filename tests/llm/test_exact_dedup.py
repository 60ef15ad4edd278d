import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.llm import exact_dedup
from pulseframe.llm.cuckoo import CuckooIndex

SCHEMA = "doc_id LONG, text STRING"


def digest_of(text):
    return hashlib.sha256(re.sub(rb"[ \t-\r]+", b" ", (text or "").encode())).hexdigest()


def wanted(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(digest_of(text), []).append(doc_id)
    for digest, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        for n, i in enumerate(order):
            yield i, order[0], len(ids), n == 0, digest


def key(row):
    return tuple((v is None, v) for v in row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 400)), max_size=800))
def test_cuckoo_is_a_dict(steps):
    index, model = CuckooIndex(2), {}
    for add, n in steps:
        digest = hashlib.sha256(b"%d" % n).digest()
        if add:
            if index.entry(digest) is None:
                index.add(digest, n)
                model[digest] = n
        else:
            assert index.remove(digest) == (model.pop(digest, None) is not None)
        assert len(index) == len(model)
    assert {d: v for d, v in index} == model
    assert all(index.entry(d)[1] == v for d, v in model.items())


def test_cuckoo_grows_and_forgets():
    index = CuckooIndex(2)
    digests = [hashlib.sha256(b"%d" % i).digest() for i in range(20_000)]
    for d in digests:
        index.add(d, None)
    assert all(index.may_hold(d) for d in digests)
    others = [hashlib.sha256(b"x%d" % i).digest() for i in range(20_000)]
    assert not any(index.entry(d) for d in others) and sum(map(index.may_hold, others)) < 100
    assert all(index.remove(d) for d in digests) and not any(map(index.may_hold, digests))


def test_against_brute_force(spark):
    r = random.Random(4)
    texts = ["", " ", "\t \n", "a b", "a  b", "a\x0bb", "a b", "A b", None, " a b", "é", "x" * 100_000]
    rows = [(i, r.choice(texts)) for i in range(500)] + [(7, "a b"), (7, "a b"), (None, "a b"), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumns({c: F.lit(1) for c in ("digest", "row", "keep_id")})
    got = [tuple(x) for x in exact_dedup.exact_duplicates(docs).collect()]
    assert sorted(got, key=key) == sorted(wanted(rows), key=key)
    stay = exact_dedup.drop_exact_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted((x["doc_id"], digest_of(x["text"])) for x in stay.collect()) == sorted((i, d) for i, _, _, kept, d in wanted(rows) if kept)
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_map_tasks_hand_on_early(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LIVE_PER_TASK", 3)
    rows = [(i, str(i % 40)) for i in range(200)]
    got = [tuple(x) for x in exact_dedup.exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == sorted(wanted(rows))


def test_index_update(spark):
    d = lambda n: hashlib.sha256(b"%d" % n).digest()
    index = spark.createDataFrame([(d(1), 1, 2), (d(2), 5, 1), (d(3), 6, 3)], "digest BINARY, keep_id LONG, group_size LONG")
    added = spark.createDataFrame([(9, d(1)), (10, d(4)), (11, d(4)), (12, d(2))], "doc_id LONG, digest BINARY")
    removed = spark.createDataFrame([(5, d(2)), (1, d(1)), (6, d(3)), (99, d(77))], "doc_id LONG, digest BINARY")
    got = {bytes(r["digest"]): (r["keep_id"], r["group_size"]) for r in exact_dedup.update_index(index, added, removed).collect()}
    assert got == {d(1): (1, 2), d(2): (12, 1), d(3): (6, 2), d(4): (10, 2)}


def test_shards_grow_with_the_rows(spark, monkeypatch):
    rows = spark.range(1000)
    assert exact_dedup._shards(rows.limit(0)) == exact_dedup._shards(rows) == 1
    monkeypatch.setattr(exact_dedup, "SHARD_ROWS", 100)
    assert exact_dedup._shards(rows) == 4
    monkeypatch.setattr(exact_dedup, "LIVE_PER_TASK", 50)
    assert exact_dedup._shards(rows) == 20
    docs = spark.createDataFrame([(i, f"text {i % 700}") for i in range(1000)], "doc_id LONG, text STRING")
    keyed = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), exact_dedup.content_digest(F.col("text")).alias("digest"))
    index = exact_dedup.build_index(keyed)
    by_shard = [r["n"] for r in index.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(by_shard) == 700 and max(by_shard) <= 2.5 * 50
