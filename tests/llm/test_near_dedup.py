import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulseframe.llm import graph, near_dedup


def plain_fingerprint(text):
    """Bit by bit from the definition."""
    data = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in data).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, bits):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def wanted(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = roots(set(prints), 2)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return [(doc_id, f"{p:016x}", least.get(root[p])) for (doc_id, _), p in zip(rows, prints)]


def component_of(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = roots(set(prints), 2)
    return [root[p] for p in prints]


def made(seed, n):
    r = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "délta", "eps.", "ÉTA", "x"]
    out = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(n)]
    for _ in range(n):
        base = r.choice(out).split(" ")
        base[r.randrange(len(base))] = r.choice(words)
        out.append(" ".join(base))
    return out + ["", None, " \t\n", "one", "one two", "a b c", "w " * 5000]


def test_components_of_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SHARD_ROWS", 20)
    rows = list(enumerate(made(3, 150))) + [(3, "one"), (3, "one"), (None, "one two"), (None, "two one three four")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({c: F.lit(1) for c in ("fingerprint", "group", "a", "b")})
    got = [tuple(r) for r in near_dedup.near_duplicates(docs).collect()]
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=order) == sorted(wanted(rows), key=order)
    stay = near_dedup.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    # One row of each component; one that has no other ids keeps a row without.
    kept = [c for c in {root: c for (_, p, c), root in zip(wanted(rows), component_of(rows))}.values()]
    assert sorted(map(str, (r["doc_id"] for r in stay.collect()))) == sorted(map(str, kept))
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shard_rows, block", [(10, 64), (60, 1024), (10_000, 1 << 17)])
def test_links_of_fingerprints(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    values = {int(v) for v in rng.integers(0, 2**63, 300)} | {0, 2**64 - 1}
    for v in list(values)[:80]:
        for _ in range(int(rng.integers(1, 9))):
            for bit in rng.integers(0, 64, int(rng.integers(1, 5))):
                v ^= 1 << int(bit)
            values.add(v)
    values |= {1 << a | 1 << b for a in range(20) for b in range(a)}  # a dense ball
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    links = near_dedup.near_links(spark.createDataFrame([(v,) for v in signed], "fingerprint LONG"), 2, shard_rows)
    found = {r["node"]: r["component"] for r in graph.components(links).collect()}
    want = roots(values, 2)
    by_root, by_found = {}, {}
    for s in signed:
        v = s % 2**64
        by_root.setdefault(want[v], set()).add(v)
        by_found.setdefault(found.get(s, s), set()).add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_found.values()))
    assert links.count() <= 8 * len(values)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_one_row_of_each_group_stays_when_ids_repeat(spark):
    long = "the quick brown fox jumps over the lazy dog and runs far away"
    other = "nothing here is like the text that stands beside it in the table"
    rows = [(3, long, 1), (5, long, 2), (5, other, 3), (None, "lone words of no id at all", 4), (None, long, 5),
            (None, "lone words of no id at all", 6), (8, None, 7), (8, "", 8), (9, " ", 9)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, id INT").withColumns({"text_key": F.lit(1), "nameless": F.lit(2)})
    stay = near_dedup.drop_near_duplicates(docs.repartition(3))
    assert stay.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in stay.collect()), key=str)
    assert [g[0] for g in got] == [3, 5, 8, None]
    assert [g[1] for g in got][:2] == [long, other] and got[2][1] in (None, "") and got[3][1].startswith("lone")
    assert near_dedup.drop_near_duplicates(docs.limit(0)).count() == 0
