import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.llm import substrings
from pulseframe.llm.suffixes import BlindTrie, common_prefix, deep_shallow_order


def wanted(texts, window):
    """Every window of every text counted."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if counts[d[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        yield len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def made(seed, n, letters, most):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(0, most)))
    shared = [word() for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [r.choice(shared) if r.random() < 0.5 else word() for _ in range(r.randint(0, 4))]
        out.append("".join(parts))
        if r.random() < 0.2:
            out.append(out[-1][:r.randint(0, len(out[-1]))] + r.choice(letters) + out[-1])
    return out + [None, "", "é" * 30, "ab" * 40, "a" * 90, out[0], out[0]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b) * 3), max_size=30), st.integers(0, 24))
def test_order(strings, shallow):
    order = deep_shallow_order(strings, shallow)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(max_size=12).map(lambda b: b"pre" + bytes(x % 2 for x in b))))
def test_blind_trie(strings):
    strings = list(strings)
    trie = BlindTrie(strings, 3)
    for i in range(len(strings)):
        trie.add(i)
    assert [strings[i] for i in trie.rows()] == sorted(strings)
    for a in strings:
        for b in strings:
            n = common_prefix(a, b)
            assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=8), st.text("ab", max_size=8)), min_size=2, max_size=25, unique=True), st.integers(1, 10))
def test_covered(pairs, total):
    blocks = [(a.encode(), b.encode()) for a, b in pairs]
    for (a, x), got in zip(blocks, substrings.covered(blocks, total)):
        reach = [(common_prefix(a, b), common_prefix(x, y)) for b, y in blocks if (b, y) != (a, x)]
        reach = [r for r in reach if sum(r) >= total]
        assert got == ((max(r[0] for r in reach), max(r[1] for r in reach)) if reach else None)


@pytest.mark.parametrize("seed, letters, window, gram, group_rows", [
    (1, "ab", 20, 4, 512), (2, "ab", 20, 4, 2), (3, "abcdefgh", 30, 8, 3), (4, "abé", 25, 5, 4), (5, "a b\n", 40, 3, 1)])
@pytest.mark.parametrize("heavy", [2, 0.01])
def test_spans(spark, monkeypatch, seed, letters, window, gram, group_rows, heavy):
    monkeypatch.setattr(substrings, "HEAVY_SHARE", heavy)
    monkeypatch.setattr(substrings, "LEAST_HEAVY", 1)
    texts = made(seed, 60, letters, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(5)
    got = substrings.remove_repeats(docs, window, gram, group_rows, keep_text=True).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == list(wanted(texts, window))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_long_texts_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 64)
    texts = made(9, 10, "abc", 200)
    for text in texts:
        data = (text or "").encode()
        parts = substrings.anchors(data, 20, 4)
        monkeypatch.setattr(substrings, "CHUNK", 1 << 20)
        whole = substrings.anchors(data, 20, 4)
        monkeypatch.setattr(substrings, "CHUNK", 64)
        assert [p.tolist() for p in parts] == [p.tolist() for p in whole]


def test_repeated_rows_nulls_and_names(spark):
    long = "".join(chr(97 + i * 7 % 26) for i in range(30)) * 20
    docs = spark.createDataFrame([(1, long), (1, long), (None, "x" + long), (None, None), (2, "short")], "doc_id LONG, text STRING")
    docs = docs.withColumns({c: F.lit(1) for c in ("key", "h", "p", "d", "g", "spans", "first")})
    got = substrings.remove_repeats(docs).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == [(0, 0, 0), (5, 0, 0), (600, 600, 1), (600, 600, 1), (601, 600, 1)]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
