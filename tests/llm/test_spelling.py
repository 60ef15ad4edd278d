import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulseframe.llm import spelling
from pulseframe.llm.queries import oracle_sql

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def wanted(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, out = {}, {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = (form[w], n[w], len(near), n[best] if form[w] else None)

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, f, root(w), c, k, fn) for w, (f, c, k, fn) in out.items())


def texts(seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdéÿ") for _ in range(r.randint(5, 12))) for _ in range(40)]
    base += ["Straßenbahn", "ÜBERMUT", "übermut", "a" * 90, "a" * 89 + "b", "a" * 91]
    rows = []
    for i in range(300):
        out = []
        for _ in range(60):
            w = r.choice(base[:1 + i % len(base)])
            if r.random() < 0.2:
                p = r.randrange(len(w))
                w = w[:p] + r.choice(["", w[p] + "c", "d", "é"]) + w[p + 1:]
            out.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i % 250, r.choice([" ", "-", "1", ", ", "×", "\U0001F600"]).join(out)))
    return rows + [(None, "nothing nothing nothing nothing nothing nothings " * 5), (7, None), (8, ""), (9, " .,; ")]


@pytest.mark.parametrize("seed, most", [(1, 1_000_000), (2, 3), (3, 0)])
def test_against_brute_force(spark, seed, most):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    docs = docs.withColumns({c: F.lit(1) for c in ("key", "word", "rest", "more", "run", "code", "own_id")})
    got = spelling.spelling_variants(docs.repartition(5), most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = wanted(rows)
    assert any(f for _, f, *_ in want)
    assert sorted(map(tuple, got.collect()), key=lambda x: x[0]) == want


def test_words_that_share_all_but_one_letter(spark):
    """One chunk holds a third of all words and more: the pairs stay exact."""
    words = ["prefix" + a + b + "ed" for a in "abcdefghij" for b in "klmnopqrst"] + ["xprefixakd", "prefixaked"]
    found = spelling.near_pairs(spark.createDataFrame([(w,) for w in set(words)], "word STRING"), 50)
    got = [tuple(sorted(r)) for r in found.collect()]
    want = {tuple(sorted((a, b))) for a in set(words) for b in set(words) if one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 700, "aaaaaab": 130, "aaaaacb": 25, "aaaadcb": 5, "zzzzzz": 26, "zzzzzy": 5, "zzzzzx": 26}
    rows = [(1000 + i, w) for w, c in counts.items() for i in range(c) if zlib.crc32(f"{1000 + i}:{w}".encode()) % 199]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert sorted(map(tuple, got), key=lambda x: x[0]) == wanted(rows)
    assert {r.word: r.root for r in got}["aaaadcb"] == "aaaaaaa" and {r.word: r.form for r in got}["zzzzzy"] == "zzzzzx"


def test_empty(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0


def test_sql_is_there():
    assert "op13_spelling_variants" in oracle_sql()
