import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulseframe.llm import packing

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def plain_best_fit(sizes, length):
    """One piece after another, into the fullest bin that it fits."""
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, left in enumerate(bins) if left >= size]
        if fitting:
            bins[min(fitting, key=bins.__getitem__)] -= size
        else:
            bins.append(length - size)
    return sorted(bins)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60).flatmap(lambda n: st.tuples(st.just(n), st.dictionaries(st.integers(1, n), st.integers(1, 20), max_size=12))))
def test_runs_are_best_fit_decreasing(case):
    length, counts = case
    used, places = defaultdict(int), defaultdict(list)
    runs = sorted(packing.best_fit(counts, length))
    for size, count in counts.items():
        own = [r for r in runs if r[0] == size]
        for rank in range(count):
            _, first, sequence, each, offset = [r for r in own if r[1] <= rank][-1]
            at = rank - first
            used[sequence + at // each] += size
            places[sequence + at // each].append((offset + at % each * size, size))
    for items in places.values():
        end = 0
        for offset, size in sorted(items):
            assert offset == end
            end += size
    sizes = [s for s, n in counts.items() for _ in range(n)]
    assert sorted(length - u for u in used.values()) == plain_best_fit(sizes, length)


def test_fast_ids_equal_the_library():
    encoder, library = packing.Encoder(*FILES), Tokenizer.from_file(FILES[0])
    r = random.Random(6)
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    letters = "abc XYZ\n\t.,'s're 012éß<|endoftext|>\x1c\x85\xa0 　"
    for _ in range(4000):
        text = "".join(chr(r.choice(points)) if r.random() < 0.3 else r.choice(letters) for _ in range(r.randint(0, 30)))
        text += r.choice(("", "", "<|endoftext|>", "  <|endoftext|> x"))
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED_TOGETHER", 7)
    library, length = Tokenizer.from_file(FILES[0]), 64
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(("the", "packing", "é", "\n")) for _ in range(r.randint(0, 90)))) for i in range(200)]
    rows += [(500, None), (501, ""), (501, ""), (None, "null id"), (502, "long " * 3000)] + [(600, "same length")] * 50
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({c: F.lit(1) for c in ("row", "piece", "size", "part")})
    got = packing.pack(docs.repartition(5), *FILES, length=length).collect()
    pieces = []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % length or length
        starts = [0, *range(first, len(ids), length)]
        pieces += [(doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(pieces, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    left = []
    for items in sequences.values():
        end = 0
        for offset, size in sorted(items):
            assert offset == end
            end += size
        left.append(length - end)
    assert sorted(left) == plain_best_fit([p[3] for p in pieces], length)
    assert packing.pack(docs.limit(0), *FILES).count() == 0
