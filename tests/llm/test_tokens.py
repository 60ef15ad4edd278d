import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pulseframe.llm import tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library(library):
    r = random.Random(2)
    letters = list("abcdefgh \n\t.,;:!?()[]{}'\"-_=+*&^%$#@0123456789ABCéüñ▁日本語の中国한국русский😀‍　\x00\xa0fi’«»")
    extra = ["<s>", "</s>", "<unk>", "<0x0A>", "\r\n", "    ", "http://", "();", "...", "$\\", "\n\n"]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    counter = tokens.PieceCounter(MODEL)
    for _ in range(6000):
        kind = r.choice((letters, extra, pieces))
        text = "".join(r.choice(kind if r.random() < 0.8 else letters) for _ in range(r.randint(0, 25)))
        assert counter.count(text) == len(library.encode(text)), text


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    counter = tokens.PieceCounter(MODEL)
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    assert counter.count(text) == len(library.encode(text)) and len(counter._remembered) <= 5


def test_operator(spark, library):
    rows = [(1, "some words"), (2, None), (3, ""), (3, ""), (None, "é" * 9000), (4, "a " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({c: F.lit(1) for c in ("n_tokens", "n_bytes")})
    got = sorted((tuple(r) for r in tokens.token_counts(docs, MODEL, 4096).collect()), key=str)
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t in rows]
    assert got == sorted(want, key=str)
    assert tokens.token_counts(docs.limit(0), MODEL).count() == 0
