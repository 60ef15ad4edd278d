"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import by_batch, whole_text

#: Words whose counts a worker remembers; when they are this many, it starts anew.
REMEMBERED = 400_000
MARK = "\u2581"


class PieceCounter:
    """Counts tokens as a sentencepiece byte-pair model with byte fallback does.

    The model must leave text as it is apart from marking spaces: each space becomes
    U+2581 and one is put before a text that is not empty.
    """

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        self._rank = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size()) if not any(f(i) for f in special)
        }
        self._remembered: dict[str, int] = {}
        self._chunks = self._splitter()

    def _splitter(self) -> re.Pattern:
        """Cuts where no piece reaches across, so that the parts merge independently.

        A longer piece holds U+2581 at its start or nothing else. Characters that are in no
        longer piece stand alone. A run of letters that no longer piece joins with a mark
        behind ends before the mark; it is the usual word.
        """
        long = [p for p in self._rank if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            raise ValueError("a piece of the model has a space after other characters")
        inside = {c for p in long for c in p} - {MARK}
        joined = {(a, b) for p in long for a, b in zip(p, p[1:])}
        plain = [c for c in inside if c.isascii() and c.isalpha()]
        marks = [c for c in inside if c.isascii() and not c.isalnum() and not any((a, c) in joined for a in plain)]
        letters = [c for c in inside if c.isalnum() and not any((c, m) in joined for m in marks)]
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        mark, letter = ("".join(map(re.escape, sorted(cs))) for cs in (marks, letters))
        ended = f"[^{MARK}{alone}{mark}]"
        parts = [f"{MARK}*[{letter}]++(?!{ended})" if letters else "", f"{MARK}*[^{MARK}{alone}]+", f"{MARK}+",
                 f"[{alone}]" if alone else ""]
        return re.compile("|".join(filter(None, parts)))

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self._remembered, 0
        for chunk in self._chunks.findall(MARK + text.replace(" ", MARK)):
            n = known.get(chunk)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[chunk] = self._merge(chunk)
            total += n
        return total

    def _merge(self, chunk: str) -> int:
        """Initial symbols less merges: pops the lowest-ranked adjacent pair until none is left.

        Symbols are characters, linked to their neighbours; a character outside the
        vocabulary never merges and counts as its UTF-8 bytes. Ties go to the left.
        """
        rank = self._rank
        symbols: list[str | None] = list(chunk)
        size = len(symbols)
        total = sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in symbols)
        left, right = list(range(-1, size - 1)), list(range(1, size + 1))
        heap = []
        for i in range(size - 1):
            pair = chunk[i:i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if symbols[i] is None or j >= size or symbols[i] + symbols[j] != pair:
                continue  # one of the two has merged meanwhile
            symbols[i], symbols[j] = pair, None
            total -= 1
            after, before = right[j], left[i]
            right[i] = after
            if after < size:
                left[after] = i
                new = pair + symbols[after]
                if new in rank:
                    heapq.heappush(heap, (rank[new], i, new))
            if before >= 0:
                new = symbols[before] + pair
                if new in rank:
                    heapq.heappush(heap, (rank[new], before, new))
        return total


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    """One counter for each model and worker process."""
    return PieceCounter(path)


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``model`` is the path of a sentencepiece file, the same on all executors. Null and
    empty texts have 0 tokens; rows that repeat count alike; texts are never cut.
    """

    def make():
        count = piece_counter(model).count

        def step(doc_id, text):
            tokens = [count(t) for t in text]
            return {"doc_id": doc_id, "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in text],
                    "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

        return step

    return by_batch(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), make,
                    "doc_id LONG, n_bytes LONG, n_tokens LONG, over_limit BOOLEAN")
