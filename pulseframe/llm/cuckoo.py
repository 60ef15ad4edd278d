"""A cuckoo filter with the live digests stored in buckets beside it."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import Any

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Digest to value. The filter answers misses; a hit is verified in the digest's bucket.

    Digests are uniformly distributed bytes, eight or more. When an insertion finds no
    slot, the table doubles and is filled anew from the stored digests, so nothing is lost.
    """

    def __init__(self, buckets: int = 256) -> None:
        self._make(max(2, 1 << (buckets - 1).bit_length()))
        self._live = 0

    def __len__(self) -> int:
        return self._live

    def _make(self, buckets: int) -> None:
        self._mask = buckets - 1
        self._slots = array("H", bytes(2 * SLOTS * buckets))
        self._content: list[list[list] | None] = [None] * buckets

    def _place(self, digest: bytes) -> tuple[int, int]:
        number = int.from_bytes(digest[:8], "little")
        return (number >> 48) or 1, number & self._mask

    def _other(self, mark: int, bucket: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & self._mask)

    def _slot(self, mark: int, bucket: int) -> int:
        """Where a bucket holds a fingerprint (0: a free slot), or -1."""
        for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if self._slots[slot] == mark:
                return slot
        return -1

    def may_hold(self, digest: bytes) -> bool:
        mark, bucket = self._place(digest)
        return self._slot(mark, bucket) >= 0 or self._slot(mark, self._other(mark, bucket)) >= 0

    def entry(self, digest: bytes) -> list | None:
        """The live ``[digest, value]``, verified, or None."""
        if self.may_hold(digest):
            for entry in self._content[self._place(digest)[1]] or ():
                if entry[0] == digest:
                    return entry
        return None

    def add(self, digest: bytes, value: Any) -> None:
        """Insert a digest that is not live."""
        mark, bucket = self._place(digest)
        if self._content[bucket] is None:
            self._content[bucket] = []
        self._content[bucket].append([digest, value])
        self._live += 1
        if not self._insert(mark, bucket):
            self._grow()

    def _insert(self, mark: int, bucket: int) -> bool:
        for turn in range(MAX_KICKS):
            for place in (bucket, self._other(mark, bucket)):
                free = self._slot(0, place)
                if free >= 0:
                    self._slots[free] = mark
                    return True
            bucket = self._other(mark, bucket)
            victim = SLOTS * bucket + turn % SLOTS
            mark, self._slots[victim] = self._slots[victim], mark
            bucket = self._other(mark, bucket)
        return False

    def _grow(self) -> None:
        entries, buckets = list(self), 2 * (self._mask + 1)
        while True:
            self._make(buckets)
            full = False
            for entry in entries:
                mark, bucket = self._place(entry[0])
                if self._content[bucket] is None:
                    self._content[bucket] = []
                self._content[bucket].append(entry)
                full = full or not self._insert(mark, bucket)
            if not full:
                return
            buckets *= 2

    def remove(self, digest: bytes) -> bool:
        """Delete a live digest; False if it was not live."""
        entry = self.entry(digest)
        if entry is None:
            return False
        mark, bucket = self._place(digest)
        self._content[bucket].remove(entry)
        slot = self._slot(mark, bucket)
        if slot < 0:
            slot = self._slot(mark, self._other(mark, bucket))
        self._slots[slot] = 0
        self._live -= 1
        return True

    def __iter__(self) -> Iterator[list]:
        for bucket in self._content:
            yield from bucket or ()
