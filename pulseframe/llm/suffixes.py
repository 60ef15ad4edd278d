"""Sorting strings by deep-shallow sorting, and longest common prefixes."""

from __future__ import annotations

from collections.abc import Sequence

#: Depth in bytes up to which multikey quicksort works; blind tries order what is still equal.
SHALLOW = 32
_STEP = 8


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix; both agree up to ``start``."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    low, high = start, end
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Orders distinct strings that share a long prefix.

    Nodes hold only the depth at which their strings differ and the byte that follows.
    A new string goes down by those bytes alone, is compared once with the leaf that it
    reaches, and is hung where the first difference is. -1 stands for the end of a string.
    """

    def __init__(self, strings: Sequence[bytes], depth: int) -> None:
        self._strings, self._depth = strings, depth
        self._root: int | tuple[int, dict] | None = None

    def _byte(self, string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    def add(self, row: int) -> None:
        if self._root is None:
            self._root = row
            return
        new, node = self._strings[row], self._root
        while isinstance(node, tuple):
            node = node[1].get(self._byte(new, node[0])) or next(iter(node[1].values()))
            node = node[0] if isinstance(node, list) else node
        other = self._strings[node]
        differ = common_prefix(new, other, self._depth)
        above, node = None, self._root
        while isinstance(node, tuple) and node[0] < differ:
            above = node[1], self._byte(new, node[0])
            node = above[0][above[1]][0]
        mark = self._byte(new, differ)
        if isinstance(node, tuple) and node[0] == differ:
            node[1][mark] = [row]
            return
        split = differ, {self._byte(other, differ): [node], mark: [row]}
        if above:
            above[0][above[1]] = [split]
        else:
            self._root = split

    def rows(self) -> list[int]:
        out: list[int] = []
        stack = [] if self._root is None else [self._root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b][0] for b in sorted(node[1], reverse=True))
            else:
                out.append(node)
        return out


def deep_shallow_order(strings: Sequence[bytes], shallow: int = SHALLOW) -> list[int]:
    """The rows of ``strings`` in the order of their bytes; equal strings stay together."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) < 2:
            out.extend(rows)
        elif depth >= shallow:
            same: dict[bytes, list[int]] = {}
            for row in rows:
                same.setdefault(strings[row], []).append(row)
            trie = BlindTrie(strings, depth)
            for first in same.values():
                trie.add(first[0])
            for row in trie.rows():
                out.extend(same[strings[row]])
        else:
            keys = [strings[row][depth:depth + _STEP] for row in rows]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [r for r, k in zip(rows, keys) if k < pivot]
            equal = [r for r, k in zip(rows, keys) if k == pivot]
            more = [r for r, k in zip(rows, keys) if k > pivot]
            stack.append((more, depth))
            # A short pivot ends its strings: they are equal.
            stack.append((equal, depth + _STEP if len(pivot) == _STEP else max(shallow, depth)))
            stack.append((less, depth))
    return out
