"""Hashed character n-grams of many words at once, in numpy: the features of the trained models.

A word is looked at between two marks, so n-grams at its ends differ from those inside (these are its affixes). All
n-grams of all given sizes count, however long a word is; the whole word is one more feature.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _Q
    return (x ^ (x >> np.uint64(29))) * _P


class Subwords:
    """Rows of a table of 2**bits + 1 rows, of which row 0 stands for no feature."""

    def __init__(self, sizes: Sequence[int], bits: int):
        self.sizes, self.bits = tuple(sizes), bits

    @property
    def rows(self) -> int:
        return (1 << self.bits) + 1

    def _row(self, h: np.ndarray, kind: int) -> np.ndarray:
        salt = np.uint64(kind * int(_Q) % 2**64)
        return (_mix(h + salt) >> np.uint64(64 - self.bits)).astype(np.int32) + 1

    def __call__(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """First characters of the words and their lengths, marks included; for every size, the row of the n-gram that
        begins at each character; and the rows of the whole words."""
        joined = "".join([f"<{w}>" for w in words])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = np.fromiter(map(len, words), np.int64, len(words)) + 2
        starts = np.cumsum(n) - n
        place = np.arange(len(codes)) - np.repeat(starts, n)
        left = np.repeat(n, n) - place
        h, found = codes + np.uint64(1), []
        for k in range(1, max(self.sizes) + 1):
            if k > 1:
                h[: 1 - k] = h[: 1 - k] * _P + codes[k - 1 :]
            if k in self.sizes:
                found.append(np.where(left >= k, self._row(h, k), 0))
        powers = np.multiply.accumulate(np.full(int(n.max()) if len(n) else 1, _P))
        whole = np.add.reduceat(_mix(codes + np.uint64(7)) * powers[place], starts) if len(n) else np.zeros(0, np.uint64)
        return starts, n, found, self._row(whole, 0)

    def sums(self, words: Sequence[str], table: np.ndarray) -> np.ndarray:
        """By word, the sum of its features' rows of the table."""
        if not len(words):
            return np.zeros((0, table.shape[1]))
        starts, _, found, whole = self(words)
        by_character = table[found[0]].astype(np.float64)
        for rows in found[1:]:
            by_character += table[rows]
        return np.add.reduceat(by_character, starts, axis=0) + table[whole]
