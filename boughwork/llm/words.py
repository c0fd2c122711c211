"""Words of a text in normal form, and their hash buckets."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import chain

import numpy as np

#: Bytes of a text to bytes of its normal form: a-z, 0-9 and bytes from 0x80 are parts of
#: words, A-Z become a-z, everything else is a space.
NORMAL = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return (text or "").encode("utf-8").translate(NORMAL).split()


class Buckets(dict):
    """crc32 buckets of words, remembered for up to ``max_words`` words."""

    def __init__(self, bits: int, max_words: int = 300_000):
        super().__init__()
        self._mask, self._max = (1 << bits) - 1, max_words

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._max:
            self.clear()
        found = self[word] = zlib.crc32(word) & self._mask
        return found

    def counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets, ascending, and the words in each."""
        return np.unique(np.fromiter(map(self.__getitem__, words), np.int64, len(words)), return_counts=True)


class Parts(dict):
    """crc32 buckets of a word and, in a range of their own above those of words, of its first
    bytes; remembered like :class:`Buckets`."""

    def __init__(self, bits: int, prefixes: tuple[int, ...] = (4, 5, 6, 8), max_words: int = 150_000):
        super().__init__()
        self._mask, self._prefixes, self._max = (1 << bits) - 1, prefixes, max_words

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self._max:
            self.clear()
        starts = {zlib.crc32(word[:n]) & self._mask for n in self._prefixes if len(word) >= n}
        found = self[word] = (zlib.crc32(word) & self._mask, *(x + self._mask + 1 for x in starts))
        return found

    def counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of all words, ascending, and the words in each."""
        own = Counter(words)
        found = list(map(self.__getitem__, own))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        every = np.fromiter(chain.from_iterable(found), np.int64, sizes.sum())
        column, at = np.unique(every, return_inverse=True)
        times = np.repeat(np.fromiter(own.values(), np.int64, len(own)), sizes)
        return column, np.bincount(at, times, len(column))


_parts: dict[int, Parts] = {}


def parts(bits: int) -> Parts:
    """This worker's parts of words; Python workers are reused between tasks."""
    return _parts.setdefault(bits, Parts(bits))


_buckets: dict[int, Buckets] = {}


def buckets(bits: int) -> Buckets:
    """This worker's buckets; Python workers are reused between tasks."""
    return _buckets.setdefault(bits, Buckets(bits))


class Rows:
    """Sparse rows for training on the driver: ``column`` and ``value`` of all entries in order."""

    def __init__(self, columns: list[np.ndarray], values: list[np.ndarray] | None = None):
        self.sizes = np.array([len(c) for c in columns], np.int64)
        self.column = np.concatenate([*columns, np.zeros(0, np.int64)]).astype(np.int64, copy=False)
        self.value = np.concatenate([*values, np.zeros(0, np.float32)]).astype(np.float32, copy=False) if values is not None else np.ones(len(self.column), np.float32)
        self._full = np.flatnonzero(self.sizes)  # rows with entries
        self._starts = (np.cumsum(self.sizes) - self.sizes)[self._full]

    def __len__(self) -> int:
        return len(self.sizes)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self))
        if len(self.column):
            out[self._full] = np.add.reduceat(self.value * weights[self.column], self._starts)
        return out

    def back(self, by_row: np.ndarray, size: int) -> np.ndarray:
        """The transposed product: a sum for each column."""
        return np.bincount(self.column, self.value * np.repeat(by_row, self.sizes), size)


class Adam:
    def __init__(self, size: int, rate: float):
        self._m, self._v, self._t, self._rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        """What to add to the weights."""
        self._t += 1
        self._m = 0.9 * self._m + 0.1 * gradient
        self._v = 0.999 * self._v + 0.001 * gradient**2
        m, v = self._m / (1 - 0.9**self._t), self._v / (1 - 0.999**self._t)
        return -self._rate * m / (np.sqrt(v) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))
