"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multiplier of the rolling polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_random = np.random.Generator(np.random.PCG64(20240601))
#: A random 64-bit value for each byte, so that byte patterns of texts do not line up.
BYTE = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """The first ``count`` powers modulo 2**64, kept for the next texts."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(count, base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit (public constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Texts are hashed about so many bytes at once; arrays take some 30 times as much.
HASHED = 1 << 18


def text_parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in order, in parts of at most ``HASHED`` bytes (one text at least)."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > HASHED:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


class Words:
    """The words (runs without white space) of texts, A-Z lower-cased.

    ``doc`` is the number of each word's text, ``start`` and ``end`` are byte places in
    the joined buffer. ``hashes(start, end)`` hashes any byte ranges of it.
    """

    def __init__(self, texts: list[bytes]):
        joined = b" ".join(texts)
        self.data = LOWER[np.frombuffer(joined, dtype=np.uint8)]
        gap = SPACE[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = np.cumsum(sizes + 1) - sizes - 1
        self.doc = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        n = len(self.data) + 1
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(BYTE[self.data] * powers(BASE, n)[:-1], out=self.sums[1:])
        self.back = powers(INVERSE, n)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        plain = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(plain + (end - start).astype(np.uint64))

    def words(self) -> np.ndarray:
        return self.hashes(self.start, self.end)


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several, order counts."""
    out = np.zeros(len(parts[0]), dtype=np.uint64)
    for part in parts:
        out = mixed(out * np.uint64(BASE) + part)
    return out
