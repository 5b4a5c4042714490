"""Vectorised 64-bit hashes of byte ranges and word runs in NumPy arrays."""

from __future__ import annotations

import numpy as np

from perennial.llm import worker

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
# Bytes hashed at once; eight bytes a position are held for each of about a dozen arrays, some 100 MB.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    start = np.uint64(seed * 1_000_003 % (1 << 63))
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + start) * np.uint64(_MULTIPLIER))


def _powers(name: str, base: int, n: int) -> np.ndarray:
    tables = worker.kept("powers", dict)
    if name not in tables or len(tables[name]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        tables[name] = np.cumprod(steps, dtype=np.uint64)
    return tables[name]


class RangeHash:
    """Hashes of ranges of a byte buffer: polynomials modulo 2^64 over a random byte table."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        terms = seeded(256, 7)[data]
        terms *= _powers("up", _MULTIPLIER, n + 1)[:n]
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self._sums[1:])
        self._down = _powers("down", _INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64))

    def every(self, width: int) -> np.ndarray:
        """Hashes of all ranges of one width, by start."""
        n = len(self._sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self._sums[width:] - self._sums[:n]) * self._down[:n])


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the white-space separated words of a text, in order."""
    out = []
    at = 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        part = np.frombuffer(data, np.uint8, end - at, at)
        gap = (part == 32) | ((part >= 9) & (part <= 13))
        edges = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            out.append(RangeHash(part).of(starts, ends))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole, if it is shorter."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    acc = np.full(n, width, np.uint64)
    for i in range(width):
        acc = mixed(acc * np.uint64(_MULTIPLIER) + words[i : i + n])
    return acc
