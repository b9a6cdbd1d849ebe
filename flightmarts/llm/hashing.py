"""Vectorised hashes of byte strings, words and word n-grams."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_MASK = (1 << 64) - 1
_U = np.uint64


class _Powers:
    """Powers of the base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> None:
        if n < len(self.up):
            return
        size = 1 << max(16, int(n).bit_length())
        steps = np.full(size, _BASE, _U)
        steps[0] = 1
        self.up = np.cumprod(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        self.down = np.cumprod(steps)


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Prefixes:
    """Hash of any substring of ``data`` from one pass over it."""

    def __init__(self, data: np.ndarray) -> None:
        _powers.upto(len(data) + 1)
        # Scrambled byte values keep short strings apart.
        values = mix(np.arange(1, 257, dtype=_U))[data]
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(values * _powers.up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * _powers.down[starts]
        return mix(raw + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes, split at ASCII white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    starts, ends = word_bounds(data)
    return Prefixes(data).of(starts, ends)


def shingle_set(text: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a shorter text is one n-gram."""
    hashes = word_hashes(np.frombuffer(text, np.uint8))
    if not len(hashes):
        return hashes
    width = min(n, len(hashes))
    total = np.zeros(len(hashes) - width + 1, _U)
    for k in range(width):
        total = total * _U(_BASE) + hashes[k : k + len(total)]
    return np.unique(mix(total + _U(width)))


def fold(values: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each row of a matrix of unsigned values."""
    out = np.full(values.shape[0], seed & _MASK, _U)
    for k in range(values.shape[1]):
        out = mix(out * _U(_BASE) + values[:, k].astype(_U))
    return out
