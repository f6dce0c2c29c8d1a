"""Words and word shingles of many texts at once, as numpy arrays."""
from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def _byte_values() -> np.ndarray:
    """A fixed odd 64-bit number for each byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for shift, factor in ((32, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB), (32, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x | _ONE


_VALUES = _byte_values()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = _ONE
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """The first n powers of a number, kept from call to call up to a few million."""
    held = _POWERS.get(name)
    if held is None or len(held) < n:
        held = _powers(base, max(n, 1 << 21))
        if n <= 1 << 22:
            _POWERS[name] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of texts: runs without ASCII white space, texts kept apart."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    edge[0] = edge[-1] = True
    at = np.flatnonzero(edge)
    word = inside[at[:-1]]
    return at[:-1][word], at[1:][word]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, start) of every word, case kept."""
    if len(data) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    start, end = word_bounds(data, offsets)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power("up", _BASE, len(data)), out=sums[1:])
    hashes = (sums[end] - sums[start]) * _power("down", _INVERSE, len(data))[start]
    return mix(hashes), start


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Of every text the sorted, different hashes of its word shingles, A-Z in lower case.

    A text with fewer words than ``size`` has its whole word sequence as one shingle, a text without
    words none.
    """
    hashes, start = word_hashes(_LOWER[data], offsets)
    cuts = np.searchsorted(start, offsets)
    n = max(0, len(hashes) - size + 1)
    rolled = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        rolled = mix(rolled ^ hashes[k:k + n]) + np.uint64(k)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mix(np.array([whole ^ h], np.uint64))[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out
