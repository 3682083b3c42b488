"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection: no two values meet)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for blocks of up to ``n`` bytes."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of each word of a text, A-Z lower-cased, cut at ASCII white space.

    A word's hash is its polynomial modulo 2**64: a difference of prefix sums,
    moved to the power of the word's start.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    word = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text.

    A text with fewer words than a shingle is one shingle of all its words; a
    text without words, or null, is the empty set.
    """
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(_BASE) + h[i : len(h) - size + 1 + i])
    return np.unique(out)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common values of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
