"""Nearest points of the E8 lattice, vectorised.

E8 is the union of D8 (integer points with an even sum) and D8 moved by a half in
every coordinate. The nearest point of D8 rounds each coordinate and, if the sum
is odd, rounds the one that is farthest from its integer the other way.
"""

from __future__ import annotations

import numpy as np


def _d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and another near point of D8 for each row."""
    down = np.rint(x)
    off = x - down
    order = np.argsort(-np.abs(off), axis=1)
    rows = np.arange(len(x))
    side = np.where(off >= 0, 1.0, -1.0)

    def turned(point: np.ndarray, nth: int) -> np.ndarray:
        out = point.copy()
        out[rows, order[:, nth]] += side[rows, order[:, nth]]
        return out

    odd = (down.sum(axis=1) % 2 != 0)[:, None]
    once, second = turned(down, 0), turned(down, 1)
    return np.where(odd, once, down), np.where(odd, second, turned(once, 1))


def nearest(x: np.ndarray, probes: int) -> list[np.ndarray]:
    """The nearest E8 point of each row of ``x`` (n, 8), then up to three
    neighbouring points by distance; all as twice their coordinates, integers."""
    found = [*_d8(x), *(p + 0.5 for p in _d8(x - 0.5))]
    points = np.stack(found, axis=1)
    far = ((points - x[:, None, :]) ** 2).sum(axis=2)
    order = np.argsort(far, axis=1, kind="stable")
    rows = np.arange(len(x))
    return [
        np.rint(2 * points[rows, order[:, i]]).astype(np.int64) for i in range(probes + 1)
    ]
