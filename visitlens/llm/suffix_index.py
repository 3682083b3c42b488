"""An inverted index of dense vectors for joins by inner product with a threshold.

Dimensions are taken in one order for all vectors, heaviest first. A row is listed
only under its leading dimensions: what the others can add to any of the asking
vectors is at most the product of both suffixes' norms, and once that is below the
threshold a pair that shares no listed dimension cannot reach it. Rows are sorted
by how far they are listed, so the list of a dimension is the head of one array and
partial scores of all asking vectors advance together. After each group of
dimensions a pair goes when its partial score and the remaining norms stay below
its threshold; few pairs left are finished one by one.

Entries are whole numbers, and scores are exact: where squared norms stay below
2^52 every sum fits a double, other vectors are multiplied as Python integers.
"""

from __future__ import annotations

import numpy as np

STEP = 8  # dimensions that advance at once
FEW = 0.15  # of pairs alive: finish them one by one
AT_ONCE = 1 << 17  # pairs finished at once
EXACT = float(1 << 52)
LONGEST = (1 << 63) - 1


def _remaining(vectors: np.ndarray) -> np.ndarray:
    """Norm of what follows, at the start of each group of dimensions and at the end."""
    squares = np.add.reduceat(vectors * vectors, np.arange(0, vectors.shape[1], STEP), axis=1)
    after = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([after, np.zeros((len(vectors), 1))]))


class SuffixIndex:
    """Rows of whole numbers with squared norms below ``EXACT``."""

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
        self.rows = np.ascontiguousarray(rows[:, self.order])
        self.after = _remaining(self.rows)

    def pairs(self, asking: np.ndarray, floors: np.ndarray):
        """(asking row, indexed row, score) of all pairs with score >= the asking row's floor."""
        asking = np.ascontiguousarray(asking[:, self.order])
        after = _remaining(asking)
        # Norms are rounded and scores whole, so half a unit keeps the bound on the safe side.
        goal = floors[:, None] - 0.5
        covered = self.after * after.max(axis=0) * (1 + 1e-12) < floors.min() - 0.5
        groups = self.after.shape[1] - 1
        listed = np.where(covered.any(axis=1), covered.argmax(axis=1), groups)
        live = np.argsort(-listed, kind="stable")
        live = live[listed[live] > 0]
        partial = np.zeros((len(asking), len(live)))
        found = []
        for group in range(groups):
            if not len(live):
                break
            own = slice(group * STEP, (group + 1) * STEP)
            partial += asking[:, own] @ self.rows[live, own].T
            bound = after[:, group + 1, None] * self.after[live, group + 1] * (1 + 1e-12)
            alive = partial + bound >= goal
            going = int((listed[live] > group + 1).sum())
            if group + 1 == groups or np.count_nonzero(alive) <= FEW * alive.size:
                going = 0
            ends = alive[:, going:].nonzero()
            if len(ends[0]):
                column = ends[1] + going
                found.append(
                    self._finish(asking, ends[0], live[column], partial[ends[0], column],
                                 (group + 1) * STEP, floors)
                )
            kept = alive[:, :going].any(axis=0).nonzero()[0]
            live, partial = live[kept], partial[:, kept]
        if not found:
            return _none()
        return tuple(np.concatenate(part) for part in zip(*found))

    def _finish(self, asking, a, r, score, start, floors):
        for at in range(0, len(a), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            score[some] += np.einsum(
                "ij,ij->i", asking[a[some], start:], self.rows[r[some], start:]
            )
        kept = score >= floors[a]
        return a[kept], r[kept], score[kept].astype(np.int64)


def _none():
    return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)


def _exact_pairs(asking: np.ndarray, rows: np.ndarray, floors: np.ndarray):
    """The same for entries of any size; scores beyond a long become its bounds."""
    if not len(asking) or not len(rows):
        return _none()
    whole = np.vectorize(int, otypes=[object])
    right = whole(rows).T
    found = []
    for i, vector in enumerate(asking):  # one row of Python integers at a time
        scores = whole(vector) @ right
        scores = np.array([max(-LONGEST, min(LONGEST, s)) for s in scores], np.int64)
        kept = (scores >= floors[i]).nonzero()[0]
        found.append((np.full(len(kept), i), kept, scores[kept]))
    return tuple(np.concatenate(part) for part in zip(*found))


class Rows:
    """Rows of whole numbers of any size, indexed where sums of doubles are exact."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        narrow = (rows * rows).sum(axis=1) < EXACT
        self.narrow, self.wide = narrow.nonzero()[0], (~narrow).nonzero()[0]
        self.index = SuffixIndex(rows[self.narrow]) if len(self.narrow) and rows.shape[1] else None

    def pairs(self, asking: np.ndarray, floors: np.ndarray):
        """(asking row, row, score) of all pairs that reach the asking row's floor."""
        if not self.rows.shape[1]:  # vectors without entries: every score is 0
            a, r = np.nonzero(np.broadcast_to(floors[:, None] <= 0, (len(asking), len(self.rows))))
            return a, r, np.zeros(len(a), np.int64)
        narrow = (asking * asking).sum(axis=1) < EXACT
        few, many = (~narrow).nonzero()[0], narrow.nonzero()[0]
        found = []
        if self.index is not None and len(many):
            a, r, score = self.index.pairs(asking[many], floors[many])
            found.append((many[a], self.narrow[r], score))
        if len(self.wide):
            a, r, score = _exact_pairs(asking[many], self.rows[self.wide], floors[many])
            found.append((many[a], self.wide[r], score))
        if len(few):
            a, r, score = _exact_pairs(asking[few], self.rows, floors[few])
            found.append((few[a], r, score))
        return tuple(np.concatenate(part) for part in zip(*found)) if found else _none()
