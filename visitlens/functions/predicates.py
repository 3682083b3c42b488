"""Parameter predicates. An empty parameter restricts nothing.

Each returns ``None`` for "no restriction", so that the caller adds no filter
at all; :func:`all_of` combines what is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def between(c: Column, low: int | None, high: int | None) -> Column | None:
    """Closed range; applies only when both bounds are given."""
    if low is None or high is None:
        return None
    return c.between(low, high)


def one_of(c: Column, wanted: Sequence) -> Column | None:
    return c.isin(list(wanted)) if wanted else None


def any_of(c: Column, wanted: Sequence) -> Column | None:
    """Some element of an array column is wanted."""
    if not wanted:
        return None
    return F.arrays_overlap(c, F.array(*[F.lit(w) for w in wanted]))


def equal_to(c: Column, wanted: str | None) -> Column | None:
    return c == wanted if wanted else None


def all_of(*parts: Column | None) -> Column:
    return reduce(lambda a, b: a & b, [p for p in parts if p is not None], F.lit(True))
