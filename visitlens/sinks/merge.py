"""How a batch of changes meets the current rows of a table.

Pure functions of two DataFrames; both sides hold at most one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_add(
    current: DataFrame, delta: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Add to existing values, insert new keys: one aggregation, no join."""
    columns = [*keys, value]
    both = current.select(*columns).unionByName(delta.select(*columns))
    return both.groupBy(*keys).agg(F.sum(value).alias(value))


def upsert_replace(current: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace existing rows by key, insert new keys."""
    kept = current.join(delta.select(*keys), list(keys), "left_anti")
    return kept.select(*delta.columns).unionByName(delta)


def replace_group(current: DataFrame, delta: DataFrame, group: Sequence[str]) -> DataFrame:
    """Delete every group that occurs in ``delta``, then insert ``delta``."""
    touched = delta.select(*group).distinct()
    kept = current.join(touched, list(group), "left_anti")
    return kept.select(*delta.columns).unionByName(delta)


def insert_new(current: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows whose key is not there yet, leave the others alone."""
    fresh = delta.join(current.select(*keys), list(keys), "left_anti")
    return current.unionByName(fresh.select(*current.columns))
