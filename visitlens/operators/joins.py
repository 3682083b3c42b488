"""Semi and anti joins that stay balanced when one key has very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _filtering_join(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    # The key's hash as a second key never changes the result. With it both
    # sides are shuffled for this join even when ``keys`` comes partitioned by
    # the key already, and only then may adaptive execution split the rows of
    # a hot key over several tasks.
    check = F.xxhash64(key).alias("_key_hash")
    return (
        rows.select("*", check)
        .join(keys.select(key, check), [key, "_key_hash"], how)
        .select(*rows.columns)
    )


def rows_with_key(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return _filtering_join(rows, keys, key, "left_semi")


def rows_without_key(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is NULL or does not occur in ``keys``."""
    return _filtering_join(rows, keys, key, "left_anti")
