"""Readers of the three shop tables and the date-range scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens import schemas


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table, or Parquet files when ``source`` looks like a path."""
    if "/" not in source:
        return spark.table(source)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(source)


def read_actions(spark: SparkSession, source: str = "user_visit_action") -> DataFrame:
    return read_table(spark, source, schemas.USER_VISIT_ACTION)


def read_users(spark: SparkSession, source: str = "user_info") -> DataFrame:
    return read_table(spark, source, schemas.USER_INFO)


def read_products(spark: SparkSession, source: str = "product_info") -> DataFrame:
    return read_table(spark, source, schemas.PRODUCT_INFO)


def in_date_range(actions: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose ``date`` text lies in the closed range.

    A plain column predicate: it reaches the scan as a partition filter when
    the table is partitioned by ``date`` and as a Parquet filter otherwise.
    """
    return actions.where(F.col("date").between(start, end))


def lookup(table: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows of the given keys; of a table bucketed by ``key`` only their buckets are opened."""
    return table.where(F.col(key).isin(list(values)))
