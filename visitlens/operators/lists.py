"""Distinct values of a group, joined into as many texts as they need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.session import materialize


def concat_distinct_chunks(
    df: DataFrame, group: Sequence[str], value: str, size: int, sep: str = ","
) -> DataFrame:
    """Sorted distinct values of each group, ``size`` of them a row: group, chunk (from 0),
    n_values, text. NULL values are skipped.

    For groups whose values don't fit a row or a task. Duplicates go before the shuffle;
    the values are then sorted by ranges, which split a group over as many tasks as it
    needs, and are stored so. A value's place in its group is its place in its range and
    what earlier ranges hold of the group, and tells its chunk.
    """
    group = list(group)
    distinct = df.where(F.col(value).isNotNull()).select(*group, value).distinct()
    ranged = materialize(
        distinct.repartitionByRange(*group, value).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    held = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_held"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = held.select(
        *(F.col(c).alias(f"_{c}") for c in group), F.col("_range").alias("_its_range"),
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    in_range = Window.partitionBy(*group, "_range").orderBy(value)
    placed = (
        ranged.withColumn("_place", F.row_number().over(in_range) - 1)
        .join(before, [*same, F.col("_range") == F.col("_its_range")])
        .withColumn("chunk", F.floor((F.col("_before") + F.col("_place")) / F.lit(size)).cast("long"))
    )
    texts = F.transform(F.array_sort(F.collect_list(value)), lambda v: v.cast("string"))
    return placed.groupBy(*group, "chunk").agg(
        F.count(F.lit(1)).alias("n_values"), F.array_join(texts, sep).alias("text")
    )
