"""Whole-table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Put the caller's run id in front of a result."""
    return df.select(F.lit(task_id).alias("taskid"), "*")


def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Replace a catalog table, kept below ``path`` or in the warehouse.

    Partition actions by ``date`` to prune scans.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _save(writer, name, path)


def overwrite_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, path: str | None = None
) -> None:
    """Replace a catalog table stored by the hash of ``key``, one sorted file a bucket.

    Tables with the same buckets join by the key without a shuffle, and a lookup by key
    opens one bucket. A key with a large part of all rows is one large bucket: store
    rows by a key that spreads them, such as sessions or users, not actions.
    """
    placed = df.repartition(buckets, key)
    _save(placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key), name, path)


def _save(writer: DataFrameWriter, name: str, path: str | None) -> None:
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_files(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_jdbc(
    df: DataFrame, url: str, table: str, user: str, password: str, connections: int = 10
) -> None:
    """Append to a database table over at most ``connections`` connections.

    Result tables are small next to their inputs. They are repartitioned for
    the write, which keeps the computation before it as wide as it was.
    """
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "numPartitions": str(connections),
    }
    df.repartition(connections).write.format("jdbc").options(**options).mode("append").save()
