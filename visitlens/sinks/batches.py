"""Tables that grow by the rows of each micro-batch.

A batch only appends what it changes, as partition ``batch=<n>`` of a plain
Parquet table; running it again replaces that partition and nothing else. What
the table holds is one aggregation on read: a sum where rows are additions, the
value of the newest batch where rows are new values. Batch numbers must come
from one stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch"


class BatchTable:
    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType,
        partition_by: Sequence[str] = (),
    ):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.partition_by = tuple(partition_by)

    def append(self, batch: int, rows: DataFrame) -> None:
        """Store the rows of a batch, in place of an earlier try of it."""
        stamped = rows.select(*self.schema.names, F.lit(batch).cast("long").alias(BATCH))
        (
            stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition_by, BATCH).parquet(self.folder)
        )

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows with their batch, optionally of earlier batches only."""
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        try:
            found = self.spark.read.schema(schema).parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        found = found.select(*schema.names)
        return found if before is None else found.where(F.col(BATCH) < before)

    def added(self, keys: Sequence[str], value: str, before: int | None = None) -> DataFrame:
        """The running total of each key."""
        return self.rows(before).groupBy(*keys).agg(F.sum(value).alias(value))

    def newest(self, keys: Sequence[str], before: int | None = None) -> DataFrame:
        """The newest row of each key."""
        values = [c for c in self.schema.names if c not in keys]
        return (
            self.rows(before).groupBy(*keys)
            .agg(F.max_by(F.struct(*values), BATCH).alias("newest"))
            .select(*keys, "newest.*").select(*self.schema.names)
        )

    def newest_group(self, group: Sequence[str], before: int | None = None) -> DataFrame:
        """The rows of the newest batch of each group."""
        rows = self.rows(before)
        last = rows.groupBy(*group).agg(F.max(BATCH).alias(BATCH))
        return rows.join(last, [*group, BATCH], "left_semi").select(*self.schema.names)

    def compact(self, content: DataFrame, folder: str, batch: int) -> BatchTable:
        """A new table that starts from ``content``, this one's as of ``batch``."""
        table = BatchTable(self.spark, folder, self.schema, self.partition_by)
        table.append(batch, content)
        return table
