"""Tables of running values whose cost per batch follows the keys of the batch.

A table is stored by day and by a hash of some key columns, as partitions
``day=…/bucket=…`` of plain Parquet. A batch reads the partitions its keys fall
into, applies a merge rule to them and replaces exactly these by dynamic partition
overwrite: what lies in other buckets, and how many batches came before, costs
nothing. A bucket holds one row a key, so it grows with its keys only.

Replacing partitions isn't atomic and rules that add must not be applied twice, so
the new contents are written apart first. Once all tables of a batch have theirs,
a :class:`Ledger` notes the batch, and they are put in place; a batch that comes
again after that is put in place again, not computed again. Batch numbers must come
from one stream. Reading a table while another stream writes it may miss buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.sinks import merge

BUCKET = "bucket"
BUCKETS = 16

#: From what a table holds and the rows of a batch to the new content.
Rule = Callable[[DataFrame, DataFrame], DataFrame]


def read_stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The Parquet files of a folder, no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(folder).select(*schema.names)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Notes:
    """A row of the newest batches, kept so that a cut-off write loses none but its own.

    Batches take turns in two partitions, and each replaces only its own.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder = spark, folder
        self.schema = T.StructType([T.StructField("batch", T.LongType()), *schema.fields])

    def put(self, batch: int, *values) -> None:
        row = self.spark.range(1).select(
            *(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip((batch, *values), self.schema))
        )
        (
            row.coalesce(1).withColumn("turn", F.lit(batch % 2)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("turn").parquet(self.folder)
        )

    def newest(self) -> list[Row]:
        """The rows of the last two batches, the newest first."""
        stored = read_stored(self.spark, self.folder, self.schema)
        return sorted(stored.collect(), key=lambda row: -row["batch"])


class Ledger:
    """The last batch whose new contents are complete."""

    def __init__(self, spark: SparkSession, folder: str):
        self._notes = Notes(spark, folder, T.StructType())

    def noted(self) -> int | None:
        rows = self._notes.newest()
        return rows[0]["batch"] if rows else None

    def note(self, batch: int) -> None:
        self._notes.put(batch)


class BucketTable:
    """``bucket_by`` are key columns whose hash places a row; rows of one key, or of one
    group where groups are replaced, must agree in them. ``day`` names the partition column."""

    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType, bucket_by: Sequence[str],
        day: str | None = None, buckets: int = BUCKETS,
    ):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.bucket_by, self.buckets = tuple(bucket_by), buckets
        self.partition_by = [*([day] if day else []), BUCKET]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def _stored(self, part: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return read_stored(self.spark, f"{self.folder}/{part}", schema)

    def rows(self) -> DataFrame:
        return self._stored("rows").drop(BUCKET)

    def staged(self) -> DataFrame:
        """New contents of the buckets that the last batch touched."""
        return self._stored("staged").drop(BUCKET)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows in the buckets of the given keys; no other file is read.

        The driver learns the buckets, at most days x ``buckets``, not the keys.
        """
        touched = keys.withColumn(BUCKET, self._bucket()).select(*self.partition_by).distinct().collect()
        stored = self._stored("rows")
        by_day: dict[tuple, list[int]] = {}
        for row in touched:
            by_day.setdefault(tuple(row)[:-1], []).append(row[BUCKET])
        conditions = [
            reduce(
                lambda both, pair: both & F.col(pair[0]).eqNullSafe(pair[1]),
                zip(self.partition_by, day), F.col(BUCKET).isin(sorted(found)),
            )
            for day, found in by_day.items()
        ]
        return stored.where(reduce(or_, conditions) if conditions else F.lit(False)).drop(BUCKET)

    def stage(self, delta: DataFrame, rule: Rule, keys: DataFrame | None = None) -> DataFrame:
        """Write the new contents of the touched buckets apart; nothing is replaced yet.

        ``keys`` may name the keys of ``delta`` where these are known more cheaply.
        """
        current = self.lookup(delta if keys is None else keys)
        merged = rule(current, delta).select(*self.schema.names)
        (
            merged.withColumn(BUCKET, self._bucket()).repartition(*self.partition_by)
            .write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.folder}/staged")
        )
        return self.staged()

    def publish(self) -> None:
        """Put the staged contents in place of the old; doing it again changes nothing."""
        (
            self._stored("staged").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*self.partition_by)
            .parquet(f"{self.folder}/rows")
        )

    def apply(self, batch: int, delta: DataFrame, rule: Rule) -> None:
        """Merge one batch into this table alone, once however often it comes."""
        ledger = Ledger(self.spark, f"{self.folder}/ledger")
        if ledger.noted() != batch:
            self.stage(delta, rule)
            ledger.note(batch)
        self.publish()


def together(*steps: Callable[[], None]) -> None:
    """Run independent writes at the same time: each is a few small jobs."""
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        for running in [pool.submit(inheriting(step)) for step in steps]:
            running.result()


def adding(keys: Sequence[str], value: str) -> Rule:
    return lambda current, delta: merge.upsert_add(current, delta, keys, value)


def replacing(keys: Sequence[str]) -> Rule:
    return lambda current, delta: merge.upsert_replace(current, delta, keys)


def replacing_group(group: Sequence[str]) -> Rule:
    return lambda current, delta: merge.replace_group(current, delta, group)


def inserting(keys: Sequence[str]) -> Rule:
    return lambda current, delta: merge.insert_new(current, delta, keys)
