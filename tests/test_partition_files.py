"""Writes by partition: seen whole or not at all."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest
from frame_rows import tuples
from pyspark.sql import functions as F

from visitlens.sinks import partition_files
from visitlens.sinks.partition_files import ATTEMPTS, PartitionFiles, _StreamWriter, _Writer


def rows(spark, n, parts=4):
    return spark.range(n, numPartitions=parts).withColumn("text", F.concat(F.lit("t"), "id"))


def read(spark, folder, like):
    return tuples(partition_files.read_partitions(spark, folder, like.schema))


@pytest.mark.parametrize("address", ["{}", "file://{}", "file:{}"])
def test_writes_add_up(spark, scratch, address):
    folder = address.format(f"{scratch}/t")
    given = rows(spark, 50)
    for _ in range(2):
        partition_files.append_partitions(given, folder)
    assert read(spark, folder, given) == sorted(tuples(given) * 2, key=repr)
    assert not list(Path(f"{scratch}/t/{ATTEMPTS}").iterdir())


def test_empty_partitions_and_tables(spark, scratch):
    given = rows(spark, 3, parts=8)
    partition_files.append_partitions(given, f"{scratch}/t")
    partition_files.append_partitions(given.limit(0), f"{scratch}/t")
    assert read(spark, f"{scratch}/t", given) == tuples(given)


def test_a_failed_task_leaves_no_row(spark, scratch):
    """The other tasks have written theirs by then."""
    given = rows(spark, 40)
    partition_files.append_partitions(given, f"{scratch}/t")
    broken = given.withColumn("text", F.when(F.col("id") == 39, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="no"):
        partition_files.append_partitions(broken, f"{scratch}/t")
    assert read(spark, f"{scratch}/t", given) == tuples(given)
    assert not list(Path(f"{scratch}/t/{ATTEMPTS}").iterdir())


def batches(*values):
    return iter([pa.RecordBatch.from_pydict({"id": list(values)})]) if values else iter([])


def ids(folder):
    return sorted(
        i for file in Path(folder).glob("batch=*/*.parquet") for i in pa.parquet.read_table(file)["id"].to_pylist()
    )


def test_what_a_failed_attempt_wrote_is_not_committed(scratch):
    writer = _Writer(scratch)
    writer.write_partition(batches(1, 2))  # this attempt's answer is lost, the task runs again
    done = [writer.write_partition(batches(1, 2)), writer.write_partition(batches()), None]
    assert [m and m.rows for m in done] == [2, 0, None]
    assert ids(scratch) == []
    writer.commit(done)
    assert ids(scratch) == [1, 2]


def test_abort_drops_the_attempts(scratch):
    writer = _Writer(scratch)
    writer.abort([writer.write_partition(batches(1))])
    assert ids(scratch) == [] and not list(Path(scratch, ATTEMPTS).iterdir())


def test_a_batch_that_comes_again_changes_nothing(scratch):
    for again in range(2):
        writers = [_StreamWriter(scratch) for _ in range(2)]
        done = [w.write_partition(batches(i)) for i, w in enumerate(writers)]
        _StreamWriter(scratch).commit(done, 7)  # not the writer that wrote
    assert ids(scratch) == [0, 1]
    _StreamWriter(scratch).commit([], 8)
    assert not list(Path(scratch, ATTEMPTS).iterdir())


def test_overwriting_is_refused(spark, scratch):
    spark.dataSource.register(PartitionFiles)
    with pytest.raises(Exception, match="only appended"):
        rows(spark, 3).write.format("partition_files").mode("overwrite").save(f"{scratch}/t")


def test_stream(spark, scratch):
    given = rows(spark, 30)
    for part in range(3):
        given.where(F.col("id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        partition_files.start_appending(
            stream, f"{scratch}/t", f"{scratch}/checkpoint", every=None
        ).awaitTermination()
    assert read(spark, f"{scratch}/t", given) == tuples(given)
    assert {p.name for p in Path(f"{scratch}/t").glob("batch=*")} == {"batch=0", "batch=1", "batch=2"}
