"""A data source whose tasks write one file a partition, seen together or not at all.

Each task writes its partition to a file of its own among the attempts of the write,
below a name that readers pass over. Only once all tasks are done does the commit
drop what tried and failed, and move the folder of the attempts into place by one
rename; an abort drops it. So no row of an aborted task is ever read. A stream names
the folder by its batch: a batch that comes again finds it there and changes nothing.

    spark.dataSource.register(PartitionFiles)
    df.write.format("partition_files").mode("append").save(folder)

Folders may lie on any file system that pyarrow opens by its address and that can
rename a folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

ATTEMPTS = "_attempts"


@dataclass
class Written(WriterCommitMessage):
    """A task's file among the attempts; no name where it had no rows."""

    attempt: str
    name: str
    rows: int


class _Attempts:
    """The files of one write, before they are seen."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.write_id = uuid.uuid4().hex

    def _opened(self) -> tuple[fs.FileSystem, str]:
        address = self.folder
        if address.startswith("file:/") and not address.startswith("file://"):
            address = f"file://{address.removeprefix('file:')}"
        elif "://" not in address:
            address = f"file://{address}"
        return fs.FileSystem.from_uri(address)

    def write_partition(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, root = self._opened()
        mine = f"{root}/{ATTEMPTS}/{self.write_id}"
        files.create_dir(mine, recursive=True)
        name = f"part-{uuid.uuid4().hex}.parquet"
        rows, writer = 0, None
        with files.open_output_stream(f"{mine}/{name}") as out:
            for batch in batches:
                writer = writer or pq.ParquetWriter(out, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer:
                writer.close()
        if not writer:  # no rows, and so no columns: not a file to read
            files.delete_file(f"{mine}/{name}")
        return Written(self.write_id, name if writer else "", rows)

    def move_into(self, place: str, messages: list[Written | None]) -> None:
        """Put the files of finished tasks in place, by one rename.

        Spark may commit by another writer than the one that wrote, so the messages tell
        where the attempts are.
        """
        files, root = self._opened()
        done = [m for m in messages if m]
        attempts = sorted({m.attempt for m in done if m.name})
        target = f"{root}/{place}"
        if attempts and files.get_file_info(target).type == fs.FileType.NotFound:
            first = f"{root}/{ATTEMPTS}/{attempts[0]}"
            for m in done:  # usually one writer wrote all of them
                if m.name and m.attempt != attempts[0]:
                    files.move(f"{root}/{ATTEMPTS}/{m.attempt}/{m.name}", f"{first}/{m.name}")
            kept = {m.name for m in done}
            for file in files.get_file_info(fs.FileSelector(first)):
                if file.base_name not in kept:
                    files.delete_file(file.path)
            files.move(first, target)
        self.drop(messages)

    def drop(self, messages: list[Written | None]) -> None:
        files, root = self._opened()
        for attempt in {self.write_id, *(m.attempt for m in messages if m)}:
            mine = f"{root}/{ATTEMPTS}/{attempt}"
            if files.get_file_info(mine).type == fs.FileType.Directory:
                files.delete_dir(mine)


class _Writer(_Attempts, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.write_partition(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.move_into(f"batch={self.write_id}", messages)

    def abort(self, messages: list[Written | None]) -> None:
        self.drop(messages)


class _StreamWriter(_Attempts, DataSourceStreamArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.write_partition(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.move_into(f"batch={batchId}", messages)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.drop(messages)


class PartitionFiles(DataSource):
    """Option ``path``: the folder of the table."""

    @classmethod
    def name(cls) -> str:
        return "partition_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("partition files are only appended")
        return _Writer(self.options["path"])

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options["path"])


def append_partitions(df: DataFrame, folder: str) -> None:
    df.sparkSession.dataSource.register(PartitionFiles)
    df.write.format(PartitionFiles.name()).mode("append").save(folder)


def start_appending(
    rows: DataFrame, folder: str, checkpoint: str, every: str | None = "5 seconds"
) -> StreamingQuery:
    """Append a stream's batches; ``every=None`` takes what is there and stops."""
    rows.sparkSession.dataSource.register(PartitionFiles)
    return (
        rows.writeStream.format(PartitionFiles.name()).outputMode("append")
        .option("path", folder).option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def read_partitions(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What committed writes have put there."""
    stored = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    return spark.read.schema(stored).parquet(folder).drop("batch")
