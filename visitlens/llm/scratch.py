"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new, not yet existing path below ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local master, where driver and
    executor are one process, may leave it unset: then a temporary folder serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def save(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back, so that later jobs start from files.

    A lost executor then costs the rerun of its own tasks, not of the lineage.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
