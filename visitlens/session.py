"""Spark session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Partition counts are left to the cluster: with adaptive execution the
    shuffle partition number is only an upper bound.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the Python line of every column expression doubles the time
        # the driver takes to build a query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only an unset folder on a local master falls back to a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="visitlens-")


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors, starts a fresh lineage, stays columnar
    and has a known size, so later joins are planned on facts.
    """
    spark = df.sparkSession
    root = folder or shared_dir(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Intermediates:
    """A folder of its own for the tables a job writes on its way, removed at the end.

    Give ``path`` to a job as its ``folder`` and write the job's results inside the
    ``with`` block: they read these tables until then. A job that fails leaves no
    table behind either; a driver that is lost leaves the one folder.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self._spark = spark
        self.path = f"{folder or shared_dir(spark)}/run-{uuid.uuid4().hex}"

    def __enter__(self) -> Intermediates:
        return self

    def __exit__(self, *failure: object) -> None:
        self.remove()

    def remove(self) -> None:
        """Remove the folder; nothing happens if it was never written."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
        files.delete(path, True)
