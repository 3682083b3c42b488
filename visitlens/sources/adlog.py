"""Ad-click lines: ``<epoch millis> <province> <city> <user id> <ad id>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import from_millis


def _typed(lines: DataFrame) -> DataFrame:
    """Each line with its five typed fields, NULL where a field does not fit.

    Split once per line: later filters stay above the generator and so do not
    repeat the split.
    """
    parts = lines.select("value", F.split("value", " ").alias("parts"))
    part = [F.get("parts", F.lit(i)) for i in range(5)]
    fields = F.struct(
        from_millis(part[0].try_cast("bigint")).alias("ts"),
        part[1].alias("province"),
        part[2].alias("city"),
        part[3].try_cast("bigint").alias("user_id"),
        part[4].try_cast("bigint").alias("ad_id"),
    )
    return parts.select("value", F.inline(F.array(fields)))


def _is_click() -> Column:
    # A fifth field implies the ones before it, so the places are there.
    return (
        F.col("ts").isNotNull() & F.col("user_id").isNotNull() & F.col("ad_id").isNotNull()
    )


def parse_ad_log(lines: DataFrame) -> DataFrame:
    """Well-formed lines of column ``value`` as typed clicks."""
    return _typed(lines).where(_is_click()).drop("value")


def rejected_ad_lines(lines: DataFrame) -> DataFrame:
    """The lines :func:`parse_ad_log` leaves out, as they came."""
    return _typed(lines).where(~_is_click()).select("value")


def kafka_options(brokers: str, topic: str) -> dict[str, str]:
    """Subscribe from the newest offsets; progress lives in the query checkpoint."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "latest",
    }


def kafka_ad_lines(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """Stream of lines from Kafka (needs the spark-sql-kafka package)."""
    stream = spark.readStream.format("kafka").options(**kafka_options(brokers, topic)).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def text_ad_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of lines from text files that appear in ``folder``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)
