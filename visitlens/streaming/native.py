"""Ad counts kept in Spark's own state store.

Their cost per micro-batch follows the batch, not the table. Without ``delay`` the
running counts have no watermark: nothing is dropped and the state holds every key.
With it a unit's state goes once the newest click is ``delay`` past its end; its last
count was written by then, and later clicks of it are dropped (to keep those apart,
see :mod:`closing`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitlens.functions.times import date_key, date_text, hour_text, minute_key, minute_text
from visitlens.operators.ads import TREND_MINUTES
from visitlens.sinks.batches import BatchTable
from visitlens.sinks.buckets import BucketTable, replacing

DAY = "1 day"


def _watermarked(clicks: DataFrame, delay: str | None) -> DataFrame:
    return clicks.withWatermark("ts", delay) if delay else clicks


def realtime_stat_stream(clicks: DataFrame, delay: str | None = None) -> DataFrame:
    """Running clicks per (day, province, city, ad); write in ``update`` mode."""
    day = F.window("ts", DAY).alias("day")
    counted = _watermarked(clicks, delay).groupBy(day, "province", "city", "ad_id")
    return counted.agg(F.count(F.lit(1)).alias("clickCount")).select(
        date_key(F.col("day.start")).alias("date"),
        "province",
        "city",
        F.col("ad_id").alias("adid"),
        "clickCount",
    )


def user_daily_clicks_stream(clicks: DataFrame, delay: str | None = None) -> DataFrame:
    """Running clicks per (day, user, ad); write in ``update`` mode."""
    day = F.window("ts", DAY).alias("day")
    counted = _watermarked(clicks, delay).groupBy(day, "user_id", "ad_id")
    return counted.agg(F.count(F.lit(1)).alias("clickCount")).select(
        date_text(F.col("day.start")).alias("date"),
        F.col("user_id").alias("userid"),
        F.col("ad_id").alias("adid"),
        "clickCount",
    )


def click_trend_stream(clicks: DataFrame, delay: str | None = None) -> DataFrame:
    """Running clicks per (minute, ad); write in ``update`` mode.

    Replacing rows by key in the sink yields the trend table; its trailing
    hour is a filter on read.
    """
    minute = F.window("ts", "1 minute").alias("slot")
    counted = _watermarked(clicks, delay).groupBy(minute, "ad_id")
    start = F.col("slot.start")
    return counted.agg(F.count(F.lit(1)).alias("clickCount")).select(
        date_key(start).alias("date"),
        hour_text(start).alias("hour"),
        minute_text(start).alias("minute"),
        F.col("ad_id").alias("adid"),
        "clickCount",
    )


def trend_windows_stream(clicks: DataFrame, minutes: int = TREND_MINUTES) -> DataFrame:
    """The trend as seen at the end of every minute; write in ``update`` mode.

    One aggregation and no watermark, so that a late click still updates all the
    windows that hold it.
    """
    seen = F.window("ts", f"{minutes} minutes", "1 minute").alias("seen")
    minute = F.date_trunc("minute", "ts").alias("ts")
    ts = F.col("ts")
    return clicks.groupBy(seen, minute, "ad_id").agg(F.count(F.lit(1)).alias("clickCount")).select(
        minute_key(F.col("seen.end")).alias("window_end"),
        date_key(ts).alias("date"), hour_text(ts).alias("hour"), minute_text(ts).alias("minute"),
        F.col("ad_id").alias("adid"), "clickCount",
    )


def start_updates(
    updates: DataFrame, table: BatchTable, checkpoint: str, every: str | None = "5 seconds"
) -> StreamingQuery:
    """Append the changed rows of an ``update`` stream; ``table.newest`` reads them.

    ``every=None`` takes what is there, in batches, and stops.
    """
    return _started(updates, lambda rows, batch_id: table.append(batch_id, rows), checkpoint, every)


def start_upserts(
    updates: DataFrame, table: BucketTable, keys: Sequence[str], checkpoint: str,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Replace the changed rows of an ``update`` stream by key, in their buckets only."""
    rule = replacing(keys)
    return _started(
        updates, lambda rows, batch_id: table.apply(batch_id, rows, rule), checkpoint, every
    )


def _started(updates, write, checkpoint: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}

    def write_once(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()  # the state store must not be asked twice in a batch
        try:
            write(rows, batch_id)
        finally:
            rows.unpersist()

    return (
        updates.writeStream.foreachBatch(write_once)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
