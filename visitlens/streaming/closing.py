"""Counts of time units that close, each given out once, and the clicks that came too late.

Spark's state store counts by minute or day behind a watermark. A unit closes when
the watermark passes its end: its counts are given out, once, and its state is
dropped, so the state holds open units only. Spark drops clicks of closed units
without a trace. The same query therefore passes on the raw clicks beside the
closed counts, and the writer keeps those that belong to units closed before:
closed counts, late clicks and the units still open account for every click.

Which clicks Spark drops follows from its rule: in a batch those whose unit ended
at or before the watermark that the batch before worked with, which is the newest
click of all batches before that one, less the delay. A clock of two rows keeps
what that takes, so it holds after a restart and for a batch that comes again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from visitlens import schemas
from visitlens.functions.times import date_key, hour_text, minute_key, minute_text
from visitlens.operators.ads import TREND_MINUTES
from visitlens.sinks.batches import BatchTable
from visitlens.sinks.buckets import Notes

MINUTE, DAY = "1 minute", "1 day"
_CLOCK = T.StructType([
    T.StructField(name, T.LongType()) for name in ("two_before", "one_before", "newest")
])


def _counted(clicks: DataFrame, unit: str, delay: str, *keys: str) -> DataFrame:
    slot = F.window("ts", unit).alias("slot")
    return clicks.withWatermark("ts", delay).groupBy(slot, *keys).agg(
        F.count(F.lit(1)).alias("clickCount")
    )


def _trend_row(minute: Column) -> list[Column]:
    return [
        date_key(minute).alias("date"), hour_text(minute).alias("hour"),
        minute_text(minute).alias("minute"), F.col("ad_id").alias("adid"), F.col("clickCount"),
    ]


def closed_minutes(clicks: DataFrame, delay: str) -> DataFrame:
    """Clicks of each (minute, ad) when the minute closes; ``append`` mode."""
    return _counted(clicks, MINUTE, delay, "ad_id").select(*_trend_row(F.col("slot.start")))


def closed_trend_windows(clicks: DataFrame, delay: str, minutes: int = TREND_MINUTES) -> DataFrame:
    """The trend as seen at the end of every minute, once per window; ``append`` mode.

    Clicks are counted by minute first and sliding windows hold minutes, so that the
    copies windows make are of counts.
    """
    by_minute = _counted(clicks, MINUTE, delay, "ad_id")
    seen = F.window(F.window_time("slot"), f"{minutes} minutes", MINUTE).alias("seen")
    held = by_minute.groupBy(seen, F.col("slot.start").alias("ts"), "ad_id").agg(
        F.sum("clickCount").alias("clickCount")
    )
    return held.select(minute_key(F.col("seen.end")).alias("window_end"), *_trend_row(F.col("ts")))


def closed_days(clicks: DataFrame, delay: str) -> DataFrame:
    """Clicks of each (day, province, city, ad) when the day closes; ``append`` mode."""
    return _counted(clicks, DAY, delay, "province", "city", "ad_id").select(
        date_key(F.col("slot.start")).alias("date"), "province", "city",
        F.col("ad_id").alias("adid"), "clickCount",
    )


class ClosedTable:
    """Closed counts, late clicks and the clock of one query, below one shared folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.closed_rows = BatchTable(spark, f"{folder}/closed", schema)
        self.late_rows = BatchTable(spark, f"{folder}/late", schemas.AD_CLICK)
        self.clock = Notes(spark, f"{folder}/clock", _CLOCK)

    def closed(self) -> DataFrame:
        return self.closed_rows.rows().select(*self.closed_rows.schema.names)

    def late(self) -> DataFrame:
        return self.late_rows.rows().select(*schemas.AD_CLICK.names)

    def tick(self, batch: int, newest: int | None) -> int | None:
        """Note a batch's newest click; returns the newest of what precedes the batch before.

        Both in epoch milliseconds, which is what Spark's watermark counts in.
        """
        rows = {row["batch"]: row for row in self.clock.newest()}
        if batch in rows:  # it comes again
            return rows[batch]["two_before"]
        last = rows.get(batch - 1)
        seen = [t for t in (newest, last and last["newest"]) if t is not None]
        before = (last["one_before"], last["newest"]) if last else (None, None)
        self.clock.put(batch, *before, max(seen, default=None))
        return before[0]


def store_closed(
    both: DataFrame, batch: int, table: ClosedTable, unit: str, delay: str
) -> None:
    """Keep the closed counts of a batch and those of its clicks that Spark dropped."""
    both = both.persist()
    try:
        clicks = both.where(F.col("click").isNotNull()).select("click.*")
        newest = clicks.agg(F.max(F.unix_millis("ts"))).first()[0]
        table.closed_rows.append(batch, both.where(F.col("closed").isNotNull()).select("closed.*"))
        known = table.tick(batch, newest)
        if known is not None:
            watermark = F.timestamp_millis(F.lit(known)) - F.expr(f"INTERVAL {delay}")
            late = clicks.where(F.window("ts", unit)["end"] <= watermark)
            table.late_rows.append(batch, late)
    finally:
        both.unpersist()


def start_closing(
    clicks: DataFrame, closed: DataFrame, table: ClosedTable, unit: str, delay: str,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Run ``closed``, one of the counts above over ``clicks``, and keep late clicks apart.

    ``unit`` is the unit that closes, ``delay`` the one given to the counts, such as
    "10 minutes". ``every=None`` takes what is there, in batches, and stops.
    """
    clicks = clicks.select(*schemas.AD_CLICK.names)
    counts = closed.select(
        F.struct(*closed.columns).alias("closed"), F.lit(None).cast(clicks.schema).alias("click")
    )
    raw = clicks.select(
        F.lit(None).cast(closed.schema).alias("closed"), F.struct(*clicks.columns).alias("click")
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        counts.unionByName(raw)
        .writeStream.outputMode("append")
        .foreachBatch(lambda both, batch: store_closed(both, batch, table, unit, delay))
        .option("checkpointLocation", f"{table.folder}/checkpoint")
        .trigger(**trigger)
        .start()
    )
