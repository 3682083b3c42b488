"""Ad-click analyses on typed clicks (``ts, province, city, user_id, ad_id``).

All of them are counts by key that combine before the shuffle; the same
functions serve whole tables and the micro-batches of the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.times import date_key, date_text, hour_text, minute_key, minute_text
from visitlens.operators.joins import rows_without_key

# Clicks on one ad in one day that list a user, ads per
# province, minutes of the trend.
BLACKLIST_THRESHOLD = 100
PROVINCE_TOP = 3
TREND_MINUTES = 60


def _clicks() -> Column:
    return F.count(F.lit(1)).alias("clickCount")


def ad_blacklist_filter(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users who are not listed.

    No broadcast hint: the list grows with the users, so that choice is left
    to Spark's size check.
    """
    listed = blacklist.select(F.col("userid").alias("user_id"))
    return rows_without_key(clicks, listed, "user_id")


def ad_user_daily_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(
        date_text(F.col("ts")).alias("date"),
        F.col("user_id").alias("userid"),
        F.col("ad_id").alias("adid"),
    ).agg(_clicks())


def ad_blacklist_update(
    counts: DataFrame, blacklist: DataFrame | None = None, threshold: int = BLACKLIST_THRESHOLD
) -> DataFrame:
    """Users to add: at or over the threshold for some (day, ad), not yet listed.

    ``date`` is the first day that reached it.
    """
    over = (
        counts.where(F.col("clickCount") >= threshold)
        .groupBy("userid")
        .agg(F.min("date").alias("date"))
        .select("date", "userid")
    )
    if blacklist is None:
        return over
    return over.join(blacklist.select("userid"), "userid", "left_anti").select("date", "userid")


def ad_realtime_stat(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(
        date_key(F.col("ts")).alias("date"), "province", "city", F.col("ad_id").alias("adid")
    ).agg(_clicks())


def ad_province_top3(
    stat: DataFrame,
    k: int = PROVINCE_TOP,
    partition_by: Sequence[str] = ("date", "province"),
) -> DataFrame:
    """The ``k`` most clicked ads; ``partition_by=("province",)`` ranks over all days."""
    per_ad = stat.groupBy("date", "province", "adid").agg(
        F.sum("clickCount").alias("clickCount")
    )
    order = Window.partitionBy(*partition_by).orderBy(F.desc("clickCount"), "adid", "date")
    return (
        per_ad.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= k)
        .select("date", "province", "adid", "clickCount")
    )


def _trend_columns(minute: Column) -> list[Column]:
    return [
        date_key(minute).alias("date"),
        hour_text(minute).alias("hour"),
        minute_text(minute).alias("minute"),
        F.col("ad_id").alias("adid"),
    ]


def _per_minute(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(F.date_trunc("minute", "ts").alias("ts"), "ad_id").agg(_clicks())


def ad_minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks of each (minute, ad): the whole trend table."""
    return _per_minute(clicks).select(*_trend_columns(F.col("ts")), "clickCount")


def ad_click_trend(
    clicks: DataFrame, as_of: Column | None = None, minutes: int = TREND_MINUTES
) -> DataFrame:
    """Clicks of each (minute, ad) in the last ``minutes`` minutes.

    The last minute is that of ``as_of``, by default of the newest click.
    """
    counts = _per_minute(clicks)
    newest = counts.agg(F.max("ts")).scalar() if as_of is None else as_of
    last = F.date_trunc("minute", newest)
    oldest = last - F.make_dt_interval(mins=F.lit(minutes - 1))
    recent = counts.where(F.col("ts").between(oldest, last))
    return recent.select(*_trend_columns(F.col("ts")), "clickCount")


def ad_trend_windows(clicks: DataFrame, minutes: int = TREND_MINUTES) -> DataFrame:
    """The trend as seen at the end of every minute: sliding windows.

    Clicks are counted per minute first, so the copies that sliding windows
    make are of counts, and a window holds each (minute, ad) once.
    """
    per_minute = clicks.groupBy(F.window("ts", "1 minute").alias("slot"), "ad_id").agg(_clicks())
    seen = F.window("slot", f"{minutes} minutes", "1 minute").alias("seen")
    minute = F.col("slot.start").alias("ts")
    windows = per_minute.select(seen, minute, "ad_id", "clickCount")
    return windows.select(
        minute_key(F.col("seen.end")).alias("window_end"),
        *_trend_columns(F.col("ts")),
        "clickCount",
    )
