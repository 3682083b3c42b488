"""A repeatable sample of sessions, spread over days and hours.

Sessions are ordered by a hash of their id. To rank them without gathering an
hour in one task, each hour is cut into slices by the leading hash digits: the
slice counts tell which slices are taken whole and which single slice is cut,
and only sessions of those slices are looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.times import date_text, hour_text
from visitlens.operators.joins import rows_with_key
from visitlens.operators.sessions import session_terms

SLICE_DIGITS = 3  # hex digits: 4096 slices per hour

def _by_hour(sessions: DataFrame) -> DataFrame:
    start = F.col("start_time")
    return sessions.select(
        "session_id",
        "start_time",
        date_text(start).alias("date"),
        hour_text(start).alias("hour"),
    )


def _quota(hour_count: Column, day_count: Column, days: Column, sample_size: int) -> Column:
    """An hour's part of its day's equal part, rounded down."""
    per_day = F.floor(F.lit(sample_size) / days)
    part = F.floor(hour_count.cast("double") / day_count * per_day)
    return F.least(part, hour_count).cast("long")


def _day_number(counts: DataFrame) -> Column:
    return counts.agg(F.count_distinct("date")).scalar()


def session_sample_quota(sessions: DataFrame, sample_size: int = 100) -> DataFrame:
    """Sessions, sessions of the day and sessions to draw, for each hour."""
    hours = _by_hour(sessions).groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("session_count")
    )
    day = Window.partitionBy("date")
    counted = hours.withColumn("day_count", F.sum("session_count").over(day))
    return counted.withColumn(
        "quota",
        _quota(F.col("session_count"), F.col("day_count"), _day_number(hours), sample_size),
    )


def session_stratified_sample(
    sessions: DataFrame, sample_size: int = 100, seed: int = 0
) -> DataFrame:
    """About ``sample_size`` sessions; the same ones for the same seed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("session_id")))
    keyed = (
        _by_hour(sessions)
        .withColumn("digest", digest)
        .withColumn("slice", F.substring("digest", 1, SLICE_DIGITS))
    )
    slices = keyed.groupBy("date", "hour", "slice").agg(F.count(F.lit(1)).alias("n"))

    # Day first: its partitioning also serves the hour windows.
    hour = Window.partitionBy("date", "hour")
    upto = hour.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    planned = (
        slices.withColumn("day_count", F.sum("n").over(Window.partitionBy("date")))
        .withColumn("hour_count", F.sum("n").over(hour))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
        .withColumn(
            "quota",
            _quota(F.col("hour_count"), F.col("day_count"), _day_number(slices), sample_size),
        )
        .where(F.col("before") < F.col("quota"))
        .select("date", "hour", "slice", (F.col("quota") - F.col("before")).alias("take"))
    )
    # Whether the kept slices fit a broadcast is left to Spark's size check.
    order = Window.partitionBy("date", "hour", "slice").orderBy("digest", "session_id")
    return (
        keyed.join(planned, ["date", "hour", "slice"])
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= F.col("take"))
        .select("session_id", "start_time", "date", "hour")
    )


def sample_with_terms(sample: DataFrame, actions: DataFrame) -> DataFrame:
    """Add search words and clicked categories, built for the sample only."""
    terms = session_terms(rows_with_key(actions, sample, "session_id"))
    return sample.join(terms, "session_id").select(
        "session_id", "start_time", "search_keywords", "click_category_ids"
    )
