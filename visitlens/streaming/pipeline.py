"""The ad-click pipeline: filter, count, list offenders, publish.

One ``foreachBatch`` does the steps in order, so that users listed by one batch
are filtered from the next one on. Running values lie in bucketed tables: a batch
reads and replaces the buckets its keys fall into, whatever came before it. All new
contents are written apart and noted before any is put in place, so a batch that
comes again after a failure is finished or begun anew from the same inputs: the
tables before the batch, and the blacklist that the first try noted down.

The per-user counts of a day are read again for the users of a batch. Where a day
holds too many for that, leave them to Spark's state store: run
:func:`start_blacklist_query` next to a pipeline with ``count_users=False``.
Both ways keep the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from visitlens import schemas
from visitlens.operators import ads
from visitlens.operators.joins import rows_without_key
from visitlens.sinks.batches import BATCH, BatchTable
from visitlens.sinks.buckets import (
    BucketTable, Ledger, adding, replacing, replacing_group, together,
)
from visitlens.sources.adlog import parse_ad_log, rejected_ad_lines
from visitlens.streaming.native import user_daily_clicks_stream

STAT_KEYS = ("date", "province", "city", "adid")
TREND_KEYS = ("date", "hour", "minute", "adid")
USER_KEYS = ("date", "userid", "adid")
TOP3_KEYS = ("date", "province")
_LINE = T.StructType([T.StructField("value", T.StringType())])
_USED = T.StructType([T.StructField("listed_before", T.LongType())])


@dataclass
class AdTables:
    """The tables and checkpoints below one folder all executors share."""

    folder: str
    ledger: Ledger
    users_ledger: Ledger
    blacklist_rows: BatchTable
    blacklist_used: BatchTable
    user_rows: BucketTable
    stat_rows: BucketTable
    top3_rows: BucketTable
    trend_rows: BucketTable
    rejected_rows: BatchTable

    @classmethod
    def under(cls, spark: SparkSession, folder: str) -> AdTables:
        def growing(name, schema):
            return BatchTable(spark, f"{folder}/{name}", schema)

        def running(name, schema, *bucket_by):
            return BucketTable(spark, f"{folder}/{name}", schema, bucket_by, day="date")

        return cls(
            folder,
            Ledger(spark, f"{folder}/ledger"),
            Ledger(spark, f"{folder}/users_ledger"),
            growing("ad_blacklist", schemas.AD_BLACKLIST),
            growing("ad_blacklist_used", _USED),
            running("ad_user_click_count", schemas.AD_USER_CLICK_COUNT, "userid"),
            running("ad_stat", schemas.AD_STAT, "province"),
            running("ad_province_top3", schemas.AD_PROVINCE_TOP3, "province"),
            # clicks of one batch lie in few hours, and so in few buckets
            running("ad_click_trend", schemas.AD_CLICK_TREND, "hour"),
            growing("rejected_lines", _LINE),
        )

    def blacklist(self, before: int | None = None) -> DataFrame:
        return self.blacklist_rows.rows(before).select("date", "userid")

    def user_click_count(self) -> DataFrame:
        return self.user_rows.rows()

    def stat(self) -> DataFrame:
        return self.stat_rows.rows()

    def province_top3(self) -> DataFrame:
        return self.top3_rows.rows()

    def click_trend(self) -> DataFrame:
        return self.trend_rows.rows()

    def rejected(self) -> DataFrame:
        return self.rejected_rows.rows().select("value")


def _listed_before(batch_id: int, tables: AdTables) -> int:
    """Up to which batch the blacklist counts for a batch: noted at its first try."""
    used = tables.blacklist_used
    noted = used.rows().where(F.col(BATCH) == batch_id).first()
    if noted:
        return noted["listed_before"]
    newest = tables.blacklist_rows.rows().agg(F.max(BATCH)).first()[0]
    before = 0 if newest is None else newest + 1
    used.append(batch_id, used.spark.createDataFrame([(before,)], _USED))
    return before


def process_batch(
    lines: DataFrame,
    batch_id: int,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    count_users: bool = True,
) -> None:
    """Apply one micro-batch of ad lines to all tables."""
    if tables.ledger.noted() != batch_id:
        stage_batch(lines, batch_id, tables, threshold, count_users)
    changed = [tables.stat_rows, tables.trend_rows, tables.top3_rows]
    together(*(table.publish for table in [*changed, *([tables.user_rows] if count_users else [])]))


def stage_batch(
    lines: DataFrame,
    batch_id: int,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    count_users: bool = True,
) -> None:
    """Write all new contents of a batch apart and note them as complete."""
    lines = lines.persist()
    # Another stream may add to the list meanwhile; this one's own batches can't.
    before = batch_id if count_users else _listed_before(batch_id, tables)
    clean = ads.ad_blacklist_filter(parse_ad_log(lines), tables.blacklist(before)).persist()
    stat = ads.ad_realtime_stat(clean).persist()

    def store_rejected():
        tables.rejected_rows.append(batch_id, rejected_ad_lines(lines))

    def stage_stat():
        current = tables.stat_rows.stage(stat, adding(STAT_KEYS, "clickCount"))
        # only provinces with clicks in this batch change their ranking
        touched = stat.select(*TOP3_KEYS).distinct()
        ranked = ads.ad_province_top3(current.join(touched, list(TOP3_KEYS), "left_semi"))
        tables.top3_rows.stage(ranked, replacing_group(TOP3_KEYS), keys=touched)

    def stage_trend():
        tables.trend_rows.stage(ads.ad_minute_counts(clean), adding(TREND_KEYS, "clickCount"))

    def stage_users():
        daily = ads.ad_user_daily_clicks(clean)
        counts = tables.user_rows.stage(daily, adding(USER_KEYS, "clickCount"))
        _list_users(counts, batch_id, tables, threshold)

    try:
        together(
            store_rejected, stage_stat, stage_trend, *([stage_users] if count_users else [])
        )
        tables.ledger.note(batch_id)
    finally:
        for kept in (stat, clean, lines):
            kept.unpersist()


def _list_users(counts: DataFrame, batch_id: int, tables: AdTables, threshold: int) -> None:
    """List the users who reached the threshold, but for those listed earlier."""
    listed = tables.blacklist(before=batch_id)
    tables.blacklist_rows.append(batch_id, ads.ad_blacklist_update(counts, listed, threshold))


def store_user_counts(
    updates: DataFrame,
    batch_id: int,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
) -> None:
    """Store the running counts that a batch of the state store changed, list users.

    The counts include clicks of listed users. That lists the same users in the
    same batches, since no click of a user is filtered before the user is listed;
    rows of users listed earlier are left out here.
    """
    if tables.users_ledger.noted() != batch_id:
        listed = tables.blacklist(before=batch_id)
        fresh = rows_without_key(updates, listed, "userid").persist()
        try:
            tables.user_rows.stage(fresh, replacing(USER_KEYS))
            _list_users(fresh, batch_id, tables, threshold)
        finally:
            fresh.unpersist()
        tables.users_ledger.note(batch_id)
    tables.user_rows.publish()


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def start_ad_pipeline(
    lines: DataFrame,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    every: str | None = "5 seconds",
    count_users: bool = True,
) -> StreamingQuery:
    """Run the pipeline on a stream of lines.

    The checkpoint lies next to the tables, whose batches are its batch ids.
    ``every=None`` takes what is there, in batches, and stops.
    """
    return (
        lines.writeStream.foreachBatch(
            lambda batch, batch_id: process_batch(batch, batch_id, tables, threshold, count_users)
        )
        .option("checkpointLocation", f"{tables.folder}/checkpoint")
        .trigger(**_trigger(every))
        .start()
    )


def start_blacklist_query(
    lines: DataFrame,
    tables: AdTables,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Keep the per-user counts in the state store, the counts and list as tables."""
    return (
        user_daily_clicks_stream(parse_ad_log(lines))
        .writeStream.outputMode("update")
        .foreachBatch(
            lambda updates, batch_id: store_user_counts(updates, batch_id, tables, threshold)
        )
        .option("checkpointLocation", f"{tables.folder}/blacklist_checkpoint")
        .trigger(**_trigger(every))
        .start()
    )


def trailing_trend(tables: AdTables, minutes: int = ads.TREND_MINUTES) -> DataFrame:
    """The last ``minutes`` minutes of the trend table, up to its newest row.

    The newest day comes from partition values; only the days that the minutes
    can reach are read for the newest minute and the counts.
    """
    rows = tables.click_trend()
    newest_day = F.to_date(rows.agg(F.max("date")).scalar(), "yyyyMMdd")
    oldest_day = F.date_format(F.date_sub(newest_day, -(-minutes // 1440)), "yyyyMMdd")
    recent = rows.where(F.col("date") >= oldest_day)
    minute = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
    newest = recent.agg(F.max(minute)).scalar()
    return recent.where(minute >= newest - F.make_dt_interval(mins=F.lit(minutes - 1)))
